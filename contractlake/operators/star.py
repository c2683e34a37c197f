"""Star publication.

From normalized payload rows (``operators.payload.normalize_payloads``):
  * rejected contracts are set aside first with the first failing rule (K7 / K8), so a contract
    is published whole or not at all;
  * parent ids are dense in ``event_id`` order (G1), children ids dense in (event_id, position);
  * children receive ``contrato_id`` by an equi-join on the natural key ``event_id`` (E3);
  * every row gets audit columns created_at = updated_at = as_of, is_active = true (D12).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contractlake.functions.scalars import AS_OF, as_of_ts, py_strip
from contractlake.operators import payload as P
from contractlake.operators.ids import assign_dense_ids
from contractlake.session import saved
from contractlake.sources.buckets import read_or_empty

STAR_TABLES = ["contrato", "compania_info", "proveedores_info", "representantes", "entidades", "multas"]


def audit(df: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """D12 audit columns."""
    ts = as_of_ts(as_of)
    return (df.withColumn("created_at", ts).withColumn("updated_at", ts)
            .withColumn("is_active", F.lit(True)))


def contract_rows(norm: DataFrame, start: int = 1) -> DataFrame:
    """Parent table ``contrato`` (B10 + G1): id, event_id, 16 contract columns."""
    acc = P.accepted(norm, "event_id", "contract").select("event_id", "contract.*")
    return assign_dense_ids(acc, ["event_id"], "id", start).select("id", "event_id", *[
        c for c in acc.columns if c != "event_id"])


def parent_keys(contracts: DataFrame) -> DataFrame:
    return contracts.select(F.col("event_id"), F.col("id").alias("contrato_id"))


def attach_parent_key(children: DataFrame, contracts: DataFrame) -> DataFrame:
    """Children keyed by ``event_id`` receive ``contrato_id`` (inner equi-join)."""
    return children.join(parent_keys(contracts), "event_id")


def _child_ids(children: DataFrame, contracts: DataFrame, cols: list[str], start: int = 1) -> DataFrame:
    # Contract ids are monotone in event_id, so (event_id, pos) order == (contrato_id, pos) order:
    # child ids do not wait for the parent join.
    with_ids = assign_dense_ids(children, ["event_id", "pos"], "id", start)
    return attach_parent_key(with_ids, contracts).select("id", "contrato_id", *cols)


def company_rows(norm: DataFrame, contracts: DataFrame, start: int = 1) -> DataFrame:
    """L1: one company row per accepted contract (empty section never reaches here, C8)."""
    rows = P.accepted(norm, "event_id", "company").select("event_id", F.lit(0).alias("pos"), "company.*")
    return _child_ids(rows, contracts, ["nombre", "rut", "domicilio"], start)


def provider_rows(norm: DataFrame, contracts: DataFrame, start: int = 1) -> DataFrame:
    """One provider row per accepted contract: the first provider only (T4)."""
    rows = P.accepted(norm, "event_id", "provider").select("event_id", F.lit(0).alias("pos"), "provider.*")
    return _child_ids(rows, contracts, ["nombre", "rut", "domicilio"], start)


def rep_rows(norm: DataFrame, contracts: DataFrame, start: int = 1) -> DataFrame:
    """Representatives (C9, D8) renamed for storage (D11: cedula_identidad -> cedula_de_identidad)."""
    rows = P.explode_reps(norm).withColumnRenamed("cedula_identidad", "cedula_de_identidad")
    return _child_ids(rows, contracts, ["nombre", "cedula_de_identidad"], start)


def entity_rows(norm: DataFrame, contracts: DataFrame, start: int = 1) -> DataFrame:
    """Entities (C11, B7; row-level failures skipped, K7)."""
    return _child_ids(P.explode_entities(norm), contracts, ["tipo", "valor"], start)


def fine_rows(norm: DataFrame, contracts: DataFrame, start: int = 1) -> DataFrame:
    """Fines (C10, B6, D3; row-level failures skipped, K7)."""
    return _child_ids(P.explode_fines(norm), contracts,
                      ["tipo_incumplimiento", "implicancias", "monto_multa_uf", "plazo_constancia",
                       "descripcion_completa"], start)


@dataclass
class Star:
    contrato: DataFrame
    compania_info: DataFrame
    proveedores_info: DataFrame
    representantes: DataFrame
    entidades: DataFrame
    multas: DataFrame
    rejected: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t) for t in STAR_TABLES}


def build_star(norm: DataFrame, as_of: str = AS_OF, starts: dict[str, int] | None = None) -> Star:
    """A6 + K8: the six star tables plus the rejected-contract table, with audit columns.

    ``starts`` gives the first id per table when appending to existing tables (max(id)+1).
    """
    st = starts or {}
    contracts = contract_rows(norm, st.get("contrato", 1))
    return Star(
        contrato=audit(contracts, as_of),
        compania_info=audit(company_rows(norm, contracts, st.get("compania_info", 1)), as_of),
        proveedores_info=audit(provider_rows(norm, contracts, st.get("proveedores_info", 1)), as_of),
        representantes=audit(rep_rows(norm, contracts, st.get("representantes", 1)), as_of),
        entidades=audit(entity_rows(norm, contracts, st.get("entidades", 1)), as_of),
        multas=audit(fine_rows(norm, contracts, st.get("multas", 1)), as_of),
        rejected=rejected_contracts(norm),
    )


def one_per_event(payloads: DataFrame) -> DataFrame:
    """One payload per event id, the smallest by text: a repeated event must not become two contracts. A pre-aggregated
    minimum, so an id that holds a large share of the rows doesn't land in one task."""
    return payloads.groupBy("event_id").agg(F.min("payload").alias("payload"))


MANIFEST_SCHEMA = "version bigint, folder string, tables array<struct<name:string,ddl:string>>"


def _write(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def publish_batch(star: Star, location: str, batch_id: int) -> Star:
    """A6 for one batch of a stream: each table's partition of that batch is replaced, so writing a batch again changes
    nothing. Returns the tables with all their batches."""
    out = {}
    for name, df in {**star.tables(), "rejected": star.rejected}.items():
        path = f"{location.rstrip('/')}/{name}"
        _write(df, f"{path}/batch_id={batch_id}", "overwrite")
        out[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return Star(**out)


def publish(star: Star, location: str) -> Star:
    """A6 + K8: write the six tables and the rejects as a new version below ``location`` and return them read back.

    Each attempt writes to a folder of its own. The manifest gets one row when all tables are whole, and readers
    follow the manifest: a crash between any two writes leaves them on the version before, and what the attempt
    wrote is never read. One writer at a time; of two that race, both versions are whole and the later folder name wins.
    """
    spark, root = star.contrato.sparkSession, location.rstrip("/")
    versions = read_or_empty(spark, f"{root}/manifest", MANIFEST_SCHEMA).agg(F.max("version")).first()
    version = (versions[0] or 0) + 1
    folder = f"version-{version}-{uuid.uuid4().hex}"
    tables = {**star.tables(), "rejected": star.rejected}
    for name, df in tables.items():
        _write(df, f"{root}/{folder}/{name}")
    entries = [(name, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)) for name, df in tables.items()]
    record = spark.createDataFrame([(version, folder, entries)], MANIFEST_SCHEMA).coalesce(1)
    _write(record, f"{root}/manifest", "append")
    return read_star(spark, location, version)


def read_star(spark: SparkSession, location: str, version: int | None = None) -> Star:
    """The star as published: its newest whole version, or an earlier one."""
    root = location.rstrip("/")
    rows = read_or_empty(spark, f"{root}/manifest", MANIFEST_SCHEMA)
    if version is not None:
        rows = rows.filter(F.col("version") == version)
    newest = rows.agg(F.max_by(F.struct("folder", "tables"), F.struct("version", "folder")).alias("r")).first()["r"]
    if newest is None:
        raise ValueError(f"no published version{'' if version is None else f' {version}'} in {location}")
    return Star(**{t["name"]: spark.read.schema(t["ddl"]).parquet(f"{root}/{newest['folder']}/{t['name']}") for t in newest["tables"]})


def write_star(payloads: DataFrame, location: str, as_of: str = AS_OF) -> Star:
    """A6 as one batch: payload rows (event_id, payload) -> one per event -> normalized once -> published tables."""
    norm = saved(P.normalize_payloads(one_per_event(payloads)), "normalized")
    return publish(build_star(norm, as_of), location)


def rejected_contracts(norm: DataFrame) -> DataFrame:
    """K7 / K8 contract-level rejects with their first failing rule."""
    return P.rejected(norm, "event_id").select("event_id", "reason")


def status_rows(norm: DataFrame, contracts: DataFrame) -> DataFrame:
    """Result record per payload: success with contract id, else error with reason (T16: always
    ``reason``, never ``error``)."""
    keys = parent_keys(contracts)
    return (norm.select("event_id", "reason").join(keys, "event_id", "left")
            .select("event_id",
                    F.when(F.col("reason") == P.OK, "success").otherwise("error").alias("status"),
                    F.when(F.col("reason") != P.OK, F.col("reason")).alias("reason"),
                    F.col("contrato_id").alias("contract_id")))


# ---------------------------------------------------------------------------
# Dormant representative path (E2, G2, B8, D7, T18: canonical names are used)
# ---------------------------------------------------------------------------

def valid_reps(reps: DataFrame) -> DataFrame:
    """Drop representatives with an empty name or national id (after trim)."""
    return reps.filter((py_strip(F.col("nombre")) != "") & (py_strip(F.col("cedula_de_identidad")) != ""))


def first_rep_wins(reps: DataFrame, contract_col: str = "contrato_id") -> DataFrame:
    """Within a contract the first row (lowest position) with a given national id is kept.
    Window partitioned by (contract, id): groups are bounded by one payload."""
    w = Window.partitionBy(contract_col, "cedula_de_identidad").orderBy("pos")
    return reps.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def resolve_existing_reps(new_reps: DataFrame, existing: DataFrame, next_start: int = 1) -> DataFrame:
    """Reuse the id of an active representative with the same (contrato_id, national id),
    otherwise assign a new dense id. Returns (contrato_id, pos, nombre, cedula_de_identidad, id,
    reused)."""
    active = (existing.filter("is_active")
              .groupBy("contrato_id", "cedula_de_identidad").agg(F.min("id").alias("existing_id")))
    cand = first_rep_wins(valid_reps(new_reps)).join(active, ["contrato_id", "cedula_de_identidad"], "left")
    fresh = assign_dense_ids(cand.filter(F.col("existing_id").isNull()).drop("existing_id"),
                             ["contrato_id", "pos"], "id", next_start).withColumn("reused", F.lit(False))
    reused = (cand.filter(F.col("existing_id").isNotNull())
              .withColumn("id", F.col("existing_id")).drop("existing_id").withColumn("reused", F.lit(True)))
    return fresh.unionByName(reused)
