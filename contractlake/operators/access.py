"""Access paths and reports over the published star (SURVEY §2.5-2.6, 2.11: B9, E5, E6, F2, F4,
F7, M1-M8, L4).

The reference serves these with filtered B-tree indexes; here they are filters, aggregations and
equi-joins that Catalyst prunes and pushes into the Parquet scans. Children are always
pre-aggregated per contract before joining the parent (no row fan-out, no cross product).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active(df: DataFrame) -> DataFrame:
    """The soft-delete predicate every access path applies."""
    return df.filter(F.col("is_active"))


def contracts_by_type(contrato: DataFrame) -> DataFrame:
    """M1: active contracts by (contract type, service type): count and total amount."""
    return (active(contrato).groupBy("tipo_contrato", "tipo_servicio")
            .agg(F.count(F.lit(1)).alias("contracts"),
                 F.sum("monto_total").cast("decimal(38,2)").alias("total_amount")))


def contracts_in_range(contrato: DataFrame, start: str, end: str) -> DataFrame:
    """M2: active contracts whose start date falls in [start, end] (Parquet min/max pruning)."""
    return (active(contrato).filter(F.col("fecha_inicio").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .select("id", "event_id", "fecha_inicio", "fecha_termino"))


def fines_of_contract(multas: DataFrame, contrato: DataFrame) -> DataFrame:
    """M3: active fines with their contract's natural key."""
    return (active(multas).join(active(contrato).select(F.col("id").alias("contrato_id"), "event_id"), "contrato_id")
            .select("event_id", "contrato_id", F.col("id").alias("multa_id"), "tipo_incumplimiento", "monto_multa_uf"))


def fines_by_breach(multas: DataFrame) -> DataFrame:
    """M3: active fines by breach type."""
    return (active(multas).groupBy("tipo_incumplimiento")
            .agg(F.count(F.lit(1)).alias("fines"), F.try_sum("monto_multa_uf").cast("decimal(38,12)").alias("total_uf")))


def party_by_tax_id(party: DataFrame, contrato: DataFrame) -> DataFrame:
    """M4: contracts per company / provider tax id."""
    return (active(party).join(active(contrato).select(F.col("id").alias("contrato_id")), "contrato_id")
            .groupBy("rut").agg(F.count(F.lit(1)).alias("contracts"),
                                F.min("contrato_id").alias("first_contrato_id")))


def reps_by_national_id(reps: DataFrame) -> DataFrame:
    """M5: active representatives by national id: rows and distinct contracts."""
    return (active(reps).groupBy("cedula_de_identidad")
            .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("contrato_id").alias("contracts")))


def entities_by_type(ents: DataFrame) -> DataFrame:
    """M6: active entities by type; and by (type, name)."""
    return active(ents).groupBy("tipo").agg(F.count(F.lit(1)).alias("entities"),
                                            F.countDistinct("valor").alias("distinct_values"))


def entities_by_type_name(ents: DataFrame) -> DataFrame:
    return active(ents).groupBy("tipo", "valor").agg(F.count(F.lit(1)).alias("entities"))


def entity_attributes(ents: DataFrame) -> DataFrame:
    """Star-B ``atributos_entidad``: one (name, value) row per entity field (unpivot)."""
    return (active(ents).select(F.col("id").alias("entidad_id"), "contrato_id",
                                F.expr("stack(2, 'tipo', tipo, 'valor', valor) AS (nombre_atributo, valor)")))


def contract_entity_attributes(contrato: DataFrame, ents: DataFrame, attrs: DataFrame) -> DataFrame:
    """Contract ⋈ entity ⋈ attribute (two inner equi-joins)."""
    c = active(contrato).select(F.col("id").alias("contrato_id"), "event_id")
    e = active(ents).select(F.col("id").alias("entidad_id"), "contrato_id", "tipo")
    return (attrs.join(e, ["entidad_id", "contrato_id"]).join(c, "contrato_id")
            .select("event_id", "entidad_id", "tipo", "nombre_atributo", "valor"))


def attributes_by_name(attrs: DataFrame) -> DataFrame:
    """M7: attributes by name."""
    return attrs.groupBy("nombre_atributo").agg(F.count(F.lit(1)).alias("attributes"),
                                                F.countDistinct("entidad_id").alias("entities"))


def contracts_by_document(contrato: DataFrame) -> DataFrame:
    """M8: active contracts by document name."""
    return (active(contrato).filter(F.col("nombre").isNotNull())
            .groupBy("nombre").agg(F.count(F.lit(1)).alias("contracts"), F.min("id").alias("first_id")))


def with_metadata(contrato: DataFrame, metadata: DataFrame) -> DataFrame:
    """Star B's view of a contract: the parent row with its document's metadata (``contrato_id`` and a metadata record)."""
    return contrato.join(metadata.withColumnRenamed("contrato_id", "id"), "id", "left")


def contracts_by_reference(contratos: DataFrame) -> DataFrame:
    """M8: active contracts by document name and internal reference (star B has both, the second in no index of star A)."""
    return (active(contratos).filter(F.col("referencia_interna").isNotNull() | F.col("nombre_documento").isNotNull())
            .groupBy("nombre_documento", "referencia_interna").agg(F.count(F.lit(1)).alias("contracts"), F.min("id").alias("first_id")))


def _per_contract_count(df: DataFrame, name: str) -> DataFrame:
    return active(df).groupBy("contrato_id").agg(F.count(F.lit(1)).alias(name))


def section_counts(contrato: DataFrame, reps: DataFrame, multas: DataFrame, ents: DataFrame) -> DataFrame:
    """representatives, fines and entities per contract (each child pre-aggregated, then
    left-joined to the parent; missing -> 0)."""
    c = active(contrato).select(F.col("id").alias("contrato_id"), "event_id")
    for df, n in ((reps, "representantes"), (multas, "multas"), (ents, "entidades")):
        c = c.join(_per_contract_count(df, n), "contrato_id", "left")
    return c.fillna(0, ["representantes", "multas", "entidades"])


def fine_totals(multas: DataFrame) -> DataFrame:
    """count and UF sum per (contract, breach type)."""
    return (active(multas).groupBy("contrato_id", "tipo_incumplimiento")
            .agg(F.count(F.lit(1)).alias("fines"), F.try_sum("monto_multa_uf").cast("decimal(38,12)").alias("total_uf")))


def child_ids(children: DataFrame) -> DataFrame:
    """generated child ids per parent, sorted, as text (a contract's children are bounded by
    one payload, so the per-group list is bounded)."""
    return (active(children).groupBy("contrato_id")
            .agg(F.array_join(F.sort_array(F.collect_list("id")), ",").alias("ids")))


def star_view(contrato: DataFrame, compania: DataFrame, multas: DataFrame, reps: DataFrame) -> DataFrame:
    """E5: the documented nested output -- one row per contract with its company and fines,
    children pre-aggregated with ``collect_list(struct)`` (sorted by id) before the join."""
    c = active(contrato).select(F.col("id").alias("contrato_id"), "event_id", "tipo_contrato",
                                "parte_cliente", "monto_total", "fecha_inicio")
    comp = (active(compania).groupBy("contrato_id")
            .agg(F.min_by(F.struct("nombre", "rut"), "id").alias("compania")))
    fin = (active(multas).groupBy("contrato_id")
           .agg(F.sort_array(F.collect_list(F.struct("id", "tipo_incumplimiento", "monto_multa_uf"))).alias("multas")))
    rep = (active(reps).groupBy("contrato_id")
           .agg(F.sort_array(F.collect_list(F.struct("id", "nombre"))).alias("representantes")))
    return c.join(comp, "contrato_id", "left").join(fin, "contrato_id", "left").join(rep, "contrato_id", "left")


def star_view_full(view: DataFrame, proveedores: DataFrame, ents: DataFrame) -> DataFrame:
    """E5 with all of a contract's children: ``star_view`` with its provider and entities, pre-aggregated per contract."""
    prov = (active(proveedores).groupBy("contrato_id")
            .agg(F.array_sort(F.collect_list(F.struct("id", "nombre", "rut"))).alias("proveedores")))
    ent = (active(ents).groupBy("contrato_id")
           .agg(F.array_sort(F.collect_list(F.struct("id", "tipo", "valor"))).alias("entidades")))
    return view.join(prov, "contrato_id", "left").join(ent, "contrato_id", "left")


def _children_text(c: str, *fields: str) -> Column:
    """Children as text: their fields as id:field:field, none for NULL."""
    parts = F.transform(c, lambda x: F.concat_ws(":", x["id"].cast("string"), *[F.coalesce(x[f], F.lit("")) for f in fields]))
    return F.array_join(parts, "|").alias(c)


def star_view_full_flat(view: DataFrame) -> DataFrame:
    """A contract's providers and entities of ``star_view_full`` as comparable text columns."""
    return view.select("contrato_id", "event_id", _children_text("proveedores", "nombre", "rut"), _children_text("entidades", "tipo", "valor"))


def star_view_flat(view: DataFrame) -> DataFrame:
    """``star_view_full`` rendered as comparable text columns (for the oracle)."""
    return view.select(
        "contrato_id", "event_id", "tipo_contrato", "parte_cliente", "monto_total", "fecha_inicio",
        F.col("compania.nombre").alias("compania_nombre"), F.col("compania.rut").alias("compania_rut"),
        _children_text("multas", "tipo_incumplimiento"), _children_text("representantes", "nombre"),
        _children_text("proveedores", "nombre", "rut"), _children_text("entidades", "tipo", "valor"))


def active_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Active row count per star table."""
    out = None
    for name, df in tables.items():
        one = active(df).agg(F.count(F.lit(1)).alias("active_rows")).withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("table_name", "active_rows")
