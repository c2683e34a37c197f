"""Embedding near-duplicates through spherical-cap filters.

Filter directions are random product codes: after a random rotation a vector is cut in two halves, each half has a
small random codebook, and a direction is a pair of codewords. A vector belongs to every filter whose direction it
exceeds by ``alpha`` standard deviations; these are list-decoded from the halves' scores (a first codeword is followed
only if the best second one could still lift it over the bar), never by trying all directions. Several independent codes
are used, and in each one a vector also takes its ``LEAST`` best filters, so that vectors in a thinly covered region are
found too. Vectors of one label that share a filter are compared in double precision.

Number of directions and bar follow from the largest label's count, so that filters keep ``OCCUPANCY`` vectors on
average at any size. Filters with more than ``TILE`` vectors are cut into tiles by hash and compared tile by tile. A
pair is counted in its smallest shared filter only, so nothing is emitted per pair: tasks return link counts and a
spanning chain of each linked group. Equal vectors are one vector with a count.

Contract: vectors that are null, empty, zero or hold null or non-finite components, and rows whose label is null, link
with nothing: no links, their own component, kept. Vectors of different length don't link. A null vec_id takes no part
(0 links, null component, not kept). Rows with equal label and vector, repeated rows included, are copies: each
counts the others as links. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlake.llm.components import connected_components
from contractlake.llm.simhash_trie import Groups
from contractlake.llm.stage import saved

CODES, PER_CODE, LEAST = 6, 2, 2
OCCUPANCY, TILE = 64, 512


@functools.lru_cache(maxsize=64)
def product_code(dim: int, code: int, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rotation, codebooks of the two halves); the same on every executor."""
    rng = np.random.default_rng([dim, code, words])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    half = (dim + 1) // 2
    books = [rng.standard_normal((words, k)) for k in (half, dim - half) if k]
    return rotation, [b / np.linalg.norm(b, axis=1, keepdims=True) / math.sqrt(len(books)) for b in books]


def list_decode(unit: np.ndarray, code: int, words: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all directions that rows of ``unit`` exceed, and of each row's LEAST best ones."""
    n, dim = unit.shape
    rotation, books = product_code(dim, code, words)
    turned, half = unit @ rotation, (dim + 1) // 2
    first = turned[:, :half] @ books[0].T * math.sqrt(dim)
    if len(books) == 1:
        row, a = np.nonzero((first >= alpha) | (first >= np.sort(first, axis=1)[:, [-min(LEAST, words)]]))
        return row, a
    second = turned[:, half:] @ books[1].T * math.sqrt(dim)
    top = second.max(axis=1)
    # the bar of a row: alpha, or the score of its LEAST-th best filter if that is lower
    best1, best2 = -np.sort(-first, axis=1)[:, :LEAST], -np.sort(-second, axis=1)[:, :LEAST]
    best = np.sort((best1[:, :, None] + best2[:, None, :]).reshape(n, -1), axis=1)
    bar = np.minimum(alpha, best[:, -min(LEAST, best.shape[1])]) - 1e-12
    row, a = np.nonzero(first + top[:, None] >= bar[:, None])
    hit, b = np.nonzero(first[row, a][:, None] + second[row] >= bar[row][:, None])
    return row[hit], a[hit] * words + b


def decode_all(vectors: np.ndarray, words: int, alpha: float) -> list[np.ndarray]:
    """The sorted filters of each vector over all codes."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rows, filters = zip(*(list_decode(unit, c, words, alpha) for c in range(CODES)))
    filters = np.concatenate([f + c * words * words for c, f in enumerate(filters)])
    rows = np.concatenate(rows)
    order = np.lexsort((filters, rows))
    return np.split(filters[order].astype(np.int32), np.cumsum(np.bincount(rows, minlength=len(unit)))[:-1])


def links_in(vectors: np.ndarray, copies: np.ndarray, filters: list[np.ndarray], here: int, tile: np.ndarray, least: float):
    """(counts, chain ends) of one filter: links >= least whose smallest shared filter is this one.

    Rows of the two tiles are compared across, or among themselves where there is one tile.
    """
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    own = tile == tile.min()
    left, right = np.flatnonzero(own), np.flatnonzero(own if own.all() else ~own)
    x, y = np.nonzero(unit[left] @ unit[right].T >= least)
    i, j = left[x], right[y]
    if own.all():
        i, j = i[i < j], j[i < j]
    counts, groups = np.zeros(len(unit), dtype=np.int64), Groups(len(unit))
    if len(i):
        used = np.unique(np.concatenate((i, j)))
        lower = [filters[u][filters[u] < here] for u in used]
        names, column = np.unique(np.concatenate(lower), return_inverse=True)
        member = np.zeros((len(used), len(names)), dtype=np.float32)
        member[np.repeat(np.arange(len(used)), [len(f) for f in lower]), column] = 1
        seen = (member @ member.T > 0)[np.searchsorted(used, i), np.searchsorted(used, j)]
        i, j = i[~seen], j[~seen]
        np.add.at(counts, i, copies[j])
        np.add.at(counts, j, copies[i])
        groups.link(i, j)
    return counts, groups.chains()


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(table: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per input row."""
    base = table.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda x: x + F.lit(0).cast("float")).alias("v"), F.col(label_col).alias("label"))
    base = base.withColumn("v", F.when(usable("v") & F.col("label").isNotNull() & F.col("id").isNotNull(), F.col("v")))
    base = base.withColumn("key", F.xxhash64("label", "v"))
    reps = saved(base.where("v is not null").groupBy("label", "key", "v").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vectors")
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0]
    if largest is None:
        return base.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    words = max(8, math.ceil(math.sqrt(largest * PER_CODE / OCCUPANCY)))
    alpha = NormalDist().inv_cdf(1 - min(0.25, PER_CODE / words ** 2))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None] * batch.num_rows
            sizes = np.array([len(v) for v in batch.column(1)])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                vectors = np.array([batch.column(1)[int(k)].as_py() for k in at], dtype=np.float64)
                for k, filters in zip(at, decode_all(vectors, words, alpha)):
                    found[k] = filters
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["rep", "filters"])

    lists = saved(reps.select("rep", "v").mapInArrow(decode, "rep long, filters array<int>")
                  .join(reps, "rep").select("rep", "label", F.size("v").alias("dim"), "v", "copies", "filters"), "decoded")
    light = lists.select("rep", "label", "dim", F.explode("filters").alias("filter"))
    cell = ["label", "dim", "filter"]
    shared = saved(light.groupBy(*cell).count().where("count > 1"), "cells")
    tiles = F.ceil(F.col("count") / TILE).cast("int")
    own = F.pmod(F.xxhash64("rep"), tiles).cast("int")
    dealt = light.join(shared, cell).select("rep", "filter", own.alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    dealt = saved(dealt.select("rep", "filter", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")), "dealt")
    v_type = reps.schema["v"].dataType.elementType.simpleString()

    def compare(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_numpy()
        vectors = group.column("v").combine_chunks().values.to_numpy().astype(np.float64).reshape(len(rep), -1)
        filters = [f.values.to_numpy() for f in group.column("filters")]
        counts, (a, b) = links_in(vectors, group.column("copies").to_numpy(), filters, group.column("filter")[0].as_py(), group.column("tile").to_numpy(), least)
        some = np.flatnonzero(counts)
        return pa.table({"src": np.concatenate((rep[some], rep[a])), "dst": np.concatenate((rep[some], rep[b])),
                         "n": np.concatenate((counts[some], np.zeros(len(a), dtype=np.int64)))})

    rows = dealt.join(lists.select("rep", "label", "dim", "v", "copies", "filters"), "rep")
    assert v_type in ("float", "double")
    found = saved(rows.groupBy("label", "dim", "filter", "low", "high").applyInArrow(compare, "src long, dst long, n long"), "compared")
    roots = connected_components(found.where("src <> dst"))
    added = saved(found.where("n > 0").groupBy("src").agg(F.sum("n").alias("n")), "counts")
    linked = saved(reps.join(roots, reps["rep"] == roots["node"], "left").select("rep", "label", "key", "v", "copies", F.coalesce("root", "rep").alias("root")), "linked")
    names = saved(linked.groupBy("root").agg(F.min("rep").alias("component_id")), "names")
    known = saved(linked.join(names, "root").join(added, linked["rep"] == added["src"], "left")
                  .select(F.col("key").alias("k2"), F.col("v").alias("v2"), F.col("label").alias("l2"), "component_id",
                          (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    out = base.join(known, (base["key"] == known["k2"]) & (base["v"] == known["v2"]) & (base["label"] == known["l2"]), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
