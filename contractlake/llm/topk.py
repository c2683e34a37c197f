"""Exact top-k search by inner product: columnar branch and bound.

Vectors are packed into blocks in vertical layout (one row of the block per dimension). A query adds up its products
dimension block by dimension block. The mass that is left bounds what a candidate can still gain or lose (the product of
the two remaining norms), so candidates whose best possible score lies below the k-th best certain score are
dropped and the survivors are compacted before the next dimension block. The best scores of earlier blocks carry over.

Queries are a stated set that grows with the table, so neither side is broadcast: blocks of queries and blocks of
candidates meet in a grid of cells of bounded size. Each cell returns at most k rows per query.

Contract: a component x counts as floor(1024 * x). Vectors that are null, empty or hold null or non-finite components
take no part; only vectors of equal length are compared. Rows with the query's id are its own. A repeated query row
is one query; repeated candidates each count. Ties go to the smaller id. Products outside 64 bits are clipped. Null
ids take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlake.llm.stage import saved

SCALE = 1024
BLOCK_ROWS, QUERY_ROWS, DIMS_AT_ONCE = 4096, 1024, 8
#: Blocks of candidates and of queries that meet in one cell of the grid, as far as there are no more than MOST_CELLS rows of cells.
CELL_BLOCKS, CELL_QUERIES, MOST_CELLS = 4, 8, 4096
EXACT = float(1 << 53)


def pack(rows: DataFrame, id_col: str, vector_col: str, block_rows: int) -> DataFrame:
    """Rows (block, dim, ids, vals): scaled vectors of one length, at most ``block_rows`` of them, dimension by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list] = {}

        def block(dim: int, found: list) -> pa.RecordBatch:
            nonlocal number
            number += 1
            ids, vectors = np.array([i for i, _ in found], dtype=np.int64), np.array([v for _, v in found])
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                                               pa.array([np.ascontiguousarray(vectors.T).tobytes()], pa.binary())], names=["block", "dim", "ids", "vals"])

        for batch in batches:
            for i, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not vector.is_valid or not len(vector.values) or vector.values.null_count:
                    continue
                v = np.floor(vector.values.to_numpy().astype(np.float64) * SCALE)
                if np.isfinite(v).all():
                    found = waiting.setdefault(len(v), [])
                    found.append((i, v))
                    if len(found) == block_rows:
                        yield block(len(v), waiting.pop(len(v)))
        for dim, found in waiting.items():
            yield block(dim, found)

    return rows.select(id_col, vector_col).mapInArrow(run, "block long, dim int, ids binary, vals binary")


def rest_norms(vals: np.ndarray) -> np.ndarray:
    """Row k: norm of what comes from dimension block k on (last row: nothing left)."""
    mass = np.add.reduceat(vals * vals, np.arange(0, len(vals), DIMS_AT_ONCE), axis=0)
    return np.sqrt(np.concatenate((np.cumsum(mass[::-1], axis=0)[::-1], np.zeros((1, vals.shape[1])))))


def search(query: np.ndarray, own: int, ids: np.ndarray, vals: np.ndarray, rest: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of all candidates that may be among the best k, with exact scores; none with a score under ``floor``."""
    left = rest_norms(query[:, None])[:, 0]
    at = np.flatnonzero(ids != own)
    score, part, bound = np.zeros(len(at)), vals[:, at] if len(at) < len(ids) else vals, rest[:, at]
    for b, d in enumerate(range(0, len(query), DIMS_AT_ONCE)):
        score = score + query[d:d + DIMS_AT_ONCE] @ part[d:d + DIMS_AT_ONCE]
        swing = left[b + 1] * bound[b + 1]
        bar = floor
        if len(score) > k:
            bar = max(bar, np.partition(score - swing, len(score) - k)[len(score) - k])
        keep = score + swing >= bar - 1e-9 * abs(bar) - 1e-3
        if 2 * np.count_nonzero(keep) < len(keep) or b + 1 == len(rest) - 1:
            at, score, part, bound = at[keep], score[keep], part[:, keep], bound[:, keep]
    return ids[at], score


def plain_scores(query: np.ndarray, own: int, ids: np.ndarray, vals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``search``, without bounds, for numbers that doubles can't add exactly."""
    at = np.flatnonzero(ids != own)
    exact = [sum(int(a) * int(b) for a, b in zip(query, vals[:, i])) for i in at]
    return ids[at], np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in exact], dtype=object)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if scores.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (-int(scores[i]), int(ids[i])))[:k], dtype=np.int64)
    else:
        order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def top_k(table: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for every row with ``is_query`` its k best other rows."""
    blocks = saved(pack(table, id_col, vector_col, BLOCK_ROWS), "candidates")
    asked = saved(pack(table.where(is_query).select(id_col, vector_col).distinct(), id_col, vector_col, QUERY_ROWS), "queries")
    down = min(MOST_CELLS, max(1, math.ceil(blocks.count() / CELL_BLOCKS)))
    across = max(1, math.ceil(asked.count() / CELL_QUERIES))
    spread = min(down * across, max(64, 4 * table.sparkSession.sparkContext.defaultParallelism))
    grid = ["dim", "row", "col"]
    left = blocks.select("dim", F.pmod(F.xxhash64("block"), F.lit(down)).alias("row"), F.explode(numbers(across)).alias("col"), "ids", "vals")
    right = asked.select("dim", F.explode(numbers(down)).alias("row"), F.pmod(F.xxhash64("block"), F.lit(across)).alias("col"),
                         F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("vals").alias("qvals"))
    cells = left.repartition(spread, *grid).join(right.repartition(spread, *grid).hint("merge"), grid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, list] = {}  # the best so far of each query of the cell at hand

        def flush() -> Iterator[pa.RecordBatch]:
            out = [(q, int(i), int(s)) for (_, _, q), (found, scores) in kept.items() for i, s in zip(found, scores)]
            kept.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["query_id", "vec_id", "score"])

        cell = None
        for batch in batches:
            for dim, row, col, ids, vals, qblock, qids, qvals in zip(*(batch.column(c) for c in range(8))):
                dim, here = dim.as_py(), (dim.as_py(), row.as_py(), col.as_py())
                if here != cell:
                    yield from flush()
                    cell = here
                ids, vals = np.frombuffer(ids.as_py(), np.int64), np.frombuffer(vals.as_py()).reshape(dim, -1)
                qids, qvals = np.frombuffer(qids.as_py(), np.int64), np.frombuffer(qvals.as_py()).reshape(dim, -1)
                rest = rest_norms(vals)
                wide = rest[0].max() * np.sqrt((qvals * qvals).sum(axis=0)).max() >= EXACT
                for n, q in enumerate(qids.tolist()):
                    key = (qblock.as_py(), n, q)
                    before = kept.get(key)
                    if wide:
                        found, scores = plain_scores(qvals[:, n], q, ids, vals)
                    else:
                        full = before is not None and len(before[1]) == k
                        found, scores = search(qvals[:, n], q, ids, vals, rest, k, float(before[1][-1]) if full else -math.inf)
                    if before is not None:
                        found, scores = np.concatenate((before[0], found)), np.concatenate((before[1], scores))
                    kept[key] = best(found, scores, k)
        yield from flush()

    found = cells.select(*grid, "ids", "vals", "qblock", "qids", "qvals").mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
