"""Packing into length buckets that minimise padding.

The histogram of document lengths is counted over all rows. Dynamic programming over it chooses the bucket boundaries:
with k buckets, every document is padded to the longest length of its bucket, and no other choice of k boundaries pads
less. Inside each bucket documents are numbered without gaps and cut into batches of as many documents as the token
budget holds at the bucket's padded length (one, if a single document is over the budget: nothing is cut or dropped).

The histogram has a cell for each distinct length, rounded nowhere: it grows with the distinct lengths (n tokens in all have about
sqrt(2 n) of them at most), not with the rows, and the dynamic programme takes n log n steps for each bucket, in vector steps.
A bucket, or an id, may hold a third of all rows: they are numbered by ranges of (bucket, hash, id), which split both.

Contract: a token is a run of other than ASCII white space, a null or empty text has none and counts as length 0 (its
bucket pads to the longest of its documents, a bucket of empty texts to 0); equal lengths share a bucket; repeated
rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlake.llm.stage import saved
from contractlake.operators.ids import assign_dense_ids

BUCKETS, TOKEN_BUDGET = 16, 65536


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` ranges of the sorted ``lengths`` with the least padding in all."""
    n = len(lengths)
    if not n:
        return []
    length, rows = lengths.astype(np.float64), np.concatenate(([0.0], np.cumsum(counts.astype(np.float64))))
    # padding of cells i..j in one bucket is length[j] * (rows up to j - rows before i) less their own tokens, which no choice changes
    best, came = length * rows[1:], []
    for _ in range(1, min(buckets, n)):
        new, start = np.empty(n), np.empty(n, dtype=np.int64)
        # of the cells lo..hi, the best start of the middle one lies in a..b: starts never move back as the end moves on. All ranges of a level at once.
        lo, hi, a, b = (np.array([x]) for x in (0, n - 1, 0, n - 1))
        while len(lo):
            j = (lo + hi) // 2
            sizes = np.minimum(b, j) - a + 1
            first = np.cumsum(sizes) - sizes
            i = np.arange(sizes.sum()) - np.repeat(first - a, sizes)
            end = np.repeat(j, sizes)
            cost = np.where(i > 0, best[i - 1], 0.0) + length[end] * (rows[end + 1] - rows[i])
            new[j] = np.minimum.reduceat(cost, first)
            least = np.flatnonzero(cost == np.repeat(new[j], sizes))
            start[j] = k = i[least[np.searchsorted(least, first)]]
            left, right = lo < j, j < hi
            lo, hi, a, b = (np.concatenate(x) for x in ((lo[left], j[right] + 1), (j[left] - 1, hi[right]), (a[left], k[right]), (k[left], b[right])))
        came.append(start)
        best = new
    ends, j = [], n - 1
    for start in [*came[::-1], None]:
        if j < 0:
            break
        ends.append(int(lengths[j]))
        j = int(start[j]) - 1 if start is not None else -1
    return ends[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, bucket, padded_tokens, batch, slot), one per input row. Batches are numbered inside their bucket from 0, slots inside their batch."""
    rows = saved(docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("n_tokens"), F.monotonically_increasing_id().alias("row")), "lengths")
    found = sorted(tuple(r) for r in rows.groupBy("n_tokens").count().collect())  # a row per distinct length
    ends = boundaries(np.array([c for c, _ in found], dtype=np.int64), np.array([n for _, n in found], dtype=np.int64), buckets)
    bucket, padded = F.lit(None).cast("int"), F.lit(None).cast("long")
    for number, end in reversed(list(enumerate(ends))):
        inside = F.col("n_tokens") <= end
        bucket, padded = F.when(inside, F.lit(number)).otherwise(bucket), F.when(inside, F.lit(end).cast("long")).otherwise(padded)
    # documents are mixed inside their bucket by a hash; ``row`` tells equal ones apart, so that no id fills a partition
    placed = rows.select("id", "n_tokens", bucket.alias("bucket"), padded.alias("padded_tokens"), F.xxhash64("id", "n_tokens").alias("draw"), "row")
    ranked = assign_dense_ids(placed, ["bucket", "draw", "id", "n_tokens", "row"], "rank", start=0)
    first = ranked.groupBy("bucket").agg(F.min("rank").alias("first"))  # a row for each bucket
    numbered = ranked.join(F.broadcast(first), "bucket").withColumn("_k", F.col("rank") - F.col("first"))
    room = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest("padded_tokens", F.lit(1)))).cast("long")
    return numbered.select(F.col("id").alias(id_col), "n_tokens", "bucket", "padded_tokens", F.floor(F.col("_k") / room).cast("long").alias("batch"), (F.col("_k") % room).cast("long").alias("slot"))
