"""SimHash near-duplicates by a binary-trie self-join.

A document's fingerprint has bit i set where more than half of its shingle hashes have. The distinct fingerprints
form a binary trie. Pairs of trie nodes are walked down together, the differing bits so far are carried along, and a
pair is dropped as soon as they exceed the budget. The top of the trie (prefixes of 16 bits at most, counted by Spark)
is cut into units of bounded size; pairs of units within the budget are dealt out as rows, and each task walks the two
subtrees of its rows. Units whose prefix can't be cut further are cut into tiles by hash, so a crowded prefix never
lands in one task. Tasks emit a spanning chain of the linked groups, not all pairs.

Contract: null and empty texts (and texts of white space only) have fingerprint zero, which links like any other;
texts with fewer words than a shingle are one shingle; repeated shingles count each time; exact copies share one trie
leaf; repeated rows stay repeated rows of one component; a null id never becomes a component's name while another
id is there. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlake.llm.components import connected_components
from contractlake.llm.stage import free, saved

SEED = 42
TOP_BITS = 16
#: Shingles hashed at a time, and node pairs walked at a time: bounds on a task's memory, not on what it handles.
SHINGLES_AT_ONCE, PAIRS_AT_ONCE = 1 << 16, 1 << 19
#: Fingerprints of a unit at least, and units at most (apart from tiles).
UNIT_ROWS, UNITS = 4096, 2048


def fingerprint(text: bytes, words_per_shingle: int) -> bytes:
    """The 64-bit fingerprint (8 bytes, big-endian) of one whole text."""
    words = text.lower().split()  # of bytes: lower-cases A-Z, splits at ASCII white space
    if not words:
        return bytes(8)
    k = min(words_per_shingle, len(words))
    ones, total, digest = np.zeros(64, dtype=np.int64), len(words) - k + 1, xxhash.xxh64_digest
    for at in range(0, total, SHINGLES_AT_ONCE):
        some = words[at:at + SHINGLES_AT_ONCE + k - 1]
        joined = b" ".join(some)
        ends = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1)
        starts = np.concatenate(([0], ends[:-k])).tolist()
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, (ends[k - 1:] - 1).tolist())])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        lanes = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(bits), 255), axis=0)  # byte counters of up to 255 rows
        ones += lanes.view(np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total).tobytes()


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp): the fingerprint as a signed long. One pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = b"".join(fingerprint(v.as_py() or b"", words_per_shingle) for v in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.frombuffer(prints, ">i8").astype(np.int64))], names=[id_col, "fp"])

    return docs.select(id_col, F.col(text_col).cast("binary").alias("_bytes")).mapInArrow(run, f"{id_col} {id_type}, fp long")


def walk(a: np.ndarray, b: np.ndarray, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with at most ``budget`` differing bits between the sorted arrays a and b; i < j where both are the same."""
    if not len(a) or not len(b):
        return
    one = lambda v: np.array([v], dtype=np.int64)
    stack = [(0, one(0), one(len(a)), one(0), one(len(b)), np.zeros(1, dtype=np.int8))]
    below: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def zeros_before(x: np.ndarray, depth: int) -> np.ndarray:
        return np.concatenate(([0], np.cumsum((x >> np.uint64(63 - depth)) & np.uint64(1) == 0)))

    while stack:
        depth, alo, ahi, blo, bhi, errors = stack.pop()
        if len(alo) > PAIRS_AT_ONCE:
            h = len(alo) // 2
            stack += [(depth, alo[:h], ahi[:h], blo[:h], bhi[:h], errors[:h]), (depth, alo[h:], ahi[h:], blo[h:], bhi[h:], errors[h:])]
            continue
        small = (ahi - alo) * (bhi - blo) <= 4
        if depth == 64:
            small[:] = True
        if small.any():
            yield from _verified(a, b, alo[small], ahi[small], blo[small], bhi[small], budget, same)
            go = ~small
            alo, ahi, blo, bhi, errors = alo[go], ahi[go], blo[go], bhi[go], errors[go]
        if not len(alo):
            continue
        if depth not in below:
            za = zeros_before(a, depth)
            below[depth] = (za, za if same else zeros_before(b, depth))
        za, zb = below[depth]
        am, bm = alo + za[ahi] - za[alo], blo + zb[bhi] - zb[blo]
        twice = same & (alo == blo) & (ahi == bhi)  # a node beside itself: its (1, 0) children are its (0, 1) children
        parts = []
        for left, right, differ in ((0, 0, 0), (1, 1, 0), (0, 1, 1), (1, 0, 1)):
            l0, l1 = (am, ahi) if left else (alo, am)
            r0, r1 = (bm, bhi) if right else (blo, bm)
            keep = (l1 > l0) & (r1 > r0) & (errors + differ <= budget)
            if left and not right:
                keep &= ~twice
            parts.append((l0[keep], l1[keep], r0[keep], r1[keep], errors[keep] + np.int8(differ)))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*parts))))


def _verified(a, b, alo, ahi, blo, bhi, budget, same) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs below small node pairs that keep to the budget; large runs of equal-prefix nodes are taken piecewise."""
    sizes = (ahi - alo) * (bhi - blo)
    at, total = 0, np.concatenate(([0], np.cumsum(sizes)))
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS_AT_ONCE, side="right")) - 1)
        n = sizes[at:to]
        k = np.repeat(np.arange(at, to), n)
        off = np.arange(total[at], total[to]) - total[k]
        width = bhi[k] - blo[k]
        i, j = alo[k] + off // width, blo[k] + off % width
        good = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            good &= i < j
        if good.any():
            yield i[good], j[good]
        at = to


class Groups:
    """Linked groups of numbered items, merged in vector steps."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            low = np.minimum(label[i], label[j])
            if (label[i] == low).all() and (label[j] == low).all():
                return
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            while not np.array_equal(label, label[label]):
                label[:] = label[label]

    def chains(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of neighbours in each group: one less than its members."""
        order = np.argsort(self.label, kind="stable")
        joined = self.label[order[1:]] == self.label[order[:-1]]
        return order[:-1][joined], order[1:][joined]


def units_of(counts: dict[int, int], bits: int) -> tuple[list[tuple[int, int, int]], dict[int, int]]:
    """Cuts the top of the trie: [(prefix, depth, tiles)] in trie order, and the unit of each counted prefix of ``bits`` bits."""
    total = sum(counts.values())
    most = max(UNIT_ROWS, math.ceil(total / UNITS))
    weight = np.zeros(1 << bits, dtype=np.int64)
    for prefix, n in counts.items():
        weight[prefix] = n
    before = np.concatenate(([0], np.cumsum(weight)))
    units, unit_of, stack = [], {}, [(0, 0)]
    while stack:
        prefix, depth = stack.pop()
        lo, hi = prefix << (bits - depth), (prefix + 1) << (bits - depth)
        n = int(before[hi] - before[lo])
        if n > most and depth < bits:
            stack += [(2 * prefix + 1, depth + 1), (2 * prefix, depth + 1)]
        elif n:
            unit_of.update({p: len(units) for p in range(lo, hi) if weight[p]})
            units.append((prefix, depth, math.ceil(n / most)))
    return units, unit_of


def near_units(units: list[tuple[int, int, int]], bits: int, budget: int) -> pd.DataFrame:
    """Pairs (a, b) of tiles, a <= b, whose prefixes differ in at most ``budget`` bits as far as both go. Tiles are numbered through all units."""
    prefix = np.array([p << (bits - d) for p, d, _ in units], dtype=np.uint64)
    depth = np.array([d for _, d, _ in units], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum([t for _, _, t in units])))
    out_a, out_b = [], []
    for i in range(len(units)):
        shared = np.minimum(depth[i], depth[i:])
        j = i + np.flatnonzero(np.bitwise_count((prefix[i] ^ prefix[i:]) >> (bits - shared).astype(np.uint64)) <= budget)
        for t in range(first[i], first[i + 1]):
            tiles = np.concatenate([np.arange(max(t, first[k]), first[k + 1]) for k in j])
            out_a.append(np.full(len(tiles), t))
            out_b.append(tiles)
    return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def near_links(prints: DataFrame, budget: int) -> DataFrame:
    """Rows (src, dst): links that connect all distinct fingerprints (column fp) within ``budget`` bits of each other."""
    spark = prints.sparkSession
    top = F.shiftrightunsigned("fp", 64 - TOP_BITS)
    counts = {r["p"]: r["n"] for r in prints.groupBy(top.alias("p")).agg(F.count("*").alias("n")).collect()}  # 2**TOP_BITS rows at most
    if not counts:
        return prints.select(F.col("fp").alias("src"), F.col("fp").alias("dst"))
    units, unit_of = units_of(counts, TOP_BITS)
    first = np.concatenate(([0], np.cumsum([t for _, _, t in units]))).tolist()
    table = spark.createDataFrame(pd.DataFrame([(p, first[u], units[u][2]) for p, u in unit_of.items()], columns=["p", "first", "tiles"]),
                                  "p long, first long, tiles long")
    near = near_units(units, TOP_BITS, budget)
    tile = F.col("first") + F.pmod(F.xxhash64("fp"), F.col("tiles"))
    blocks = saved(prints.withColumn("p", top).join(F.broadcast(table), "p").groupBy(tile.alias("unit"))
                   .agg(F.sort_array(F.collect_list("fp")).alias("fps")), "trie-units")  # a tile holds a bounded number of fingerprints
    parts = int(min(len(near), max(64, 4 * spark.sparkContext.defaultParallelism, len(near) // 64)))
    work = (spark.createDataFrame(near, "a long, b long")
            .join(blocks.select(F.col("unit").alias("a"), F.col("fps").alias("fa")), "a")
            .join(blocks.select(F.col("unit").alias("b"), F.col("fps").alias("fb")), "b")
            .repartition(parts, "a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ka, kb, fa, fb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                a, b = (np.sort(x.values.to_numpy().astype(np.int64).view(np.uint64)) for x in (fa, fb))
                n = 0 if ka == kb else len(a)
                groups = Groups(n + len(b))
                for i, j in walk(a, b, budget, ka == kb):
                    groups.link(i, j + n)
                src, dst = groups.chains()
                values = (b if ka == kb else np.concatenate((a, b))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(values[src]), pa.array(values[dst])], names=["src", "dst"])

    return work.select("a", "b", "fa", "fb").mapInArrow(run, "src long, dst long")


def named_leaves(own: DataFrame, budget: int, id_col: str) -> DataFrame:
    """Rows (fp, least: its smallest id, root: a fingerprint that stands for the component, component_id), one per distinct fingerprint of ``own``."""
    leaves = saved(own.groupBy("fp").agg(F.min(id_col).alias("least")), "leaves")
    roots = connected_components(near_links(leaves.select("fp"), budget))
    linked = saved(leaves.join(roots, leaves["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "linked")
    names = saved(linked.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    return linked.join(names, "root")


def simhash_groups(docs: DataFrame, words_per_shingle: int = 3, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fingerprint as 16 hex digits, component_id: the smallest id that links reach), one per input row."""
    own = saved(fingerprints(docs, words_per_shingle, id_col, text_col), "fingerprints")
    by_print = saved(named_leaves(own, budget, id_col).select("fp", "component_id"), "components")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return own.join(by_print, "fp").select(id_col, digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 3, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, all columns, of each component: the first by id, rows without an id last, then by text, then by the other columns
    as JSON. Rows are told apart by their fingerprint, not by their id: an id whose texts are in several components stays for each
    of them that it is the smallest id of."""
    @F.arrow_udf("long")
    def print_of(texts: pa.Array) -> pa.Array:
        prints = b"".join(fingerprint(v.as_py() or b"", words_per_shingle) for v in texts)
        return pa.array(np.frombuffer(prints, ">i8").astype(np.int64))

    fp, first_fp, first_id, root, row = (free(c, docs) for c in ("_fp", "_first_fp", "_first_id", "_root", "_row"))
    printed = saved(docs.withColumn(fp, print_of(F.col(text_col).cast("binary"))), "printed")  # the fingerprint goes with its row: ids repeat
    named = named_leaves(printed.select(F.col(id_col).alias("id"), F.col(fp).alias("fp")), budget, "id")
    first = saved(named.where(F.col("least").eqNullSafe(F.col("component_id")))
                  .select(F.col("fp").alias(first_fp), F.col("component_id").alias(first_id), F.col("root").alias(root)), "first")
    may_stay = printed.join(first, (printed[fp] == first[first_fp]) & printed[id_col].eqNullSafe(first[first_id]))
    others = [F.col(c) for c in docs.columns if c not in (id_col, text_col)]
    order = F.struct(F.col(text_col), *([F.to_json(F.struct(*others))] if others else []))
    once = may_stay.groupBy(root).agg(F.min_by(F.struct(*docs.columns), order).alias(row))  # before the exchange, each part keeps a row per component
    return once.select(f"{row}.*")
