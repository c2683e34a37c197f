"""Merkle manifest of a dataset by time-forward processing.

A leaf is the digest of a row's fields. The leaves of a group ascend by id; every two consecutive nodes become their parent (a
last one alone too) until one remains, the group's subroot, and the subroots, ordered by group, give the root the same way.

The trees are evaluated like a circuit whose gates are taken in the order of their labels. A node's label is (last leaf that it
covers, level): children come before their parent, and whatever waits for a parent fits a queue of a few entries. Each digest is
sent forward to its parent through a priority queue ordered by label. The queue is external: digests that cross a task are rows,
which Spark shuffles and sorts by (group, cell, position), and a task keeps a heap for those that it sends to itself. A cell is
a complete subtree of ``CELL`` nodes of one level; a round of cells lifts the trees by log2(CELL) levels, so a few rounds do.
A second sweep goes through the labels backwards, from the root: each node sends its children the proof that it was
sent, with the sibling's digest in front, until the leaves have theirs. Rows of a cell are sorted behind the proof that came for it.

Memory is bounded by a cell, whatever a group's share of the rows. Repeated rows and ids are leaves each, in an order fixed by
(id, leaf); leaves that agree in both swap places without a trace.

Contract: a null id comes first in its group, a null group before the others; nulls hash as ``-``, other values by their UTF-8
length and text, so no two rows of fields are confused; a lone leaf is its subroot, a lone subroot the root; an empty table gives
an empty manifest. Columns beside those named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlake.llm.stage import broadcast_if_small, saved
from contractlake.operators.ids import assign_dense_ids

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: log2 of the nodes that a task takes together.
CELL_LEVELS = 12
PROOF = "array<struct<left:boolean,digest:string>>"


def leaf(fields: dict[str, Column]) -> Column:
    """Lowercase hex SHA-256 over all ``fields``, each ``-`` if null, else its length in UTF-8 bytes, a colon and its text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in fields.values()]), 256)


def parent(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def lift(digests: list[str], levels: int | None, seen: Callable[[int, int, str], None] = lambda *_: None) -> str:
    """The node over ``digests``, ``levels`` up, or if None where only one remains. Forward sweep: gates fire in label order, and what a
    gate sends waits in a queue ordered by its receiver's label. ``seen`` is told each node's level, place in it and digest."""
    last = len(digests) - 1
    queue: list[tuple[tuple[int, int], int, str]] = []

    def send(level: int, place: int, digest: str) -> str:
        seen(level, place, digest)
        if level < levels if levels is not None else last >> level:
            end = ((place // 2 + 1) << (level + 1)) - 1
            heapq.heappush(queue, ((min(end, last), level + 1), place, digest))
        return digest

    top = ""
    for leaf_place, digest in enumerate(digests):
        top = send(0, leaf_place, digest)
        while queue and queue[0][0][0] <= leaf_place:
            label, place, digest = heapq.heappop(queue)
            children = [digest]
            if queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            top = send(label[1], place // 2, parent(children))
    return top


def proofs(digests: list[str], levels: int | None, above: list) -> Iterator[list]:
    """Of each of ``digests``, last one first, the proof from there up: for each level (left, sibling's digest), or None where it is alone,
    then ``above``. Reverse sweep: labels fall, and a node's proof goes to its children with the sibling in front."""
    nodes: dict[tuple[int, int], str] = {}
    lift(digests, levels, lambda level, place, digest: nodes.__setitem__((level, place), digest))
    last, top = len(digests) - 1, max(level for level, _ in nodes)
    queue: list[tuple[tuple[int, int], int, list]] = [((-last, -top), 0, above)]
    while queue:
        (_, level), place, proof = heapq.heappop(queue)
        if level == 0:
            yield proof
            continue
        below = -level - 1
        for child in (2 * place, 2 * place + 1):
            if (below, child) in nodes:
                sibling = nodes.get((below, child ^ 1))
                step = None if sibling is None else (bool(child & 1), sibling)
                end = min(((child + 1) << below) - 1, last)
                heapq.heappush(queue, ((-end, -below), child, [step, *proof]))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (tree, cell), from batches sorted by them."""
    open_rows: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        trees, cells = batch["tree"].to_numpy(), batch["cell"].to_numpy()
        starts = [0, *(np.flatnonzero((trees[1:] != trees[:-1]) | (cells[1:] != cells[:-1])) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(starts, starts[1:]):
            at = (trees[lo], cells[lo])
            if open_rows and at != key:
                yield pa.Table.from_batches(open_rows)
                open_rows = []
            key = at
            open_rows.append(batch.slice(lo, hi - lo))
    if open_rows:
        yield pa.Table.from_batches(open_rows)


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of rows (tree, cell, place, digest, nodes) -> (tree, place, digest, done), the node over each."""
    names, out = ["tree", "place", "digest", "done"], []
    for cell in _cells(batches):
        done = cell["nodes"][0].as_py() <= 1 << CELL_LEVELS
        top = lift(cell["digest"].to_pylist(), None if done else CELL_LEVELS)
        out.append((cell["tree"][0].as_py(), cell["cell"][0].as_py(), top, done))
        if len(out) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)


def _steps(found: list[list]) -> pa.Array:
    flat = [step for proof in found for step in proof]
    alone = np.array([step is None for step in flat], dtype=bool)
    fields = [pa.array([step and step[0] for step in flat], pa.bool_()), pa.array([step and step[1] for step in flat], pa.string())]
    ends = np.concatenate(([0], np.cumsum([len(proof) for proof in found], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["left", "digest"], mask=pa.array(alone)))


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of node rows behind the row with the proof that came for the cell -> the node rows, each with its own proof."""
    for cell in _cells(batches):
        above = [s and (s["left"], s["digest"]) for s in cell["above"][0].as_py()]
        rows = cell.slice(1)
        levels = None if rows["nodes"][0].as_py() <= 1 << CELL_LEVELS else CELL_LEVELS
        found = list(proofs(rows["digest"].to_pylist(), levels, above))[::-1]
        rows = rows.drop_columns(["cell", "nodes", "above"])
        for lo in range(0, rows.num_rows, 1024):
            some = rows.slice(lo, 1024)
            for batch in some.append_column("proof", _steps(found[lo:lo + 1024])).combine_chunks().to_batches():
                yield batch


def _in_cells(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "cell").sortWithinPartitions("tree", "cell", F.col("place").asc_nulls_first())


def _forward(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Forward sweep over rows (tree, place, digest, nodes): each round's rows, and (tree, digest, round) of each tree's top."""
    rounds, tops, more = [], None, True
    while more:
        rounds.append(nodes.withColumn("cell", F.shiftright("place", CELL_LEVELS)))
        up = _in_cells(rounds[-1].select("tree", "cell", "place", "digest", "nodes")).mapInArrow(_up, "tree long, place long, digest string, done boolean")
        up = saved(up, "manifest-round")
        done = up.where("done").select("tree", "digest", F.lit(len(rounds) - 1).alias("round"))
        tops = done if tops is None else tops.unionByName(done)
        up = up.where("not done").drop("done")
        if more := not up.isEmpty():
            counts = saved(up.groupBy("tree").agg(F.count(F.lit(1)).alias("nodes")), "manifest-counts")
            nodes = up.join(broadcast_if_small(counts), "tree")
    return rounds, saved(tops, "manifest-tops")


def _backward(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Reverse sweep. ``above`` has (tree, round, above) for each tree's top; the first round's rows come back with their proof."""
    sent: DataFrame | None = None
    for k, nodes in reversed(list(enumerate(rounds))):
        heads = above.where(F.col("round") == k).select("tree", F.lit(0).cast("long").alias("cell"), "above")
        if sent is not None:
            heads = heads.unionByName(sent.select("tree", F.col("place").alias("cell"), F.col("proof").alias("above")))
        both = _in_cells(heads.unionByName(nodes, allowMissingColumns=True))
        out = T.StructType([f for f in both.schema.fields if f.name not in ("cell", "nodes", "above")]).add("proof", both.schema["above"].dataType)
        order = ["tree", "cell", "above", *[f.name for f in out.fields if f.name not in ("tree", "proof")], "nodes"]
        sent = both.select(*order).mapInArrow(_down, T.StructType([out[c] for c in order if c in out.names] + [out["proof"]]))
        if k:
            sent = saved(sent, "manifest-proofs")
    return sent


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", also: dict[str, Column] | None = None) -> DataFrame:
    """Rows (id, group, leaf, place, subroot, root, proof), one per row of ``docs``, with the columns ``also`` carried along.

    ``proof`` holds a step for each level from the leaf by the subroot to the root: the sibling's digest and whether it stands
    left, or null where the node was alone.
    """
    also = also or {}
    extra = [f"also_{k}" for k in also]
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf({c: F.col(c) for c in fields}).alias("digest"),
                       *[c.alias(f"also_{k}") for k, c in also.items()], F.monotonically_increasing_id().alias("row"))
    ranked = assign_dense_ids(saved(rows, "manifest-leaves"), ["grp", "id", "digest", "row"], "rank", start=0)
    trees = assign_dense_ids(ranked.groupBy("grp").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("nodes")), ["grp"], "tree", start=0)
    known = broadcast_if_small(trees.select(F.col("grp").alias("name"), "first", "nodes", "tree"))
    placed = ranked.join(known, F.col("grp").eqNullSafe(F.col("name"))).select("tree", (F.col("rank") - F.col("first")).alias("place"), "nodes", "id", "digest", *extra)

    rounds, tops = _forward(saved(placed, "manifest-places"))
    # the subroots are the leaves of one more tree
    over, root = _forward(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest", F.lit(tops.count()).cast("long").alias("nodes")))
    subroots = _backward(over, root.select("tree", "round", F.array().cast(PROOF).alias("above")))
    subroots = saved(subroots.select(F.col("place").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("above")), "manifest-subroots")

    down = _backward(rounds, tops.select("tree", "round").join(subroots.select("tree", "above"), "tree"))
    top = root.select("digest").first()  # one row, none for an empty table
    ends = subroots.select("tree", "subroot", F.lit(top and top[0]).alias("root")).join(trees.select("tree", "grp"), "tree")
    return (down.join(broadcast_if_small(ends), "tree")
            .select(F.col("id").alias(id_col), F.col("grp").alias(group_col), F.col("digest").alias("leaf"), "place", "subroot", "root", "proof",
                    *[F.col(f"also_{k}").alias(k) for k in also]))


def siblings(proof: Column) -> Column:
    """The siblings' digests of a proof, from the leaf to the root, concatenated."""
    return F.array_join(F.transform(F.filter(proof, lambda s: s.isNotNull()), lambda s: s["digest"]), "")


def fold(start: Column, proof: Column) -> Column:
    """The root that ``start`` and a proof lead to."""
    def step(acc: Column, s: Column) -> Column:
        both = F.when(s.isNull(), acc).when(s["left"], F.concat(s["digest"], acc)).otherwise(F.concat(acc, s["digest"]))
        return F.sha2(both, 256)

    return F.aggregate(proof, start, step)


def verified(docs: DataFrame, changed: dict[str, Column], fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """The manifest of ``docs`` held against rows in which ``changed`` replaces some fields: rows (id, leaf, subroot, root, proof_sha256,
    folded_root, verified). The root is folded from the leaf of what the row says now and the manifest's proof."""
    differs = F.lit(False)
    for c, value in changed.items():
        differs = differs | ~value.cast("string").eqNullSafe(F.col(c).cast("string"))
    now = F.when(differs, leaf({c: changed.get(c, F.col(c)) for c in fields}))
    m = manifest(docs, fields, id_col, group_col, {"now": now}).withColumn("folded_root", fold(F.coalesce("now", "leaf"), F.col("proof")))
    return m.select(id_col, "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))
