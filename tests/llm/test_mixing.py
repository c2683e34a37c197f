"""Mixing against a plain schedule and water level."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from contractlake.llm import mixing as mx

SHAPE = "doc_id long, text string, source string, number string, size string, block string, step string"


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, out, left = Fraction(3 * sum(sizes.values()), 2), {}, set(names)
    while left:
        share = total - sum(out.values())
        full = {s for s in left if 2 * sizes[s] <= share * weight[s] / sum(weight[x] for x in left)}
        if not full:
            return out | {s: share * weight[s] / sum(weight[x] for x in left) for s in left}
        out |= {s: Fraction(2 * sizes[s]) for s in full}
        left -= full
    return out


def brute(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want, seen, docs = targets(sizes), Counter(), defaultdict(list)
    for i, text, source in rows:
        size = len((text or "").split())
        seen[i, size, source] += 1
        copy = seen[i, size, source]
        draw = hashlib.md5(f"{'null' if i is None else i}/{size}/{copy}".encode()).hexdigest()
        docs[source].append((draw, i is not None, i or 0, size, copy, i))
    out = []
    for source, own in docs.items():
        words = min(int(float(want[source]) + 0.5), 2 * sizes[source])
        stream = [k for _ in range(2) for k, d in enumerate(sorted(own)) for _ in range(d[3])][:words]
        took = Counter(stream)
        out += [(d[5], d[3], sizes[source], float(want[source]), took[k]) for k, d in enumerate(sorted(own))]
    return sorted(out, key=str)


def rows_of(seed):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 700]))), rng.choice(["hot"] * 5 + ["b", "a", "é", "", None, "tiny"])) for i in range(300)]
    return rows + [(5, "the same row", "hot")] * 150 + [(None, "x y", "a"), (None, "x y", "a"), (None, None, None), (9, None, "empty only"), (9, "", "empty only"), (8, "long " * 30_000, "hot")]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SHAPE)


def test_taken_matches_brute_force_in_any_layout(spark):
    rows = rows_of(1)
    want = brute(rows)
    for docs in (table(spark, rows).repartition(7), table(spark, rows[::-1]).coalesce(1)):
        got = mx.taken(docs)
        assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    for i, size, source_size, target, took in want:
        assert took <= 2 * size and target <= 2 * source_size


def test_blocks_follow_the_points_in_proportion(spark):
    m = mx.mix(table(spark, rows_of(2)))
    blocks = {r.number: r.blocks for r in m.sources.collect()}
    pieces = m.pieces.collect()
    steps = defaultdict(set)
    for p in pieces:
        steps[p.number].add((p.step, p.block))
    assert len({s for own in steps.values() for s, _ in own}) == sum(blocks.values())  # no two blocks at one step
    for number, own in steps.items():
        assert [b for _, b in sorted(own)] == list(range(blocks[number]))  # each block once, in order
    order = sorted((s, number) for number, own in steps.items() for s, _ in own)
    seen = Counter()
    for i, (_, number) in enumerate(order, 1):
        seen[number] += 1
        for k, n in blocks.items():
            assert abs(seen[k] - i * n / len(order)) < 4 + len(blocks)
    fill = Counter()
    for p in pieces:
        fill[p.number, p.block] += p.n_words
    full = {r.number: r.words for r in m.sources.collect()}
    for (number, block), n in fill.items():
        assert n == min(mx.BLOCK_WORDS, full[number] - block * mx.BLOCK_WORDS)


def test_levels_of_many_sources(spark):
    rng = random.Random(6)
    sizes = {f"s{i:03}": rng.choice([0, 1, 7, 100, 5_000, 10 ** 6, 10 ** 12]) for i in range(60)}
    got = mx.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = targets(sizes)
    assert {r.source: r.target for r in got} == {s: float(t) for s, t in want.items()}
    assert abs(sum(r.target for r in got) - 1.5 * sum(sizes.values())) < 1e-3 * sum(sizes.values()) ** 0.5


def test_no_words_and_no_rows(spark):
    assert mx.taken(table(spark, rows_of(1)).limit(0)).collect() == []
    assert [tuple(r) for r in mx.taken(table(spark, [(1, None, "a"), (2, " ", "b")])).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_main_path_is_native(spark):
    plan = mx.taken(table(spark, rows_of(1)).where(F.col("doc_id") < 50))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
