"""The Merkle manifest against a plain recursive build."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from contractlake.llm import manifest as mf
from contractlake.llm import queries

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, tree string, place string, digest string, proof string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n = row
    n = n if n is None else n + more
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    steps = []
    for level in tree[:-1]:
        steps.append((i % 2 == 1, level[i ^ 1]) if (i ^ 1) < len(level) else None)
        i //= 2
    return steps


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for la in langs:
        own = sorted((r for r in rows if r[2] == la), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[la] = (own, levels([leaf(r) for r in own]))
    top = levels([trees[la][1][-1][0] for la in langs])
    out = []
    for k, la in enumerate(langs):
        own, tree = trees[la]
        for i, r in enumerate(own):
            steps = path(tree, i) + path(top, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            acc = leaf(r, 1 if bad else 0)
            for s in steps:
                acc = H(acc) if s is None else H(s[1], acc) if s[0] else H(acc, s[1])
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], H(*[s[1] for s in steps if s]), acc, acc == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n, seed=0):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["", "text", "ä" * 9, "1:x", None]), rng.choice(["en", "en", "en", "fr", "", None, "é"]), rng.choice(["s", None]), rng.choice([i, None])) for i in range(n)]
    return rows + rows[:n // 9] + [(None, "no id", "en", None, 3), (None, None, None, None, None), (7, "other text", "en", "s", 2 ** 63 - 1)] * (n > 0)


def table_of(spark, folder, rows):
    spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SHAPE).repartition(4).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 333])
def test_manifest_matches_a_plain_build(spark, scratch, n):
    rows = rows_of(n) if n > 3 else rows_of(n)[:n]
    got = queries.op12_manifest(spark, table_of(spark, scratch, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_trees_of_many_cells(spark):
    """More leaves than one cell holds: three rounds of cells would need 2 ** 24 leaves, two rounds show both kinds of heads."""
    n = (1 << mf.CELL_LEVELS) * 2 + 77
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "fr").otherwise("en").alias("lang"))
    got = mf.manifest(docs, fields=("doc_id", "lang")).orderBy("lang", "place").collect()
    for la in ("en", "fr"):
        own = [r for r in got if r.lang == la]
        tree = levels([r.leaf for r in own])
        assert [r.place for r in own] == list(range(len(own))) and own == sorted(own, key=lambda r: r.doc_id)
        assert {r.subroot for r in own} == {tree[-1][0]}
        for i in [0, 1, 4095, 4096, len(own) - 2, len(own) - 1, *random.Random(1).sample(range(len(own)), 20)]:
            if i < len(own):
                steps = [s and (s["left"], s["digest"]) for s in own[i].proof]
                assert steps[:-1] == path(tree, i) and len(steps) == len(tree)


@pytest.mark.parametrize("levels_up", [None, 5])
def test_sweeps(levels_up):
    for n in range(1, 34):
        nodes = [H(str(i)) for i in range(n)]
        tree = levels(nodes)
        while levels_up and len(tree) <= levels_up:
            tree.append([H(*tree[-1][i:i + 2]) for i in range(0, len(tree[-1]), 2)])
        if levels_up and n > 1 << levels_up:
            continue
        assert mf.lift(nodes, levels_up) == tree[-1][0]
        assert list(mf.proofs(nodes, levels_up, ["above"]))[::-1] == [path(tree, i) + ["above"] for i in range(n)]


def test_a_changed_row_shows(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.col("id").alias("n_chars"))
    got = mf.verified(docs, {"n_chars": F.when(F.col("doc_id") == 42, 0).otherwise(F.col("n_chars"))}, fields=("doc_id", "lang", "n_chars")).collect()
    assert [r.doc_id for r in got if not r.verified] == [42]
