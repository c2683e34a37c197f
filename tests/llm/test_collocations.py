"""Phrase counting and collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from contractlake.llm import collocations as co

PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, percent, first):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(PLAIN)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 4):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        kept = []
        for phrase, a in counts.items():
            if len(phrase) < 2 or a < least:
                continue
            longer = [c for p, c in counts.items() if len(p) > len(phrase) and c >= least and any(p[i:i + len(phrase)] == phrase for i in range(len(p) - len(phrase) + 1))]
            if any(100 * c >= percent * a for c in longer):
                continue
            s, k = min((1_000_000 * a * a // (counts[phrase[:k]] * counts[phrase[k:]]), k) for k in range(1, len(phrase)))
            kept.append((lang, " ".join(phrase), a, counts[phrase[:k]], counts[phrase[k:]], n[lang], s))
        kept.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i, *r[1:]) for i, r in enumerate(kept[:first], 1)]
    return sorted(out)


def rows_of(seed, texts=60):
    rng = random.Random(seed)
    words = ["the", "The", "a", "of", "new", "york", "times", "ß", "Élan", "x\x00y", " ", "naïve x", "zz"]
    rows = []
    for _ in range(texts):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "\x0c", "\r", "\x85"]) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "en", "fr", "und", None, ""]), text))
    return [*rows, *rows[:9], ("en", None), (None, ""), ("de", " \t\n"), ("en", "w " * 3000), ("en", "new york times. " * 50)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, la, "clash", "clash", "clash") for i, (la, t) in enumerate(rows)], "doc_id long, text string, lang string, part string, phrase string, a string")


@pytest.mark.parametrize("sizes", [{}, {"run_words": 500, "range_phrases": 60, "proposal": 8}])
def test_collocations_match_brute_force(spark, sizes):
    rows = rows_of(1)
    got = co.collocations(docs_of(spark, rows).repartition(5), least=3, covered_percent=50, first=40, **sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 50, 40)


def test_many_ranges_were_cut(spark):
    docs = docs_of(spark, rows_of(2, 200))
    _, ranges, cuts = co.counts(docs, 1, run_words=400, range_phrases=60, proposal=8)
    assert ranges.where("lang = 'en'").count() > 3 and len(cuts["en"]) > 3


def test_empty_table(spark):
    assert co.collocations(docs_of(spark, [("en", "a")]).limit(0)).collect() == []
    assert co.collocations(docs_of(spark, [(None, None)])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(4)
    rows = [(a, a + rng.randrange(3), a + rng.randrange(10 ** rng.randrange(1, 17))) for a in (10 ** rng.randrange(1, 16) + rng.randrange(9) for _ in range(300))]
    rows += [(999_999, 999_999, 999_999 * 1_000_000), (3, 3, 3_000_000), (10 ** 15, 10 ** 15, 10 ** 15 + 1)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    from pyspark.sql import functions as F
    for r in df.withColumn("s", co.score(F.col("a"), F.col("l"), F.col("r"))).collect():
        assert r.s == 1_000_000 * r.a * r.a // (r.l * r.r), r


def phrases_of(words, found):
    items = sorted(found.items())
    ids = np.array([[words.index(w) + 1 for w in p] + [0] * (3 - len(p)) for p, _ in items], dtype=np.int32).reshape(-1, 3)
    return co.Phrases(words, ids, np.array([c for _, c in items], dtype=np.int64))


def as_dict(p):
    return {p.at(i): int(p.counts[i]) for i in range(len(p))}


def test_automata_round_trip_share_endings_unite_and_compose():
    rng = random.Random(5)
    words = sorted({bytes([rng.randrange(97, 103)]) * rng.randrange(1, 3) for _ in range(40)})
    draw = lambda n: {tuple(rng.choice(words) for _ in range(rng.randrange(1, 4))): rng.choice([1, 1, 2, 1 << 40]) for _ in range(n)}
    for size in (0, 1, 5, 300):
        one, two = draw(size), draw(size)
        first = co.build(phrases_of(words, one))
        again = co.Automaton.unpack(first.pack())
        assert as_dict(again.phrases()) == one
        assert [again.phrases().at(i) for i in range(len(one))] == sorted(one)
        assert len(again.first) - 1 <= 2 + sum(len(p) for p in one)
        both = Counter(one)
        both.update(two)
        assert as_dict(co.united([phrases_of(words, one), phrases_of(words, two)])) == dict(both)
        assert as_dict(first.compose(co.build(phrases_of(words, two)))) == {p: one[p] for p in two if p in one}
        for _ in range(12):
            lo, hi = sorted(tuple(rng.choice([*words, b"ab", b"zz", b"A"]) for _ in range(rng.randrange(1, 4))) for _ in range(2))
            lo, hi = rng.choice([(lo, hi), (None, hi), (lo, None), (None, None)])
            part = first.restricted(lo, hi)
            want = {p: c for p, c in one.items() if (lo is None or p >= lo) and (hi is None or p < hi)}
            assert (as_dict(co.Automaton.unpack(part.pack()).phrases()) if part else {}) == want, (lo, hi)
    shared = co.build(phrases_of([b"a", b"b", b"c"], {(x, y, z): 1 for x in (b"a", b"b", b"c") for y in (b"a", b"b", b"c") for z in (b"a", b"b")}))
    assert len(shared.first) - 1 == 4  # end, after two words, after one, start
