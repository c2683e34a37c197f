"""Near-duplicates where ids repeat with other texts or are missing."""

import random

from contractlake.llm import simhash_trie


def test_repeated_and_missing_ids(spark):
    rng = random.Random(4)
    far = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(300)) for _ in range(5)]
    a, b, c, d, e = far
    rows = [(7, "0 " + a, "near copy of doc 3"), (3, a, "x"), (7, b, "only one of its group"), (7, c, "y"), (7, c, "x"),
            (None, d, "1"), (None, d, "0"), (None, d + " 0", "2"), (None, b, "copy of 7"), (9, e, "x"), (9, e + " 0", "x"), (9, None, "no text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    prints = {t: int.from_bytes(simhash_trie.fingerprint(t.encode(), 3), "big") for _, t, _ in rows if t}
    near = lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 3
    assert near("0 " + a, a) and near(d, d + " 0") and near(e, e + " 0") and not any(near(x, y) for x in far for y in far if x != y)
    got = simhash_trie.keep_one(docs)
    assert got.columns == docs.columns
    want = [(3, a, "x"), (7, b, "only one of its group"), (7, c, "x"), (None, d, "0"), (9, e, "x"), (9, None, "no text")]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
