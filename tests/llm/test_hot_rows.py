"""One id on many rows, clashing column names, near copies among the labelled: what a single key must not break."""

import numpy as np
from pyspark.sql import functions as F

from contractlake.llm import hash_tree, packing, quality, simhash_trie, toxicity
from contractlake.llm.text_features import fresh, one_of_each, sampled_texts


def hot(spark, n=3000):
    many = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.repeat(F.lit("x "), (F.col("id") % 5).cast("int"))).alias("text"))
    return many.unionByName(spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t "), "id").alias("text"))).unionByName(
        spark.createDataFrame([(None, None), (None, "a b"), (None, "a b")], "doc_id long, text string")).repartition(6)


def test_shards_and_buckets_number_a_hot_id_without_gaps(spark):
    docs = hot(spark)
    placed = hash_tree.place(docs, hash_tree.layout(8), hash_tree.layout(8, 1)).collect()
    assert len(placed) == docs.count()
    for s in {r.shard for r in placed}:
        own = sorted((r for r in placed if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in own]
        assert keys == sorted(keys)
    packed = packing.pack(docs, buckets=3, token_budget=64).collect()
    assert len(packed) == docs.count()
    again = packing.pack(docs.coalesce(1), buckets=3, token_budget=64).collect()
    assert sorted(map(repr, packed)) == sorted(map(repr, again))  # another layout of the rows, the same result
    for b in {r.bucket for r in packed}:
        own = [r for r in packed if r.bucket == b]
        room = max(1, 64 // max(own[0].padded_tokens, 1))
        assert sorted(r.batch * room + r.slot for r in own) == list(range(len(own))) and all(r.slot < room for r in own)


def test_one_text_of_each_sampled_id(spark):
    sample = spark.createDataFrame([(7, 1), (3, 0), (99999, 1)], "doc_id long, y int")

    def picked(docs):
        def run(batches):
            seen = {}
            for batch in batches:
                yield fresh(batch, seen)
        found = sampled_texts(docs, sample, "doc_id", "text")
        some = found.mapInArrow(run, found.schema)
        assert some.where("id = 7").count() <= 6 * 6  # five texts of one id in each task at most, not 3,001
        return sorted((r.y, bytes(r.bytes)) for r in one_of_each(some).collect())

    rows = picked(hot(spark))
    assert [y for y, _ in rows] == [0, 1] and rows == picked(hot(spark).coalesce(1))


def test_repeated_labelled_ids_weigh_as_one(spark):
    rng = np.random.default_rng(1)
    words, foul = [f"{a}{b}ord" for a in "bcdfgklmnp" for b in "aeiou"], ["zzqot", "spamix", "vorg", "hraxx", "kwuul"]
    bad = " ".join(rng.choice(foul, 4))
    rows = [(i, " ".join(rng.choice(words, 40)) + (" " + " ".join(rng.choice(foul, 6)) if i >= 200 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i < 200), int(i >= 200)) for i in range(400)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    many = docs.unionByName(spark.createDataFrame([(1, bad)] * 2000, "doc_id long, text string"))  # one id, two thousand rows
    for module, fit in ((quality, lambda d: quality.fit(d, labels)), (toxicity, lambda d: toxicity.fit(d, labels))):
        one = module.score(docs, fit(many), threshold=0.5).collect()
        right = sum((r.predicted == 1) == ((r.doc_id < 200) == (module is quality)) for r in one)
        assert right > 390, module.__name__


def test_only_near_copies_are_thinned():
    rng = np.random.default_rng(0)
    common = np.arange(3)
    far = [(0, np.concatenate((common, np.sort(rng.choice(np.arange(10, 5000), 300, replace=False))))) for _ in range(50)]
    near = [(0, np.delete(far[0][1], [10 * k + 5])) for k in range(20)]
    kept = toxicity.without_near_copies([*far, *near, far[3], (1, far[0][1]), (1, np.zeros(0, dtype=int))])
    assert len([1 for y, _ in kept if y == 0]) == 50 and len([1 for y, _ in kept if y == 1]) == 1


def test_keep_one_with_the_stages_own_column_names(spark):
    rows = [(1, "alpha beta gamma delta", "a", "b", 3, "c", "d"), (2, "alpha beta gamma delta", "a", "b", 4, "c", "d"), (3, "something else entirely here", "z", "y", 5, "x", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp string, _root string, _first_id int, _row string, fp string")
    kept = simhash_trie.keep_one(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
    assert simhash_trie.keep_one(docs.withColumnRenamed("fp", "least")).count() == 2
