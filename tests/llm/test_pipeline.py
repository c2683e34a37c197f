"""The pipeline against its stages applied by hand, and the queries' SQL."""

import duckdb
import pytest

import corpus_pipeline
from contractlake.llm import packing, quality, simhash_trie, toxicity
from contractlake.llm.queries import ORACLES, QUERIES, table
from tests.llm.test_training_data import roots

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.fit(docs, labels)
    good = {r["doc_id"] for r in quality.score(docs, model).collect() if r["score"] >= 0.3}
    left = docs.where(docs["doc_id"].isin(sorted(good)))
    clean = {r["doc_id"] for r in toxicity.score(left, toxicity.fit(left, labels)).collect() if r["score"] < 0.5}
    ids = sorted(clean)
    prints = [int.from_bytes(simhash_trie.fingerprint(texts[i].encode(), 3), "big") for i in ids]
    root = roots(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    want = {ids[r] for r in root}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == want and len(got) == len(want)
    packed = packing.pack(docs.where(docs["doc_id"].isin(sorted(want)))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, packed))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    result = con.execute(ORACLES[name])
    place = [[d[0] for d in result.description].index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in found.collect()) == sorted(repr(tuple(r[k] for k in place)) for r in result.fetchall())
