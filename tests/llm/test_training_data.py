"""The training-data operators against brute force, on small tables with nulls, ties, repeats and extra columns."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlake.llm import bpe, cap_filters, components, hash_tree, html_text, packing, quality, simhash_trie, stage, topk, toxicity, warc

DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
                                                      ("n_chars", T.LongType()), ("score", T.StringType()), ("y", T.StringType()), ("fp", T.StringType()), ("shard", T.StringType()))])
ODD = [None, "", " \t\n", "one", "two words", "x" * 5000, "ÀÉ ß\u0085a b", "a<|endoftext|>b", "Same text here and there", "Same text here and there", "word " * 3000]


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", None, "clash", "clash", "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id", None, None, None, None, None, None, None)], DOCS)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "x") for i, v, label in rows],
                                 "vec_id long, embedding array<float>, label int, rank string, score string")


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(300)] + [(400, 400 + i) for i in range(1, 90)] + [(500, 501), (501, 500), (502, 502)] + [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(80)]
    table = spark.createDataFrame([*pairs, (None, 1), (2, None)], "src long, dst long")
    found = {r["node"]: r["root"] for r in components.connected_components(table).collect()}
    want = roots(700, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert set(found) == linked
    for a, b in itertools.combinations(sorted(linked), 2):
        assert (found[a] == found[b]) == (want[a] == want[b])
    assert components.connected_components(table.limit(0)).count() == 0


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.standard_normal(20)], 0) for i in range(400)]
    rows += [(1000 + i, rows[7][1], 0) for i in range(15)] + [(2000, rows[0][1], 0)]  # ties, and a repeated vector as query
    rows += [(3000, None, 0), (3100, [], 0), (3200, [1.0, None] * 10, 0), (3300, [float("nan")] * 20, 0), (3400, [1.0, 2.0], 0), (3500, [3e9] * 20, 0), (None, rows[1][1], 0)]
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 100 == 0).collect()}
    good = {i: [int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v] for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    want = {}
    for q in good:
        if q % 100 == 0:
            clip = lambda s: min(max(s, -2**63), 2**63 - 1)
            scored = sorted((-clip(sum(a * b for a, b in zip(good[q], v))), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scored[:10])}
    assert got == want
    assert topk.top_k(vectors_of(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_warc_resolution_and_archives(spark):
    rows = [(1, "u1", "same"), (5, "u5", "same"), (5, "u5", "same"), (3, None, None), (4, "u4", ""), (6, "u\r\n6", "a\r\n\r\nWARC/1.1\r\n\r\nb"), (None, "u", "same"), (8, "é", "ßü" * 9000)]
    pages = spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, payload string, record_type string")
    path = stage.new_folder(spark, "warc-test")
    got = sorted(tuple(r) for r in warc.archived(pages, path=path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").na.fill(-1).collect())
    best = {}
    for i, _, body in rows:
        best[body or ""] = max(best.get(body or "", -1), -1 if i is None else i)
    want = sorted((-1 if i is None else i, len((b or "").encode()), base64.b32encode(hashlib.sha1((b or "").encode()).digest()).decode(),
                   "response" if (i if i is not None else -1) == best[b or ""] else "revisit", -1 if (i if i is not None else -1) == best[b or ""] else best[b or ""]) for i, _, b in rows)
    assert got == want
    kept = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read(spark, path).where("record_type = 'response'").collect()}
    assert kept == {5: "same", 4: "", 6: rows[5][2], 8: rows[7][2]}
    again = stage.new_folder(spark, "warc-test")
    assert sorted(tuple(r) for r in warc.dedup_archives(spark, path, again).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").na.fill(-1).collect()) == want
    small = warc.archived(pages, min_bytes=5).groupBy("record_type").count().collect()
    assert {r["record_type"]: r["count"] for r in small} == {"response": 8}
    assert warc.archived(pages.limit(0)).count() == 0


def test_packing_is_optimal_and_gapless(spark):
    rng = random.Random(1)
    for n, k in ((1, 3), (6, 2), (9, 3), (9, 12)):
        lengths = np.array(sorted(rng.sample(range(40), n)))
        counts = np.array([rng.randrange(1, 9) for _ in range(n)])

        def cost(ends):
            return sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts))
        best = min(cost([*ends, lengths[-1]]) for m in range(min(k, n)) for ends in itertools.combinations(lengths[:-1].tolist(), m))
        assert cost(packing.boundaries(lengths, counts, k)) == best
    texts = ODD + [" ".join("w" * 3 for _ in range(rng.randrange(1, 90))) for _ in range(300)]
    rows = packing.pack(docs_of(spark, texts), buckets=5, token_budget=200).collect()
    assert len(rows) == len(texts) + 1
    room = {}
    for r in rows:
        assert r["n_tokens"] <= r["padded_tokens"]
        room.setdefault((r["bucket"], r["batch"]), []).append(r)
    for (bucket, batch), held in room.items():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
        assert len(held) * held[0]["padded_tokens"] <= 200 or len(held) == 1 or held[0]["padded_tokens"] == 0
    assert {r["doc_id"]: r["n_tokens"] for r in rows if r["doc_id"] is not None and r["doc_id"] < 6} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 2, 5: 1}
    assert packing.pack(docs_of(spark, []).limit(0)).count() == 0


PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="with-sidebar"><header class="site-header"><h1>Site</h1><ul class=menu><li><a href=/>Home</a></ul></header>
<div id="cookie-notice">We use cookies</div><div class="content"><h2>Head &eacute;</h2><p>One two <a href=x>three</a> four\n\n five.<p>Next <i>x</i>y &lt;b&gt; 1 < 2 &amp;amp; more words here.
<div class="ad-slot">Buy</div><ul><li>Item one<li>item two</ul><form>mail <input></form><p>Last one with words.</div><aside>Side</aside>
<section id="comments"><p>First! nice article thanks</p></section><footer>&copy; me</footer><script>if(a<b) "</p>"</script></body></html>"""


def test_main_text(spark):
    simple = "<html><body><nav><a href=/>Menu item</a></nav><article><h1>T{0}</h1><p>Words of page {0} &amp; more.<p>Second</article><footer>&copy; x</footer></body></html>"
    rows = [(i, "u", simple.format(i)) for i in range(20)] + [(100, None, PAGE), (101, "u", None), (102, "u", ""), (103, "u", "<!-- open"), (104, "u", "plain  text"), (105, "u", "<p>" * 3000 + "deep")]
    pages = spark.createDataFrame([(*r, "x", "x") for r in [*rows, rows[3]]], "page_id long, url string, html string, text string, key string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(pages, html_text.fit(pages)).collect()}
    for i in range(20):
        assert got[i][0] == f"T{i}\nWords of page {i} & more.\nSecond"
    assert got[100][0] == "Head é\nOne two three four five.\nNext xy <b> 1 < 2 &amp; more words here.\nItem one\nitem two\nLast one with words."
    assert [got[i] for i in (101, 102, 103, 104, 105)] == [("", 0), ("", 0), ("", 0), ("plain text", 10), ("deep", 4)]
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0


def test_best_region_is_the_best():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.randrange(-4, 5) for _ in range(rng.randrange(0, 12))]
        best = max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))])
        a, b = html_text.best_region(scores)
        assert sum(scores[a:b]) == best


def test_bpe_matches_the_tokenizers_library(spark):
    tokenizers, vocabularies = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = vocabularies.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = ODD + ["aaaa" * 99, "-" * 700, " " * 900 + "x", "don't I'LL we've", "日本語 😀😀 é́", "x\u0085y \u001c ​ z　", "<|endoftext|>", "".join(map(chr, range(0x250)))]
    texts += ["".join(rng.choice("ab thein s\n") for _ in range(200)) for _ in range(100)]
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in bpe.encode(docs, path, digests=True).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))


def test_bpe_gadgets_of_a_small_vocabulary():
    merges = [(b"a", b"a"), (b"a", b"b"), (b"aa", b"aa"), (b"b", b"c"), (b"ab", b"c"), (b"aa", b"ab"), (b"c", b"c")]
    tokens = [b"a", b"b", b"c", *dict.fromkeys(a + b for a, b in merges)]
    automaton = bpe.Automaton({"vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges, "added": {}})
    for n in range(1, 9):
        for word in itertools.product((b"a", b"b", b"c"), repeat=n):
            want = list(word)
            for a, b in merges:
                k = 0
                while k < len(want) - 1:
                    if (want[k], want[k + 1]) == (a, b):
                        want[k:k + 2] = [a + b]
                    k += 1
            assert [tokens[i] for i in automaton.read(b"".join(word))] == want


def test_hash_tree_laws(spark):
    texts = ODD + [f"text {i % 50}" for i in range(3000)]
    docs = docs_of(spark, texts).union(docs_of(spark, texts).where("doc_id < 20"))
    rows = hash_tree.place(docs, hash_tree.layout(40), hash_tree.layout(40, added=1)).collect()
    assert len(rows) == docs.count()
    shards = {}
    for r in rows:
        text = "no id" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text.encode()) + 16, zlib.crc32(text.encode()), "key")
        assert r["grown_shard"] in (r["shard"], 40)
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert set(shards) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert any(r["grown_shard"] == 40 for r in rows) and max(map(len, shards.values())) < 2 * len(rows) / 40
    assert hash_tree.place(docs.limit(0), hash_tree.layout(40)).count() == 0


def test_hash_tree_moves_only_into_heavier_subtrees(spark):
    def tree(heavy):
        shard = lambda n, w=1.0: hash_tree.Node(f"s{n}", own_weight=w, shard=n)
        return hash_tree.Node("root", (hash_tree.Node("r0", (hash_tree.Node("k0", (shard(0), shard(1))), hash_tree.Node("k1", (shard(2), shard(3, heavy))))),
                                       hash_tree.Node("r1", (hash_tree.Node("k2", (shard(4), shard(5))),))))
    ids = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    moved = ids.select(hash_tree.descend(F.col("k"), tree(1.0)).alias("a"), hash_tree.descend(F.col("k"), tree(3.0)).alias("b")).where("a <> b").distinct().collect()
    region, rack = lambda s: s > 3, lambda s: s // 2
    assert moved
    for r in moved:  # at the level where the paths part, the row went into the subtree that grew
        if region(r["a"]) != region(r["b"]):
            assert not region(r["b"])
        elif rack(r["a"]) != rack(r["b"]):
            assert rack(r["b"]) == 1
        else:
            assert r["b"] == 3
    light = ids.select(hash_tree.descend(F.col("k"), tree(0.0)).alias("a")).distinct().collect()
    assert {r["a"] for r in light} == {0, 1, 2, 4, 5}


def brute_links(rows, least):
    unit = {i: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for i, v, label in rows
            if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: x for i, _, x in rows}
    return [(a, b) for a, b in itertools.combinations(unit, 2) if label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least]


def test_cap_filters_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((30, 24))
    rows = [(i, [float(x) for x in centre[i % 30] + rng.standard_normal(24) * (0.05 if i % 30 < 20 else 1)], i % 3) for i in range(900)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)] + [(1100, [2 * x for x in rows[0][1]], 0)]  # copies, and a longer vector of the same direction
    rows += [(2000, None, 1), (2001, [0.0] * 24, 1), (2002, [1.0, None] * 12, 1), (2003, [float("inf")] * 24, 1), (2004, rows[0][1], None), (2005, [1.0], 1), (2006, [1.0], 1)]
    monkeypatch.setattr(cap_filters, "TILE", 16)
    got = {r["vec_id"]: r for r in cap_filters.near_duplicates(vectors_of(spark, [*rows, (None, rows[0][1], 0)])).collect()}
    links = brute_links(rows, 0.93)
    count = {i: 0 for i, _, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    place = {i: k for k, i in enumerate(count)}
    ids, root = list(count), roots(len(count), [(place[a], place[b]) for a, b in links])
    assert all(got[i]["n_links"] <= count[i] for i in count)
    assert sum(got[i]["n_links"] for i in count) >= 0.99 * sum(count.values())
    assert sum(got[i]["component_id"] == ids[root[place[i]]] for i in count) >= 0.99 * len(count)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in count)
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, False)
    assert cap_filters.near_duplicates(vectors_of(spark, [])).count() == 0


def test_list_decoding_finds_every_exceeded_direction():
    rng = np.random.default_rng(1)
    unit = rng.standard_normal((50, 17))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rotation, books = cap_filters.product_code(17, 2, 9)
    full = np.array([np.concatenate((a, b)) for a in books[0] for b in books[1]])
    score = unit @ rotation @ full.T * np.sqrt(17)
    bar = np.minimum(1.5, np.sort(score, axis=1)[:, -cap_filters.LEAST])
    row, found = cap_filters.list_decode(unit, 2, 9, 1.5)
    assert set(zip(row.tolist(), found.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(score >= bar[:, None] - 1e-12))))


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: 32 for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    rng = random.Random(9)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(400)] for _ in range(6)]
    texts = []
    for words in base:
        for _ in range(25):
            copy = words.copy()
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(400)] = "new"
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("unit_rows", [4096, 8])
def test_simhash_matches_brute_force(spark, monkeypatch, unit_rows):
    monkeypatch.setattr(simhash_trie, "UNIT_ROWS", unit_rows)
    monkeypatch.setattr(simhash_trie, "SHINGLES_AT_ONCE", 100)
    texts = ODD + near_texts()
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in simhash_trie.simhash_groups(docs.union(docs.where("doc_id = 4"))).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    root = roots(len(texts), [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3])
    assert len(set(root)) < len(texts) - 60
    for i in range(len(texts)):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{prints[i]:016x}", root[i])
    kept = simhash_trie.keep_one(docs.union(docs.where("doc_id = 4"))).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(set(root)) and len(kept) == len(set(root)) + 1
    assert kept[0].asDict().keys() == set(DOCS.names)


def test_trie_walk_cuts_crowded_units():
    rng = np.random.default_rng(6)
    a = np.unique(rng.integers(0, 1 << 12, 900, dtype=np.uint64) << np.uint64(3))
    found = [(int(i), int(j)) for x, y in simhash_trie.walk(a, a, 2, True) for i, j in zip(x, y)]
    want = {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2)) if i < j}
    assert len(found) == len(set(found)) and set(found) == want
    units, unit_of = simhash_trie.units_of({0: 10_000, 1: 3, 65535: 5}, 16)
    assert units[unit_of[0]][2] == 3 and sum(t for _, _, t in units) == 5  # a crowded prefix is cut into tiles
    near = simhash_trie.near_units(units, 16, 3)
    assert len(near) == 15  # all tiles with each other: the shallow unit differs in one bit so far
    far = simhash_trie.near_units([(0, 16, 1), (0xFFFF, 16, 2)], 16, 3)
    assert far.values.tolist() == [[0, 0], [1, 1], [1, 2], [2, 2]]


def labelled(spark, n, bad, kind):
    rng = random.Random(n)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "st", "ing"]) for _ in range(rng.randrange(1, 4)))
    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(30, 120))]
        y = i % 4 == 0
        if y:
            words = bad(rng, words)
        texts.append(" ".join(words))
        labels.append((i, int(y) if kind == "toxic" else int(not y)))
    labels += [(None, 1), (3, None), (10**9, 1)]
    return docs_of(spark, texts + ODD), spark.createDataFrame(labels, f"doc_id long, {kind} int")


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_learns_held_out_documents(spark):
    def bad(rng, words):
        return rng.choice([[w.upper() + "!!" for w in words], [words[0]] * len(words), [w + "%%%" for w in words]])
    docs, labels = labelled(spark, 500, bad, "quality")
    model = quality.fit(docs, labels)
    rows = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    assert len(rows) == 500 + len(ODD) + 1 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    assert all(rows[i]["held_out"] == held(i) for i in range(500)) and rows[None]["held_out"] is False
    test = [i for i in range(500) if held(i)]
    assert sum(rows[i]["predicted"] == int(i % 4 != 0) for i in test) >= 0.95 * len(test)
    kept = {r["doc_id"] for r in quality.keep_good(docs, model).collect()}
    assert kept == {i for i, r in rows.items() if r["predicted"]}
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r["doc_id"]: r["score"] for r in quality.score(docs, quality.fit(docs, wrong)).collect()} == {i: r["score"] for i, r in rows.items()}  # held-out labels aren't read
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0))).count() == 0
    assert quality.score(docs, quality.fit(docs, labels.limit(0))).agg(F.max("score")).first()[0] == pytest.approx(0.5)


def test_toxicity_learns_held_out_documents(spark):
    stems = ["vequ", "veju", "lowei"]

    def bad(rng, words):
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", rng.choice(stems) + rng.choice(["ons", "er", "tion", "as", "ung"])])
        return words
    docs, labels = labelled(spark, 600, bad, "toxic")
    model = toxicity.fit(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    test = [i for i in range(600) if held(i)]
    assert sum(rows[i]["predicted"] == int(i % 4 == 0) for i in test) >= 0.95 * len(test)
    assert {r["doc_id"] for r in toxicity.keep_clean(docs, model).collect()} == {i for i, r in rows.items() if not r["predicted"]}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).count() == 600 + len(ODD) + 1


def test_label_model_recovers_accuracies_and_links():
    rng = np.random.default_rng(8)
    y = rng.random(6000) < 0.2
    right = [0.9, 0.85, 0.8, 0.75]
    votes = np.stack([np.where(rng.random(6000) < p, np.where(y, 1, -1), np.where(y, -1, 1)) for p in right], axis=1)
    votes = np.concatenate((votes, np.where(rng.random((6000, 1)) < 0.95, votes[:, 3:4], -votes[:, 3:4])), axis=1)  # a voter that copies the last one
    model = toxicity.LabelModel(votes, np.where(np.arange(6000) < 500, y, -1))
    assert model.parent[4] == 3 or model.parent[3] == 4
    for k, p in enumerate(right[:3]):
        assert abs(model.accuracy[1, k, 2] - p) < 0.08 and abs(model.accuracy[0, k, 0] - p) < 0.08


def test_spans_of_long_texts_are_whole():
    from contractlake.llm import text_features as X
    import pyarrow as pa
    texts = [b"alpha beta " * 900_000, None, b"", b"alpha"]
    seen = np.zeros(4)
    for chunk in X.chunks(pa.array(texts, pa.binary())):
        start, end = chunk.words(X.LETTER)
        seen += np.bincount(chunk.owner(start), minlength=4)
        h = chunk.span(chunk.hashes(chunk.data), start, end)
        assert len(np.unique(h)) <= 2
    assert seen.tolist() == [1_800_000, 0, 0, 1]
