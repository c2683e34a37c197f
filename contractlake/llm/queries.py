"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlake.llm import bpe, cap_filters, collocations, hash_tree, html_text, manifest, mixing, packing, quality, simhash_trie, topk, toxicity, warc
from contractlake.llm.stage import batch_rows

SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    batch_rows(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Place of the byte-level vocabulary that comes with the machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), min_bytes=0).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary(), digests=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.place(table(spark, sf_dir, "documents"), hash_tree.layout(SHARDS), hash_tree.layout(SHARDS, added=1))


def op9_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.simhash_groups(table(spark, sf_dir, "documents"), words_per_shingle=3, budget=3)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    more = F.col("n_chars").cast("decimal(20,0)") + 1  # a long's last value has a next one here
    return manifest.verified(table(spark, sf_dir, "documents"), {"n_chars": F.when(tampered, more).otherwise(F.col("n_chars")).cast("string")})


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_topk_search, op2_warc_revisits, op3_length_buckets, op4_main_text, op5_quality, op6_bpe,
                            op7_toxicity, op8_hash_tree, op9_cap_filters, op10_simhash_trie, op11_collocations, op12_manifest, op13_mixing, pipeline)}

GOOD_VECTOR = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x : x is null or not isfinite(x))) = 0"

TOPK_SQL = f"""
with v as (select vec_id, list_transform(embedding, lambda x : cast(floor(1024 * cast(x as double)) as bigint)) as q
           from embeddings where vec_id is not null and {GOOD_VECTOR}),
s as (select a.vec_id as query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z : z[1] * z[2])) as bigint) as score
      from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""

_digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + (((('0x' || substr(h, {at}, 10))::ubigint) >> {shift}) & 31) as integer), 1)"
WARC_SQL = f"""
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, cast(strlen(body) as bigint) as payload_bytes, sha1(body) as h from p),
e as (select page_id, payload_bytes, {' || '.join(_digit.format(at=1 + 10 * k, shift=35 - 5 * j) for k in range(4) for j in range(8))} as payload_digest from d),
f as (select *, max(page_id) over (partition by payload_digest) as first from e)
select page_id, payload_bytes, payload_digest, case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from first then first end as refers_to
from f
"""


def _descend_sql(node: hash_tree.Node) -> str:
    if not node.children:
        return str(node.shard)
    if len(node.children) == 1:
        return _descend_sql(node.children[0])
    draw = "{{'d': ln((('0x' || substr(md5(key || '/{name}'), 1, 12))::ubigint + 0.5::double) / {size}::double) / {weight}::double, 'n': '{name}'}}"
    draws = ", ".join(draw.format(name=c.name, size=1 << 48, weight=c.weight) for c in node.children)
    return f"case list_reverse_sort([{draws}])[1].n " + " ".join(f"when '{c.name}' then {_descend_sql(c)}" for c in node.children) + " end"


HASH_TREE_SQL = f"""
with steps as (select list_transform(range(256), lambda i : list_reduce(list_prepend(i::ubigint, range(8)::ubigint[]),
               lambda c, _ : case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end)) as t),
d as (select doc_id, coalesce(cast(doc_id as varchar), 'null') as key, coalesce(text, '') as text from documents),
e as (select doc_id, key, cast(strlen(text) + 16 as bigint) as size,
             cast(xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda b : ('0x' || b)::ubigint)),
                                  lambda c, b : xor(c >> 8, t[cast(xor(c, b) & 255 as integer) + 1])), 4294967295::ubigint) as bigint) as text_crc32 from d, steps),
f as (select *, {_descend_sql(hash_tree.layout(SHARDS))} as shard, {_descend_sql(hash_tree.layout(SHARDS, added=1))} as grown_shard from e)
select doc_id, size, text_crc32, 'key' as law, cast(shard as integer) as shard,
       row_number() over (partition by shard order by doc_id nulls first, text_crc32, size) - 1 as slot, cast(grown_shard as integer) as grown_shard
from f
"""

CAP_FILTERS_SQL = f"""
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings
                     where vec_id is not null and label is not null and {GOOD_VECTOR} and len(list_filter(embedding, lambda x : x <> 0)) > 0),
l as (select a.vec_id as u, b.vec_id as w from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.93),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.w from reach r join l on l.u = r.b),
c as (select a, min(b) as component_id from reach group by a),
n as (select u, count(*) as n from l group by u)
select e.vec_id, coalesce(n.n, 0) as n_links, c.component_id, e.vec_id is not null and e.vec_id = c.component_id as kept
from embeddings e left join c on c.a = e.vec_id left join n on n.u = e.vec_id
"""

COLLOCATIONS_SQL = r"""
with p as (select coalesce(lang, 'und') as lang,
                  unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as (select lang, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i : w[i] || ' ' || w[i + 1]),
                                      list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as phrase from w),
f as (select lang, phrase, count(*) as c, len(string_split(phrase, ' ')) as k from g group by lang, phrase),
n as (select lang, sum(c)::bigint as n from f where k = 1 group by lang),
cut as (select lang, phrase, c as a, k, unnest(range(1, k)) as pos, string_split(phrase, ' ') as s from f where k > 1 and c >= 10),
part as (select lang, phrase, a, k, pos, array_to_string(s[1:pos], ' ') as head, array_to_string(s[pos + 1:], ' ') as tail from cut),
lr as (select part.*, l.c as l, r.c as r, (1000000::hugeint * a * a // (l.c::hugeint * r.c))::bigint as score
       from part join f l on l.lang = part.lang and l.phrase = head join f r on r.lang = part.lang and r.phrase = tail),
weakest as (select * from lr qualify row_number() over (partition by lang, phrase order by score, pos) = 1),
gone as (select lang, head as phrase from lr where k = 3 and pos = 2 and 100 * a >= 50 * l union select lang, tail from lr where k = 3 and pos = 1 and 100 * a >= 50 * r),
kept as (select * from weakest anti join gone using (lang, phrase)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000
"""

_part = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
_leaf = "sha256(" + " || ".join(_part.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
_crc = """xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(regexp_extract_all(hex(encode(doc_id::varchar)), '..'), lambda b : ('0x' || b)::ubigint)),
                            lambda c, b : xor(c >> 8, t[cast(xor(c, b) & 255 as integer) + 1])), 4294967295::ubigint)"""
# Level by level: groups are trees, and the subroots the leaves of one more tree.
MANIFEST_SQL = f"""
with recursive steps as (select list_transform(range(256), lambda i : list_reduce(list_prepend(i::ubigint, range(8)::ubigint[]),
               lambda c, _ : case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end)) as t),
l as (select doc_id, lang, {_leaf.format(n="n_chars")} as leaf,
             case when n_chars is not null and doc_id is not null and {_crc} % 7 = 0 then {_leaf.format(n="(n_chars::hugeint + 1)")} end as now from documents, steps),
p as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place, dense_rank() over (order by lang nulls first) - 1 as tree from l),
up(tree, level, place, digest) as (
    select tree, 0, place, leaf from p
    union all
    select tree, level + 1, place // 2, sha256(string_agg(digest, '' order by place))
    from (select *, count(*) over (partition by tree) as n from up) where n > 1 group by tree, level, place // 2),
tops as (select tree, arg_max(digest, level) as subroot, max(level) as levels from up group by tree),
over(level, place, digest) as (
    select 0, tree, subroot from tops
    union all
    select level + 1, place // 2, sha256(string_agg(digest, '' order by place))
    from (select *, count(*) over () as n from over) where n > 1 group by level, place // 2),
root as (select arg_max(digest, level) as root, max(level) as levels from over),
nodes as (select tree, level, place, digest from up union all
          select t.tree, t.levels + 1 + o.level, o.place, o.digest from tops t, over o),
walk(doc_id, leaf, tree, place, level, ends, levels, own, digest, siblings) as (
    select p.doc_id, p.leaf, p.tree, p.place, 0, t.levels, t.levels + r.levels, case when t.levels = 0 then p.tree else p.place end, coalesce(p.now, p.leaf), '' from p join tops t using (tree), root r
    union all
    select w.doc_id, w.leaf, w.tree, w.place, w.level + 1, w.ends, w.levels, case when w.level + 1 = w.ends then w.tree else w.own // 2 end,
           sha256(case when n.digest is null then w.digest when w.own % 2 = 1 then n.digest || w.digest else w.digest || n.digest end), w.siblings || coalesce(n.digest, '')
    from walk w left join nodes n on n.tree = w.tree and n.level = case when w.level < w.ends then w.level else w.level + 1 end and n.place = xor(w.own, 1)
    where w.level < w.levels)
select w.doc_id, w.leaf, t.subroot, r.root, sha256(w.siblings) as proof_sha256, w.digest as folded_root, w.digest = r.root as verified
from walk w join tops t using (tree), root r where w.level = w.levels
"""

# The words that a source's share takes are the first of its shuffled stream, so SQL needs no blocks and no schedule.
MIXING_SQL = r"""
with recursive d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
c as (select *, row_number() over (partition by doc_id, source, size) as copy from d),
s as (select source, sum(size)::bigint as source_size, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight from d group by source),
total as (select sum(source_size)::double * 1.5 as t from s),
-- shares are dealt again and again: a round settles the sources that the level would fill
deal(round, source, source_size, weight, full_up, level) as (
    select 0, source, source_size, weight, false, (select t from total) / nullif((select sum(weight) from s), 0) from s
    union all
    select round + 1, source, source_size, weight, now_full,
           ((select t from total) - coalesce(sum(2 * source_size) filter (now_full) over (), 0)) / nullif(sum(weight) filter (not now_full) over (), 0)
    from (select *, full_up or 2 * source_size <= level * weight as now_full, bool_or(not full_up and 2 * source_size <= level * weight) over () as more from deal)
    where more),
f as (select source, source_size, case when full_up then 2.0 * source_size else level * weight end::double as target from deal where round = (select max(round) from deal)),
w as (select *, least(floor(target + 0.5)::bigint, 2 * source_size) as words from f),
p as (select c.doc_id, c.size, w.source_size, w.target, w.words,
             coalesce(sum(c.size) over (partition by c.source order by md5(coalesce(c.doc_id::varchar, 'null') || '/' || c.size || '/' || c.copy), c.doc_id nulls first, c.size, c.copy
                                        rows between unbounded preceding and 1 preceding), 0) as pos
      from c join w on c.source is not distinct from w.source)
select doc_id, size, source_size, target,
       (greatest(0, least(pos + size, words) - pos) + greatest(0, least(pos + source_size + size, words) - (pos + source_size)))::bigint as taken
from p
"""

ORACLES: dict[str, str] = {"op1_topk_search": TOPK_SQL, "op2_warc_revisits": WARC_SQL, "op8_hash_tree": HASH_TREE_SQL, "op9_cap_filters": CAP_FILTERS_SQL,
                           "op11_collocations": COLLOCATIONS_SQL, "op12_manifest": MANIFEST_SQL, "op13_mixing": MIXING_SQL}
