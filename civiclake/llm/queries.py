"""Queries over the training-data tables, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import (chat_tree, conversation_trie, embedding_dedup, exact_dedup, html_extract, jaccard_join, language_id, licenses, mixing, packing, periodic_runs,
                           suffix_dedup, url_rules)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public tokenizer. The ranks give the same ids as
    byte_bpe_50k.json under the tokenizers library (tested) at six times its speed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), capacity=2048, keep={"ids_crc32": F.crc32("ids")})


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), words=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), total_ratio=1.5, cap=2.0)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    model = language_id.train(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return language_id.predict(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    same = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(same).alias("text"))
    return chat_tree.format_and_read(turns.unionByName(extra), tokenizer())


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), threshold=0.8)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.passages(table(spark, sf_dir, "documents"), least=50)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each after the first turns of the one that
    begins its group of 20 ids (bytes of a path: 16 a turn)."""
    own = conversation_trie.sequences(table(spark, sf_dir, "conversations"))
    heads = own.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("top"), F.substring("path", 1, 48).alias("head"), F.slice("words", 1, 3).alias("head_words"))
    rows = own.withColumn("top", F.expr("conv_id - conv_id % 20")).withColumn("h", F.expr("int(crc32(cast(conv_id as string)) % 4)")).join(heads, "top", "left")
    rebuilt = rows.select("conv_id", F.expr("concat(coalesce(substring(head, 1, 16 * h), cast('' as binary)), substring(path, 16 * h + 1))").alias("path"),
                          F.expr("concat(coalesce(slice(head_words, 1, h), array()), slice(words, h + 1, size(words)))").alias("words"))
    return conversation_trie.prefix_trie(rebuilt)


#: (verdict, host, path)
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op12_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are the rows of ``labels`` under the page's number; toxic or of low
    quality is bad."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    mined = url_rules.mine(pages.select("page_id", "url").join(labels, "page_id").select("url", "bad"), max_items=None)
    return url_rules.judge(pages, URL_RULES, mined)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose id's checksum is a multiple of ten repeat themselves from a word on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.expr("if(n > 0, int(g % n), null)")).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    again = F.expr("array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), int((n - a) div p) + 1)), 1, n - a)), ' ')")
    rows = rows.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))
    found = periodic_runs.detect(rows, min_words=12)
    best = found.withColumn("best", F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))))
    said = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    said = F.when(F.size("runs") > 0, F.concat(said, F.lit("\n"))).otherwise(F.lit(""))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
                       (-F.col("best.p")).alias("period"), F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
                       F.sha2(said, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pack_documents, op2_jaccard_join, op3_mix_sources, op4_extract_html, op5_identify_language, op6_exact_dedup,
                            op7_chat_trees, op8_embedding_dedup, op9_license_scan, op10_suffix_dedup,
                            op11_conversation_trie, op12_filter_urls, op13_periodic_runs)}

_WS = r"[\x20\x09-\x0D]"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _apportion(parties: str, votes: str, seats: str, group: str, order: str) -> str:
    """All quotients down to one seat more than the share, the highest win."""
    return f"""
      select {group} as grp, {order} as party, count(*) as quota from (
        select *, row_number() over (partition by {group} order by q desc, {order}) as rn from (
          select {group}, {order}, {seats} as seats, {votes} * 1.0 / (2 * unnest(range(0, cast(ceil({seats} * {votes} / sum({votes}) over (partition by {group})) as bigint) + 40)) + 1) as q
          from {parties} where {votes} > 0)) where rn <= seats group by 1, 2"""


_MIX = f"""
with base as (select doc_id, source, cast(len({_WORDS}) as bigint) as size from documents),
keyed as (select *, md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || cast(size as varchar)) as key from base),
sources as (select source, sum(size) as source_size, count(*) as n_docs from base group by source),
ranked as (select *, row_number() over (order by source nulls last) as rank from sources),
weighted as (select *, [3.0, 1.0, 2.0][(rank - 1) % 3 + 1]::double as weight from ranked),
leveled as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(source_size * 2.0::double) over (order by source_size / weight, rank rows between unbounded preceding and 1 preceding), 0))
   / sum(weight) over (order by source_size / weight, rank rows between current row and unbounded following) as level from weighted),
targets as (select *, least(source_size * 2.0::double, weight * max(level) over ()) as target from leveled),
counted as (select *, 0 as grp0, cast(floor(sum(target) over () / 64 + 0.5) as bigint) as blocks from targets),
q1 as ({_apportion('counted', 'target', 'blocks', 'grp0', 'rank')}),
quotas as (select c.*, coalesce(q1.quota, 0) as source_quota, cast(ceil(n_docs / 20000.0) as bigint) as n_shards from counted c left join q1 on q1.party = c.rank),
rws as (select k.*, q.source_size, q.target, q.rank, q.source_quota, cast('0x' || substr(k.key, 1, 12) as bigint) % q.n_shards as shard
   from keyed k join quotas q on k.source is not distinct from q.source),
shards as (select rank, shard, source_quota, sum(size) as shard_size from rws group by 1, 2, 3),
q2 as ({_apportion('shards', 'shard_size', 'source_quota', 'rank', 'shard')}),
given as (select s.rank, s.shard, s.shard_size, least(coalesce(q2.quota, 0) * 64, 2 * s.shard_size) as words from shards s left join q2 on q2.grp = s.rank and q2.party = s.shard),
laid as (select r.*, g.shard_size, g.words, coalesce(sum(size) over (partition by r.rank, r.shard order by key, size rows between unbounded preceding and 1 preceding), 0) as start
   from rws r join given g on r.rank = g.rank and r.shard = g.shard)
select doc_id, size, cast(source_size as bigint) as source_size, target,
  cast(case when shard_size > 0 then (words // shard_size) * size + greatest(0, least(size, words % shard_size - start)) else 0 end as bigint) as taken from laid
"""

_DEDUP = f"""
with n as (select doc_id, length(coalesce(text, '')) as n_chars, regexp_replace(coalesce(text, ''), '{_WS}', '', 'g') as norm from documents),
r as (select *, row_number() over (partition by norm order by n_chars desc, doc_id nulls last) as rn, count(*) over (partition by norm) as group_size from n),
k as (select norm, doc_id as keep_id from r where rn = 1)
select r.doc_id, k.keep_id, r.group_size, rn = 1 as kept, sha256(r.norm) as text_sha256 from r join k using (norm)
"""

_COMPONENTS = """
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a as id, min(b) as low from reach group by a)"""

_JACCARD = f"""
with recursive w as (select doc_id, list_transform({_WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as ws from documents),
g as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
  else list_distinct([array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)]) end as grams from w),
s as (select doc_id, unnest(grams) as gram from g),
links as (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as shared from s x join s y on x.gram = y.gram and x.doc_id <> y.doc_id group by 1, 2) p
  join g ga on ga.doc_id = a join g gb on gb.doc_id = b where 100 * shared >= 85 * (len(ga.grams) + len(gb.grams) - shared)),
{_COMPONENTS}
select g.doc_id, cast(len(grams) as bigint) as n_shingles, least(g.doc_id, coalesce(low, g.doc_id)) as component_id from g left join least on id = g.doc_id
"""

_EMBEDDINGS = f"""
with recursive v as (select vec_id, embedding::double[] as e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id and len(x.e) = len(y.e)
  where list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.95),
{_COMPONENTS},
n as (select a, count(*) as n_links from links group by a)
select e.vec_id, coalesce(n_links, 0) as n_links, least(e.vec_id, coalesce(low, e.vec_id)) as component_id, e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) as kept
from embeddings e left join least on id = e.vec_id left join n on n.a = e.vec_id
"""


def _grams(text: str) -> str:
    words = f"string_split(trim(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    return f"(select list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) from (select {words} as w))"


def _license_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(lid, text.replace("'", "''")) for lid, text in licenses.TEMPLATES)
    return f"""
with t(license_id, txt) as (values {rows}), tg as (select license_id, {_grams('txt')} as grams from t),
l as (select doc_id, string_split(text, chr(10)) as ls, text from documents where text is not null),
u as (select doc_id, unnest(range(1, len(ls) + 1)) as line, unnest(ls) as unit from l union all select doc_id, 0, text from l where len(ls) > 1),
ug as (select doc_id, line, {_grams('unit')} as grams from u),
d as (select doc_id, line, license_id, 2.0::double * len(list_intersect(ug.grams, tg.grams)) / (len(ug.grams) + len(tg.grams)) as dice from ug, tg where len(ug.grams) > 0)
select doc_id, line::int as line, license_id, max(dice) as dice from d where dice >= 0.8 group by 1, 2, 3
"""


_SUFFIX = f"""
with w as (select doc_id, row_number() over () as r, {_WORDS} as ws from documents),
s as (select r, doc_id, len(ws) as n, unnest(range(0, len(ws) - 49)) as pos, unnest([md5(array_to_string(ws[i:i + 49], ' ')) for i in range(1, len(ws) - 48)]) as run from w where len(ws) >= 50),
h as (select * from (select *, count(*) over (partition by run) as c from s) where c > 1),
b as (select *, case when pos - lag(pos) over (partition by r order by pos) <= 50 then 0 else 1 end as new from h),
i as (select *, sum(new) over (partition by r order by pos) as grp from b)
select doc_id, min(pos) as start_word, max(pos) + 50 as end_word, max(pos) + 50 - min(pos) as n_words, min(pos) = 0 and max(pos) + 50 = any_value(n) as whole from i group by r, doc_id, grp
"""

_CRC = """(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda x: ord(x)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::bigint[]), lambda x, _: xor(x >> 1, (x & 1) * 3988292384::bigint))))"""

_TRIE = f"""
with t as (select conv_id, {_CRC.format("cast(conv_id as varchar)")} as c, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) as x, turn from conversations where conv_id is not null),
o as (select conv_id, xor(any_value(c), 4294967295::bigint) % 4 as h, list(x order by turn nulls first, x.r, x.t) as turns from t group by conv_id),
b as (select c.conv_id, list_concat(coalesce(r.turns[1:c.h], []), c.turns[c.h + 1:]) as turns from o c left join o r on r.conv_id = c.conv_id - c.conv_id % 20),
m as (select conv_id, turns[1:d] as p, d, len(turns) = d as last from (select conv_id, turns, unnest(range(0, len(turns) + 1)) as d from b)),
n as (select p, d, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where last), '')) as ends_sha256,
  case when d = 0 then 0 else (count(*) - 1) * len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) end as saved from m group by p, d),
k as (select n.p, count(c.p) as n_children from n left join n c on c.d = n.d + 1 and c.p[1:n.d] = n.p group by n.p),
s as (select p[1:a] as p, sum(saved)::bigint as saved_tokens, count(*) filter (where n_children = 0) as n_leaves
  from (select n.p, saved, n_children, unnest(range(0, n.d + 1)) as a from n join k on k.p = n.p) group by 1)
select n.conv_id, n.d as depth, u.conv_id as parent_conv_id, n.n_convs, k.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
from n join k on k.p = n.p join s on s.p = n.p left join n u on u.d = n.d - 1 and n.p[1:u.d] = u.p
"""


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    wilson = "(({h} * 1.0::double / {n} + 9.0::double / (2 * {n}) - 3.0::double * sqrt({h} * 1.0::double / {n} * (1 - {h} * 1.0::double / {n}) / {n} + 9.0::double / (4 * {n} * {n}))) / (1 + 9.0::double / {n}))"
    host = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    full = "list_filter({}, lambda x: x <> '')"
    tokens = f"""list_sort(list_distinct(list_concat(
      list_filter(['scheme=' || lower(regexp_extract(coalesce(url, ''), '(?s)^(.*?)://', 1)), 'ext=' || lower(regexp_extract(path, '\\.([A-Za-z0-9]{{1,5}})$', 1))], lambda x: x[-1] <> '='),
      list_transform({full.format("string_split(host, '.')")}, lambda x: 'host=' || x), list_transform({full.format("regexp_split_to_array(host, '[.-]')")}, lambda x: 'word=' || x),
      list_transform({full.format("string_split(regexp_replace(path, '\\.[A-Za-z0-9]{1,5}$', ''), '/')")}, lambda x: 'path=' || regexp_replace(lower(x), '[0-9]+', '#', 'g')),
      list_transform({full.format("string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*[?]([^#]*)', 1), '&')")}, lambda x: 'key=' || lower(split_part(x, '=', 1))))))"""
    return f"""
with r(verdict, rh, rp) as (values {rules}),
u as (select distinct url, {host} as host, {path} as path from pages),
a as (select *, {tokens} as has from u),
g as (select url, rh || rp as rule, verdict, row_number() over (partition by url order by length(rh) + length(rp) desc, rh || rp desc) as rn
  from u join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)),
l as (select row_number() over () as id, has, (toxic = 1 or quality = 0)::int as bad from pages join labels on doc_id = page_id join a on a.url = pages.url where toxic = 1 or (toxic is not null and quality is not null) or quality = 0),
c as (select greatest(10, 0.0005 * count(*)) as least from l),
e as (select id, bad, unnest(has) as token from l),
f as (select token, {wilson.format(h='sum(bad)', n='count(*)')} as bound from e group by token having sum(bad) >= (select least from c)),
i as (select id, bad, list_sort(list(token order by -bound, token)[1:12]) as items from e join f using (token) group by id, bad),
s as (select bad, unnest(list_transform(list_filter(range(1, (1 << len(items))::bigint), lambda k: bit_count(k) <= 4), lambda k: list_filter(items, lambda x, j: (k >> (j - 1)) & 1 = 1))) as tokens from i),
q as (select tokens, count(*) as n, sum(bad) as hits, {wilson.format(h='sum(bad)', n='count(*)')} as confidence from s group by tokens),
k as (select * from q where hits >= (select least from c) and confidence >= 0.5),
z as (select * from k where not exists (select 1 from k o where len(o.tokens) < len(k.tokens) and list_has_all(k.tokens, o.tokens))),
b as (select url, arg_max(array_to_string(tokens, ' '), struct_pack(c := confidence, t := array_to_string(tokens, ' '))) as mined
  from a join z on list_has_all(has, tokens) where url not in (select url from g) group by url)
select page_id, u.host, u.path, g.rule, coalesce(g.verdict, case when mined is null then 'allow' else 'block' end) as verdict, mined
from pages p join u on u.url is not distinct from p.url left join g on g.url = p.url and rn = 1 left join b on b.url = p.url
"""


SQL: dict[str, str] = {
    "op2_jaccard_join": _JACCARD, "op3_mix_sources": _MIX, "op6_exact_dedup": _DEDUP, "op8_embedding_dedup": _EMBEDDINGS,
    "op9_license_scan": _license_sql(), "op10_suffix_dedup": _SUFFIX,
    "op11_conversation_trie": _TRIE, "op12_filter_urls": _url_sql(),
}
