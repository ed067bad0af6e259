"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewave.llm import (
    ann, credentials, embed_dedup, manifest, minhash, mixing, packing, phrases, quality, rans, toxicity, url_rules, warc,
)
from spindlewave.llm.common import stored, table
from spindlewave.session import work_dir

CAPACITY, END = 4096, 1


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer(), CAPACITY, END)


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.responses(table(spark, sf_dir, "pages"))
    return warc.derivatives(records, key="page_id")


MARGINS = [
    mixing.Margin("source", power=0.5),
    mixing.Margin("lang", shares={"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}),
    mixing.Margin("topic", power=0.9),
]
KEEP = 0.7


def op3_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    # Texts are read once; what is known of them is small.
    rows = stored(mixing.described(docs).drop("text"), "described")
    found = mixing.mixed(rows, MARGINS, KEEP)
    # How far the margins are from their targets, which the tokens may not allow.
    miss = F.round(F.lit(mixing.largest_miss(found, MARGINS)), 6).alias("largest_miss")
    columns = ["doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"), "sampled", miss]
    return found.select(*columns)


def op4_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "rans")
    rans.encode_documents(table(spark, sf_dir, "documents"), path, tokenizer(), END)
    return rans.read_blocks(spark, path, ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_grammar_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return credentials.secret_spans(docs, credentials.learn(docs))


def op6_pca_tiled_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def op7_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op8_kmeans_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 100 = 0"), k=10)


URL_RULES = [
    url_rules.Rule("org", "/", "allow"),
    url_rules.Rule("example.org", "/es/", "block"),
    url_rules.Rule("example.org", "/en/1", "block"),
    url_rules.Rule("com", "/fr/", "allow"),
    url_rules.Rule("com", "/de/", "block"),
]


def op9_association_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


def op10_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.learn(docs, table(spark, sf_dir, "labels"))
    found = quality.scored(docs, trees, threshold=0.3)
    return found.select("doc_id", (quality.fold() == 0).alias("held_out"), "score", "predicted")


def op11_era_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=10, top=2000)


def op12_midstate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # A document without an id is not tampered with.
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    tree = manifest.documents_manifest(docs, tampered, {"text": F.translate("text", "\n", "")})
    found = manifest.folded(tree, "__replaced")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, model, threshold=0.5)
    return found.select("doc_id", (quality.fold() == 0).alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_raked_mixing": op3_raked_mixing,
    "op4_rans_token_files": op4_rans_token_files,
    "op5_grammar_secrets": op5_grammar_secrets,
    "op6_pca_tiled_dedup": op6_pca_tiled_dedup,
    "op7_superminhash_dedup": op7_superminhash_dedup,
    "op8_kmeans_tree_search": op8_kmeans_tree_search,
    "op9_association_url_filter": op9_association_url_filter,
    "op10_boosted_quality": op10_boosted_quality,
    "op11_era_collocations": op11_era_collocations,
    "op12_midstate_manifest": op12_midstate_manifest,
    "op13_boosted_toxicity": op13_boosted_toxicity,
}
#: Token sets are grown one token at a time here, where Spark mines them.
URL_SQL = r"""
with recursive parted as (
  select page_id, url,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), rows_ as (
  select page_id, url,
    translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) as path
  from (select page_id, url, coalesce(rest, '') as rest from parted)
), urls as (
  select distinct url, host, path from rows_ where host <> ''
), tokens as (
  select url, host, path, list_distinct(list_filter(list_concat(
    ['scheme=' || lower(regexp_extract(url, '^([^:/?#]*)://', 1)),
     case when len(labels) > 1 then 'site=' || array_to_string(labels[-2:], '.') end,
     'host=' || host,
     case when regexp_matches(path, '\.([A-Za-z0-9]+)$') then 'ending=' || regexp_extract(path, '\.([A-Za-z0-9]+)$', 1) end,
     case when strpos(url, '#') > 0 then 'fragment' end],
    list_transform(labels, lambda x: 'label=' || x),
    list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> ''), lambda x: 'folder=' || x),
    list_transform(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: 'field=' || string_split(x, '=')[1])
  ), lambda x: x is not null)) as tokens
  from (select *, list_filter(string_split(host, '.'), lambda x: x <> '') as labels from urls)
), known as (
  select doc_id, max(coalesce(quality = 0, false) or coalesce(toxic = 1, false)) as bad
  from labels where doc_id is not null and (quality is not null or toxic is not null) group by doc_id
), baskets as (
  select row_number() over () as basket, list_sort(t.tokens) as tokens, k.bad
  from rows_ r join tokens t on t.url = r.url
  join known k on k.doc_id = try_cast(nullif(regexp_extract(r.path, '/([0-9]{1,18})(\.html)?/?$', 1), '') as bigint)
), items as (
  select basket, bad, unnest(tokens) as token from baskets
), common as (
  select token from items group by token
  having count(*) >= greatest(0.002 * (select count(*) from baskets), 20)
), kept as (
  select basket, bad, token from items where token in (select token from common)
), least as materialized (
  select greatest(0.002 * count(*), 20) as least from baskets
), sets as (
  -- Sets grow by tokens that come later in order, as long as enough bad URLs hold them.
  select basket, bad, [token] as rule, token as last from kept
  where token in (select token from kept, least group by token, least having sum(bad::int) >= 0.6 * least - 0.000001)
  union all
  select basket, bad, rule, last from (
    select *, sum(bad::int) over (partition by rule) as n from (
      select s.basket, s.bad, list_append(s.rule, k.token) as rule, k.token as last
      from sets s join kept k on s.basket = k.basket and k.token > s.last
    )
  ), least where n >= 0.6 * least - 0.000001
), rules as (
  select rule, sum(bad::int) / count(*) as confidence from sets, least group by rule, least
  having count(*) >= least and sum(bad::int) >= 0.6 * count(*)
), hits as (
  select distinct url from tokens t join rules r on list_has_all(t.tokens, r.rule)
), fixed as (
  select r.*, h.url is not null as hit,
    case
      when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
      when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
      when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/'
    end as rule
  from rows_ r left join hits h on h.url = r.url
)
select page_id, host, path, rule,
  case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block'
       when rule is not null then 'allow' when hit then 'block' else 'allow' end as verdict
from fixed
"""

def raking_sql(jobs: int = mixing.BOUNDED // mixing.AT_ONCE, sweeps: int = mixing.AT_ONCE, rescales: int = mixing.RESCALES) -> str:
    """The mixing of op3 as SQL: sweeps by recursion, with the same end of fitting."""
    text = r"""
with recursive rows_ as materialized (
  select doc_id, source, lang,
    case when size - length(replace(body, '|', '')) > size / 50.0 then 'table'
         when size - length(translate(body, '#$%&*', '')) > size / 50.0 then 'symbols'
         when size - length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) > size / 2.0 then 'capitals'
         when size < 500 then 'brief' else 'prose' end as topic,
    len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) as tokens
  from (select *, coalesce(text, '') as body, length(coalesce(text, '')) as size from documents)
), cells as materialized (
  select source, lang, topic, sum(tokens)::double as t from rows_ group by all
), goal_source as materialized (
  select source as v, s, pow(s, 0.5) / sum(pow(s, 0.5)) over () as target
  from (select source, sum(t) as s from cells group by source having sum(t) > 0)
), goal_topic as materialized (
  select topic as v, s, pow(s, 0.9) / sum(pow(s, 0.9)) over () as target
  from (select topic, sum(t) as s from cells group by topic having sum(t) > 0)
), goal_lang as materialized (
  select lang as v, s, case when wanted is null then s / sum(s) over ()
    else wanted / sum(wanted) over () * sum(case when wanted is not null then s end) over () / sum(s) over () end as target
  from (select lang, sum(t) as s, case lang when 'en' then 0.55::double when 'de' then 0.15 when 'fr' then 0.15 when 'es' then 0.15 end as wanted
        from cells group by lang having sum(t) > 0)
)"""
    names = ("source", "lang", "topic")
    for name in names:
        # What each value gives: all it has, or its target, with what is missing shared out.
        text += f""", scale_{name} as (
  select {KEEP} * sum(t) as whole, {KEEP} * sum(t) as s from cells
  union all
  select whole, more from (
    select whole, x.s, (whole - coalesce(sum(case when g.target * x.s >= g.s then g.s end), 0)) / sum(case when g.target * x.s < g.s then g.target end) as more
    from scale_{name} x, goal_{name} g group by whole, x.s
  ) where more > s * (1 + {mixing.CLOSE})
), give_{name} as materialized (
  select v, least(s, target * (select max(s) from scale_{name})) as g from goal_{name}
)"""
    goals = ", ".join(f"x{k}.g as g{k}" for k in range(3))
    joins = " ".join(f"left join give_{name} x{k} on x{k}.v is not distinct from c.{name}" for k, name in enumerate(names))
    own = "source, lang, topic, t, g0, g1, g2"
    relation = "(select *, 0.0::double as f0 from fit)"
    for step in range(3 * sweeps):
        k = step % 3
        relation = f"""(
  select job, top, {own}, w2 as w, greatest(f0, abs(least(t, w2) - least(t, w)) / nullif(t, 0)) as f0 from (
    select *, least(w * coalesce(case when g{k} > total then 1 + (g{k} - total) / nullif(loose, 0) else g{k} / total end, 1), t * 1e9) as w2 from (
      select *, nullif(sum(least(t, w)) over (partition by {names[k]}), 0) as total,
        sum(case when w < t then w else 0 end) over (partition by {names[k]}) as loose from {relation})))"""
    text += f""", fit as (
  select 0 as job, {own}, w, top from (select c.*, {goals}, t as w, 1e300::double as top from cells c {joins})
  union all
  select job + 1, {own}, w, max(f0) over () from {relation} where job < {jobs} and top >= {mixing.NEAR}
), raked as materialized (
  select source, lang, topic, t, least(t, w) as w from fit where job = (select max(job) from fit)
), s0 as (select {KEEP} * sum(t) / sum(w) as s from raked)"""
    for k in range(rescales):
        text += f", s{k + 1} as (select s * {KEEP} * sum(t) / sum(least(t, w * s)) as s from raked, s{k} group by s)"
    text += f""", chances as materialized (
  select source, lang, topic, t, case when t > 0 then round(least(1.0, w * s / t), 9) else 1.0 end as p from raked, s{rescales}
)"""
    misses = " union all ".join(
        f"select abs(g.target - r / (select sum(t * p) from chances)) as miss from goal_{name} g "
        f"join (select {name} as v, sum(t * p) as r from chances group by {name}) x on x.v is not distinct from g.v"
        for name in names
    )
    return text + f"""
select doc_id, r.source, r.lang, r.topic, tokens, round(p, 6) as probability,
  coalesce(('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint / 4294967296.0, 0) < p as sampled,
  (select round(max(miss), 6) from ({misses})) as largest_miss
from rows_ r join chances c on c.source is not distinct from r.source and c.lang is not distinct from r.lang and c.topic is not distinct from r.topic
"""


PHRASE_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as materialized (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), f1 as materialized (
  select lang, word, count(*) as f from (select lang, unnest(w) as word from words) group by all
), f2 as materialized (
  select lang, x[1] as w1, x[2] as w2, count(*) as f
  from (select lang, unnest(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) as x from words) group by all
), f3 as materialized (
  select lang, x[1] as w1, x[2] as w2, x[3] as w3, count(*) as f
  from (select lang, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) as x from words)
  group by all having count(*) >= 10
), longer as (
  select lang, w1, w2, max(f) as longest
  from (select lang, w1, w2, f from f3 union all select lang, w2, w3, f from f3) group by all
), two as (
  select p.lang, p.w1 || ' ' || p.w2 as phrase, p.f as a, x.f as l, y.f as r,
    1000000::hugeint * p.f * p.f // (x.f::hugeint * y.f) as score
  from f2 p join f1 x on x.lang = p.lang and x.word = p.w1 join f1 y on y.lang = p.lang and y.word = p.w2
  left join longer o on o.lang = p.lang and o.w1 = p.w1 and o.w2 = p.w2
  where p.f >= 10 and (o.longest is null or 100 * o.longest < 50 * p.f)
), three as (
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 as phrase, t.f as a, x.f as fx, yz.f as fyz, xy.f as fxy, z.f as fz,
    1000000::hugeint * t.f * t.f // (x.f::hugeint * yz.f) as s1, 1000000::hugeint * t.f * t.f // (xy.f::hugeint * z.f) as s2
  from f3 t join f1 x on x.lang = t.lang and x.word = t.w1 join f1 z on z.lang = t.lang and z.word = t.w3
  join f2 xy on xy.lang = t.lang and xy.w1 = t.w1 and xy.w2 = t.w2
  join f2 yz on yz.lang = t.lang and yz.w1 = t.w2 and yz.w2 = t.w3
), scored as (
  select * from two
  union all
  select lang, phrase, a, case when s1 <= s2 then fx else fxy end, case when s1 <= s2 then fyz else fz end, least(s1, s2) from three
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from scored
)
select lang, rank, phrase, a, l, r, n, score::bigint as score
from ranked join (select lang, sum(f)::bigint as n from f1 group by lang) using (lang) where rank <= 2000
"""
MANIFEST_SQL = r"""
with recursive crc_table as materialized (
  select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t
), checked as (
  select d.*, coalesce(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)) & 1 = 1, false) as tampered
  from documents d, crc_table
), hashed as (
  select doc_id, source, sha256(own || coalesce(strlen(text)::varchar || ':' || text, '-')) as leaf,
    sha256(own || coalesce(strlen(other)::varchar || ':' || other, '-')) as replaced
  from (select *, case when tampered then replace(text, chr(10), '') else text end as other, coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-') || coalesce(strlen(source)::varchar || ':' || source, '-') || coalesce(strlen(lang)::varchar || ':' || lang, '-') || coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-') as own from checked)
), leaves as materialized (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
    count(*) over (partition by source) as n
  from hashed
), nodes as (
  select source, 0::bigint as level, idx, n, leaf as digest from leaves
  union all
  select source, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by idx))
  from nodes where n > 1 group by source, level, idx // 3, n
), runs as materialized (
  select source, level, idx // 3 as idx, list(digest order by idx) as digests from nodes where n > 1 group by source, level, idx // 3
), subroots as materialized (
  select source, digest, row_number() over (order by source nulls first) - 1 as idx, count(*) over () as n from nodes where n = 1
), tops as (
  select 0::bigint as level, idx, n, digest from subroots
  union all
  select level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by idx)) from tops where n > 1 group by level, idx // 3, n
), top_runs as materialized (
  select level, idx // 3 as idx, list(digest order by idx) as digests from tops where n > 1 group by level, idx // 3
), walk as (
  select doc_id, source, leaf, 0::bigint as level, idx, n, replaced as cur, '' as proof from leaves
  union all
  select doc_id, w.source, leaf, w.level + 1, w.idx // 3, (n + 2) // 3,
    sha256(array_to_string(list_transform(digests, lambda d, i: case when i = w.idx % 3 + 1 then cur else d end), '')),
    proof || array_to_string(list_filter(digests, lambda d, i: i <> w.idx % 3 + 1), '')
  from walk w join runs r on r.source is not distinct from w.source and r.level = w.level and r.idx = w.idx // 3
  where w.n > 1
), further as (
  select doc_id, leaf, s.digest as subroot, 0::bigint as level, s.idx, s.n, cur, proof
  from walk w join subroots s on s.source is not distinct from w.source where w.n = 1
  union all
  select doc_id, leaf, subroot, w.level + 1, w.idx // 3, (n + 2) // 3,
    sha256(array_to_string(list_transform(digests, lambda d, i: case when i = w.idx % 3 + 1 then cur else d end), '')),
    proof || array_to_string(list_filter(digests, lambda d, i: i <> w.idx % 3 + 1), '')
  from further w join top_runs r on r.level = w.level and r.idx = w.idx // 3
  where w.n > 1
)
select doc_id, leaf, subroot, t.digest as root, sha256(proof) as proof_sha256, cur as folded_root, cur = t.digest as verified
from further f, (select digest from tops where n = 1) t where f.n = 1
"""


ORACLES: dict[str, str] = {
    "op3_raked_mixing": raking_sql(),
    "op9_association_url_filter": URL_SQL,
    "op11_era_collocations": PHRASE_SQL,
    "op12_midstate_manifest": MANIFEST_SQL,
}
