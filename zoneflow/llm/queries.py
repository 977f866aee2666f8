"""The registered queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zoneflow.llm.decontaminate import contamination
from zoneflow.llm.divergence import source_divergence
from zoneflow.llm.fill_in_middle import fill_in_middle, store_frames, with_digests
from zoneflow.llm.fingerprint import fingerprints
from zoneflow.llm.packing import pack_documents
from zoneflow.llm.pii import personal_data
from zoneflow.llm.quality import score_quality
from zoneflow.llm.sharding import shard_documents
from zoneflow.llm.similarity import jaccard_components
from zoneflow.llm.text import table
from zoneflow.llm.token_count import token_counts
from zoneflow.llm.top_k import exact_top_k
from zoneflow.llm.toxicity import score_documents
from zoneflow.llm.url_filter import judge_urls, repeated_addresses

# Fixed rules of the address query: verdict, host, path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_minimax_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of near equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"), shards=8)


@query("op2_ngram_jaccard_join", r"""
with recursive words as (
  select doc_id, string_split_regex(trim(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g')), ' ') w from documents),
sized as (select doc_id, case when w = [''] then [] else w end w from words),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) end s from sized),
tokens as (select doc_id, len(s) n, unnest(s) t from sets),
links as (
  select a.doc_id a, b.doc_id b from tokens a join tokens b on a.t = b.t and a.doc_id <> b.doc_id
    and 100 * a.n >= 90 * b.n and 100 * b.n >= 90 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (select a root, b node from links union select r.root, l.b from reach r join links l on l.a = r.node)
select s.doc_id, len(s.s)::bigint n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) component_id
from sets s left join (select root, min(node) low from reach group by 1) m on m.root = s.doc_id
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of at least 90 % Jaccard similarity between the 3-word shingle sets of all documents."""
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


@query("op4_cost_balanced_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids in sequences of at most 1024."""
    return pack_documents(table(spark, sf_dir, "documents"), capacity=1024)


@query("op5_url_filter", r"""
with parts as (
  select page_id, url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
split as (
  select page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') path,
    regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) q from parts),
named as (
  select *, list_sort(list_filter(string_split(coalesce(q, ''), '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref)(=|$)'))) kept
  from split),
addressed as (
  select page_id, host, path, case when host <> '' then
    host || regexp_replace(path, '/+$', '') || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end end address
  from named),
listed as (select address from addressed where address is not null group by 1 having count(*) >= 2),
rules(verdict, h, p) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
ruled as (
  select a.page_id, a.host, a.path, a.address, r.h || r.p rule, r.verdict,
    row_number() over (partition by a.page_id, a.host, a.path, a.address order by length(r.h || r.p) desc) k
  from addressed a left join rules r on (a.host = r.h or ends_with(a.host, '.' || r.h)) and starts_with(a.path, r.p))
select page_id, host, path, rule,
  coalesce(verdict, case when address in (select address from listed) then 'block' else 'allow' end) verdict
from ruled where k = 1
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the address of every page; listed are addresses that several pages share."""
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, RULES, repeated_addresses(pages))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), limit=2048)


@query("op10_benchmark_decontamination", r"""
with dw as (
  select row_number() over () row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
bw as (
  select item_id::varchar item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where item_id is not null and text is not null),
windows as (
  select item, least(len(w), 10) m, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') for i in range(1, len(w) - least(len(w), 10) + 2)]) t
  from bw where len(w) > 0),
sizes as (select distinct m from windows),
places as (
  select row_id, m, unnest(range(1, len(w) - m + 2)) i, w from dw join sizes on len(w) >= m),
hits as (
  select p.row_id, p.i, p.m, x.item from places p join windows x on x.m = p.m and x.t = array_to_string(p.w[p.i:p.i + p.m - 1], ' ')),
covered as (select row_id, count(distinct k) n from (select row_id, unnest(range(i, i + m)) k from hits) group by 1),
met as (
  select row_id, count(*) n, string_agg(item, ',' order by item) items from (select distinct row_id, item from hits) group by 1)
select doc_id, len(w)::bigint n_words, coalesce(c.n, 0)::bigint n_hit, coalesce(m.n, 0)::bigint n_items,
  sha256(coalesce(m.items, '')) items_sha256, coalesce(c.n, 0) > 0 contaminated
from dw left join covered c using (row_id) left join met m using (row_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark passages of ten words."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


@query("op3_kneser_ney_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


@query("op6_multiset_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints(table(spark, sf_dir, "documents"))


@query("op7_pii_disclosure")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms of every document."""
    return personal_data(table(spark, sf_dir, "documents"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query("op11_source_divergence", r"""
with d as (
  select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
g as (select distinct lang, source from d),
kept as (select lang, term, count(*) c from w group by 1, 2 having count(distinct r) >= 10),
own as (select lang, source, term, count(*) c from w semi join kept using (lang, term) group by 1, 2, 3),
langs as (select lang, count(*) v, sum(c) n from kept group by 1),
sizes as (select lang, source, sum(c) n from own group by 1, 2),
p as (
  select g.lang, g.source, k.term, coalesce(o.c, 0) c,
    1 + (1000000000::hugeint * (coalesce(o.c, 0) + 2)) // (coalesce(s.n, 0) + 2 * l.v) p,
    1 + (1000000000::hugeint * (k.c + 2)) // (l.n + 2 * l.v) q
  from g join kept k on k.lang = g.lang join langs l on l.lang = g.lang
    left join sizes s on s.lang = g.lang and s.source = g.source
    left join own o on o.lang = g.lang and o.source = g.source and o.term = k.term),
sums as (
  select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
pairs as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(s.value, 0) value
  from g a join g b on a.lang = b.lang and a.source <> b.source
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (
  select lang, source, 'term' part, term item, ((p - q) * (p - q)) // (p + q) value from p where c > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value::bigint value, rank::int rank from ranked where part = 'pair' or rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms that stand out in it."""
    return source_divergence(table(spark, sf_dir, "documents"), least_documents=10, ranks=10)


@query("op12_exact_top_k", """
with v as (
  select row_number() over () r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) q from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.r, a.vec_id query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint score
  from v a join v b on a.vec_id % 20 = 0 and a.r <> b.r),
k as (select *, row_number() over (partition by r order by score desc, vec_id) rank from s)
select query_id, rank::int rank, vec_id, score from k where rank <= 20
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best by inner product of every twentieth vector, among all others."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


@query("op13_fill_in_middle", """
with d as (
  select doc_id, coalesce(text, '') t, length(coalesce(text, '')) n, sha256('1:' || coalesce(doc_id::varchar, '')) h from documents),
k as (
  select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) c1, ('0x' || substr(h, 9, 8))::bigint % (n + 1) c2,
    ('0x' || substr(h, 17, 8))::bigint h3, ('0x' || substr(h, 25, 8))::bigint h4 from d),
f as (
  select *, least(c1, c2) a, greatest(c1, c2) b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end form from k),
o as (select *, substr(t, 1, a) prefix, substr(t, a + 1, b - a) middle, substr(t, b + 1) suffix from f)
select doc_id, n::bigint n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) output_sha256, sha256(t) restored_sha256
from o
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and rearranged, with the digests of its output and of the text rebuilt from it."""
    return with_digests(fill_in_middle(store_frames(table(spark, sf_dir, "documents"))))
