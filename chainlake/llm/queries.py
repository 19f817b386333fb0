"""Registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm import (
    bpe, extend, grades, lattice, ngram_join, packing, periods, pieces, quality_rules, ranking, secret_scan, suffix, urls,
)
from chainlake.llm.base import ready, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# The rules that the pages are judged by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), RANKS, PATTERN)


@query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Grades: 0 toxic, 1 poor, 2 neither; rows that don't tell are no ratings.
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return grades.graded(docs, grades.train(docs, labels, grade, top=2))


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


QUALITY_SQL = r"""
with texts as (select doc_id, lang, source, coalesce(text, '') as t from documents),
words as (
  select doc_id, lang, source, t, regexp_extract_all(t, '[^ \x09-\x0D]+') as w from texts
),
windows as (
  select doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') as run
  from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from words where len(w) >= 8)
),
repeated as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, run) as n from windows) where n > 1
),
covered as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from repeated) group by doc_id
),
lines as (
  select doc_id, count(*) - count(distinct line) as n
  from (select doc_id, unnest(string_split(t, chr(10))) as line from words)
  where regexp_matches(line, '[^ \x09-\x0D]') group by doc_id
),
counts as (
  select doc_id, lang, source, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(length(t) - length(regexp_replace(t, '[!?]', '', 'g')) as bigint) as n_marks,
    cast(coalesce(l.n, 0) as bigint) as n_dup_lines, cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from words left join lines l using (doc_id) left join covered c using (doc_id)
),
rated as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    n_symbols * 1000 // greatest(n_words, 1) as symbols, n_marks * 1000 // greatest(n_words, 1) as marks,
    n_repeat_words * 1000 // greatest(n_words, 1) as repeats, n_dup_lines * 1000 // greatest(n_words, 1) as lines,
    word_chars * 100 // greatest(n_words, 1) as width
  from counts
),
long_form as (
  select lang, source, measure, (value >> greatest(length(bin(value)) - 5, 0)) << greatest(length(bin(value)) - 5, 0) as bucket
  from (select lang, source, base_failed, symbols, marks, repeats, lines, width from rated)
  unpivot (value for measure in (symbols, marks, repeats, lines, width)) where not base_failed
),
group_steps as (
  select lang, source, measure, bucket, sum(count(*)) over (partition by lang, source, measure order by bucket) as upto,
    sum(count(*)) over (partition by lang, source, measure) as total
  from long_form group by lang, source, measure, bucket
),
tongue_steps as (
  select lang, measure, bucket, sum(count(*)) over (partition by lang, measure order by bucket) as upto,
    sum(count(*)) over (partition by lang, measure) as total
  from long_form group by lang, measure, bucket
),
all_steps as (
  select measure, bucket, sum(count(*)) over (partition by measure order by bucket) as upto,
    sum(count(*)) over (partition by measure) as total
  from long_form group by measure, bucket
),
spreads(measure, least) as (values ('symbols', 100), ('marks', 100), ('repeats', 50), ('lines', 30), ('width', 100)),
own as (
  select lang, source, measure, cast(any_value(total) as double) as docs,
    min(bucket) filter (upto * 4 >= total) as low, min(bucket) filter (upto * 4 >= total * 3) as high
  from group_steps group by lang, source, measure
),
tongue as (
  select lang, measure, cast(any_value(total) as double) as docs,
    min(bucket) filter (upto * 4 >= total) as low, min(bucket) filter (upto * 4 >= total * 3) as high
  from tongue_steps group by lang, measure
),
overall as (
  select measure, min(bucket) filter (upto * 4 >= total) as low, min(bucket) filter (upto * 4 >= total * 3) as high
  from all_steps group by measure
),
wide as (
  select g.lang, g.source, a.measure, o.docs as o_docs, t.docs as t_docs,
    cast(o.high + 3 * greatest(o.high - o.low, s.least) as double) as o_most, cast(o.low - 3 * greatest(o.high - o.low, s.least) as double) as o_least,
    cast(t.high + 3 * greatest(t.high - t.low, s.least) as double) as t_most, cast(t.low - 3 * greatest(t.high - t.low, s.least) as double) as t_least,
    cast(a.high + 3 * greatest(a.high - a.low, s.least) as double) as a_most, cast(a.low - 3 * greatest(a.high - a.low, s.least) as double) as a_least
  from (select distinct lang, source from rated) g cross join overall a join spreads s on s.measure = a.measure
  left join own o on o.lang is not distinct from g.lang and o.source is not distinct from g.source and o.measure = a.measure
  left join tongue t on t.lang is not distinct from g.lang and t.measure = a.measure
),
mixed as (
  select *, case when t_docs is null then a_most else (t_docs * t_most + 50.0::double * a_most) / (t_docs + 50.0::double) end as m_most,
    case when t_docs is null then a_least else (t_docs * t_least + 50.0::double * a_least) / (t_docs + 50.0::double) end as m_least
  from wide
),
fences as (
  select lang, source, measure, case when o_docs is null then m_most else (o_docs * o_most + 50.0::double * m_most) / (o_docs + 50.0::double) end as most,
    case when measure <> 'width' then -1 when o_docs is null then m_least
      else (o_docs * o_least + 50.0::double * m_least) / (o_docs + 50.0::double) end as fewest
  from mixed
),
outside as (
  select distinct r.doc_id
  from (select doc_id, lang, source, symbols, marks, repeats, lines, width from rated)
  unpivot (value for measure in (symbols, marks, repeats, lines, width)) r
  join fences f on f.lang is not distinct from r.lang and f.source is not distinct from r.source and f.measure = r.measure
  where r.value > f.most or r.value < f.fewest
)
select doc_id, n_words, word_chars, n_symbols, n_marks, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and doc_id not in (select doc_id from outside) as kept
from rated
"""


@query(QUALITY_SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


LATTICE_SQL = """
with recursive vectors as (
  select vec_id, cast(embedding as double[]) as v, sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))) as norm
  from embeddings where embedding is not null
),
links as (
  select x.vec_id as a, y.vec_id as b from vectors x join vectors y on x.vec_id != y.vec_id
  where x.norm > 0 and y.norm > 0 and list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.9
),
reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on r.b = l.a),
parts as (select a, min(b) as component_id from reach group by a),
degrees as (select a, count(*) as n from links group by a)
select p.a as vec_id, coalesce(n, 0) as n_links, component_id, p.a = component_id as kept
from parts p left join degrees d on p.a = d.a
"""


@query(LATTICE_SQL)
def op5_lattice_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


SUFFIX_SQL = """
with texts as (select doc_id, encode(coalesce(text, '')) as b from documents),
sized as (select doc_id, b, octet_length(b) as n, md5(b) as h from texts),
starts as (
  select doc_id, p, md5(b[p:p + 199]) as h
  from (select doc_id, b, unnest(range(1, n - 198)) as p from sized where n >= 200)
),
again as (select doc_id, p from (select doc_id, p, count(*) over (partition by h) as c from starts) where c > 1),
edges as (
  select doc_id, p, case when lag(p) over (partition by doc_id order by p) >= p - 200 then 0 else 1 end as fresh from again
),
runs as (select doc_id, p, sum(fresh) over (partition by doc_id order by p) as g from edges),
spans as (select doc_id, g, min(p) as s, max(p) + 200 as e from runs group by doc_id, g),
gaps as (select doc_id, s, e, lag(e, 1, 1) over (partition by doc_id order by s) as f from spans),
parts as (
  select doc_id, string_agg(hex(b[f:s - 1]), '' order by s) as kept, max(e) as tail, sum(e - s) as removed, count(*) as spans
  from gaps join sized using (doc_id) group by doc_id
)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, cast(coalesce(spans, 0) as bigint) as n_spans,
  sha256(case when spans is null then b else unhex(kept || hex(b[tail:])) end) as kept_sha256
from sized left join parts using (doc_id)
"""


@query(SUFFIX_SQL)
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


EXTEND_SQL = r"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') as w from documents),
starts as (
  select doc_id, p, row_number() over (partition by md5(array_to_string(list_slice(w, p, p + 19), ' ')) order by doc_id, p) as k
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as p from texts where len(w) >= 20)
),
gone as (select distinct doc_id, unnest(range(p, p + 20)) as q from starts where k > 1),
each as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as q from texts),
kept as (
  select doc_id, string_agg(word, ' ' order by q) as words, count(*) as n
  from each anti join gone using (doc_id, q) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(words, '')) as kept_sha256
from texts left join kept using (doc_id)
"""


@query(EXTEND_SQL)
def op7_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extend.without_later_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


NGRAM_SQL = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \x09-\x0D]+') as w
  from documents
),
grams as (
  select distinct doc_id, g from (
    select doc_id, array_to_string(list_slice(w, p, p + 3), ' ') as g
    from (select doc_id, w, unnest(range(1, len(w) - 2)) as p from texts where len(w) >= 4)
    union all select doc_id, array_to_string(w, ' ') from texts where len(w) between 1 and 3
  )
),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
links as (
  select x.doc_id as a, y.doc_id as b
  from grams x join grams y on x.g = y.g and x.doc_id != y.doc_id
  group by x.doc_id, y.doc_id
  having 185 * count(*) >= 85 * ((select n from sizes s where s.doc_id = x.doc_id) + (select n from sizes s where s.doc_id = y.doc_id))
),
reach(a, b) as (select doc_id, doc_id from texts union select r.a, l.b from reach r join links l on r.b = l.a)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from (select a as doc_id, min(b) as component_id from reach group by a) left join sizes using (doc_id)
"""


@query(NGRAM_SQL)
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


@query()
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), MULTI_RANKS, PATTERN)


URL_SQL = r"""
with parts as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
),
split as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
),
rules(rule_host, rule_path, rule_verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
fit as (
  select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) as verdict
  from split join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from split left join fit using (page_id)
"""


@query(URL_SQL)
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query()
def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)


def planted(docs: DataFrame) -> DataFrame:
    """Documents, every tenth by a hash of its id with words that repeat from some place on."""
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce((h % 10 == 0) & (F.col("text").rlike("[^ \\t-\\r]")), F.lit(False))
    parts = (
        docs.select("doc_id", "text", F.when(chosen, words).alias("w"), F.floor(h / 10).alias("g"))
        .withColumn("n", F.size("w")).withColumn("a", F.col("g") % F.col("n"))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )
    again = F.expr("flatten(array_repeat(slice(w, cast(a as int) + 1, cast(p as int)), cast(ceil((n - a) / p) as int)))")
    text = F.concat_ws(" ", F.expr("slice(w, 1, cast(a as int))"), F.slice(again, F.lit(1), (F.col("n") - F.col("a")).cast("int")))
    return parts.select("doc_id", F.when(F.col("w").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(planted(table(spark, sf_dir, "documents"))).drop("runs")


RANKING_SQL = r"""
with found as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
),
sizes as (select doc_id, count(*) as n from found group by doc_id),
whole as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from sizes),
asked as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
),
held as (select doc_id, term, count(*) as tf from found where term in (select term from asked) group by doc_id, term),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / (2 * df + 1))) as bigint) as w
  from (select term, count(*) as df from held group by term) cross join whole
),
scores as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l))))) as bigint) as score
  from asked join held using (term) join weights using (term) join sizes using (doc_id) cross join whole
  group by item_id, doc_id
),
ranks as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranks where rank <= 50
"""


@query(RANKING_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
