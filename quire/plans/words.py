"""Vocabulary queries: a document's source stands for its edition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import vocabulary as V
from quire.plans.common import Registry, table

R = Registry()

_OCC = """occ as (select doc_id as id, source as edition, k as key from (select doc_id, source,
  regexp_replace(upper(replace(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ß', 'ss')), '[^A-Z]', '', 'g') as k from documents) where length(k) >= 3)"""
VOCAB = "vocab as (select key, list_sort(list(distinct edition)) as editions, count(distinct edition)::bigint as n_editions from occ group by key)"
FUZZY = """placed as (select *, left(key, 2) as block, row_number() over (partition by left(key, 2) order by key) as at from vocab),
pairs as (select s.key as variant, s.editions[1] as edition, c.key as canonical, levenshtein(s.key, c.key)::bigint as edit_distance, c.n_editions
  from placed s join placed c on s.block = c.block and c.at - s.at >= -30 and c.at - s.at < 30
  where s.n_editions = 1 and c.n_editions > 1 and abs(length(s.key) - length(c.key)) <= 2
    and left(s.key, greatest(2, ceil(least(length(s.key), length(c.key)) / 2)::int)) = left(c.key, greatest(2, ceil(least(length(s.key), length(c.key)) / 2)::int))
    and not list_contains(c.editions, s.editions[1]) and levenshtein(s.key, c.key) <= 2),
sug as (select variant, edition, row_number() over (partition by variant order by edit_distance, n_editions desc, canonical) as rank, canonical, edit_distance, n_editions from pairs qualify rank <= 4)"""
_FUZZY = f"{_OCC}, {VOCAB}, {FUZZY}"


def _occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.occurrences(table(spark, sf_dir, "documents"))


@R.query("select p_partkey, regexp_replace(upper(p_name), '[^A-Z]', '', 'g') as name_key, regexp_replace(upper(p_brand), '[^A-Z]', '', 'g') as brand_key from part")
def norm_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.key(F.col("p_name")).alias("name_key"), X.key(F.col("p_brand")).alias("brand_key"))


@R.query(f"with {_OCC}, {VOCAB} select key, editions[1] as edition from vocab where n_editions = 1")
def vocab_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.vocabulary(_occurrences(spark, sf_dir)).where("n_editions = 1").select("key", F.get("editions", F.lit(0)).alias("edition"))


@R.query(f"with {_OCC}, {VOCAB} select key, array_to_string(editions, ',') as editions, n_editions from vocab where n_editions > 1")
def vocab_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.vocabulary(_occurrences(spark, sf_dir)).where("n_editions > 1").select("key", F.array_join("editions", ",").alias("editions"), "n_editions")


@R.query(f"with {_FUZZY} select * from sug")
def fuzzy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.suggestions(V.vocabulary(_occurrences(spark, sf_dir)))


@R.query(
    f"""with {_FUZZY}, best as (select variant, min(edit_distance) as d, arg_min(n_editions, rank) as n, list(edit_distance) as l from sug group by variant)
select count(*) as candidates, count(*) filter (d = 1) as distance_one, count(*) filter (len(list_filter(l, lambda x: x = d)) = 1) as unique_best,
  count(*) filter (n >= 4) as widely_confirmed from best"""
)
def candidate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.summary(fuzzy_candidates(spark, sf_dir))


@R.query(
    f"""with {_OCC}, {VOCAB} select key, lag(key, 2) over w as before2, lag(key) over w as before1, lead(key) over w as after1, lead(key, 2) over w as after2
from vocab window w as (order by key)"""
)
def vocab_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.neighbours(V.vocabulary(_occurrences(spark, sf_dir)))


@R.query(f"with {_OCC} select edition, key, lead(key) over (partition by edition order by key) as successor from (select distinct edition, key from occ)")
def edition_successor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.successors(_occurrences(spark, sf_dir))


@R.query(
    f"""with {_OCC}, have as (select distinct edition, key from occ), words as (select key from have group by key having count(*) >= 3),
grid as (select e.edition, w.key from words w, (select distinct edition from have) e),
marks as (select coalesce(g.edition, h.edition) as edition, coalesce(g.key, h.key) as key, h.key as present from grid g full join have h on g.edition = h.edition and g.key = h.key),
seen as (select edition, key, present, last_value(present ignore nulls) over (partition by edition order by key rows between unbounded preceding and 1 preceding) as absorber from marks)
select edition, absorber, key from seen where present is null and absorber is not null"""
)
def absent_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.absent_between(_occurrences(spark, sf_dir))


@R.query(
    """with s as (select l_partkey, l_suppkey, max(l_extendedprice) as size from lineitem group by all)
select a.l_partkey, a.l_suppkey, a.size, median(b.size) as median_elsewhere, count(*) as n_others from s a join s b on a.l_partkey = b.l_partkey and a.l_suppkey <> b.l_suppkey
group by all having count(*) >= 3 and median(b.size) > 0 and a.size > 1.5 * median(b.size) and a.size - median(b.size) > 1000"""
)
def oversize_vs_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.max("l_extendedprice").alias("size"))
    return V.oversized(sizes, "l_partkey", "l_suppkey", "size", 1.5, 1000)


@R.query(
    """with s as (select lang, source, max(n_chars) as size from documents group by all)
select a.lang, a.source, a.size, median(b.size) as median_elsewhere, count(*) as n_others from s a join s b on a.lang = b.lang and a.source <> b.source
group by all having count(*) >= 3 and median(b.size) > 0 and a.size > 1.2 * median(b.size) and a.size - median(b.size) > 100"""
)
def oversize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.max("n_chars").alias("size"))
    return V.oversized(sizes, "lang", "source", "size", 1.2, 100)


@R.query("select lang, arg_min(left(text, 140), (source, doc_id)) as snippet, min(source) as first_source from documents where n_chars > 40 group by lang")
def reference_snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("n_chars > 40")
    first = docs.groupBy("lang").agg(F.min(F.struct("source", "doc_id")).alias("m"))
    # The text is fetched for the chosen rows alone.
    keys = first.select("lang", F.col("m.source").alias("source"), F.col("m.doc_id").alias("doc_id"))
    return docs.join(keys, ["lang", "source", "doc_id"]).select("lang", F.left("text", F.lit(140)).alias("snippet"), F.col("source").alias("first_source"))


@R.query(
    f"""with {_OCC}, words as (select distinct k as key from (select regexp_replace(upper(replace(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ß', 'ss')), '[^A-Z]', '', 'g') as k from benchmark) where length(k) >= 3)
select distinct o.id, w.key from (select distinct id, key from occ) o join words w on left(o.key, 3) = left(w.key, 3) and starts_with(o.key, left(w.key, greatest(5, length(w.key) - 1)))"""
)
def body_token_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = V.keyed(V.words_of_documents(table(spark, sf_dir, "benchmark"), id="item_id")).select("key").distinct()
    return V.contained(table(spark, sf_dir, "documents"), words)
