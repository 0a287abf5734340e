"""Queries over records of several editions: a document is a record, its source the edition, its first word the headword."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import editions as E
from quire.plans.common import Registry, table
from quire.plans.words import FUZZY, VOCAB
from quire.sources import scans, sinks

R = Registry()

_RECORDS = """r as (select source as edition, lang as file, doc_id as line, regexp_extract(text, '([A-Za-zÀ-ÿ]+)', 1) as base_headword, n_chars as char_count, text as body_text from documents),
k as (select * from (select *, regexp_replace(upper(replace(base_headword, 'ß', 'ss')), '[^A-Z]', '', 'g') as key from r) where length(key) >= 3),
occ as (select line as id, edition, key from k)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.regexp_extract("text", "([A-Za-zÀ-ÿ]+)", 1)
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("edition"), F.col("lang").alias("file"), F.col("doc_id").alias("line"), word.alias("headword"), word.alias("base_headword"), F.lit("article").alias("type"),
        F.col("n_chars").alias("char_count"), F.col("text").alias("body_text"), F.lit(False).alias("is_cross_reference"),
    )


@R.query(
    f"""with {_RECORDS}, {VOCAB}, {FUZZY},
near as (select key, array_to_string(list_filter([lag(key, 2) over w, lag(key) over w, lead(key) over w, lead(key, 2) over w], lambda x: x is not null), ',') as neighbors from vocab window w as (order by key)),
shown as (select edition, key, arg_min(base_headword, (file, line)) as display from k group by edition, key),
told as (select variant, s.edition, string_agg(canonical, ',' order by rank) as norms, string_agg(display, ',' order by rank) as displays, string_agg(edit_distance::varchar || ':' || s.n_editions::varchar, ',' order by rank) as ranks
  from sug s join vocab v on v.key = s.canonical join shown d on d.key = s.canonical and d.edition = v.editions[1] group by all),
own as (select edition, key, count(*) as n_records, array_to_string(list(line order by file, line)[1:5], ',') as lines, arg_min(left(body_text, 160), (file, line)) as snippet from k group by edition, key)
select variant, t.edition, n_records, norms, displays, ranks, lines, neighbors, md5(snippet) as snippet_md5 from told t join own o on o.edition = t.edition and o.key = t.variant join near n on n.key = t.variant"""
)
def headword_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.headword_candidates(_records(spark, sf_dir))
    joined = lambda c, f: F.array_join(F.transform(c, f), ",")
    return out.select(
        "variant", "edition", "n_records", joined("suggestions", lambda s: s["norm"]).alias("norms"), joined("suggestions", lambda s: s["canonical"]).alias("displays"),
        joined("suggestions", lambda s: F.concat_ws(":", s["edit_distance"].cast("string"), s["n_editions"].cast("string"))).alias("ranks"), joined("records", lambda r: r["line"].cast("string")).alias("lines"),
        F.array_join("neighbors", ",").alias("neighbors"), F.md5(F.col("snippet").cast("binary")).alias("snippet_md5"),
    )


@R.query(
    f"""with {_RECORDS}, have as (select distinct edition, key from k), words as (select key, count(*) as n from have group by key having count(*) >= 3),
sizes as (select key, edition, max(char_count) as size from k group by all),
middle as (select a.key, a.edition, median(b.size) as m from sizes a join sizes b on a.key = b.key and a.edition <> b.edition group by all having count(*) >= 3),
large as (select k.*, m from k join middle using (key, edition) where m > 0 and char_count > 1.5 * m and char_count - m > 300),
nexts as (select edition, key, coalesce(lead(key) over (partition by edition order by key), 'ZZZZZZZZ') as s from have),
miss as (select l.edition, l.file, l.line, w.key from large l join nexts x on x.edition = l.edition and x.key = l.key join words w on w.key > l.key and w.key < x.s
  union select l.edition, l.file, l.line, w.key from large l join words w on w.key > l.key and w.key < left(l.key, 2) || 'ZZZZZZ'
  where regexp_matches(upper(replace(body_text, 'ß', 'SS')), '(^|[^\\pL\\pN\\pM_])' || left(w.key, greatest(5, length(w.key) - 1)))),
ref as (select key, arg_min(base_headword, (edition, file, line)) as headword, arg_min(left(body_text, 140), (edition, file, line)) as ref from k where char_count > 40 group by key)
select l.edition, l.file, l.line, any_value(l.base_headword) as absorber_base, any_value(l.char_count) as absorber_cc, floor(any_value(m))::int as median_elsewhere, string_agg(w.key, ',' order by w.key) as norms,
  string_agg(coalesce(ref.headword, w.key), ',' order by w.key) as headwords, string_agg(w.n::varchar, ',' order by w.key) as n_editions, md5(string_agg(coalesce(ref, ''), '|' order by w.key)) as refs_md5
from large l join miss m2 on m2.edition = l.edition and m2.file = l.file and m2.line = l.line join words w on w.key = m2.key left join ref on ref.key = w.key
where not exists (select 1 from have h where h.edition = l.edition and h.key = w.key) group by l.edition, l.file, l.line"""
)
def absorbed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir)
    editions = sorted(r.edition for r in rows.select("edition").distinct().where("edition is not null").collect())
    out = E.absorbed_entries(rows, editions, times=1.5, more=300)
    joined = lambda f: F.array_join(F.transform("absorbed", f), ",")
    return out.select(
        "edition", "file", "line", "absorber_base", "absorber_cc", "median_elsewhere", joined(lambda a: a["norm"]).alias("norms"), joined(lambda a: a["headword"]).alias("headwords"), joined(lambda a: a["n_editions"].cast("string")).alias("n_editions"),
        F.md5(F.array_join(F.transform("absorbed", lambda a: a["ref"]), "|").cast("binary")).alias("refs_md5"),
    )


@R.query("select c_mktsegment as type, c_nationkey as detected_by, count(*) as n, grouping(c_mktsegment, c_nationkey)::bigint as level from customer group by rollup (c_mktsegment, c_nationkey)")
def record_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("type"), F.col("c_nationkey").alias("detected_by"))
    return E.tallies(rows)


_PAGES = "p as (select source as identifier, doc_id as image, n_chars as token_count, coalesce(toxic = 1, false) as error from documents left join labels using (doc_id))"


def _page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.select(F.col("source").alias("identifier"), F.col("doc_id").alias("image"), F.col("n_chars").alias("token_count"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("error"))


@R.query(f"with {_PAGES} select identifier, count(*) as n_pages, count(*) filter (not error) as n_ocr_ok, coalesce(array_to_string(list(image order by image) filter (error), ','), '') as failed, sum(token_count)::bigint as total_tokens from p group by identifier")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sinks.run_summary(_page_rows(spark, sf_dir), 0.0, 1.0)
    return out.select("identifier", "n_pages", "n_ocr_ok", F.array_join("failed_pages", ",").alias("failed"), "total_tokens")


@R.query(f"with {_PAGES} select identifier, count(*) as n_pages, count(*) filter (error) as n_missing, count(*) filter (error) = 0 as complete from p group by identifier")
def volume_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _page_rows(spark, sf_dir)
    return sinks.completeness(pages.select("identifier", "image"), pages.where("not error").select("identifier", "image"))


@R.query("select source as identifier, doc_id as image, row_number() over (partition by source order by doc_id % 97, doc_id)::int as ord from documents")
def page_order_by_mets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("identifier"), F.col("doc_id").alias("image"), (F.col("doc_id") % 97).alias("order"))
    return scans.page_order(docs.select("identifier", "image"), docs)


@R.query(
    """with inbox as (select event_id as ord, (user_id % 500)::int as i, event_type as splits from events), fresh as (select * from inbox where i % 7 <> 0)
select i, splits, 'f' || (i % 3) as file, i * 2 as line from fresh where i % 5 <> 0 qualify row_number() over (partition by i order by ord) = 1"""
)
def decisions_taken_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), (F.col("user_id") % 500).cast("int").alias("i"), F.lit("?").alias("file"), F.lit(-1).alias("line"), F.col("event_type").alias("splits"))
    numbers = spark.range(500).select(F.col("id").cast("int").alias("i"))
    places = numbers.where("i % 5 <> 0").select("i", F.concat(F.lit("f"), (F.col("i") % 3).cast("string")).alias("file"), (F.col("i") * 2).alias("line"))
    return E.taken_in(inbox, numbers.where("i % 7 = 0"), ["i"], places)[0].select("i", "splits", "file", "line")


@R.query("select source as edition, count(*) as n_records, count(*) filter (n_chars > 3000) as n_problems, ((count(*) - 1) // 200 + 1)::bigint as n_pages from documents group by source")
def review_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = F.when(F.col("n_chars") > 3000, F.array(F.lit("long"))).otherwise(F.array().cast("array<string>"))
    return sinks.review_index(table(spark, sf_dir, "documents").select(F.col("source").alias("edition"), long.alias("problems")))


@R.query(
    """with d as (select source as file, doc_id as line, split_part(text, ' ', 1) as base_headword, text as body_text, split_part(text, ' ', 12) as marker from documents),
first as (select file, base_headword, min(line) as line from d group by all),
cut as (select d.*, case when f.line is not null and marker <> '' and instr(body_text, marker) - 1 >= 10 then instr(body_text, marker) - 1 end as pos from d left join first f using (file, base_headword, line))
select file, line, 0 as sub, base_headword, md5(case when pos is null then body_text else trim(left(body_text, pos::int)) end) as body_md5, case when pos is not null then 'patch' end as patched_by from cut
union all select file, line, 1, 'NEW', md5(trim(substr(body_text, pos::int + 1))), 'patch' from cut where pos is not null"""
)
def patched_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = lambda n: F.coalesce(F.get(F.split("text", " "), F.lit(n - 1)), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("file"), F.col("doc_id").alias("line"), word(1).alias("headword"), word(1).alias("base_headword"), F.col("text").alias("body_text"), word(12).alias("marker"))
    firsts = docs.groupBy("file", "base_headword").agg(F.min_by("marker", "line").alias("marker")).where("marker <> ''")
    patches = firsts.select("file", "base_headword", F.lit("split").alias("kind"), "marker", F.lit("NEW").alias("new_headword"), F.lit("patch").alias("source"))
    out = E.split_out(docs.drop("marker"), patches)
    return out.select("file", "line", "sub", "base_headword", F.md5(F.col("body_text").cast("binary")).alias("body_md5"), "patched_by")
