"""Queries of repairs, resumable work and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import provenance as N
from quire.operators import repairs as P
from quire.operators import reports as Q
from quire.operators import vocabulary as V
from quire.plans.common import Registry, table
from quire.streaming import resume

R = Registry()

#: A small fix table: what is read as what, by part type; and which of the fixes are wrong.
FIXES = [("ECONOMY", "red", "rede"), ("SMALL", "blue", "bleu"), ("PROMO", "green", "greene"), ("LARGE", "small", "smal")]
WRONG = [("blue", "bleu")]
_FIX = "fixes(p_type, old, new) as (values " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in FIXES) + ")"
_APPLIED = f"""{_FIX}, applied as (select p_partkey, p_type, p_name as before, old, new,
  case when old is null then p_name when regexp_matches(p_name, '\\b' || old || '\\b') then regexp_replace(p_name, '\\b' || old || '\\b', new) else new end as p_name,
  case when old is not null then p_name end as raw_p_name from part left join fixes using (p_type))"""


def _fixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXES, "p_type string, old string, new string")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")


@R.query(f"with {_APPLIED} select p_partkey, p_type, p_name, raw_p_name from applied")
def apply_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = P.fixed(_parts(spark, sf_dir), _fixes(spark), ["p_type"], "p_name")
    return P.fixed(once, _fixes(spark), ["p_type"], "p_name").select("p_partkey", "p_type", "p_name", "raw_p_name")


@R.query("select p_partkey, p_type, p_name, null::varchar as raw_p_name from part")
def revert_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.reverted(P.fixed(_parts(spark, sf_dir), _fixes(spark), ["p_type"], "p_name"), "p_name").select("p_partkey", "p_type", "p_name", "raw_p_name")


@R.query(f"with {_APPLIED} select p_partkey, case when p_type = 'SMALL' then before else p_name end as p_name from applied")
def revert_wrong_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = _fixes(spark).join(spark.createDataFrame(WRONG, "old string, new string"), ["old", "new"], "left_semi").select("p_type")
    return P.reverted(P.fixed(_parts(spark, sf_dir), _fixes(spark), ["p_type"], "p_name"), "p_name", wrong, ["p_type"]).select("p_partkey", "p_name")


@R.query(f"with {_APPLIED} select p_partkey, case when old = 'blue' then before else p_name end as p_name, case when old = 'blue' then null else raw_p_name end as raw_p_name from applied")
def reapply_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = spark.createDataFrame(WRONG, "old string, new string")
    return P.reapplied(_parts(spark, sf_dir), _fixes(spark), wrong, ["p_type"], "p_name").select("p_partkey", "p_name", "raw_p_name")


_NOTED = f"""{_FIX}, noted as (select p_partkey, upper(p_name) as was, upper(split_part(p_name, ' ', 1)) as old_base, upper(new) as new,
  old is not null and upper(split_part(p_name, ' ', 1)) = upper(old) as done, old in ({", ".join(f"'{a}'" for a, _ in WRONG)}) as wrong from part left join fixes using (p_type))"""


@R.query(
    f"""with {_NOTED} select p_partkey, case when done and not wrong then regexp_replace(was, '(^|[^A-Za-z])' || old_base || '($|[^A-Za-z-])', '\\1' || new || '\\2') else was end as headword,
  case when done and not wrong then new else old_base end as base_headword, case when done and not wrong then was end as raw_headword, case when done and not wrong then old_base end as corrected_from from noted"""
)
def corrections_noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records of editions: corrected twice (the second time changes nothing), then the wrong ones undone."""
    parts = _parts(spark, sf_dir)
    records = parts.select("p_partkey", F.col("p_type").alias("eb_code"), F.upper("p_name").alias("headword"), F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("base_headword"), F.lit("article").alias("type"))
    fixes = _fixes(spark).select(F.col("p_type").alias("eb_code"), F.upper("old").alias("variant"), F.upper("new").alias("canonical"), F.lit(3).alias("n_editions"), F.lit(1).alias("edit_distance"))
    wrong = spark.createDataFrame([(a.upper(), b.upper()) for a, b in WRONG], "old string, new string")
    out = N.uncorrected(N.corrected(N.corrected(records, fixes), fixes), wrong)
    return out.select("p_partkey", "headword", "base_headword", "provenance.raw_headword", F.col("provenance.headword_correction.from").alias("corrected_from"))


@R.query("select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as n from events) where n = 1")
def merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.first_wins(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@R.query("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by event_id desc) as n from events where event_type <> 'error') where n = 1")
def last_good_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.last_good(table(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type") != "error").select("user_id", "event_id", "event_type", "value")


@R.query("select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def todo_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.todo(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id", "source")


@R.query(
    """with p as (select source, doc_id, coalesce(toxic = 0, false) as ok, toxic from documents left join labels using (doc_id))
select source as identifier, count(*) as n_pages, count(*) filter (ok) as n_ocr_ok, coalesce(string_agg(doc_id::varchar, ',' order by doc_id) filter (not ok), '') as failed_pages,
  coalesce(sum(doc_id) filter (ok), 0)::bigint as total_tokens, bool_and(ok) as complete,
  md5(string_agg('<!-- page ' || doc_id || ' | image ' || doc_id || ' -->' || chr(10) || chr(10) || case when ok then 'label ' || toxic else '[OCR FAILED]' end || chr(10) || chr(10), '' order by doc_id)) as text_md5
from p group by source"""
)
def volume_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as volumes, documents as their pages, labels as what a model has answered: toxic ones as failures."""
    order = table(spark, sf_dir, "documents").select(F.col("source").alias("identifier"), F.col("doc_id").cast("string").alias("image"), F.col("doc_id").cast("int").alias("ord"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("image"), F.col("doc_id").cast("bigint").alias("token_count"), F.concat(F.lit("label "), F.col("toxic").cast("string")).alias("markdown"), (F.col("toxic") != 0).alias("error"))
    told = order.join(labels, "image").drop("ord")
    states = resume.volume_states(order, told).withColumn("failed_pages", F.array_join("failed_pages", ","))
    texts = resume.volume_texts(order, told).select("identifier", F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return states.join(texts, "identifier")


@R.query(
    """select batch, count(*) as items, count(l.doc_id) as done, count(*) = count(l.doc_id) as complete from (select doc_id, doc_id // 4 as batch from documents) d
left join (select distinct doc_id from labels) l using (doc_id) group by batch"""
)
def resume_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 4).alias("batch"))
    return P.progress(items, table(spark, sf_dir, "labels"), "doc_id", "batch")


@R.query("select source, doc_id // 1000 as volume, md5(string_agg(doc_id::varchar || ':' || coalesce(toxic::varchar, '[missing]'), chr(10) order by doc_id)) as text_md5 from documents left join labels using (doc_id) group by all")
def left_default_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    text = F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.coalesce(F.col("toxic").cast("string"), F.lit("[missing]")))
    docs = docs.withColumn("volume", F.floor(F.col("doc_id") / 1000))
    return Q.assembled(docs, ["source", "volume"], "doc_id", text).select("source", "volume", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@R.query(
    """with d as (select doc_id as id, text as body, left(string_split(text, chr(10))[2], 30) as a, left(string_split(text, chr(10))[4], 30) as b from documents),
p as (select id, 'second' as name, instr(body, a) - 1 as off from d where a is not null and trim(a) <> '' union all select id, 'fourth', instr(body, b) - 1 from d where b is not null and trim(b) <> ''),
s as (select id, list({'off': off, 'name': name} order by off, name) as l from p where off >= 10 group by id),
k as (select id, case when len(l) = 2 and l[2].off - l[1].off < 40 then l[1:1] else l end as l from s),
c as (select d.id, d.body, l, left(body, l[1].off) as own from k join d using (id)),
parts as (select id, unnest(range(1, len(l) + 1)) as i, l, body, own from c),
cut as (select id, i, l[i].name as name, substr(body, l[i].off + 1, coalesce(l[i + 1].off, length(body)) - l[i].off) as body, length(own) < 150 as moved, own from parts)
select id, case when moved then i - 1 else i end as part, name, md5(body) as body_md5, (moved and i = 1) as relabelled, case when moved and i = 1 then own end as discarded from cut
union all select id, 0, null, md5(own), false, null from c where length(own) >= 150
union all select id, 0, null, md5(body), false, null from d where id not in (select id from k)"""
)
def split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    lines = F.split("body", "\n")
    wanted = F.array(F.struct(F.lit("second").alias("name"), F.left(F.get(lines, F.lit(1)), F.lit(30)).alias("start_text")), F.struct(F.lit("fourth").alias("name"), F.left(F.get(lines, F.lit(3)), F.lit(30)).alias("start_text")))
    points = docs.select("id", F.explode(wanted).alias("p")).select("id", "p.*").where("start_text is not null and trim(start_text) <> ''")
    return P.split(docs, points).select("id", "part", "name", F.md5(F.col("body").cast("binary")).alias("body_md5"), "relabelled", "discarded")


@R.query(
    """select l_orderkey, l_linenumber, case when l_partkey is not null and l_suppkey is not null and (l_suppkey < l_partkey or abs(l_suppkey - (l_partkey + l_linenumber)) > 50) then l_partkey + l_linenumber else l_suppkey end as page_end
from lineitem"""
)
def page_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    end = P.page_end(F.col("l_partkey"), F.col("l_suppkey"), F.lit(0), F.col("l_linenumber"))
    return items.select("l_orderkey", "l_linenumber", end.alias("page_end"))


_PART_RECORDS = """r as (select p_partkey, upper(p_name) || case when p_partkey % 3 = 0 then ' (' || lower(p_type) || ', of ' || p_brand || ') ' else '' end as headword,
  case p_partkey % 5 when 0 then p_name when 1 then 'X' || upper(p_name) else upper(p_name) end as base_headword, case when p_partkey % 7 = 0 then 'own' end as qualifier,
  p_size as ps, case when p_partkey % 11 > 0 then p_size + (p_partkey % 140)::int - 30 end as pe, 4 as image_start, case when p_partkey % 13 > 0 then 4 + p_size // 2 end as image_end from part)"""


def _part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records: some with what they are in parentheses, some with bases that don't fit, end pages of all kinds."""
    name, k = F.upper("p_name"), F.col("p_partkey")
    told = F.concat(F.lit(" ("), F.lower("p_type"), F.lit(", of "), F.col("p_brand"), F.lit(") "))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(name, F.when(k % 3 == 0, told).otherwise("")).alias("headword"), F.when(k % 5 == 0, F.col("p_name")).when(k % 5 == 1, F.concat(F.lit("X"), name)).otherwise(name).alias("base_headword"),
        F.when(k % 7 == 0, "own").alias("qualifier"), F.col("p_size").alias("printed_page_start"), F.when(k % 11 > 0, F.col("p_size") + (k % 140).cast("int") - 30).alias("printed_page_end"),
        F.lit(4).alias("image_page_start"), F.when(k % 13 > 0, 4 + F.floor(F.col("p_size") / 2).cast("int")).alias("image_page_end"),
    )


@R.query(
    f"""with {_PART_RECORDS}, t as (select *, ps + (image_end - image_start) as expected, regexp_extract(headword, '\\(([^)]+)\\)\\s*$', 1) as inside from r),
f as (select *, expected is not null and pe is not null and (pe < ps or abs(pe - expected) > 50) as moved from t)
select p_partkey, case when qualifier is null and inside <> '' and regexp_full_match(base_headword, '[A-Z][A-Z''. -]+') and starts_with(headword, left(base_headword, 3)) then inside else qualifier end as qualifier,
  case when moved then expected else pe end as printed_page_end, case when moved then pe end as raw_printed_page_end from f"""
)
def completed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed twice, which is as once."""
    out = N.completed(N.completed(_part_records(spark, sf_dir)))
    return out.select("p_partkey", "qualifier", "printed_page_end", F.col("provenance.raw_printed_page_end").alias("raw_printed_page_end"))


_TEXT = "coalesce(text, '')"


@R.query(
    f"""with r as (select d.doc_id, split_part({_TEXT}, chr(10), 1) as head, trim({_TEXT}) as body, n_chars, coalesce(toxic, 0) as first, coalesce(quality, 0) as last from documents d left join labels l using (doc_id))
select doc_id, array_to_string(list_filter([case when rtrim(body, '.,') = rtrim(trim(head), '.,') then 'empty-body' when len(regexp_extract_all(body, '[A-Za-zÀ-ÿ0-9]+')) <= 4 then 'fragment' end,
  case when first <> 0 and last <> 0 and last < first then 'page-end<start' end, case when n_chars > 25000 then 'long-maybe-bleed' end], lambda x: x is not null), ',') as flags from r"""
)
def problem_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    head = F.get(F.split(F.coalesce("text", F.lit("")), "\n"), F.lit(0))
    flags = Q.problems(head, F.col("text"), F.lit("article"), F.lit(False), F.col("toxic"), F.col("quality"), F.col("n_chars"))
    return docs.select("doc_id", F.array_join(flags, ",").alias("flags"))


@R.query("select source, count(*) as n_docs, count(*) filter (n_chars > 3000) as n_long, sum(n_chars)::bigint as n_chars from documents group by grouping sets ((source), ())")
def quality_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.totals(table(spark, sf_dir, "documents"), ["source"], n_docs=F.count("*"), n_long=F.count_if(F.col("n_chars") > 3000), n_chars=F.sum("n_chars"))


@R.query("select c_nationkey, c_mktsegment, count(*) as n_customers, round(sum(c_acctbal), 2) as balance from customer group by grouping sets ((c_nationkey, c_mktsegment), ())")
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")
    return Q.totals(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], n_customers=F.count("*"), balance=F.round(balance, 2))


@R.query("select doc_id, source, n_chars from documents where lang in ('en', 'de') and (contains(lower(split_part(text, chr(10), 1)), 'mit') or contains(lower(text), 'mit'))")
def viewer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("head", F.get(F.split("text", "\n"), F.lit(0)))
    return Q.viewed(docs, "head", "text", ["en", "de"], "lang", "MIT").select("doc_id", "source", "n_chars")


@R.query(
    f"""with r as (select d.doc_id, split_part({_TEXT}, chr(10), 1) as head, {_TEXT} as body, case when coalesce(toxic, 0) = 1 then 'treatise' else 'article' end as type, quality = 5 as xref, n_chars,
  doc_id::int % 90 as ps, doc_id::int % 90 + coalesce(quality, 0) * 9 - 5 as pe from documents d left join labels l using (doc_id)),
f as (select *, list_filter([case when rtrim(trim(body), '.,') = rtrim(trim(head), '.,') then 'empty-body' when len(regexp_extract_all(body, '[A-Za-zÀ-ÿ0-9]+')) <= 4 and not coalesce(xref, false) and type <> 'treatise' then 'fragment' end,
  case when ps <> 0 and pe <> 0 and pe < ps then 'page-end<start' end, case when ps <> 0 and pe <> 0 and type <> 'treatise' and pe - ps > 30 then 'page-span-large' end,
  case when type <> 'treatise' and n_chars > 25000 then 'long-maybe-bleed' end], lambda x: x is not null) as flags from r)
select doc_id, type, ps, pe, n_chars as cc, array_to_string(flags, ',') as flags, md5(case when type = 'treatise' and length(body) > 12000 then left(body, 12000) || ' …[treatise body truncated in viewer — full ' || n_chars || ' chars in JSONL]' else body end) as body_md5
from f where type in ('article', 'treatise') and not coalesce(xref, false) and len(flags) > 0"""
)
def viewer_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the viewer lists without references and with problems only; a document is a record."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    first, none = (F.col("doc_id") % 90).cast("int"), F.lit(None).cast("string")
    records = docs.select(
        F.get(F.split(F.coalesce("text", F.lit("")), "\n"), F.lit(0)).alias("headword"), none.alias("base_headword"), none.alias("qualifier"), F.when(F.col("toxic") == 1, "treatise").otherwise("article").alias("type"),
        F.col("doc_id").cast("string").alias("detected_by"), (F.col("quality") == 5).alias("is_cross_reference"), first.alias("printed_page_start"), (first + F.coalesce("quality", F.lit(0)) * 9 - 5).alias("printed_page_end"),
        F.lit(0).alias("image_page_start"), F.lit(0).alias("image_page_end"), F.col("n_chars").alias("char_count"), F.lit(None).cast("array<string>").alias("cross_refs"), F.lit(None).cast("array<string>").alias("outline"),
        F.struct(none.alias("headword_image")).alias("provenance"), F.col("text").alias("body_text"),
    )
    shown = Q.viewed(Q.viewer_rows(records), "headword", "body", ["article", "treatise"], "type", redirect="xref", flags="flags")
    return shown.select(F.col("by").cast("bigint").alias("doc_id"), "type", "ps", "pe", "cc", F.array_join("flags", ",").alias("flags"), F.md5(F.col("body").cast("binary")).alias("body_md5"))


@R.query("select source, doc_id, ((row_number() over (partition by source order by doc_id) - 1) // 10)::bigint as page from documents")
def paginate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id").withColumn("block", F.floor(F.col("doc_id") / 4096))
    numbered = V.ordinal(docs, "block", ["doc_id"], "number", part=("source",))
    return numbered.select("source", "doc_id", F.floor((F.col("number") - 1) / 10).cast("bigint").alias("page"))


_TITLE = "case when n_nationkey % 4 = 3 then 'Supplement to the third edition of the Encyclopaedia - Volume ' || n_nationkey || ', ' || n_name else 'Encyclopaedia; or, A dictionary - ' || case n_nationkey % 3 when 0 then 'First edition, 1771' when 1 then 'Second edition' else 'Seventh edition, 1842' end || case when n_nationkey % 5 = 4 then ', General index' else ', Volume ' || n_nationkey || ', ' || n_name || '-Z' end end || ' - EB.' || n_nationkey"


@R.query(
    f"""with t as (select n_nationkey, {_TITLE} as title from nation)
select n_nationkey, 'EB.' || n_nationkey as eb_code, n_nationkey % 4 = 3 as is_supplement, case when n_nationkey % 4 = 3 then 'third edition' end as supplement_to,
  case when n_nationkey % 4 = 3 then 'Supplement (third edition)' when n_nationkey % 3 = 0 then 'First edition' when n_nationkey % 3 = 1 then 'Second edition' else 'Seventh edition' end as edition_label,
  case when n_nationkey % 4 = 3 then null when n_nationkey % 3 = 0 then 1 when n_nationkey % 3 = 1 then 2 else 7 end as edition_num,
  case when n_nationkey % 4 = 3 then null when n_nationkey % 3 = 0 then 1771 when n_nationkey % 3 = 2 then 1842 end as edition_year,
  try_cast(nullif(regexp_extract(title, 'Volume ([0-9]+)', 1), '') as int) as volume_num,
  nullif(regexp_replace(regexp_extract(title, 'Volume [0-9]+, (.*)$', 1), '\\s*-\\s*EB\\.[0-9]+$', ''), '') as alpha_range,
  case when not regexp_matches(title, 'Volume [0-9]+') then regexp_extract(title, ' - ([^-]*General index) - ', 1) end as volume_label from t"""
)
def title_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(_TITLE).alias("title"))
    return titles.select("n_nationkey", X.title_fields(F.col("title")).alias("f")).select("n_nationkey", "f.*").drop("title")


@R.query("select p_partkey, 'EB.' || p_size || '_ed' || (p_size % 8 + 1) || '_v' || lpad((p_size % 100)::varchar, 2, '0') || '_' || replace(p_name, ' ', '-') || '_' || p_partkey || '.html' as name from part")
def slug_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    name = X.file_name(F.concat(F.lit("EB."), size.cast("string")), size % 8 + 1, F.lit(False), size % 100, F.col("p_name"), F.lit(None).cast("string"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


@R.query("select p_partkey, p_name || ' (' || p_type || ')' as full_name, p_type as qualifier from part")
def paren_qualifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", full.alias("full_name"), X.qualifier(full).alias("qualifier"))


@R.query(
    """select doc_id, trim(regexp_replace(regexp_replace(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')), '([\\pL\\pN_])[­-]\\s+([a-z])', '\\1\\2', 'g'), '\\s+([,.;:)])', '\\1', 'g')) as cleaned from documents"""
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.clean(F.col("text")).alias("cleaned"))


@R.query("select doc_id, count(*) as n_roman from (select doc_id, unnest(string_split_regex(text, '[\\x20\\x09-\\x0D]+')) as w from documents) where regexp_matches(w, '^[IVXLCDM]+\\.?$') group by doc_id")
def roman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("w"))
    return words.where(X.is_roman(F.col("w"))).groupBy("doc_id").agg(F.count("*").alias("n_roman"))


@R.query(
    """select page_id, array_to_string(list_distinct_ordered, ',') as refs from (select page_id, list(r order by p) as list_distinct_ordered from
(select page_id, r, min(p) as p from (select page_id, unnest(refs) as r, generate_subscripts(refs, 1) as p from (select page_id, regexp_extract_all(html, 'href="/([^"]*)"', 1) as refs from pages)) group by all) group by page_id)"""
)
def link_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = F.array_distinct(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1)))
    return table(spark, sf_dir, "pages").select("page_id", refs.alias("refs")).where(F.size("refs") > 0).select("page_id", F.array_join("refs", ",").alias("refs"))


@R.query(
    """with t as (select c_custkey, 'AB' || c_custkey || ', in ' || c_mktsegment || case when c_custkey % 3 = 0 then ', a tool' else '' end || '. See ' || upper(n_name) || case when c_custkey % 2 = 0 then ' and See BOOK' else '' end as body, n_name
  from customer join nation on c_nationkey = n_nationkey)
select c_custkey, array_to_string(list_distinct_in_order, ',') as refs, c_custkey % 3 <> 0 as is_redirect from (select c_custkey,
  case when c_custkey % 2 = 0 then [trim(regexp_extract(body, 'See ([A-Z][A-Z&-]+(?: [A-Z][A-Z&-]+)*)', 1)), 'BOOK'] else [trim(regexp_extract(body, 'See ([A-Z][A-Z&-]+(?: [A-Z][A-Z&-]+)*)', 1))] end as list_distinct_in_order from t)"""
)
def cross_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    head = F.concat(F.lit("AB"), F.col("c_custkey").cast("string"))
    tool = F.when(F.col("c_custkey") % 3 == 0, ", a tool").otherwise("")
    more = F.when(F.col("c_custkey") % 2 == 0, " and See BOOK").otherwise("")
    body = F.concat(head, F.lit(", in "), F.col("c_mktsegment"), tool, F.lit(". See "), F.upper("n_name"), more)
    rows = people.select("c_custkey", head.alias("head"), body.alias("body"))
    return rows.select("c_custkey", F.array_join(X.cross_references(F.col("body")), ",").alias("refs"), X.is_redirect(F.col("head"), F.col("body")).alias("is_redirect"))
