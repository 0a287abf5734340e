"""Queries over ordered rows: lines of documents, events of users, turns of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import sequences as S
from quire.operators import vocabulary as V
from quire.plans.common import Registry, table
from quire.sources import sinks

R = Registry()

_EV = "ev as (select user_id, event_id, event_type, value, row_number() over (partition by user_id order by ts, event_id) - 1 as pos from events)"
_RUNS = f"""{_EV}, isl as (select *, sum((event_type <> 'error')::int) over (partition by user_id order by pos) as island from ev),
runs as (select user_id, min(pos) as start, max(pos) as "end", max(pos) - min(pos) + 1 as length from isl where event_type = 'error' group by user_id, island having max(pos) - min(pos) + 1 >= 2)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@R.query(
    """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
s as (select *, sum((regexp_matches(line, '^[A-Z]{3,}'))::int) over (partition by doc_id order by pos) as segment from l)
select doc_id, segment::bigint as segment, arg_min(left(line, 60), pos) as head, count(*) as n_lines, sum(length(line))::bigint as n_chars, md5(string_agg(line, chr(10) order by pos)) as body_md5
from s where segment > 0 group by doc_id, segment"""
)
def line_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    found = S.segments(lines, ["doc_id"], ["at"], F.col("line").rlike("^[A-Z]{3,}"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    return found.groupBy("doc_id", "segment").agg(
        F.left(F.min_by("line", "at"), F.lit(60)).alias("head"), F.count("*").alias("n_lines"), F.sum(F.length("line").cast("bigint")).alias("n_chars"), F.md5(body.cast("binary")).alias("body_md5")
    )


@R.query(f'with {_RUNS} select user_id, start, "end", length from runs')
def header_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.runs(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")


@R.query(
    f"""with {_EV}, c as (select user_id, event_type, count(*) as n, min(pos) as f from ev group by all)
select user_id, arg_max(event_type, (n, -f)) as event_type from c group by user_id"""
)
def most_frequent_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _events(spark, sf_dir).withColumn("at", F.row_number().over(S._over(["user_id"], ["ts", "event_id"])) - 1)
    return S.most_frequent(placed, ["user_id"], "event_type", "at")


@R.query(
    f"""with {_EV}, s as (select user_id, event_type, pos as start, pos as "end" from ev),
m as (select *, coalesce(lag(event_type) over w = event_type and start - lag("end") over w <= 3, false) as follows from (select * from s where event_type <> 'view') window w as (partition by user_id order by start, "end")),
g as (select *, sum((not follows)::int) over (partition by user_id order by start, "end") as grp from m)
select user_id, event_type, min(start) as start, max("end") as "end", count(*) as n_spans from g group by user_id, grp, event_type"""
)
def merge_nearby_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = (F.row_number().over(S._over(["user_id"], ["ts", "event_id"])) - 1).cast("bigint")
    spans = _events(spark, sf_dir).withColumn("start", at).withColumn("end", F.col("start")).where("event_type <> 'view'").select("user_id", "event_type", "start", "end")
    return S.merged_spans(spans, ["user_id"], "event_type")


@R.query("select user_id, event_id, event_type from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as before from events) where before is distinct from event_type")
def dedup_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.without_repeats(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["event_type"]).select("user_id", "event_id", "event_type")


@R.query(
    """select conv_id, turn, role from (select *, lead(role) over (partition by conv_id order by turn) as after from conversations)
where not (length(text) < 200 and after is not distinct from role and after is not null)"""
)
def drop_stub_before_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.without_stubs(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "role", F.length("text") < 200).select("conv_id", "turn", "role")


@R.query(
    """select user_id, event_id, value from (select *, max(value) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as top from events)
where value is not null and (top is null or value > top)"""
)
def monotonic_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rising(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value").select("user_id", "event_id", "value")


@R.query(
    """with w as (select user_id, left(event_type, 1) as v, row_number() over o as pos, lead(left(event_type, 1)) over o as a1, lead(left(event_type, 1), 2) over o as a2, lead(left(event_type, 1), 3) over o as a3
from events window o as (partition by user_id order by ts, event_id))
select user_id, coalesce(arg_min(v, pos) filter (a1 is null or a1 >= v or coalesce(a2 >= v, false) or coalesce(a3 >= v, false)), arg_min(v, pos)) as opening from w group by user_id"""
)
def opening_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.opening(_events(spark, sf_dir).withColumn("v", F.left("event_type", F.lit(1))), ["user_id"], ["ts", "event_id"], "v")


@R.query("select conv_id, turn, role, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn) as asked_at from conversations")
def forward_fill_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.filled(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "asked_at").select("conv_id", "turn", "role", "asked_at")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("block", F.floor(F.col("o_orderkey") / 4096))
    return S.chunked(V.ordinal(orders, "block", ["o_orderkey"]), "ordinal", 40)


@R.query("select o_orderkey, ((row_number() over (order by o_orderkey) - 1) // 40)::bigint as chunk from orders")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).select("o_orderkey", "chunk")


@R.query(
    """with c as (select *, ((row_number() over (order by o_orderkey) - 1) // 40)::bigint as chunk from orders)
select chunk, count(*) as n_orders, round(sum(o_totalprice), 2) as total, array_to_string(list_sort(list(distinct o_orderstatus)), ',') as statuses from c group by chunk"""
)
def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double")
    return _numbered(spark, sf_dir).groupBy("chunk").agg(F.count("*").alias("n_orders"), total.alias("total"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"))


@R.query(
    """with p as (select doc_id, list_transform(range(1, len(l)), lambda i: list_sum(list_transform(l[1:i], lambda x: length(x) + 1))::bigint) as pts
  from (select doc_id, string_split(text, chr(10)) as l from documents))
select doc_id, array_to_string(list_reduce(list_transform(pts, lambda p: [p]), lambda kept, p: case when p[1] - kept[-1] >= 400 then list_concat(kept, p) else kept end), ',') as kept from p where len(pts) > 0"""
)
def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(lines).alias("at", "line"))
    run = F.sum(F.length("line").cast("bigint") + 1).over(S._over(["doc_id"], ["at"]))
    more = F.lead("at").over(S._over(["doc_id"], ["at"])).isNotNull()
    placed = docs.withColumn("end", run).withColumn("more", more).where("more").groupBy("doc_id").agg(F.array_sort(F.collect_list("end")).alias("ends"))
    return placed.select("doc_id", F.array_join(S.spaced_points(F.col("ends"), 400), ",").alias("kept"))


@R.query(
    """with v as (select 'p' || p_partkey as identifier, case when p_size % 5 > 0 then 'EB.' || p_size end as eb_code, case when p_partkey % 9 > 0 then p_partkey % 40 end as volume_num, p_size * 10 as n_images, p_size from part),
c as (select *, (row_number() over (order by case when eb_code is null then 999 else p_size end, coalesce(volume_num, 0), identifier) - 1) // 3 as chunk from v)
select chunk::bigint as chunk, count(*) as n_volumes, sum(n_images)::bigint as n_pages, array_to_string(list_sort(list(distinct coalesce(eb_code, '?'))), ',') as codes, string_agg(identifier, ',' order by identifier) as identifiers from c group by chunk"""
)
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part is a volume, its size the edition."""
    size = F.col("p_size")
    volumes = table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("identifier"), F.when(size % 5 > 0, F.concat(F.lit("EB."), size.cast("string"))).alias("eb_code"),
        F.when(F.col("p_partkey") % 9 > 0, F.col("p_partkey") % 40).alias("volume_num"), (size * 10).alias("n_images"),
    )
    plan = sinks.planned(volumes)
    ids = plan.groupBy("chunk").agg(F.array_join(F.array_sort(F.collect_list("identifier")), ",").alias("identifiers"))
    return sinks.plan_report(plan).join(ids, "chunk")
