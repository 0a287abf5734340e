"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is measured and tested by rules; failures are aggregated by host, each host's failure rate is
shrunk towards the others by an empirical beta prior, and a host whose shrunk rate is over the limit for any
rule takes its documents down with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import SPACE, once, stored, table

#: A host goes when the shrunk failure rate of a rule is over this.
HOST_LIMIT = 0.5
#: Strength of the prior where the hosts' rates don't tell (one host, or no spread), and its bounds.
DEFAULT_STRENGTH, LEAST_STRENGTH, MOST_STRENGTH = 10.0, 1.0, 1000.0
#: Rules by name: true is a failure. Integer arithmetic, so that any engine agrees.
RULES = {
    "short": "n_words < 10",
    "repeat": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "length": "word_chars < 3 * n_words or word_chars > 15 * n_words",
}


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (null text: zeros).

    Repeated 5-word windows are looked for by hash first; those of equal hashes are compared as strings, so the
    count is exact.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<bigint>")
    out = once(docs, F.array_remove(F.split(body, SPACE), "").alias("_words"), F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    n = F.size("_words")
    out = once(
        out,
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, "[#*$%&|<>]", ""))).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n >= 5, F.transform(F.sequence(F.lit(1), n - 4), lambda i: F.xxhash64(F.slice("_words", i, 5)))).otherwise(none).alias("_hash"),
    )
    # Places whose hash stands twice; only their windows are written out and compared.
    placed = F.sort_array(F.transform("_hash", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
    out = once(out, F.when(F.size(F.array_distinct("_hash")) < F.size("_hash"), placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_placed"))
    hash_at = lambda k: F.get("_placed", k)["h"]
    again = lambda k: (hash_at(k).eqNullSafe(hash_at(k - 1)) & (k > 0)) | hash_at(k).eqNullSafe(hash_at(k + 1))
    twice = F.when(F.size("_placed") > 0, F.filter(F.sequence(F.lit(0), F.size("_placed") - 1), again)).otherwise(F.array().cast("array<int>"))
    window = lambda k: F.struct(F.array_join(F.slice("_words", F.get("_placed", k)["i"], 5), " ").alias("w"), F.get("_placed", k)["i"].alias("i"))
    out = once(out, F.sort_array(F.transform(twice, window)).alias("_sorted"))
    at = lambda i: F.get("_sorted", i)
    same = lambda i: (at(i)["w"].eqNullSafe(at(i - 1)["w"]) & (i > 0)) | at(i)["w"].eqNullSafe(at(i + 1)["w"])
    found = F.filter(F.sequence(F.lit(0), F.size("_sorted") - 1), same)
    out = once(out, F.when(F.size("_sorted") > 0, F.sort_array(F.transform(found, lambda i: at(i)["i"]))).otherwise(F.array().cast("array<int>")).alias("_at"))
    gap = lambda total, k: total + F.least(F.lit(5), F.get("_at", k) - F.get("_at", k - 1))
    covered = F.when(F.size("_at") == 0, 0).when(F.size("_at") == 1, 5).otherwise(F.aggregate(F.sequence(F.lit(1), F.size("_at") - 1), F.lit(5), gap))
    return out.withColumn("n_repeat_words", covered.cast("bigint")).drop("_words", "_lines", "_hash", "_placed", "_sorted", "_at")


def prior(rates: DataFrame) -> dict[str, tuple[float, float]]:
    """alpha and beta by rule, by the method of moments over the hosts' rates; the one row of moments is all
    that reaches the driver."""
    asked = [f(f"rate_{r}").alias(f"{a}_{r}") for r in RULES for a, f in (("m", F.avg), ("v", F.var_pop))]
    row = rates.agg(*asked).first()
    out = {}
    for r in RULES:
        m, v = row[f"m_{r}"] or 0.0, row[f"v_{r}"] or 0.0
        spread = m * (1 - m)
        strength = min(max(spread / v - 1, LEAST_STRENGTH), MOST_STRENGTH) if 0 < v < spread else DEFAULT_STRENGTH
        out[r] = (m * strength, (1 - m) * strength)
    return out


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One row a row of ``docs``: key, host, the measures, base_failed, host_rate (of its host's worst rule) and kept.

    A row without a host is judged alone (host_rate null). Repeated rows are measured and counted each.
    Rates are pre-aggregated by host before the shuffle, so a host with a third of all rows is no burden.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    rows = measured(rows).drop("text").withColumns({f"fail_{r}": F.expr(rule) for r, rule in RULES.items()})
    rows = stored(rows, "quality")
    sums: list[Column] = [F.sum(F.col(f"fail_{r}").cast("bigint")).alias(f"n_{r}") for r in RULES]
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("host_docs"), *sums)
    hosts = stored(hosts.withColumns({f"rate_{r}": F.col(f"n_{r}") / F.col("host_docs") for r in RULES}), "hosts")
    fitted = prior(hosts)
    shrunk = [(F.col(f"n_{r}") + F.lit(a)) / (F.col("host_docs") + F.lit(a + b)) for r, (a, b) in fitted.items()]
    verdicts = hosts.select("host", "host_docs", F.greatest(*shrunk).alias("host_rate"))
    out = rows.join(verdicts, "host", "left")
    failed = F.col("fail_short") | F.col("fail_repeat")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("host_rate") <= limit, F.lit(True)))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents."""
    out = judged(table(spark, sf_dir, "documents"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host", "host_docs"]
    return out.select(*columns, F.round("host_rate", 6).alias("host_rate"))


def _oracle() -> str:
    names = list(RULES)
    flags = ", ".join(f"({rule}) as fail_{r}" for r, rule in RULES.items())
    sums = ", ".join(f"sum(fail_{r}::int)::bigint as n_{r}" for r in names)
    moments = ", ".join(f"avg(n_{r} / host_docs) as m_{r}, var_pop(n_{r} / host_docs) as v_{r}" for r in names)
    strength = lambda r: f"case when v_{r} > 0 and v_{r} < m_{r} * (1 - m_{r}) then least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, {LEAST_STRENGTH}), {MOST_STRENGTH}) else {DEFAULT_STRENGTH} end"
    strengths = ", ".join(f"m_{r}, {strength(r)} as k_{r}" for r in names)
    shrunk = ", ".join(f"(n_{r} + m_{r} * k_{r}) / (host_docs + k_{r})" for r in names)
    return f"""
with d as (select doc_id, source as host, coalesce(text, '') as t from documents),
w as (select doc_id, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from d),
lines as (select doc_id, l, count(*) as c from (select doc_id, unnest(string_split(t, chr(10))) as l from d)
  where regexp_matches(l, '[^\\x20\\x09-\\x0D]') group by doc_id, l),
dup as (select doc_id, sum(c)::bigint as n_lines, (sum(c) - count(*))::bigint as n_dup_lines from lines group by doc_id),
grams as (select doc_id, p, array_to_string(ws[p:p+4], ' ') as g from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as p from w)),
twice as (select doc_id, p from grams qualify count(*) over (partition by doc_id, g) > 1),
covered as (select doc_id, count(distinct p + k)::bigint as n from (select doc_id, p, unnest(range(0, 5)) as k from twice) group by doc_id),
m as (select d.doc_id, d.host, len(ws)::bigint as n_words, coalesce(length(array_to_string(ws, '')), 0)::bigint as word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
  coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words
  from d join w using (doc_id) left join dup using (doc_id) left join covered using (doc_id)),
f as (select *, {flags} from m),
hosts as (select host, count(*) as host_docs, {sums} from f where host is not null group by host),
prior as (select {strengths} from (select {moments} from hosts)),
rates as (select host, host_docs, greatest({shrunk}) as host_rate from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_short or fail_repeat) as base_failed,
  (not (fail_short or fail_repeat) and coalesce(host_rate <= {HOST_LIMIT}, true)) as kept, host, host_docs, round(host_rate, 6) as host_rate
from f left join rates using (host)"""


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES = {"op5_quality_rules": _oracle()}
