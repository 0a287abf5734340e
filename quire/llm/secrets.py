"""Secret scans with a random forest that removes false positives, in DataFrame functions only.

Words that could hold a secret become candidates; Spark's own random forest, trained on labelled findings,
judges each by its length, the character classes it runs through, how much of it a dictionary covers, its
document's path and its neighbouring words. The dictionary holds the words that most documents have.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import SPACE, most_frequent, once, set_aside, stored, table

#: Names that secrets are assigned to, neighbours that speak against one, parts of paths that
#: do so, and frequent letter groups and words that make up names and prose.
NAMES = "password|passwd|passphrase|pwd|secret|token|api_?key|apikey|access_?key|private_?key|credential|auth|bearer"
AGAINST = "example|sample|dummy|placeholder|changeme|your|test|fake|redacted|checksum|sha1|sha256|md5|commit|revision|digest|hash|uuid|guid|etag|version|build|color|isbn|http|https|www|image|integrity"
PATHS = "test|example|fixture|sample|doc|mock|spec|vendor"
DICTIONARY = "tion|ment|able|ing|ness|less|ously|ation|ever|with|that|this|from|have|user|name|data|file|page|index|value|type|list|item|time|date|code|model|image|error|config|server|client|default|public|local|class|object|string|number|version|update|create|delete|system|service|result|request|response|message|example|there|where|which|about|other|these|would|hand|land|ther|ere|and|the|ion|ent|ver|ers|ter|est|ous|com|net|org|www"
PREFIXES = "AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|xox[abp]-|sk_live_|sk-|AIza|eyJ|SG\\.|npm_|hf_"
#: Bounds of the classifier: findings that train it, trees and depth.
FINDINGS, TREES, DEPTH = 6_000, 30, 7
#: Words of the dictionary; the most frequent of the corpus, beside those that are fixed.
WORDS = 2_048
LEAST = 0.5
#: Signs that part the values of a query string, of JSON or of a CSV line; a value that something is assigned to.
PARTS = r"[,;&?|<>(){}\[\]]+"
VALUE = "[:=][\"']?([A-Za-z0-9+/_=.~!@^-]{6,})"
#: What a name is assigned: all up to the quote that closes it, or to the end of the word; and the next field of a query.
WHOLE = rf"(?i)(?:{NAMES})[\"']?(?:[:=]+|=>)(?:\"([^\"]+)|'([^']+)|([^\"'&]+))"
#: Signs that no candidate but a whole value holds.
ODD = r"[^A-Za-z0-9+/_=.~!@^-]"
FEATURES = ["length", "digits", "upper", "lower", "signs", "switches", "letter_runs", "hexadecimal", "covered", "known", "a_name", "prefixed", "assigned", "named", "against", "path"]


def candidates(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` with one row for each candidate: word (its place, from 0), candidate, before, own, after, path.

    A word holds candidates if it has sixteen characters or more with letters and digits or a usual prefix, if it assigns
    something to one of NAMES, or if it follows such a name and a sign of assignment. Every assigned value and
    every other run in each part of the word is one; ``own`` is the part that it stands in. What such a name is
    assigned is one as a whole too, whatever signs are in it (``whole``, also beside the candidates that are pieces of
    it). A candidate has six characters at least; shorter ones can't be told from words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("_path", F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit(""))
    rows = once(rows, F.array_remove(F.split(body, SPACE), "").alias("_words"))
    at = lambda i: F.get("_words", i)
    long = lambda w: (F.length(w) >= 16) & (w.rlike("[0-9]") & w.rlike("[A-Za-z]") | w.rlike(f"(?:^|[^A-Za-z0-9])(?:{PREFIXES})"))
    inside = lambda w: F.contains(w, F.lit("=")) & w.rlike(f"(?i)(?:{NAMES})[\"']?[=]") | F.contains(w, F.lit(":")) & w.rlike(f"(?i)(?:{NAMES})[\"']?:")
    follows = lambda i: at(i - 1).isin("=", ":", ":=", "=>") & at(i - 2).rlike(f"(?i)(?:{NAMES})[\"']?$") | at(i - 1).rlike("[:=]$") & at(i - 1).rlike(f"(?i)(?:{NAMES})[\"']?[:=]$")
    places = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: (F.length(at(i)) >= 6) & (long(at(i)) | inside(at(i)) | F.coalesce(follows(i), F.lit(False))))
    rows = once(rows, F.when(F.size("_words") > 0, places).otherwise(F.array().cast("array<int>")).alias("_places"))
    rows = rows.withColumn("word", F.explode("_places"))
    around = lambda lo, hi: F.lower(F.array_join(F.filter(F.array(*[at(F.col("word") + k) for k in range(lo, hi)]), lambda x: x.isNotNull()), " "))
    rows = once(rows, at(F.col("word")).alias("_word"), around(-3, 0).alias("before"), around(1, 4).alias("after"))
    # Named values of the word, or the word itself, without quotes and closing signs, where it follows a name.
    named = F.filter(F.flatten(F.array(*[F.regexp_extract_all("_word", F.lit(WHOLE), F.lit(k)) for k in (1, 2, 3)])), lambda v: v != "")
    after_name = F.coalesce(follows(F.col("word")), F.lit(False))
    bare_word = F.array(F.btrim("_word", F.lit("\"'`")))
    closed = F.transform(F.when(after_name, bare_word).otherwise(named), lambda v: F.rtrim(F.rtrim(v, F.lit(".,;:!)]}\"'")), F.lit("\"'")))
    rows = once(rows, F.filter(closed, lambda v: F.length(v) >= 6).alias("_named"))
    rows = rows.withColumn("own", F.explode(F.concat(F.filter(F.split("_word", PARTS), lambda o: F.length(o) >= 6), F.when(F.exists("_named", lambda v: v.rlike(PARTS) | v.rlike(ODD)), F.array("_word")).otherwise(F.array().cast("array<string>")))))
    # Assigned values, and their pieces where more signs stand in them; then bare runs of what values leave.
    values = F.regexp_extract_all("own", F.lit(VALUE), F.lit(1))
    pieces = F.flatten(F.transform(F.col("_values"), lambda v: F.split(v, "[=@]+(?=[^=@])")))
    bare = F.regexp_extract_all(F.regexp_replace("own", VALUE, " "), F.lit("([A-Za-z0-9+/_=.-]{6,})"), F.lit(1))
    rows = once(rows, values.alias("_values"), bare.alias("_bare"))
    runs = F.when(F.size("_values") == 0, F.col("_bare")).otherwise(F.filter("_bare", long))
    some = F.transform(F.concat("_values", pieces, runs), lambda c: F.rtrim(c, F.lit(".,;:!")))
    entire = (F.col("own") == F.col("_word")) & F.exists("_named", lambda v: v.rlike(PARTS) | v.rlike(ODD))
    rows = rows.withColumn("candidate", F.explode(F.array_distinct(F.when(entire, F.filter("_named", lambda v: v.rlike(PARTS) | v.rlike(ODD))).otherwise(some))))
    rows = rows.withColumn("whole", F.get(F.filter("_named", lambda v: F.contains(v, F.col("candidate"))), F.lit(0)))
    return rows.where(F.length("candidate") >= 6).drop("_words", "_places", "_word", "_values", "_bare", "_named")


@dataclass
class Scanner:
    """The forest and the dictionary that it was trained with."""

    model: PipelineModel
    words: list[str]


def dictionary(docs: DataFrame, text: str = "text", most: int = WORDS) -> list[str]:
    """Words of 4 to 20 letters that most documents have, ``most`` of them at most; counted over all documents.

    Null and empty texts have none, repeated rows count each.
    """
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z]+"))).alias("w")).where(F.length("w").between(4, 20))
    return sorted(r.w for r in most_frequent(stored(words.groupBy("w").agg(F.count("*").alias("n")), "dictionary"), "n", most))


def featured(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with FEATURES, all doubles without nulls."""
    listed = F.lit(sorted({*words, *(w for w in f"{DICTIONARY}|{AGAINST}".split("|") if len(w) > 3)}))
    c = F.col("candidate")
    n = F.length(c)
    share = lambda pattern: F.length(F.regexp_replace(c, f"[^{pattern}]", "")) / n
    # Runs of one class of characters, each shortened to one; one less is the number of transitions.
    runs = c
    for pattern, one in (("[a-z]+", "a"), ("[A-Z]+", "B"), ("[0-9]+", "0"), ("[^a-zA-Z0-9]+", "-")):
        runs = F.regexp_replace(runs, pattern, one)
    lower = F.lower(c)
    parts = F.split(F.lower(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")), "[^a-z]+")
    known = F.aggregate(F.filter(parts, lambda x: F.array_contains(listed, x)), F.lit(0), lambda total, x: total + F.length(x))
    # What stands before the candidate in its part, and the name that it is assigned to there.
    lead = F.expr("lower(substring_index(own, candidate, 1))")
    name = F.regexp_extract(lead, "([^:=]*[:=][\"']?)$", 1)
    near = F.when(name != "", F.concat(name, lower)).otherwise(F.lower("own"))
    features: dict[str, Column] = {
        "length": F.least(n, F.lit(200)),
        "digits": share("0-9"),
        "upper": share("A-Z"),
        "lower": share("a-z"),
        "signs": F.length(F.regexp_replace(c, "[a-zA-Z0-9]", "")) / n,
        "switches": (F.length(runs) - 1) / n,
        "letter_runs": F.length(F.regexp_replace(lower, "[aeiouy0-9]", "")) / n,
        "hexadecimal": lower.rlike("^[0-9a-f]+$"),
        "covered": 1 - F.length(F.regexp_replace(lower, f"(?:{DICTIONARY})", "")) / n,
        "known": known / n,
        "a_name": lower.rlike(f"(?:{NAMES})$") & ~c.rlike("[0-9]"),
        "prefixed": c.rlike(f"^(?:{PREFIXES})"),
        "assigned": (name != "") | F.contains(F.col("own"), F.lit("=")) | F.col("before").rlike("[:=]$"),
        "named": F.concat_ws(" ", "before", F.when(name != "", name).otherwise(lead)).rlike(f"(?:{NAMES})"),
        "against": F.concat_ws(" ", "before", near).rlike(f"(?:^|[ \"'=:_-])(?:{AGAINST})(?:[ \"'=:_-]|$)|@[^ ]*$"),
        "path": F.lower("_path").rlike(f"(?:^|[^a-z])(?:{PATHS})s?(?:[^a-z]|$)"),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in features.items()})


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """(text, source, label, secret) of ``n`` invented findings, by rule: the default where no reviewed ones are given.

    Half are keys, tokens and passwords of the usual forms, with the secret itself; the others are what scans
    wrongly report: sums and commits, identifiers, placeholders, addresses, versions, dates, file names and
    names with numbers.
    """
    i = F.col("id")
    h = F.concat(F.md5(i.cast("string").cast("binary")), F.md5((i * 7 + 3).cast("string").cast("binary")))
    upper = F.upper(F.translate(h, "0189", "ghjk"))
    wide = F.base64(F.unhex(h))
    pad = lambda k: F.element_at(F.array(*[F.lit(w) for w in ("the", "with", "value", "and then", "per", "to user@mail.example.com", "one")]), (F.pmod(F.floor(i / k), F.lit(7)) + 1).cast("int"))
    word = lambda k: F.element_at(F.array(*[F.lit(w) for w in ("config", "summer", "release", "annotation", "model", "station", "handler", "reference")]), (F.pmod(F.floor(i / k), F.lit(8)) + 1).cast("int"))
    number = lambda most: F.pmod(F.xxhash64("id"), F.lit(most)).cast("string")
    # What stands before a secret, and the secret.
    real = [
        ('token = "', F.substring(h, 1, 40)),
        ("password=", F.substring(h, 3, 18)),
        ("", F.concat(F.lit("AKIA"), F.substring(upper, 2, 16))),
        ("", F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(wide, "[^A-Za-z0-9]", "x"), 1, 36))),
        ("secret: ", F.substring(wide, 1, 40)),
        ("api_key=", F.substring(F.regexp_replace(wide, "[+/=]", "_"), 1, 32)),
        ("auth Bearer ", F.concat(F.lit("eyJ"), F.regexp_replace(wide, "[+/=]", "-"))),
        ("pwd = ", F.substring(wide, 4, 12)),
        ("", F.concat(F.lit("sk_live_"), F.substring(F.regexp_replace(wide, "[+/=]", "a"), 1, 24))),
        ("", F.concat(F.lit("xoxb-"), F.regexp_replace(F.substring(h, 1, 24), "[a-f]", "4"), F.lit("-"), F.substring(wide, 1, 18))),
        ("login password: ", F.concat(word(5), F.upper(F.substring(h, 5, 3)), F.lit("!"), F.substring(h, 9, 4))),
        ("private_key ", F.concat(wide, F.substring(wide, 7, 20))),
    ]
    wrong = [
        F.concat(F.lit("commit "), F.substring(h, 1, 40)),
        F.concat(F.lit("sha256 checksum "), h),
        F.concat(F.lit("uuid "), F.concat_ws("-", *[F.substring(h, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])),
        F.concat(F.lit("password=your_password_"), F.pmod(i, F.lit(90)).cast("string"), F.lit("_here")),
        F.concat(F.lit("token = "), F.lit('"example_token_'), F.pmod(i, F.lit(1000)).cast("string"), F.lit('"')),
        F.concat(word(2), F.lit("_"), word(16), F.lit("_version_"), F.pmod(i, F.lit(2030)).cast("string")),
        F.concat(F.lit("https://www.example.com/"), word(3), F.lit("/"), word(24), F.lit("/page"), F.pmod(i, F.lit(500)).cast("string")),
        F.concat(word(5), F.lit("."), F.pmod(i, F.lit(99)).cast("string"), F.lit("@mail"), F.pmod(i, F.lit(9)).cast("string"), F.lit(".example.com")),
        F.concat(F.lit("build version 2024-"), F.pmod(i, F.lit(12)).cast("string"), F.lit("-01T00:00:"), F.pmod(i, F.lit(60)).cast("string"), F.lit("Z-release")),
        F.concat(word(7), word(9), word(11), F.pmod(i, F.lit(77)).cast("string")),
        F.concat(F.initcap(word(4)), F.lit("_20"), number(10**6), F.lit("_"), number(999983), F.element_at(F.array(F.lit(".jpg"), F.lit(".csv"), F.lit(".tar.gz")), (F.pmod(F.floor(i / 24), F.lit(3)) + 1).cast("int"))),
        F.concat(F.lit("at 20"), number(89), F.lit("-03-14T"), number(23), F.lit(":26:53."), number(9973), F.lit("Z")),
    ]
    at = lambda forms: F.element_at(F.array(*forms), (F.pmod(F.floor(i / 2), F.lit(len(forms))) + 1).cast("int"))
    secret = F.when(i % 2 == 1, at([value for _, value in real]))
    shown = F.when(i % 2 == 1, F.concat(at([F.lit(before) for before, _ in real]), secret, F.when(at([F.lit(before) for before, _ in real]).endswith('"'), F.lit('"')).otherwise(F.lit("")))).otherwise(at(wrong))
    text = F.concat_ws(" ", pad(3), shown, pad(11))
    source = F.when((i % 2 == 0) & (F.pmod(F.floor(i / 20), F.lit(4)) == 0), "tests/fixtures").when(F.pmod(F.floor(i / 20), F.lit(4)) == 1, "src").otherwise("web")
    return spark.range(n, numPartitions=1).select(text.alias("text"), source.alias("source"), (i % 2).cast("int").alias("label"), secret.alias("secret"))


def trained(findings: DataFrame, words: list[str] | None = None) -> Scanner:
    """A forest from labelled findings (text, source, label 0 or 1), FINDINGS of them at most, by hash.

    Where they have a column ``secret``, only candidates that are it or a part of it are secrets: not the name that it
    is assigned to. ``words`` is the dictionary.
    """
    words = list(words or [])
    if "secret" not in findings.columns:
        findings = findings.withColumn("secret", F.lit(None).cast("string"))
    bounded = findings.where("text is not null and label is not null").orderBy(F.xxhash64("text"), "text", "label").limit(FINDINGS)
    found = candidates(bounded)
    own = F.col("secret").isNull() | F.contains(F.col("secret"), F.col("candidate")) | F.contains(F.col("candidate"), F.col("secret"))
    rows = stored(featured(found, words).select(*FEATURES, F.when(own, F.col("label")).otherwise(0).cast("double").alias("label")).coalesce(1), "findings")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=17, subsamplingRate=0.8).fit(vectors.transform(rows))
    return Scanner(PipelineModel(stages=[vectors, forest]), words)


def findings(docs: DataFrame, scanner: Scanner, text: str = "text", path: str = "source", keep: tuple[str, ...] = ("doc_id",), least: float = LEAST) -> DataFrame:
    """Candidates of the whole texts, one row each: ``keep``, word, candidate, whole (the named value it is in), probability, is_secret.

    Null and empty texts have none; a null path tells nothing. Repeated rows are scanned each.
    """
    kept = docs.select(*[F.col(k).alias(f"_k_{k}") for k in keep], F.col(text).alias("text"), (F.col(path) if path in docs.columns else F.lit(None)).cast("string").alias("source"))
    rows = featured(candidates(kept), scanner.words).drop("text", "source")
    judged = scanner.model.transform(rows).withColumn("probability", F.round(F.element_at(vector_to_array("probability"), 2), 6))
    return judged.select(*[F.col(f"_k_{k}").alias(k) for k in keep], "word", "candidate", "whole", "probability", (F.col("probability") >= least).alias("is_secret"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates with their verdicts; secrets themselves appear as digests only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = findings(docs, trained(labelled_findings(spark), dictionary(docs)))
    return found.select("doc_id", F.col("word").cast("bigint").alias("word"), F.sha2("candidate", 256).alias("sha256"), F.length("candidate").cast("bigint").alias("length"), "probability", "is_secret")


#: Rows with secrets that may be broadcast back to the documents.
BROADCAST_ROWS = 200_000
MASK = "[SECRET]"


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row stays; its secrets are masked wherever they stand, and n_chars follows.

    Null and empty texts have none; repeated rows are masked each. ``docs`` is a stored table, so its rows are
    numbered alike each time it is read.
    """
    columns = docs.columns
    docs, back = set_aside(docs, "_row", "_masks")
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    found = findings(numbered, trained(labelled_findings(spark), dictionary(docs)), keep=("_row",)).where("is_secret")
    # Longer masks first: a shorter one may be part of them.
    # A piece of a named value takes the whole value with it.
    masks = stored(found.groupBy("_row").agg(F.collect_set(F.coalesce("whole", "candidate")).alias("_masks")), "masks")
    longest = F.sort_array(F.transform("_masks", lambda m: F.struct(F.length(m).alias("n"), m.alias("m"))), asc=False)
    masks = masks.withColumn("_masks", F.transform(longest, lambda x: x["m"]))
    few = masks.count() <= BROADCAST_ROWS
    out = numbered.join(F.broadcast(masks) if few else masks, "_row", "left")
    text = F.when(F.col("_masks").isNull(), F.col("text")).otherwise(F.aggregate("_masks", F.col("text"), lambda t, m: F.replace(t, m, F.lit(MASK))))
    out = out.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("_masks").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return back(out.drop("_row", "_masks")).select(*columns)


QUERIES = {"op2_secret_scan": op2_secret_scan}
ORACLES: dict[str, str] = {}
