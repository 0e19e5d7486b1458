"""Personal data by candidate gradient boosting, in DataFrame operations only.

Generators with high recall propose spans of four kinds, which may overlap: the strict shapes, and
wider ones (numbers without a country code, obfuscated addresses, numbers with other separators).
Boosted trees score every candidate from its format and its context; per kind, the lowest score at
which enough of the scored candidates are right selects the spans to redact. Spans of the strict
rules always stay; the trees add those of the wide generators.

The trees learn from candidates of the strict shapes, which the strict rules label: checksums, part
and digit counts. At most ``sample`` of them are learned from, first by a hash of their text and
place; a model for a kind that has only one label is not fitted, and adds nothing.

A null text is an empty one, without spans. Rows are known by a number of their own: repeated ids,
null ids and columns of any name make no difference. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palaver.llm.common import table
from palaver.llm.spans import candidates, disjoint, joined, located, redacted
from palaver.session import materialise

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
#: Share of right candidates from which a score selects.
PRECISION = 0.95
BINS = 50

#: The strict shapes. Lookbehinds and possessive repetition only spare attempts that
#: must fail, so that long unbroken texts take linear time.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email_wide": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?[\[({]\x20?at\x20?[\])}]\x20?[A-Za-z0-9-]{2,63}+(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?)[A-Za-z0-9-]{2,63}+)++",
    "card_wide": r"(?<![0-9.])[0-9]{4}[./_][0-9]{4}[./_][0-9]{4}[./_][0-9]{2,7}(?![0-9])",
    "phone_wide": r"(?<![0-9+)])\(?[0-9]{3}\)?[\x20./-]{0,2}[0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
}
FEATURES = (
    "length", "n_digits", "n_letters", "n_seps", "n_groups", "longest_group", "has_plus", "has_at", "has_paren", "luhn",
    "largest_part", "ends_alpha", "glued_before", "glued_after", "hint_before", "digits_near", "kind_email", "kind_ip", "kind_card",
)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a number of at most 32 digits has a valid check digit."""
    def added(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    total = F.aggregate(F.transform(F.split(F.reverse(number), ""), added), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    short = F.char_length(number).between(1, 32)
    return F.coalesce(short & (F.when(short, total) % 10 == 0), F.lit(False))


def strictly(kind: Column, match: Column) -> Column:
    """Whether a match of a strict shape passes its rule."""
    n = F.char_length(digits(match))
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", match.rlike(rf"\A{part}(?:\.{part}){{3}}\z"))
        .when(kind == "card", n.between(14, 19) & luhn(digits(match)))
        .otherwise(n.between(10, 15))
    )


def described(found: DataFrame) -> DataFrame:
    """Candidates with their kind, whether they are strict, the strict label, and the features."""
    m, before, after = F.col("match"), F.col("before"), F.col("after")
    kind = F.regexp_extract("generator", "^[a-z]+", 0)
    short = F.left(m, F.lit(64))
    number = digits(short)
    groups = F.regexp_extract_all(short, F.lit("[0-9]+"), F.lit(0))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.select(
        "*",
        kind.alias("kind"),
        F.col("generator").isin(*KINDS).alias("strict"),
        F.when(F.col("generator").isin(*KINDS), strictly(kind, m)).alias("valid"),
        F.least(F.char_length(m), F.lit(64)).cast("double").alias("length"),
        F.char_length(number).cast("double").alias("n_digits"),
        F.char_length(F.regexp_replace(short, "[^A-Za-z]", "")).cast("double").alias("n_letters"),
        F.char_length(F.regexp_replace(short, "[A-Za-z0-9]", "")).cast("double").alias("n_seps"),
        F.size(groups).cast("double").alias("n_groups"),
        F.coalesce(F.array_max(F.transform(groups, F.char_length)), F.lit(0)).cast("double").alias("longest_group"),
        flag(m.startswith("+")).alias("has_plus"),
        flag(short.rlike("@|[\\[({] ?at")).alias("has_at"),
        flag(short.contains("(")).alias("has_paren"),
        flag(luhn(number)).alias("luhn"),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.least(F.left(g, F.lit(6)).cast("int"), F.lit(9999)))), F.lit(0)).cast("double").alias("largest_part"),
        flag(short.rlike("[A-Za-z]\\z")).alias("ends_alpha"),
        flag(before.rlike("[A-Za-z0-9_.-]\\z")).alias("glued_before"),
        flag(after.rlike("\\A[A-Za-z0-9_-]")).alias("glued_after"),
        flag(F.lower(before).rlike("(?:mail|phone|tel|call|fax|mobile|contact|card|visa|account|ip|host|address)\\W{0,4}\\z")).alias("hint_before"),
        F.char_length(digits(F.concat_ws("", before, after))).cast("double").alias("digits_near"),
        *[flag(kind == k).alias(f"kind_{k}") for k in KINDS[:3]],
    )


def fit(known: DataFrame, sample: int = SAMPLE, rounds: int = 12, depth: int = 3):
    """Boosted trees on at most ``sample`` strict candidates, half of either label; None without both labels."""
    picked = None
    for label in (1, 0):
        part = known.where("strict").where(F.col("valid") == bool(label)).withColumn("label", F.lit(float(label)))
        part = part.select("label", *FEATURES, F.xxhash64("match", "before", "row", "start").alias("h")).orderBy("h").limit(sample // 2)
        picked = part if picked is None else picked.union(part)
    picked = materialise(picked.coalesce(1), "pii-sample").coalesce(2)
    if len(picked.select("label").distinct().limit(2).collect()) < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(picked)
    return GBTClassifier(maxIter=rounds, maxDepth=depth, seed=7, maxMemoryInMB=64).fit(rows.select("features", "label"))


def scored(rows: DataFrame, model) -> DataFrame:
    """Candidates with their ``score``, the probability that they are personal data; null without a model."""
    if model is None:
        return rows.withColumn("score", F.lit(None).cast("double"))
    given = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)
    out = model.setFeaturesCol("_features").setPredictionCol("_p").setRawPredictionCol("_r").setProbabilityCol("_q").transform(given)
    return out.withColumn("score", vector_to_array("_q")[1]).drop("_features", "_p", "_r", "_q")


def thresholds(rows: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per kind the lowest score from which on at least ``precision`` of the strict candidates are right.

    Counted over all candidates, in ``BINS`` bins of the score: a few rows per kind.
    """
    bins = rows.where("strict and score is not null").groupBy("kind", F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(F.col("valid").cast("long")).alias("good")
    )
    down = Window.partitionBy("kind").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = bins.select("kind", "bin", (F.sum("good").over(down) / F.sum("n").over(down)).alias("share"))
    return reached.where(F.col("share") >= precision).groupBy("kind").agg((F.min("bin") / BINS).alias("least"))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``key``, the strict spans ``base`` and all ``spans``: arrays of ``start, rank, kind, end`` in order."""
    rows = located(docs, STRICT | WIDE, key, text)
    found = materialise(described(candidates(rows)), "pii-candidates")
    judged = scored(found, fit(found))
    least = thresholds(judged)
    # one threshold per kind
    chosen = judged.join(F.broadcast(least), "kind", "left")
    strict = F.col("strict") & F.col("valid")
    added = ~F.col("strict") & (F.col("score") >= F.coalesce("least", F.lit(2.0)))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(F.col("start"), rank.alias("rank"), F.col("kind"), F.col("end"))
    per_row = (
        chosen.where(strict | added)
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list(F.when(strict, span))).alias("base"),
            F.array_sort(F.collect_list(F.when(added, span))).alias("more"),
        )
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    # an added span that a strict one of its kind overlaps says nothing new
    fresh = F.filter(
        "more", lambda s: ~F.exists("base", lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    return (
        rows.select("row", "key")
        .join(per_row, "row", "left")
        .withColumns({"base": F.coalesce("base", none), "more": F.coalesce("more", none)})
        .select(F.col("key").alias(key), "base", F.array_sort(F.concat("base", fresh)).alias("spans"))
    )


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced; ``found`` as from ``personal_data``, whose ids must be distinct."""
    spans = found.where(F.size("spans") > 0).select(F.col(key).alias("_pii_key"), F.col("spans").alias("_pii_spans"))
    clean = redacted(F.col(text), disjoint(F.col("_pii_spans")), F.lit("[PII]"))
    both = docs.join(spans, docs[key] == spans["_pii_key"], "left")
    return both.withColumn(text, F.when(F.col("_pii_spans").isNotNull(), clean).otherwise(F.col(text))).select(*docs.columns)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind))

    return rows.select(
        "doc_id",
        *[count(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
