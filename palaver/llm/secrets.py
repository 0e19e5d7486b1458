"""Secret scans: a random forest that removes false positives, in DataFrame operations only.

Generators propose every token of 16 characters that has a digit or a capital behind a small letter, however late, and every
value of 4 behind a name that a credential word begins (within the 32 characters before the sign). A candidate is
described by its length, the changes between kinds of characters, the share of it that dictionary
words cover, the path it was found under and the words beside it. The dictionary is the most
frequent words of the whole corpus. A forest trained from labelled findings scores candidates;
those above a threshold are secrets.

Labelled findings are rows with the columns of ``described`` and a ``label`` (1 secret, 0 not).
Where none are given, candidates whose form settles the matter are the labels (``settled``): known
formats and long random values assigned to credential names; plain numbers and words, and values
beside words such as "example". At most ``sample`` findings are learned from.

A null text is an empty one; a null path is an empty one. Rows are known by a number of their own:
repeated ids, null ids and columns of any name make no difference. An empty table gives an empty
result. With labels of one kind only, no forest is fitted and the settled candidates decide. Very long texts and
tokens are read whole. Words as frequent as the last of the dictionary go by name.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import spare_name, table
from palaver.llm.spans import candidates, disjoint, located, redacted
from palaver.session import materialise

SAMPLE = 20_000
#: Entries of the dictionary: the most frequent words of the corpus.
DICTIONARY = 5000
LEAST = 0.5

_NAME = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer)"
#: Lookbehinds and possessive repetition let long unbroken texts take linear time.
PATTERNS = {
    "token": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|[A-Z+/_-]*+[a-z][a-z+/_-]*+[A-Z])[A-Za-z0-9+/_-]{16,}+={0,2}",
    "value": r"[=:]\x20{0,3}[\"']?[A-Za-z0-9+/_.!@#$%^&*-]{4,}+",
}
FEATURES = (
    "length", "changes", "distinct_share", "digit_share", "upper_share", "hex_only", "digits_only", "word_share", "named", "assigned",
    "quoted", "dummy_near", "known_form", "path_depth", "path_test", "dictionary_before",
)


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> DataFrame:
    """The ``size`` most frequent words of at least three letters, over all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.regexp_replace(text, "[^A-Za-z]+", " ")), " ")).alias("word"))
    counted = words.where(F.char_length("word") >= 3).groupBy("word").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "word").limit(size).select("word")


def known_form(match: Column) -> Column:
    """Prefixes that issuers give their keys."""
    return match.rlike(r"\A(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})")


def values_only(found: DataFrame) -> DataFrame:
    """Assigned values without the sign before them, where a credential word precedes it; other candidates as they are.

    A value that is a token of its own too is one candidate, the value.
    """
    sign = F.when(F.col("generator") == "value", F.regexp_extract("match", r"\A[=:] {0,3}[\"']?", 0)).otherwise("")
    named = F.lower("before").rlike(_NAME + r"[a-z0-9_-]*[\"']? {0,3}\z")
    kept = found.where((F.col("generator") == "token") | named)
    cut = kept.withColumn("sign", sign).withColumns(
        {
            "match": F.substring("match", F.char_length("sign") + 1, F.char_length("match")),
            "before": F.concat("before", "sign"),
            "start": F.col("start") + F.char_length("sign"),
        }
    )
    place = ["row", "start", "end"]
    # "value" is the larger name of the two generators
    rest = F.struct("generator", *[c for c in found.columns if c not in (*place, "generator")])
    return cut.groupBy(*place).agg(F.max(rest).alias("_c")).select(*place, "_c.*").select(*found.columns)


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with their features; ``words`` is a dictionary of bounded size."""
    head = F.col("match")
    size = F.greatest(F.char_length(head), F.lit(1))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(head, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A"), "[^0aA]", ".")
    runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
    before = F.lower("before")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    share = lambda keep: F.char_length(F.regexp_replace(head, keep, "")) / size
    last = F.regexp_extract(before, r"([a-z]{3,})[^a-z]*\z", 1)
    rows = found.withColumns({"_id": F.struct("row", "generator", "start"), "_last": last})
    parts = rows.select("_id", F.explode(F.regexp_extract_all(F.lower(head), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    # the dictionary has at most DICTIONARY words
    covered = parts.join(F.broadcast(words), "word").groupBy("_id").agg(F.sum(F.char_length("word")).alias("_covered"))
    seen = words.select(F.col("word").alias("_last"), F.lit(True).alias("_seen"))
    both = rows.join(covered, "_id", "left").join(F.broadcast(seen), "_last", "left")
    return both.select(
        *found.columns,
        F.char_length("match").cast("double").alias("length"),
        ((F.char_length(runs) - 1) / size).alias("changes"),
        (F.size(F.array_distinct(F.split(head, ""))) / size).alias("distinct_share"),
        share("[^0-9]").alias("digit_share"),
        share("[^A-Z]").alias("upper_share"),
        flag(head.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z")).alias("hex_only"),
        flag(head.rlike(r"\A[0-9_./+-]+\z")).alias("digits_only"),
        (F.coalesce("_covered", F.lit(0)) / size).alias("word_share"),
        flag(before.rlike(_NAME + r"[a-z0-9_-]*\W{0,8}\z")).alias("named"),
        flag(before.rlike(r"[=:]\s*[\"']?\z")).alias("assigned"),
        flag(before.rlike(r"[\"'`]\z") & F.col("after").rlike(r"\A[\"'`]")).alias("quoted"),
        flag(F.lower(F.concat_ws(" ", "before", head, "after")).rlike(r"(?<![@.])\b(?:example|sample|dummy|placeholder|changeme)\b(?!\.[a-z])|xxxx|your[_-]")).alias("dummy_near"),
        flag(known_form(F.col("match"))).alias("known_form"),
        (F.size(F.split(F.coalesce("path", F.lit("")), "/")) - 1).cast("double").alias("path_depth"),
        flag(F.lower("path").rlike("test|example|sample|mock|fixture|doc")).alias("path_test"),
        flag(F.col("_seen")).alias("dictionary_before"),
    )


def settled(rows: DataFrame) -> DataFrame:
    """Findings whose form settles their label."""
    random = (F.col("changes") > 0.2) & (F.col("word_share") < 0.3) & (F.col("distinct_share") > 0.15)
    secret = (F.col("dummy_near") == 0) & ((F.col("known_form") == 1) | ((F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("length") >= 12) & random))
    harmless = (F.col("dummy_near") == 1) | (F.col("digits_only") == 1) | ((F.col("assigned") == 0) & (F.col("known_form") == 0) & ((F.col("word_share") > 0.5) | (F.col("changes") < 0.1)))
    return rows.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0)).where("label is not null")


def fit(labelled: DataFrame, sample: int = SAMPLE, trees: int = 20, depth: int = 6):
    """A random forest on at most ``sample`` labelled findings, half of either label; None without both labels."""
    picked = None
    for label in (1, 0):
        part = labelled.where(F.col("label") == label).select(
            F.col("label").cast("double").alias("label"), *FEATURES, F.xxhash64("match", "before", "row", "start").alias("h")
        )
        part = part.orderBy("h").limit(sample // 2)
        picked = part if picked is None else picked.union(part)
    picked = materialise(picked.coalesce(1), "secret-sample").coalesce(2)
    if len(picked.select("label").distinct().limit(2).collect()) < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(picked)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, maxMemoryInMB=64).fit(rows.select("features", "label"))


def scored(rows: DataFrame, model) -> DataFrame:
    """Candidates with the probability that they are secrets as ``score``."""
    if model is None:
        return settled(rows).withColumn("score", F.col("label").cast("double")).drop("label")
    given = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)
    out = model.setFeaturesCol("_features").setPredictionCol("_p").setRawPredictionCol("_r").setProbabilityCol("_q").transform(given)
    return out.withColumn("score", vector_to_array("_q")[1]).drop("_features", "_p", "_r", "_q")


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: Column | None = None,
    labelled: DataFrame | None = None,
    least: float = LEAST,
) -> DataFrame:
    """Every row's ``key``, the ``digest`` of its text, its number of candidates and its secrets: disjoint ``start, end`` in order."""
    where = F.lit("") if path is None else F.coalesce(path.cast("string"), F.lit(""))
    rows = located(docs, PATTERNS, key, text, {"path": where, "digest": F.xxhash64(text)})
    words = materialise(dictionary(docs, text), "secret-words")
    found = materialise(described(values_only(candidates(rows, "path")), words), "secret-candidates")
    judged = scored(found, fit(settled(found) if labelled is None else labelled))
    per_row = found.groupBy("row").agg(F.count("*").alias("n_candidates"))
    secrets = judged.where(F.col("score") >= least).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hits"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return (
        rows.select("row", "key", "digest")
        .join(per_row, "row", "left")
        .join(secrets, "row", "left")
        .select(
            F.col("key").alias(key),
            "digest",
            F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"),
            F.when(F.col("hits").isNull(), none).otherwise(disjoint(F.col("hits"))).alias("secrets"),
        )
    )


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", sign: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets replaced. ``found`` is as from ``scan``; of rows that repeat an id, each loses its own secrets only.

    Rows are matched by id and text digest, so that repeated and null ids meet their own findings. Equal rows whose paths
    led to different findings lose the larger list.
    """
    names = [spare_name(docs, n) for n in ("found_key", "found_digest", "found_secrets")]
    listed = found.where(F.size("secrets") > 0).select(F.col(key), "digest", "secrets").toDF(*names)
    spans = listed.groupBy(*names[:2]).agg(F.max(names[2]).alias(names[2]))
    spans = materialise(spans, "secret-spans")
    on = docs[key].eqNullSafe(spans[names[0]]) & (F.xxhash64(docs[text]) == spans[names[1]])
    both = docs.join(spans, on, "left")
    clean = redacted(docs[text], F.col(names[2]), F.lit(sign))
    return both.select(
        *[F.when(F.col(names[2]).isNotNull(), clean).otherwise(docs[c]).alias(c) if c == text else docs[c] for c in docs.columns]
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"), path=F.col("source"))
    return rows.select(
        "doc_id",
        "n_candidates",
        F.size("secrets").cast("long").alias("n_secrets"),
        joined_secrets().alias("spans"),
    )


def joined_secrets() -> Column:
    return F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", F.lit("secret"), s["start"], s["end"])), ",")
