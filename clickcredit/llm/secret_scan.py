"""Secret scanning: candidates by pattern, false positives removed by a random forest.

Only DataFrame functions and Spark's DataFrame-based ML run here. A candidate is
a run of ``MIN_CHARS`` or more letters, digits and ``_ + / -``. The forest judges it
by

* its length and the shares of lower-case, upper-case, digit and other characters;
* character transitions: how often the class changes, between letters and
  digits, between cases, and from vowel to consonant, and its distinct characters;
* dictionary coverage: the share of its letter ``GRAM``-grams that words of the
  training documents have;
* the path it was found under: length, depth, and whether it names tests or examples;
* the neighbouring words and the characters that lead to it, hashed.

``train`` fits it on labelled findings, a sample of about ``MAX_FINDINGS`` of
them at most, chosen by hash. The dictionary comes from all documents. It holds at
most 26 ** ``GRAM`` grams, as many as the alphabet has, so it may be broadcast.
All documents are scanned, whole.

Defined cases: a null text counts as empty and a null path as empty; labelled
findings with a null label aren't learned from; unless findings of both
labels are given there is nothing to learn, and every candidate is kept with a
null probability; repeated rows give repeated findings; an empty table gives
none; other columns are never read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize, text_of

MIN_CHARS = 16
GRAM = 4
MAX_FINDINGS = 20_000
MIN_PROBABILITY = 0.5
TREES, DEPTH, SEED = 30, 8, 7
NEIGHBOUR_BUCKETS = 64
_NEAR = 64
_MARK = "\x01"
_CANDIDATE = rf"[A-Za-z0-9_+/-]{{{MIN_CHARS},}}"
_CLASSES = str.maketrans({**dict.fromkeys(string.ascii_lowercase, "a"), **dict.fromkeys(string.ascii_uppercase, "A"),
                          **dict.fromkeys(string.digits, "9"), **dict.fromkeys("_+/-", "_")})
_CHARACTERS = string.ascii_letters + string.digits + "_+/-"
NUMERIC = ["n_chars", "lower", "upper", "digit", "other", "changes", "letter_digit", "case_changes",
           "vowel_consonant", "distinct", "coverage", "path_chars", "path_depth", "path_example"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path_col: str | None = "source") -> DataFrame:
    """Findings (written): ``finding, id, path, start, candidate, before, after``.

    ``start`` counts code points from 0. ``before`` and ``after`` are up to 64
    characters of text around it, up to the next candidate.
    """
    path = F.coalesce(docs[path_col].cast("string"), F.lit("")) if path_col else F.lit("")
    text = F.translate(text_of(docs, text_col), _MARK, " ")
    # contexts and candidates take turns: context 0, candidate 1, context 2, ...
    pieces = F.split(F.regexp_replace(text, _CANDIDATE, f"{_MARK}$0{_MARK}"), _MARK)
    rows = (docs.select(docs[id_col].alias("id"), path.alias("path"), pieces.alias("pieces"))
            .where(F.size("pieces") > 1)
            .select(F.monotonically_increasing_id().alias("row"), "id", "path", "pieces"))
    each = F.transform(F.sequence(F.lit(1), F.size("pieces") - 2, F.lit(2)), lambda i: F.struct(
        F.get("pieces", i).alias("candidate"),
        F.length(F.get("pieces", i - 1)).alias("gap"),
        F.right(F.get("pieces", i - 1), F.lit(_NEAR)).alias("before"),
        F.left(F.get("pieces", i + 1), F.lit(_NEAR)).alias("after")))
    found = rows.select("row", "id", "path", F.posexplode(each).alias("k", "c")).select(
        "row", "id", "path", "k", "c.*")
    start = F.expr("sum(gap + length(candidate)) OVER (PARTITION BY row ORDER BY k) - length(candidate)")
    placed = found.withColumn("start", start)
    return materialize(placed.select(
        F.struct("row", "k").alias("finding"), "id", "path", "start", "candidate", "before", "after"),
        "secrets-candidates")


def _share(kind: Column, of: str, total: Column) -> Column:
    return (total - F.length(F.replace(kind, F.lit(of), F.lit("")))) / total


def _letter_grams(c: Column) -> Column:
    """The distinct ``GRAM``-grams of letters of a text, in lower case."""
    low = F.lower(c)
    spans = F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - (GRAM - 1), F.lit(1))),
                        lambda i: F.substr(low, i, F.lit(GRAM)))
    return F.array_distinct(F.filter(spans, lambda g: g.rlike(f"^[a-z]{{{GRAM}}}$")))


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The letter grams that plain words of the documents have more than once (written): ``gram``."""
    words = docs.select(F.explode(F.regexp_extract_all(
        text_of(docs, text_col), F.lit(rf"(?<![^\s])([A-Za-z][a-z]{{{GRAM - 1},}})(?=[\s.,]|$)"), 1)).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    grams = counted.select(F.explode(_letter_grams(F.col("word"))).alias("gram"), "n").groupBy("gram").agg(
        F.sum("n").alias("n")).where("n > 1")
    return materialize(grams.select("gram"), "secrets-dictionary")


def _neighbours(before: Column, after: Column) -> Column:
    """Neighbouring words and leading characters, each with its place."""
    left = F.reverse(F.regexp_extract_all(F.lower(before), F.lit("([a-z]+)"), 1))
    right = F.regexp_extract_all(F.lower(after), F.lit("([a-z]+)"), 1)
    lead = F.regexp_replace(F.right(F.rtrim(before), F.lit(2)), r"[\p{L}\p{N}]", "w")
    return F.filter(F.array(
        F.concat(F.lit("left "), F.get(left, F.lit(0))), F.concat(F.lit("left "), F.get(left, F.lit(1))),
        F.concat(F.lit("right "), F.get(right, F.lit(0))), F.concat(F.lit("lead "), lead)), F.isnotnull)


def features(findings: DataFrame, grams: DataFrame) -> DataFrame:
    """``findings`` with the numeric features and ``neighbours``."""
    c = F.col("candidate")
    n = F.length(c)
    kind = F.translate(c, _CHARACTERS, _CHARACTERS.translate(_CLASSES))

    def count(pattern: str, of: Column = kind) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / n

    own = findings.select("finding", F.explode(_letter_grams(c)).alias("gram"))
    # bounded by the alphabet
    covered = own.join(F.broadcast(grams), "gram").groupBy("finding").agg(F.count(F.lit(1)).alias("covered"))
    numbered = findings.select(
        "*", n.cast("double").alias("n_chars"),
        _share(kind, "a", n).alias("lower"), _share(kind, "A", n).alias("upper"),
        _share(kind, "9", n).alias("digit"), _share(kind, "_", n).alias("other"),
        count("a(?=[^a])|A(?=[^A])|9(?=[^9])|_(?=[^_])").alias("changes"),
        count("9(?=[aA])|[aA](?=9)").alias("letter_digit"), count("a(?=A)|A(?=a)").alias("case_changes"),
        count("[aeiou](?=[bcdfghjklmnpqrstvwxyz])", F.lower(c)).alias("vowel_consonant"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct"),
        F.length("path").cast("double").alias("path_chars"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("path_depth"),
        F.col("path").rlike("(?i)test|spec|example|sample|fixture|mock|doc").cast("double").alias("path_example"),
        _neighbours(F.col("before"), F.col("after")).alias("neighbours"),
        F.size(_letter_grams(c)).alias("grams"))
    return numbered.join(covered, "finding", "left").withColumn(
        "coverage", F.coalesce(F.col("covered") / F.greatest("grams", F.lit(1)), F.lit(0.0))).drop("grams", "covered")


@dataclass
class SecretModel:
    """A forest with its features; ``forest`` is None where nothing could be learned."""

    forest: PipelineModel | None
    grams: DataFrame


def train(labelled: DataFrame, docs: DataFrame, text_col: str = "text", label_col: str = "label",
          max_findings: int = MAX_FINDINGS) -> SecretModel:
    """Fit on ``labelled``: findings as ``candidates`` gives them, with a label 1 (secret) or 0.

    ``docs`` are the documents that the dictionary is taken from.
    """
    grams = dictionary(docs, text_col)
    known = labelled.where(F.col(label_col).isNotNull())
    share = min(1.0, max_findings / max(known.count(), 1))
    sample = known.where(F.pmod(F.xxhash64("id", "start", "candidate"), F.lit(1 << 20)) < share * (1 << 20))
    rows = materialize(features(sample, grams).withColumn("label", F.col(label_col).cast("double")),
                       "secrets-training")
    if rows.select("label").distinct().count() < 2:
        return SecretModel(None, grams)
    hashed = HashingTF(numFeatures=NEIGHBOUR_BUCKETS, inputCol="neighbours", outputCol="near")
    assembled = VectorAssembler(inputCols=[*NUMERIC, "near"], outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label",
                                    featuresCol="features").fit(assembled.transform(hashed.transform(rows)))
    return SecretModel(PipelineModel([hashed, assembled, forest]), grams)


def judge(findings: DataFrame, model: SecretModel, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """``findings`` with ``probability`` and ``is_secret``."""
    if model.forest is None:
        return findings.select("*", F.lit(None).cast("double").alias("probability"), F.lit(True).alias("is_secret"))
    scored = model.forest.transform(features(findings, model.grams))
    p = vector_to_array("probability")[1]
    return scored.select(*findings.columns, p.alias("p")).select(
        *findings.columns, F.col("p").alias("probability"), (F.col("p") >= min_probability).alias("is_secret"))
