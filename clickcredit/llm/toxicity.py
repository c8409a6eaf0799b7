"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its terms: each word (lower case, without punctuation) and
the first ``PREFIXES`` bytes of it, which catch inflected forms, hashed to 32
bits. The model gives each term ``i`` a weight ``w`` and a vector ``v`` of
``FACTORS`` numbers::

    p = sigmoid(b + sum_i w_i + sum_{i < j} <v_i, v_j>)

The sum over pairs is ``(|sum v|^2 - sum |v|^2) / 2``, so a text costs its terms
and not its pairs. A pair such as an insult and the mention of a group can weigh
what neither term does alone.

Training:

1. At most about ``MAX_ROWS`` labelled rows are drawn by a hash, from the labels alone.
   They are broadcast, so no text is shuffled.
2. The terms of these texts are written, and counted per term and label.
3. The model's terms are those whose share of toxic texts differs from that of all texts
   beyond chance (``MIN_Z``), at most ``MAX_TERMS``, and the ``FREQUENT`` most
   frequent ones, which mean something only beside others.
4. Spark's distributed learner fits the machine. Texts without any term, ``EMPTY_SHARE`` of the
   sample, are taught as clean, or the bias would be left to the frequent terms.

Scoring reads each text where it lies: terms outside the model are dropped before
anything is sorted, and nothing is shuffled.

Defined cases: a null or empty text has no terms and gets the machine's score of
no terms; labels whose id or value is null teach nothing, an id with several
labels is toxic if one says so; equal rows get equal scores, and each row gets one;
without labelled texts of both kinds every score is the share of toxic ones among
them (0 without any); an empty table gives an empty result; a text may be
arbitrarily long; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialize, prepare_workers, text_of
from .words import NOT_ALNUM, parts_of, word_prefixes

#: Bytes of a word that are terms too.
PREFIXES = (4, 5, 6)
MAX_ROWS = 20_000
MAX_TERMS = 4096
FREQUENT = 64
MIN_TEXTS = 5
#: Standard deviations between a term's toxic texts and what chance gives.
MIN_Z = 5.5
EMPTY_SHARE = 0.05
FACTORS = 8
ITERATIONS = 120
STEP = 0.1
REGULARIZATION = 1e-4
_BATCH_CHARS = 1 << 22
#: Leading bits of a term that a table of the model's terms knows.
_KNOWN_BITS = 20


@dataclass
class Model:
    """A trained machine: sorted terms with their weights and factors."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def logits(self, doc: np.ndarray, term: np.ndarray, texts: int) -> np.ndarray:
        """Of each text, from the sorted distinct pairs of text and place of a term."""
        out = np.full(texts, self.bias) + np.bincount(doc, self.weights[term], texts)
        for column in self.factors.T:
            out += (np.bincount(doc, column[term], texts) ** 2 - np.bincount(doc, column[term] ** 2, texts)) / 2
        return out


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``doc, terms``: the index of the text, and the term as 32 bits; a term may repeat."""
    data = [t.lower().encode() for t in texts]
    offsets = np.cumsum([0, *(len(t) + 1 for t in data)])
    starts, hashes = word_prefixes(b"\n".join(data), PREFIXES, NOT_ALNUM)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    some = hashes > 0
    return np.repeat(doc, some.sum(axis=1)), (hashes[some] >> np.uint64(32)).astype(np.int64)


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for part in parts_of([len(t) for t in texts], _BATCH_CHARS):
            doc, terms = terms_of(texts[part])
            keys = np.unique(doc << 32 | terms)
            offsets = np.searchsorted(keys >> 32, np.arange(part.stop - part.start + 1))
            yield pa.record_batch({
                "label": batch.column("label").slice(part.start, part.stop - part.start),
                "terms": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys & (1 << 32) - 1))})


def sampled_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
                   max_rows: int = MAX_ROWS) -> DataFrame:
    """``id, label`` of about ``max_rows`` labelled ids at most, drawn by a hash of the id."""
    known = (labels.where(labels[id_col].isNotNull() & labels[label_col].isNotNull())
             .groupBy(labels[id_col].alias("id")).agg(F.max(labels[label_col].cast("double")).alias("label")))
    share = min(1.0, max_rows / max(known.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 30)) / float(1 << 30)
    return known.where(draw < share)


def chosen_terms(texts: DataFrame, toxic: int, total: int) -> list[int]:
    """The terms of the model, from the table ``label, terms`` of the sampled texts."""
    counts = materialize(
        texts.select("label", F.explode("terms").alias("term")).groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).where(F.col("n") >= MIN_TEXTS),
        "toxic-counts")
    share = toxic / total
    expected = F.col("n") * share
    # the variance of drawing n of all texts without putting back
    spread = F.sqrt(expected * (1 - share) * (1 - F.col("n") / total) + 1e-9)
    z = F.abs(F.col("toxic") - expected) / spread
    strong = counts.where(z > MIN_Z).orderBy(z.desc(), "term").limit(MAX_TERMS)
    frequent = counts.orderBy(F.desc("n"), "term").limit(FREQUENT)
    return sorted({r["term"] for r in strong.select("term").union(frequent.select("term")).collect()})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """Learn from the texts of ``docs`` whose ids ``labels`` marks with 0 or 1."""
    prepare_workers(docs.sparkSession)
    taught = materialize(sampled_labels(labels, id_col, label_col, max_rows), "toxic-labels")
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    # at most about max_rows rows of an id and a label
    joined = rows.join(F.broadcast(taught), "id").select("label", "text")
    texts = materialize(joined.mapInArrow(_distinct_terms, "label double, terms array<bigint>"), "toxic-terms")
    seen = texts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    total, toxic = seen["n"], seen["toxic"] or 0
    vocabulary = chosen_terms(texts, toxic, total) if 0 < toxic < total else []
    if not vocabulary:
        share = np.clip(toxic / max(total, 1), 1e-9, 1 - 1e-9)
        return Model(np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)), float(np.log(share / (1 - share))))
    vectors = CountVectorizerModel.from_vocabulary(
        [str(t) for t in vocabulary], inputCol="words", outputCol="features", binary=True)
    empty = docs.sparkSession.range(int(np.ceil(EMPTY_SHARE * total)), numPartitions=1).select(
        F.lit(0.0).alias("label"), F.lit(None).cast("array<bigint>").alias("terms"))
    words = F.coalesce(F.col("terms").cast("array<string>"), F.array().cast("array<string>"))
    featured = vectors.transform(texts.unionByName(empty).select("label", words.alias("words")))
    machine = FMClassifier(factorSize=FACTORS, maxIter=ITERATIONS, stepSize=STEP, regParam=REGULARIZATION,
                           seed=1).fit(featured.select("label", "features"))
    return Model(np.array(vocabulary, np.int64), machine.linear.toArray(), machine.factors.toArray(),
                 machine.intercept)


def _score_with(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(1 << _KNOWN_BITS, bool)
        known[model.terms >> 32 - _KNOWN_BITS] = True
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in parts_of([len(t) for t in texts], _BATCH_CHARS):
                doc, terms = terms_of(texts[part])
                maybe = known[terms >> 32 - _KNOWN_BITS]
                doc, terms = doc[maybe], terms[maybe]
                place = np.searchsorted(model.terms, terms)
                same = np.flatnonzero(np.append(model.terms, -1)[place] == terms)
                pairs = np.unique(doc[same] << 32 | place[same])
                n = part.stop - part.start
                logits = model.logits(pairs >> 32, pairs & (1 << 32) - 1, n)
                yield pa.record_batch({"id": batch.column("id").slice(part.start, n),
                                       "score": pa.array(1 / (1 + np.exp(-np.clip(logits, -500, 500)))),
                                       "n_terms": pa.array(np.bincount(pairs >> 32, minlength=n).astype(np.int64))})
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score, n_terms`` per row: the probability that it is toxic, and how many of the model's terms it has."""
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(_score_with(model), T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("n_terms", T.LongType())]))
