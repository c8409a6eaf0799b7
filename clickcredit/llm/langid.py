"""Language identification with interpolated Kneser-Ney character models.

A text is its lower-case letters, every run of anything else one space. Each
language has an n-gram model of order ``ORDER``. The n-grams of all languages
are stored in one sorted hash array per order, with a column of log
probabilities per language; a second array per order holds the contexts with
their back-off weights. A character is looked up at the highest order first
and backs off where the n-gram is unknown. The language of the lowest
cross-entropy per character wins.

**Rejection.** A tenth of the training sample is held back. ``s = H - spread /
sqrt(n)`` (cross-entropy ``H`` of ``n`` characters; ``spread`` is three standard
deviations of ``sqrt(n) * H`` around its language's mean) is taken for
each of its texts, and a text is rejected if its ``s`` is above the conformal
quantile of level ``1 - ALPHA`` by more than ``SLACK_BITS``. So texts like
those learned are kept, however short, and gibberish or unknown scripts go.

**Bounds.** Training takes texts by hash so that each language gives about
``MAX_CHARS`` characters (all of them, if it has fewer), and raises an error
beyond ``MAX_LANGUAGES`` languages. So the model that is broadcast holds at
most ``ORDER * MAX_CHARS * languages`` n-grams, in practice a few percent of that.

Defined cases: a null text, an empty one and one without a letter get the
language ``und``, score 0, no cross-entropy, and are rejected; null languages and
texts without a letter aren't learned from; without any labelled text every
prediction is ``und``; very long texts are scored in pieces that carry their
context over; equal entropies give the language first in order; repeated rows
get the same answer; other columns pass through untouched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import docs_col, free_name, prepare_workers, text_of
from .words import HashArray, mix, parts_of

ORDER = 5
MAX_CHARS = 2_000_000
MAX_LANGUAGES = 512
ALPHA = 0.001
SLACK_BITS = 1.0
UNKNOWN = "und"
_PAD, _SPACE = 0, 32
_CHUNK = 1 << 18


@cache
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case letter or a space, and whether it is a letter."""
    fold = np.full(0x110000, _SPACE, np.int32)
    letter = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        kind = unicodedata.category(c)[0]
        if kind in "LM":
            low = c.lower()
            fold[i] = ord(low) if len(low) == 1 else i
            letter[i] = kind == "L"
    return fold, letter


def codes_of(text: str) -> np.ndarray:
    """Letters of a text in lower case, with one space for each run between; empty without a letter."""
    fold, letter = _folding()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not letter[points].any():
        return np.empty(0, np.int32)
    codes = fold[points]
    keep = codes != _SPACE
    keep[1:] |= codes[:-1] != _SPACE
    codes = codes[keep]
    return codes[int(codes[0] == _SPACE):len(codes) - int(codes[-1] == _SPACE)]


def _lay_out(texts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each behind ``order - 1`` pads, and where each begins."""
    pad = np.full(order - 1, _PAD, np.int32)
    line = np.concatenate([x for t in texts for x in (pad, t)])
    starts = np.cumsum([0, *(len(t) + order - 1 for t in texts[:-1])])
    return line, starts + order - 1


def _longer(shorter: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    """Hash of ``k`` codes from that of the last ``k - 1`` and the one before them."""
    return mix(shorter * np.uint64(0x2545F4914F6CDD1D) + code + np.uint64(k))


def suffix_hashes(line: np.ndarray, order: int) -> list[np.ndarray]:
    """``out[k][i]``: hash of the ``k`` codes that end at ``i`` (the line's start wraps; ``out[0]`` is 0)."""
    out = [np.zeros(len(line), np.uint64)]
    wide = line.astype(np.uint64)
    for k in range(1, order + 1):
        out.append(_longer(out[-1], np.roll(wide, k - 1), k))
    return out


def row_hashes(codes: np.ndarray) -> np.ndarray:
    """The hash of each row of codes, as ``suffix_hashes`` has it."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(1, codes.shape[1] + 1):
        out = _longer(out, codes[:, -k].astype(np.uint64), k)
    return out


@dataclass
class Model:
    """Kneser-Ney models of several languages. ``grams[k - 1]`` and ``contexts[k - 1]`` are of order k."""

    languages: list[str]
    grams: list[HashArray]
    contexts: list[HashArray]
    floor: np.ndarray
    spread: float = 0.0
    threshold: float = np.inf

    def log2(self, line: np.ndarray) -> np.ndarray:
        """Log probabilities of each character of a padded line, in bits, per language."""
        order = len(self.grams)
        hashes = suffix_hashes(line, order)
        out = np.zeros((len(line), len(self.languages)), np.float32)
        rest = np.flatnonzero(line != _PAD)
        for k in range(order, 0, -1):
            place = self.grams[k - 1].find(hashes[k][rest])
            known = place >= 0
            out[rest[known]] += self.grams[k - 1].values[place[known]]
            rest = rest[~known]
            place = self.contexts[k - 1].find(hashes[k - 1][rest - 1])
            known = place >= 0
            out[rest[known]] += self.contexts[k - 1].values[place[known]]
        out[rest] += self.floor
        return out

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits per character of each text (none empty), per language."""
        order, many = len(self.grams), max(1, len(self.languages) // 8)
        total = np.zeros((len(texts), len(self.languages)))
        sizes = [len(t) for t in texts]
        for part in parts_of(sizes, _CHUNK // many):
            some = texts[part]
            if len(some) > 1 or sizes[part.start] <= 2 * _CHUNK // many:
                line, starts = _lay_out(some, order)
                total[part] = np.add.reduceat(self.log2(line).astype(np.float64), starts, axis=0)
                continue
            whole, _ = _lay_out(some, order)
            for lo in range(order - 1, len(whole), _CHUNK // many):
                piece = whole[lo - order + 1:lo + _CHUNK // many]
                total[part.start] += self.log2(piece)[order - 1:].sum(axis=0, dtype=np.float64)
        return -total / np.array(sizes)[:, None]


def _by_order(lang: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """From the highest order down: language, n-gram, context, shorter n-gram and count of each n-gram.

    Below the highest order an n-gram counts once for each character seen before it.
    """
    while True:
        shorter = row_hashes(codes[:, 1:])
        yield lang, row_hashes(codes), row_hashes(codes[:, :-1]), shorter, counts
        if codes.shape[1] == 1:
            return
        by = np.lexsort((shorter, lang))
        new = np.ones(len(by), bool)
        new[1:] = (shorter[by][1:] != shorter[by][:-1]) | (lang[by][1:] != lang[by][:-1])
        heads = np.flatnonzero(new)
        counts = np.diff(np.append(heads, len(by)))
        codes, lang = codes[by[heads]][:, 1:], lang[by[heads]]


def fit(languages: list[str], lang: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> Model:
    """Models from n-gram counts: the row ``codes[i]`` occurs ``counts[i]`` times in language ``lang[i]``."""
    many = len(languages)
    floor = np.full(many, -np.log2(len(np.unique(codes)) + 1))
    grams: list[HashArray] = []
    contexts: list[HashArray] = []
    below_keys, below = np.empty(0, np.uint64), np.empty((0, many))
    for own_lang, gram, context, shorter, count in reversed(list(_by_order(lang, codes, counts))):
        ones, twos = int((count == 1).sum()), int((count == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        keys, one, gram_at = np.unique(gram, return_index=True, return_inverse=True)
        context_keys, context_at = np.unique(context, return_inverse=True)
        total, kinds = np.zeros((2, len(context_keys), many))
        np.add.at(total, (context_at, own_lang), count)
        np.add.at(kinds, (context_at, own_lang), 1)
        # a context that a language never had passes all its mass to the shorter n-gram
        back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        p = np.zeros((len(keys), many))
        p[gram_at, own_lang] = (count - discount) / total[context_at, own_lang]
        lower = below[np.searchsorted(below_keys, shorter[one])] if grams else np.exp2(floor)
        p += back[context_at[one]] * lower
        grams.append(HashArray(keys, np.log2(p).astype(np.float32)))
        contexts.append(HashArray(context_keys, np.log2(back).astype(np.float32)))
        below_keys, below = keys, p
    return Model(languages, grams, contexts, floor.astype(np.float32))


def _count_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_numpy(zero_copy_only=False)
            texts = [codes_of(t) for t in batch.column("text").to_pylist()]
            for which in np.unique(lang):
                own = [t for t, x in zip(texts, lang, strict=True) if x == which and len(t)]
                for part in parts_of([len(t) for t in own], _CHUNK):
                    line, _ = _lay_out(own[part], order)
                    at = np.flatnonzero(line != _PAD)
                    hashes = suffix_hashes(line, order)[order][at]
                    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                    ends = at[first]
                    yield pa.record_batch({"lang": pa.array(np.full(len(ends), which, np.int32))} | {
                        f"c{j}": pa.array(line[ends - order + 1 + j]) for j in range(order)} | {
                        "n": pa.array(counts.astype(np.int64))})
    return run


def _answers(model: Model, texts: Iterator[str]) -> pd.DataFrame:
    codes = [codes_of(t) for t in texts]
    out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "entropy": np.nan,
                        "n_letters": [len(c) for c in codes], "rejected": True})
    some = [i for i, c in enumerate(codes) if len(c)] if model.languages else []
    if some:
        n = out["n_letters"].to_numpy()[some]
        bits = model.entropies([codes[i] for i in some])
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(some)), best]
        odds = np.exp2(np.maximum(-(bits - least[:, None]) * n[:, None], -1000.0))
        columns = {"lang_pred": np.array(model.languages, object)[best], "score": 1 / odds.sum(axis=1),
                   "entropy": least, "rejected": least - model.spread / np.sqrt(n) > model.threshold}
        for name, values in columns.items():
            whole = out[name].to_numpy(copy=True)
            whole[some] = values
            out[name] = whole
    return out


_ANSWER = "lang_pred string, score double, entropy double, n_letters bigint, rejected boolean"


def _identify_with(docs: DataFrame, model: Model):
    """A column function: the answer for a text."""
    prepare_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(_ANSWER)
    def identify_texts(texts: pd.Series) -> pd.DataFrame:
        return _answers(shared.value, texts)

    return identify_texts


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
          max_chars: int = MAX_CHARS, alpha: float = ALPHA, slack_bits: float = SLACK_BITS) -> Model:
    """The models of all languages of ``labelled``, calibrated for rejection."""
    prepare_workers(labelled.sparkSession)
    rows = labelled.select(labelled[lang_col].cast("string").alias("lang"),
                           text_of(labelled, text_col).alias("text")).where("lang IS NOT NULL AND text <> ''")
    sizes = {r["lang"]: r["n"] for r in
             rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).orderBy("lang")
             .limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], [], [], np.empty(0, np.float32))
    known = F.create_map(*[x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))])
    share = F.array(*[F.lit(min(1.0, max_chars / sizes[lang])) for lang in languages])
    sample = rows.select(F.element_at(known, F.col("lang")).alias("lang"), "text").where(
        F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.get(share, F.col("lang")) * (1 << 20))
    held_back = F.pmod(F.xxhash64(F.lit("calibration"), "text"), F.lit(10)) == 0
    fields = [f"c{j}" for j in range(order)]
    schema = ", ".join(["lang int", *(f"{c} int" for c in fields), "n bigint"])
    counted = (sample.where(~held_back).mapInArrow(_count_grams(order), schema)
               .groupBy("lang", *fields).agg(F.sum("n").alias("n")).toArrow())
    if not counted.num_rows:  # too few texts to hold any back
        counted = (sample.mapInArrow(_count_grams(order), schema)
                   .groupBy("lang", *fields).agg(F.sum("n").alias("n")).toArrow())
    if not counted.num_rows:
        return Model([], [], [], np.empty(0, np.float32))
    codes = np.stack([counted[c].to_numpy() for c in fields], axis=1).astype(np.int32)
    model = fit(languages, counted["lang"].to_numpy().astype(np.int64), codes, counted["n"].to_numpy())
    answer = _identify_with(sample, model)(F.col("text"))
    told = (sample.where(held_back).select("lang", answer.alias("a"))
            .select("lang", "a.entropy", "a.n_letters").where("n_letters > 0").toArrow())
    if told.num_rows:
        own, bits, n = (told[c].to_numpy() for c in ("lang", "entropy", "n_letters"))
        mean = np.array([bits[own == i].mean() if (own == i).any() else 0.0 for i in range(len(languages))])
        model.spread = 3.0 * float(np.sqrt(np.mean((bits - mean[own]) ** 2 * n)))
        s = np.sort(bits - model.spread / np.sqrt(n))
        rank = min(len(s), int(np.ceil((len(s) + 1) * (1 - alpha))))
        model.threshold = float(s[rank - 1]) + slack_bits
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score, entropy, n_letters, rejected`` per row.

    ``score`` is the probability of the language given the text, all being
    equally likely before; ``entropy`` is in bits per character.
    """
    answer = _identify_with(docs, model)(text_of(docs, text_col))
    return (docs.select(docs[id_col].alias("id"), answer.alias("a"))
            .select("id", "a.lang_pred", "a.score", "a.entropy", "a.n_letters", "a.rejected"))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is rejected, all columns as they were."""
    name = free_name(docs, "language")
    answered = docs.withColumn(name, _identify_with(docs, model)(text_of(docs, text_col)))
    return answered.where(~F.col(name)["rejected"]).select(*[docs_col(c) for c in docs.columns])
