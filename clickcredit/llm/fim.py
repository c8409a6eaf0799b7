"""Fill-in-the-middle examples by a pipeline of Arrow compute functions.

A text is cut into units: a word with the white space before it, and the white
space at its end. Two places drawn from a hash of the id part them into prefix,
middle and suffix. An example is the text as it is (``plain``), or its pieces
behind sentinels: ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is
``<S>suffix<P>prefix<M>middle``. A text that holds a sentinel stays plain, so
every example gives its exact text back (``restored``).

Each Arrow batch goes through these steps, all of them over whole arrays:

1. Split the texts into a list array of units.
2. Flatten it, with the index of each unit's text as its parent.
3. The ordinal of a unit is its place minus that of the first unit of its parent.
4. The ordinal gives the unit's role; filter by role and rebuild the lists.
5. Join each list to a piece, and the pieces with the sentinels of their form.

The numbers that place the cuts and choose the form are a hash of seed and id, so
an example is the same whatever partition it is made in and however often.

Defined cases: null and empty texts are plain and empty; a null id counts as an
empty one in the hash; rows that share an id are cut at the same numbers, each
over its own text, and all stay; a text of blanks is one unit; a very long text is
a batch of its own; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import prepare_workers, text_of

PLAIN, PSM, SPM = "plain", "psm", "spm"
_KIND = pa.large_binary()
_UNIT = rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
#: No byte of a UTF-8 text.
_CUT = b"\xff"


class Sentinels(NamedTuple):
    """What stands before each piece."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _bytes(value: bytes) -> pa.Scalar:
    return pa.scalar(value, _KIND)


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts (binary), and the index of each unit's text."""
    marked = pc.replace_substring_regex(texts, pattern=_UNIT, replacement=rb"\0" + _CUT)
    lists = pc.split_pattern(marked, pattern=_CUT)
    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # behind the last word comes an empty unit, or the white space at the end
    some = pc.greater(pc.binary_length(units), 0)
    return units.filter(some), parents.filter(some).to_numpy()


def _joined(units: pa.Array, parents: np.ndarray, chosen: np.ndarray, texts: int) -> pa.Array:
    """The chosen units of each text as one piece."""
    counts = np.bincount(parents[chosen], minlength=texts)
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts)))),
                                          units.filter(pa.array(chosen)))
    return pc.binary_join(lists, _bytes(b""))


def _chars(pieces: pa.Array) -> pa.Array:
    anything = pc.CastOptions(target_type=pa.large_string(), allow_invalid_utf8=True)
    return pc.utf8_length(pc.cast(pieces, options=anything)).cast(pa.int64())


def examples(texts: pa.Array, draws: list[np.ndarray], rate: int, spm_rate: int,
             sentinels: Sentinels) -> dict[str, pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of a batch of texts (binary, no nulls).

    ``draws`` are four arrays of numbers per text: two for the places, one for whether it is cut, one for the form.
    """
    count = len(texts)
    units, parents = units_of(texts)
    n = np.bincount(parents, minlength=count)
    first = np.cumsum(n) - n
    ordinal = np.arange(len(parents)) - first[parents]
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    lo, hi = np.minimum(one, two)[parents], np.maximum(one, two)[parents]
    prefix, middle, suffix = (_joined(units, parents, chosen, count) for chosen in (
        ordinal < lo, (ordinal >= lo) & (ordinal < hi), ordinal >= hi))
    held = np.zeros(count, bool)
    for sentinel in sentinels:
        held |= pc.match_substring(texts, sentinel.encode()).to_numpy(zero_copy_only=False)
    plain = (n == 0) | held | (draws[2] % 100 >= rate)
    forms = np.where(plain, PLAIN, np.where(draws[3] % 100 < spm_rate, SPM, PSM))
    p, s, m = (_bytes(x.encode()) for x in sentinels)
    output = pc.case_when(
        pa.StructArray.from_arrays([pa.array(forms == PLAIN), pa.array(forms == PSM)], ["plain", "psm"]),
        texts, pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, _bytes(b"")),
        pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, _bytes(b"")))
    absent = pa.scalar(None, pa.int64())
    return {"n": pa.array(n.astype(np.int64)), "form": pa.array(forms.tolist(), pa.string()),
            "prefix_chars": pc.if_else(pa.array(plain), absent, _chars(prefix)),
            "middle_chars": pc.if_else(pa.array(plain), absent, _chars(middle)), "output": output.cast(pa.binary())}


def _in_batches(rate: int, spm_rate: int, sentinels: Sentinels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = [batch.column(f"h{k}").to_numpy() for k in range(4)]
            texts = batch.column("text").cast(_KIND)
            yield pa.record_batch({"id": batch.column("id"),
                                   **examples(texts, draws, rate, spm_rate, sentinels)})
    return run


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
              spm_rate: int = 80, sentinels: Sentinels = Sentinels()) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` per row of ``docs``.

    ``rate`` of a hundred texts are cut, and ``spm_rate`` of a hundred of those take
    the form ``spm``. ``n`` counts units; the lengths of the pieces are in code points, null if plain.
    """
    prepare_workers(docs.sparkSession)
    name = F.coalesce(docs[id_col].cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k}") for k in range(4)]
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).cast("binary").alias("text"), *draws)
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.BinaryType())])
    found = rows.mapInArrow(_in_batches(rate, spm_rate, sentinels), schema)
    return found.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The exact text of an example."""
    def pieces(first: str, *others: str) -> Column:
        behind = F.substring(output, F.lit(len(first) + 1), F.length(output))
        return F.split(behind, "|".join(re.escape(x) for x in others), -1)

    p, s, m = sentinels
    psm, spm = pieces(p, s, m), pieces(s, p, m)
    return (F.when(form == PSM, F.concat(F.get(psm, 0), F.get(psm, 2), F.get(psm, 1)))
            .when(form == SPM, F.concat(F.get(spm, 1), F.get(spm, 2), F.get(spm, 0)))
            .otherwise(output))
