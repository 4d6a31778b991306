"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams of a language, most frequent first.  A document's own list is compared
with each profile: every n-gram of the document adds the distance between its two places, or the full length of a profile
if that lacks it.  The language with the smallest sum of these out-of-place distances is predicted.

N-grams are runs of 1 to 3 characters inside words; a word is a run of letters with one blank before and after it, so
beginnings and ends count.  Texts are lower-cased.  An n-gram is packed exactly into 63 bits, 21 per character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import PIECE_BYTES, adding, codepoints, decoded, packed, small

LENGTH = 400  # n-grams in a profile
UNKNOWN = "und"
_BLANK = np.uint64(0x20)


def _letters() -> np.ndarray:
    """For every code point: is it a letter (Unicode category L)?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str, letters: np.ndarray) -> np.ndarray:
    """Every n-gram occurrence of a text, packed; empty if the text has no letter."""
    points = codepoints(text.lower())
    keep = letters[points]
    if not keep.any():
        return np.zeros(0, np.uint64)
    x = np.where(keep, points, 0x20).astype(np.uint64)
    x = np.concatenate([[_BLANK], x, [_BLANK]])
    solid = x != _BLANK
    x = x[np.concatenate([[True], solid[1:] | solid[:-1]])]
    solid = x != _BLANK
    pairs = (x[:-1] << np.uint64(21)) | x[1:]
    triples = ((pairs[:-1] << np.uint64(21)) | x[2:])[solid[1:-1]]
    return np.concatenate([x[solid], pairs, triples])


def ranked(text: str, letters: np.ndarray, length: int) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first; ties by code points."""
    values, counts = np.unique(ngrams(text, letters), return_counts=True)
    if len(values) > length:
        least = np.partition(counts, len(counts) - length)[len(counts) - length]
        values, counts = values[counts >= least], counts[counts >= least]
    return values[np.argsort(-counts, kind="stable")][:length]


def profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", length: int = LENGTH) -> DataFrame:
    """``(lang, gram, place)``: the ``length`` most frequent n-grams of every language, place 0 first, ties by n-gram.

    Rows with a null language or text teach nothing.  Counts cover all rows given.
    """
    needed = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where(
        "lang is not null and text is not null"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                values, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch(
                    [pa.array([name] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"],
                )
            held.clear()

        for batch in small(batches):
            for name, t in zip(batch.column(0).to_pylist(), decoded(batch.column(1)), strict=True):
                held.setdefault(name, []).append(ngrams(t, letters))
                size += len(t)
                if size >= PIECE_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = needed.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < length).select("lang", "gram", "place")


def identify(documents: DataFrame, known: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(row, lang_pred, score)`` per row of ``documents``, against ``known(lang, gram, place)``.

    ``known`` has ``length`` rows per language and goes to every task.  ``score`` is 1 for a document that lists the same
    n-grams in the same order as the best profile and 0 for one that shares none with any; equally near languages
    go to the first by name.  Null texts, texts without a letter, and all texts if no language is known, are ``und``
    with score 0.
    """
    rows = packed(documents)
    table = known.toPandas()  # length x languages rows
    names = sorted(table["lang"].unique())
    grams = np.unique(table["gram"].to_numpy(np.uint64)) if len(table) else np.zeros(0, np.uint64)
    places = np.full((len(names), len(grams) + 1), -1, np.int32)
    for i, name in enumerate(names):
        own = table[table["lang"] == name]
        places[i, np.searchsorted(grams, own["gram"].to_numpy(np.uint64))] = own["place"].to_numpy()

    def judge(text_value: str | None, letters: np.ndarray) -> tuple[str, float]:
        listed = ranked(text_value, letters, length) if text_value and names else ()
        if len(listed) == 0:
            return UNKNOWN, 0.0
        spot = np.searchsorted(grams, listed)
        spot[spot < len(grams)] = np.where(grams[spot[spot < len(grams)]] == listed[spot < len(grams)], spot[spot < len(grams)], len(grams))
        theirs = places[:, spot]
        away = np.where(theirs < 0, length, np.abs(theirs - np.arange(len(listed), dtype=np.int32)))
        sums = away.sum(axis=1)
        best = int(np.argmin(sums))
        return names[best], 1.0 - float(sums[best]) / (length * len(listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in small(batches):
            row = batch.column(0)
            said = [judge(t, letters) for t in decoded(row.field(text))]
            lang = pa.array([s[0] for s in said], pa.string())
            yield pa.record_batch([row, lang, pa.array([s[1] for s in said], pa.float64())], ["row", "lang_pred", "score"])

    return rows.mapInArrow(run, adding(rows.schema, "lang_pred string, score double"))


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from learning: the CRC-32 of the id as text leaves 2 when divided by 4.  Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_all(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows with a language that are not held out, then judge every row; as ``identify``."""
    return identify(documents, profiles(documents.where(~held_out(key)), text, lang), text)


def recognised(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose language is told, all columns unchanged: those judged ``und`` or of score 0 go."""
    found = identify_all(documents, key, text, lang)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).select("row.*")
