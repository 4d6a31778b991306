"""Importance resampling towards a target distribution, with weights from bit-sliced sums.

Features of a text are its runs of consecutive words; each falls into a bucket by its CRC-32.  A bucket's gain is the
logarithm of how much likelier the target is to produce it than the documents are, in whole thousandths.  A document's weight
is the mean gain of its features.

The sum of gains over a document is taken bit-sliced: its bucket counts become planes, one bit per bucket and a plane per
binary digit, and so do the gains in two's complement.  The sum over all pairs of planes of 2^(i + j) times the number of
bits set in both is the exact sum of count times gain.

The draw takes the documents with the highest weight plus Gumbel noise, which is a sample without replacement in proportion
to the exponentials of the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import PIECE_BYTES, adding, checkpointed, in_order, packed, small, text_bytes

BUCKETS = 10_000
MIN_RUN = MAX_RUN = 1  # words of a feature
LEAST_WORDS = 20  # of a document that can be drawn
PERCENT = 10
SEED = 2024
CHUNK = 64  # documents whose bucket counts a task holds at a time
# A-Z become a-z, other letters, digits and bytes from 0x80 on stay, all else parts words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_lists(text: bytes, carry: int = 0, size: int = PIECE_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """Words of ``text`` in pieces of about ``size`` bytes, and how many words at the head were in the piece before.

    Pieces end between words and repeat the last ``carry`` words, so no run of up to ``carry + 1`` words is lost.
    """
    text, begin, kept = text.translate(_WORDS), 0, []
    while begin < len(text):
        end = text.find(b" ", begin + size)
        end = len(text) if end < 0 else end
        words = kept + text[begin:end].split()
        yield words, len(kept)
        kept = words[len(words) - carry :] if carry and len(words) > carry else words[: len(words) * (carry > 0)]
        begin = end


def features(text: bytes, low: int, high: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and how many features fall into each bucket."""
    n_words, counts = 0, np.zeros(buckets, np.int64)
    for words, old in word_lists(text, high - 1):
        n_words += len(words) - old
        for n in range(low, high + 1):
            first = max(0, old - n + 1)  # runs that end among the words carried over were counted
            runs = words if n == 1 and not first else (b" ".join(words[i : i + n]) for i in range(first, len(words) - n + 1))
            codes = np.fromiter(map(crc32, runs), np.uint32)
            counts += np.bincount(codes % buckets, minlength=buckets)
    return n_words, counts


def bit_planes(values: np.ndarray, digits: int) -> np.ndarray:
    """``[digit, ..., word]``: bit ``k`` of plane ``j`` is digit ``j`` of the ``k``-th number of the last axis."""
    width = -(-values.shape[-1] // 64) * 64
    planes = np.zeros((digits, *values.shape[:-1], width), np.uint8)
    for j in range(digits):
        planes[j, ..., : values.shape[-1]] = (values >> j) & 1
    return np.packbits(planes, axis=-1, bitorder="little").view(np.uint64)


def gain_planes(gains: np.ndarray) -> np.ndarray:
    """Planes of whole numbers in two's complement; the last plane is the sign."""
    reach = max(int(gains.max(initial=0)), -int(gains.min(initial=0)) - 1, 0)
    return bit_planes(gains, reach.bit_length() + 1)


def weighted_sums(counts: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Sum of count times gain per row of ``counts``, from the gains' planes."""
    total = np.zeros(len(counts), np.int64)
    for j, plane in enumerate(bit_planes(counts, int(counts.max(initial=0)).bit_length())):
        for i, gain in enumerate(gains):
            both = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) << (i + j)
            total += -both if i == len(gains) - 1 else both
    return total


def bucket_counts(texts: DataFrame, text: str = "text", low: int = MIN_RUN, high: int = MAX_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``texts`` per bucket.  A task sends one row per bucket; one number per bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for one in text_bytes(batch.column(0)):
                total += features(one, low, high, buckets)[1]
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    parts = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / document share)) per bucket, with one more feature in each bucket than there are."""
    all_documents, all_target, n = int(documents.sum()), int(target.sum()), len(documents)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_documents + n) / ((s + 1) * (all_target + n))))
            for s, t in zip(documents.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weigh(
    documents: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
    low: int = MIN_RUN, high: int = MAX_RUN, buckets: int = BUCKETS, carry_text: bool = False,
) -> DataFrame:
    """``(row, n_words, n_features, weight)`` per row of ``documents``; ``row`` has all columns, the text if ``carry_text``.

    Features are runs of ``low`` to ``high`` words.  ``weight`` is the floored mean gain of a row's features.  Null and empty
    texts, or texts without words, have no features and weight 0.  Repeated rows count as often as they stand in the table.
    With an empty target every bucket is equally likely there.  An empty table gives none.
    """
    gains = bucket_gains(bucket_counts(documents, text, low, high, buckets), bucket_counts(target, target_text, low, high, buckets))
    planes = gain_planes(gains)
    kept = [c for c in documents.columns if carry_text or c != text]
    shaped = packed(documents.select(*[F.col(f"`{c}`") for c in kept]), t=F.col(f"`{text}`")) if carry_text else documents.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row") if kept else F.struct(F.lit(None).alias("none")).alias("row"),
        F.col(f"`{text}`").alias("t"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = text_bytes(batch.column(1))
            n_words, n_features, weights = (np.zeros(len(texts), np.int64) for _ in range(3))
            for start in range(0, len(texts), CHUNK):
                here = slice(start, start + CHUNK)
                seen = [features(one, low, high, buckets) for one in texts[here]]
                counts = np.stack([c for _, c in seen])
                n_words[here] = [n for n, _ in seen]
                n_features[here] = counts.sum(axis=1)
                weights[here] = weighted_sums(counts, planes) // np.maximum(n_features[here], 1)
            yield pa.record_batch([batch.column(0), *map(pa.array, (n_words, n_features, weights))], names=["row", "n_words", "n_features", "weight"])

    shape = adding(shaped.select("row").schema, "n_words bigint, n_features bigint, weight bigint")
    return shaped.mapInArrow(judge, shape)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from the first 32 bits of a SHA-256 of the seed and the key; a null key is empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0).cast("bigint")


def draw(
    weighed: DataFrame, key: str = "doc_id", least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """``weighed`` with ``score`` (weight plus noise by the key) and ``rank`` (1, 2, ... of the rows drawn, null for others).

    Of the N rows with at least ``least_words`` words the floor(percent N / 100) with the highest scores are drawn; ties go to
    the smaller key, null keys last.  Rows equal in score and key are drawn in no stated order.  An empty table gives none.
    """
    own = F.col(f"row.`{key}`")
    scored = checkpointed(weighed.withColumn("score", F.col("weight") + noise(own, seed)))
    able = F.col("n_words") >= least_words
    # Whole thousandths of a logarithm of ratios of counts, plus noise between -3,200 and 23,000: some 200,000 values.
    levels = sorted(scored.where(able).groupBy("score").agg(F.count("*").alias("n")).collect(), reverse=True)
    wanted = sum(n for _, n in levels) * percent // 100
    above, cut = 0, None
    for score, n in levels:
        if above >= wanted:
            break
        above, cut = above + n, score
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    top = able & (F.col("score") >= cut)
    one = F.monotonically_increasing_id()  # of rows read from a written table: the same whenever a task runs again
    ranked = in_order(scored.where(top).withColumn("one", one), F.desc("score"), own.asc_nulls_last(), F.col("one"))
    placed = ranked.select(*scored.columns, F.when(F.col("at") < wanted, F.col("at") + 1).alias("rank"))
    return scored.where(~top).withColumn("rank", F.lit(None).cast("bigint")).unionByName(placed)


def resample(documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """The rows of ``documents`` drawn towards ``target``, with all their columns; ``settings`` are those of ``draw``."""
    return draw(weigh(documents, target, text, carry_text=True), key, **settings).where("rank IS NOT NULL").select("row.*")
