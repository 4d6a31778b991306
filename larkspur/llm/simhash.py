"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked when at most two bits differ.

Fingerprints are cut into four blocks of 16 bits.  Two of them that differ in at most two bits agree in at least two
blocks, so each is filed under the six pairs of blocks; candidates share a file and are then verified by Hamming
distance.  Only distinct fingerprints are compared: exact and equal copies weigh one row, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import adding, checkpointed, packed, small, text_bytes
from larkspur.llm.graph import components, forest

SHINGLE, SEED, DISTANCE = 3, 42, 2
PAIR_ROWS = 32  # files of at most so many fingerprints are compared by a join, which then gives at most 496 links each
FILE_ROWS = 2_048  # larger files are compared in one call and give a forest; still larger ones are filed by finer blocks
UPPER_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """One hash per shingle of one UTF-8 text, repeats included; a text of fewer words is one shingle, one of none has none."""
    words = text.translate(UPPER_TO_LOWER).split()
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return np.array([digest(b" ".join(words), seed)] if words else [], np.uint64)
    return np.array([digest(s, seed) for s in map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if more than half of ``hashes`` have it."""
    n, counts = len(hashes), np.zeros((8, 8), np.int64)
    full = n // 255 * 255
    for bit in range(8):  # eight byte-wide counters per word; 255 additions cannot overflow one
        lanes = (hashes >> np.uint64(bit)) & _LANES
        sums = np.append(lanes[:full].reshape(-1, 255).sum(axis=1, dtype=np.uint64), lanes[full:].sum(dtype=np.uint64))
        counts[bit] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    out = 0
    for bit, byte in np.argwhere(2 * counts > n):
        out |= 1 << int(8 * byte + bit)
    return out


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one UTF-8 text: a bit is set if more than half of the shingle hashes have it."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(documents: DataFrame, text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(row, fp)``: each row as a struct and its fingerprint as a signed 64-bit integer.  Null text is empty."""
    rows = packed(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            row = batch.column(0)
            found = [fingerprint(t, shingle, seed) for t in text_bytes(row.field(text))]
            yield pa.record_batch([row, pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())], ["row", "fp"])

    return rows.mapInArrow(run, adding(rows.schema, "fp bigint"))


def _filed(fps: DataFrame, blocks: list[tuple[int, int]], agree: int, file: list[str]) -> DataFrame:
    """Each fingerprint under every choice of ``agree`` blocks; a block is (lowest bit, width)."""
    entries = []
    for number, chosen in enumerate(combinations(blocks, agree)):
        mask = sum(((1 << width) - 1) << low for low, width in chosen)
        mask -= (mask >> 63) << 64  # as a signed integer
        entries.append(F.struct(F.lit(number).alias("k"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    spread = fps.select(*file, "fp", F.explode(F.array(*entries)).alias("e"))
    return spread.select(*file, "fp", F.col("e.k").alias(f"k{len(file) // 2}"), F.col("e.bits").alias(f"bits{len(file) // 2}"))


def _links_in_files(filed: DataFrame, file: list[str], distance: int) -> DataFrame:
    """Verified links inside each file: every fingerprint to the smallest one it is connected to within the file."""

    def run(table: pa.Table) -> pa.Table:
        fp = np.unique(table.column("fp").to_numpy().astype(np.int64))
        bits = fp.view(np.uint64)
        a, b = [], []
        for low in range(0, len(bits), 512):
            far = np.bitwise_count(bits[low : low + 512, None] ^ bits[None, :])
            i, j = np.nonzero(far <= distance)
            a.append(i[i + low < j] + low)
            b.append(j[i + low < j])
        label = forest(len(fp), np.concatenate(a), np.concatenate(b))
        moved = label != np.arange(len(fp))
        return pa.table({"a": fp[moved], "b": fp[label[moved]]})

    return filed.groupBy(*file).applyInArrow(run, "a bigint, b bigint")


def links(fps: DataFrame, distance: int = DISTANCE, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the distinct ``fps(fp)`` within ``distance`` (at most 2) bits of each other.

    Files of more than ``file_rows`` fingerprints agree in 32 bits already; they are filed again by two of the four
    blocks of 8 among the other 32 bits.  What is left free then is 16 bits, so such a file cannot outgrow 65,536 rows.
    """
    blocks = [(0, 16), (16, 16), (32, 16), (48, 16)]
    file = ["k0", "bits0"]
    filed = _filed(fps, blocks, 2, [])
    sizes = filed.groupBy(*file).agg(F.count("*").alias("n")).where("n > 1")
    filed = checkpointed(filed.join(sizes, file))
    few = filed.where(F.col("n") <= PAIR_ROWS).drop("n")
    other = few.select(*file, F.col("fp").alias("other"))
    close = (F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)
    out = few.join(other, file).where(close).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    out = out.union(_links_in_files(filed.where((F.col("n") > PAIR_ROWS) & (F.col("n") <= file_rows)), file, distance))
    large = filed.where(F.col("n") > file_rows)
    for number, chosen in enumerate(combinations(blocks, 2)):
        rest = [(low + half, 8) for low, _ in blocks if (low, 16) not in chosen for half in (0, 8)]
        finer = _filed(large.where(F.col("k0") == number), rest, 2, file)
        out = out.union(_links_in_files(finer, [*file, "k1", "bits1"], distance))
    return out


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE
) -> DataFrame:
    """``(key, h1, h2, fp, component)`` per row: fingerprint and the smallest ``key`` reachable over links.

    Rows of equal text share a fingerprint and so a component; null and empty texts have fingerprint zero, linked like
    any other.  Null keys are ignored when the smallest is taken; a component of null keys only has a null one.  Repeated
    rows stay repeated, extra columns are not read, an empty table gives an empty result.  ``h1, h2`` hash key and text
    to 96 bits: they name a row even where keys are null or repeated.
    """
    needed = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    found = fingerprints(needed.select("key", "text", *_name("key", "text")), "text", shingle, seed)
    return with_components(checkpointed(found.select("row.key", "row.h1", "row.h2", "fp")), distance)


def _name(key: str, text: str) -> list[Column]:
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    return [F.xxhash64(k, t).alias("h1"), F.hash(t, k).alias("h2")]


def with_components(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``rows(key, h1, h2, fp)`` with ``component``."""
    least = rows.groupBy("fp").agg(F.min("key").alias("least"))
    roots = components(links(least.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    classes = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    firsts = classes.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(classes.join(firsts, "root").select("fp", "root", "component"), "fp")


def keep_first(documents: DataFrame, key: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """One row of each component, all columns unchanged: the one with the smallest key, null keys last.

    Rows that repeat both key and text count as one.  ``settings`` are those of ``near_duplicates``.
    """
    found = near_duplicates(documents, key, text, **settings)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("key").isNull(), "key", "h1", "h2")).alias("f"))
    kept = packed(documents, **dict(zip(("h1", "h2"), _name(key, text), strict=True))).join(
        first.select("f.h1", "f.h2"), ["h1", "h2"], "left_semi"
    )
    return kept.dropDuplicates(["h1", "h2"]).select("row.*")
