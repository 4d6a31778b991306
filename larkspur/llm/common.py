"""What several operators share: cutting lineage, dealing documents into groups of bounded size, text buffers."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

GROUP_BYTES = 8_000_000  # text that one Python call holds at a time
BATCH_ROWS = 500  # rows whose Python objects a task holds at a time; Arrow batches may be larger
EXACT = float(1 << 52)  # whole numbers below it are exact in double precision
FAR = (1 << 63) - 1  # stands for scores beyond 64 bits
PIECE_BYTES = 500_000  # text that one vectorised step handles; a longer text is a piece of its own


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local master may leave it unset (tests) and gets a folder of its own; on a cluster others could not read that.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoints-"))
        folder = spark.sparkContext.getCheckpointDir()
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared checkpoint folder: a lost executor costs a re-read, and lineage ends here."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a Parquet table in the shared folder: lineage ends, and Spark knows the size and reads only what it needs."""
    path = f"{shared_folder(rows.sparkSession)}/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def packed(rows: DataFrame, **extra: Column) -> DataFrame:
    """The whole row as one struct column ``row`` beside the ``extra`` columns, so that no name can clash."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[v.alias(k) for k, v in extra.items()])


def adding(schema: StructType, columns: str) -> StructType:
    """``schema`` and further columns, given as in DDL."""
    return StructType(schema.fields + StructType.fromDDL(columns).fields)


def group_total(rows: DataFrame, text: str, group_bytes: int = GROUP_BYTES) -> int:
    """How many groups to deal ``rows`` into.

    About ``group_bytes`` of text each; for very large inputs fewer and larger groups, so that what every group sends to
    every other stays some 64 items of 6 bytes of text.
    """
    total = rows.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    return max(1, min(math.ceil(total / group_bytes), math.isqrt(int(total) // 384) + 1))


def group_of(key: str, text: str, groups: int) -> Column:
    """Group of a row by its id and text, so that an id shared by many rows is spread over all groups."""
    return F.pmod(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")), F.lit(groups)).cast("int")


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``BATCH_ROWS``, without copying them."""
    for batch in batches:
        for low in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(low, BATCH_ROWS)


def decoded(column: pa.Array | pa.ChunkedArray) -> list[str | None]:
    """Python strings of a string column; bytes that are no UTF-8 become replacement characters."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about ``size`` bytes each."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def finite_vector(x: Column) -> Column:
    """Whether an array of doubles has neither null nor non-finite components; false for null."""
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return F.coalesce(fine, F.lit(False))


def whole_numbers(vector: np.ndarray, scale: float) -> list[int]:
    """floor(scale * component), exactly, whatever the size of the components; ``scale`` is a power of two."""
    return [math.floor(scale * c) if abs(c) < 1e300 else int(c) * int(scale) for c in vector.tolist()]


def whole_products(rows: np.ndarray, query: np.ndarray, scale: float) -> np.ndarray:
    """Inner products of the whole numbers of ``rows`` and ``query``: in doubles where no sum can leave them, else unbounded."""
    if rows.size == 0 or np.abs(rows).max() < 1e100 and np.abs(query).max() < 1e100:
        near, far = np.floor(rows * scale), np.floor(query * scale)
        if np.abs(near).max(initial=0) * np.abs(far).sum() < EXACT:
            return (near @ far).astype(np.int64)
    asked = whole_numbers(query, scale)
    return np.array([sum(a * b for a, b in zip(whole_numbers(r, scale), asked, strict=True)) for r in rows] or [0], object)[: len(rows)]


def within_64_bits(score: Column) -> Column:
    """``score``, an error where it stands for one beyond 64 bits; far below zero it may, since no answer needs its value."""
    return F.when(score < F.lit(FAR), score).otherwise(F.raise_error("a score leaves 64 bits").cast("bigint"))


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def codepoints(text: str) -> np.ndarray:
    """Unicode code points as unsigned 32-bit integers."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def in_order(rows: DataFrame, *keys: Column, name: str = "at") -> DataFrame:
    """``rows`` with their place (0, 1, ...) in the order of ``keys``.

    Rows are dealt by ranges of the keys, sorted, and written; a running sum over the sizes of the written parts gives each
    part its first number.  A key that many rows share is split if a later key tells them apart.
    """
    part, inside = f"{name}_part", f"{name}_inside"
    written = checkpointed(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    numbered = written.withColumns({part: F.spark_partition_id(), inside: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = numbered.groupBy(part).agg(F.count("*").alias("n"))
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per written part
    starts = sizes.select(part, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    placed = numbered.join(F.broadcast(starts), part)  # a row per written part
    return placed.select(*written.columns, (F.col("first") + F.col(inside)).alias(name))
