"""Mixing sources to target weights by Pfair scheduling of blocks.

Time is cut into slots of one block.  A source with ``p`` of ``A`` parts must have had ``p / A`` of all slots, to within one
block, at any time: its block ``k`` is released at slot ``floor(k A / p)`` and due by ``ceil((k + 1) A / p)``.  Each slot
goes to the released block with the earliest deadline.  After ``A`` slots every source has had exactly its parts, so the
schedule of one period serves blocks of any number: it is worked out once, over ``A`` slots, written, and joined.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import packed, written

BLOCK = 32  # documents
PARTS = 1_000  # slots of a period, at least
PARTS_PER_SOURCE = 100  # slots of a period per source, on average, at least
BUCKET_ROWS = 4_000  # documents of all sources per stretch of the shuffled order


def period(parts: Mapping[str, int]) -> Iterator[tuple[str, int, int]]:
    """``(source, k, slot)`` of one period: earliest deadline first among released blocks, ties by source.

    Holds one block per source, whatever the number of slots.
    """
    total = sum(parts.values())
    release = lambda s, k: k * total // parts[s]
    due = lambda s, k: -(-(k + 1) * total // parts[s])
    waiting = [(0, s, 0) for s in sorted(parts) if parts[s]]
    ready: list[tuple[int, str, int]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due(s, k), s, k))
        _, s, k = heapq.heappop(ready)
        yield s, k, slot
        heapq.heappush(waiting, (max(slot + 1, release(s, k + 1)), s, k + 1))


def tempered_parts(
    documents: DataFrame, source: str = "source", power: float = 0.7, least: int = PARTS, per_source: int = PARTS_PER_SOURCE
) -> DataFrame:
    """``(s, parts)``: target parts in proportion to each source's number of documents to ``power``; below 1 small sources gain.

    A period has about ``per_source`` parts per source, and ``least`` in all, so ratios hold whatever the number of sources.
    A source has one part at least, which together may add ``1 / per_source`` of the period.
    """
    counts = documents.groupBy(_name(source).alias("s")).agg(F.pow(F.count("*").cast("double"), power).alias("share"))
    counts = written(counts, "source-shares")  # a row per source
    whole = counts.agg(F.count("*").alias("n"), F.sum("share").alias("share")).first()
    total = max(least, per_source * whole["n"])
    parts = F.greatest(F.round(F.col("share") * F.lit(total / (whole["share"] or 1.0))), F.lit(1)).cast("bigint")
    return counts.select("s", parts.alias("parts"))


def schedule(parts: DataFrame) -> DataFrame:
    """``(s, k, first)``: the slot of every block of one period, as a written table.

    Which block is next depends on all slots before, so one task works the period out, holding one block per source.
    """

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            known |= dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        rows: list[tuple[str, int, int]] = []
        for row in period(known):
            rows.append(row)
            if len(rows) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["s", "k", "first"])
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["s", "k", "first"])

    return written(parts.select("s", "parts").repartition(1).mapInArrow(lay_out, "s string, k bigint, first bigint"), "mix-period")


def _name(source: str) -> Column:
    """Name of a source in the schedule: ``=`` and the value, or nothing for null."""
    value = F.col(f"`{source}`").cast("string")
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit("="), value))


def interleave(
    documents: DataFrame, parts: Mapping[str, int] | DataFrame, source: str = "source", block: int = BLOCK, seed: int = 0,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(row, block, slot, place)`` per document: its block within its source, the block's slot, its place in the block.

    ``parts`` gives sources (``=name``, ``""`` for null) their target parts, as a mapping or a table ``(s, parts)``; a source
    without parts is an error.  Within a source documents are shuffled by a hash of the row and ``seed``.  Every document has
    exactly one place: where a source has run out its later slots stay empty, and the others keep their order.  Up to any
    slot, a source that has not run out has had its share of slots to within less than one block.  Sort by (slot, place) to
    read the mix.

    Rows with a null source are a source of their own.  Repeated rows each get a place.  An empty table gives none.
    """
    if not isinstance(parts, DataFrame):
        parts = documents.sparkSession.createDataFrame(list(parts.items()), "s string, parts bigint")
    rows = packed(documents, s=_name(source)).withColumn("h", F.xxhash64(F.lit(seed), "row"))
    total = documents.count()
    bits = max(0, math.ceil(math.log2(max(1, total / bucket_rows))))
    bucket = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("bigint")
    rows = rows.withColumn("bucket", bucket)

    counts = rows.groupBy("s", "bucket").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    starts = counts.select("s", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    starts = starts.join(parts.select("s", F.col("parts").alias("of")), "s", "left")
    starts = starts.withColumn("of", F.coalesce("of", F.raise_error(F.concat(F.lit("no parts for source "), "s")).cast("bigint")))
    inside = Window.partitionBy("s", "bucket").orderBy("h", F.hash("row"))
    numbered = rows.withColumn("i", F.row_number().over(inside) - 1).join(starts, ["s", "bucket"])

    length = parts.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    placed = numbered.withColumn("block", F.floor((F.col("start") + F.col("i")) / block))
    placed = placed.withColumn("k", F.col("block") % F.col("of")).join(schedule(parts), ["s", "k"], "left")
    slot = F.floor(F.col("block") / F.col("of")) * length + F.col("first")
    return placed.select("row", "block", slot.alias("slot"), ((F.col("start") + F.col("i")) % block).cast("int").alias("place"))


def mixed_order(documents: DataFrame, source: str = "source", power: float = 0.7, block: int = BLOCK) -> DataFrame:
    """``documents`` with all columns, every row once, written in the order of the mix to tempered weights."""
    placed = interleave(documents, tempered_parts(documents, source, power), source, block)
    ranged = placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return ranged.select("row.*")
