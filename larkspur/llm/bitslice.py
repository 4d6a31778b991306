"""Exact top-k search by inner product over a bit-sliced index.

Vectors are quantised to whole numbers.  The index holds, for a block of vectors and every dimension, one bitmap per binary
digit (two's complement): bit ``r`` of slice ``b`` is digit ``b`` of row ``r``.  For a query, the slices of each dimension are
added once per digit of the query's component in its sparsest signed form, shifted by that digit's place, in carry-save form:
a few bitmap operations per addend whatever the number of rows.  The sum's slices are then walked from the most significant
one downward, keeping the set surely among the k best and the set still tied at the boundary; rows tied to the end are
resolved by id, and the scores of the winners are computed exactly.

Blocks of rows meet blocks of queries; no row ever meets a query outside such a pair of blocks.  A block has as many slices as
its largest component needs, and vectors of like size share blocks, so a few large vectors do not widen the others' index.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import FAR, checkpointed, finite_vector, whole_numbers, whole_products, within_64_bits

SCALE, TOP = 256.0, 5
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 1_024
SIZE_STEP = 16  # binary digits of the largest component by which vectors share blocks
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, x)`` of the vectors that take part, one row per id and vector."""
    x = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.where(finite_vector(x) & F.col(f"`{key}`").isNotNull())
    return rows.select(F.col(f"`{key}`").cast("bigint").alias("id"), x.alias("x")).distinct()


def size_class(x: Column) -> Column:
    """Binary digits of the largest component, in steps; 0 for all below one step."""
    largest = F.array_max(F.transform(x, F.abs))
    return F.when(F.coalesce(largest, F.lit(0.0)) < 1, 0).otherwise(F.floor(F.log2(largest) / SIZE_STEP)).cast("int")


def quantised(raw: np.ndarray, scale: float) -> np.ndarray:
    """Whole numbers floor(scale * component), unbounded where 64 bits do not hold them."""
    if raw.size == 0 or np.abs(raw).max() < 2.0**61 / scale:
        return np.floor(raw * scale).astype(np.int64)
    return np.array([whole_numbers(r, scale) for r in raw], object)


def build_slices(values: np.ndarray) -> np.ndarray:
    """``[dimension, digit, word]`` bitmaps of whole numbers ``[row, dimension]``; the last digit is the sign."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    digits = max(-low - 1, high, 0).bit_length() + 1
    words = max(1, -(-len(values) // 64))
    bits = np.zeros((values.shape[1], digits, words * 64), np.uint8)
    for b in range(digits):
        bits[:, b, : len(values)] = ((values >> b) & 1).T
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64)


def signed_digits(value: int) -> list[tuple[int, int]]:
    """``value`` as a sum of sign * 2^place with no two neighbouring places."""
    out, place = [], 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            out.append((place, sign))
            value -= sign
        value >>= 1
        place += 1
    return out


def scores(slices: np.ndarray, query: list[int], width: int) -> np.ndarray:
    """``[digit, word]`` slices of every row's inner product with ``query``, in two's complement of ``width`` digits."""
    _, digits, words = slices.shape
    total = np.zeros((width, words), np.uint64)
    carry = np.zeros((width, words), np.uint64)
    addend, half = np.empty((width, words), np.uint64), np.empty((width, words), np.uint64)
    fix = 0  # each subtraction adds the complement and owes one unit in its place
    for d, component in enumerate(query):
        for place, sign in signed_digits(component):
            addend[:place] = 0
            addend[place : place + digits] = slices[d][: width - place]
            addend[place + digits :] = slices[d, -1]
            if sign < 0:
                np.bitwise_not(addend, out=addend)
                fix += 1
            np.bitwise_xor(total, carry, out=half)
            np.bitwise_and(total, carry, out=carry)
            np.bitwise_xor(half, addend, out=total)
            np.bitwise_and(half, addend, out=half)
            np.bitwise_or(carry, half, out=carry)
            carry[1:] = carry[:-1].copy()
            carry[0] = 0
    constant = np.zeros((width, words), np.uint64)
    for b in range(width):
        if fix >> b & 1:
            constant[b] = _FULL
    half = total ^ carry
    carry, total = ((total & carry) | (half & constant)), half ^ constant
    carry[1:] = carry[:-1].copy()
    carry[0] = 0
    ripple = np.zeros(words, np.uint64)
    for b in range(width):
        both = total[b] ^ carry[b]
        ripple, total[b] = (total[b] & carry[b]) | (both & ripple), both ^ ripple
    return total


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(total: np.ndarray, eligible: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows surely among the ``k`` largest, and rows tied for the places that are left."""
    sure, tied = np.zeros_like(eligible), eligible
    for b in range(len(total) - 1, -1, -1):
        digit = ~total[b] if b == len(total) - 1 else total[b]  # a set sign is smaller
        more = sure | (tied & digit)
        n = _count(more)
        if n > k:
            tied = tied & digit
        elif n == k:
            return _rows(more), np.zeros(0, np.int64)
        else:
            sure, tied = more, tied & ~digit
    return _rows(sure), _rows(tied)


def search_block(
    ids: np.ndarray, raw: np.ndarray, slices: np.ndarray, query_id: int, query: np.ndarray, k: int, scale: float
) -> list[tuple[int, int]]:
    """The ``k`` best ``(id, score)`` of one block for one query: largest score, then smallest id; never the query's own id."""
    asked = whole_numbers(query, scale)
    width = (sum(map(abs, asked)) << (slices.shape[1] - 1)).bit_length() + 2
    total = scores(slices, asked, width)
    allowed = np.zeros(slices.shape[2] * 64, np.uint8)
    allowed[: len(ids)] = ids != query_id
    sure, tied = top_rows(total, np.packbits(allowed, bitorder="little").view(np.uint64), k)
    tied = tied[np.argsort(ids[tied], kind="stable")][: k - len(sure)]
    chosen = np.concatenate([sure, tied])
    exact = whole_products(raw[chosen], query, scale)
    return sorted(zip(ids[chosen].tolist(), exact.tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def search(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = TOP, scale: float = SCALE
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` rows of ``vectors`` with the highest integer inner product per query.

    Components are floor(scale * component), ``scale`` a power of two.  Ties go to the smaller id; a query's own id is no
    candidate; with fewer candidates all are returned.  Vectors that are null or hold a null or non-finite component, and
    rows without an id, take no part, as row or as query; every finite vector does.  Rows equal in id and vector count once.
    Vectors of fewer dimensions are filled up with zeros.  A score in the result that leaves 64 bits is an error.  Empty
    tables give an empty result.
    """
    spark = vectors.sparkSession
    rows = checkpointed(usable(vectors, key, vector).withColumn("size", size_class(F.col("x"))))
    asked = checkpointed(usable(queries, key, vector))
    sizes = rows.groupBy("size").agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).collect()  # at most 65 rows
    most = asked.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    if not sizes or not most["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    n_asked = math.ceil(most["n"] / BLOCK_QUERIES)
    dims = max(most["d"], 1, *[s["d"] for s in sizes])

    def matrix(x: pa.ChunkedArray) -> np.ndarray:
        lists = x.to_pylist()
        out = np.zeros((len(lists), dims))
        for i, v in enumerate(lists):
            out[i, : len(v)] = v
        return out

    def index(table: pa.Table) -> pa.Table:
        """A block of rows as one record: ids, vectors and slices."""
        ids, raw = table.column("id").to_numpy(), matrix(table.column("x"))
        order = np.argsort(ids, kind="stable")
        ids, raw = ids[order], raw[order]
        slices = build_slices(quantised(raw, scale))
        return pa.table({
            "block": table.column("block").slice(0, 1), "ids": pa.array([ids.tobytes()], pa.binary()),
            "raw": pa.array([raw.tobytes()], pa.binary()), "digits": pa.array([slices.shape[1]], pa.int32()),
            "slices": pa.array([slices.tobytes()], pa.binary()),
        })

    def spread(count: int | Column) -> Column:
        return F.pmod(F.xxhash64("id", "x"), F.lit(count) if isinstance(count, int) else count).cast("int")

    block, n_rows = F.lit(0), 0
    for s in sizes:
        count = math.ceil(s["n"] / BLOCK_ROWS)
        block = F.when(F.col("size") == s["size"], n_rows + spread(count)).otherwise(block)
        n_rows += count

    shape = "block int, ids binary, raw binary, digits int, slices binary"
    indexed = checkpointed(rows.withColumn("block", block).groupBy("block").applyInArrow(index, shape))
    pairs = indexed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    sent = asked.withColumn("part", spread(n_asked)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows:
            ids = np.frombuffer(left.column("ids")[0].as_py(), np.int64)
            raw = np.frombuffer(left.column("raw")[0].as_py(), np.float64).reshape(len(ids), dims)
            slices = np.frombuffer(left.column("slices")[0].as_py(), np.uint64).reshape(dims, left.column("digits")[0].as_py(), -1)
            for query_id, query in zip(right.column("id").to_pylist(), matrix(right.column("x")), strict=True):
                found = search_block(ids, raw, slices, query_id, query, k, scale)
                out += [(query_id, i, max(-FAR, min(FAR, s))) for i, s in found]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "id", "score"])

    found = pairs.groupBy("block", "part").cogroup(sent.groupBy("block", "part")).applyInArrow(run, "query_id bigint, id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    kept = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    score = F.when(F.col("score") > -FAR, within_64_bits(F.col("score"))).otherwise(F.raise_error("a score leaves 64 bits").cast("bigint"))
    return kept.select("query_id", "rank", "id", score.alias("score"))
