"""Hard negatives of anchor vectors, found through angles to reference directions.

Vectors are quantised to whole numbers, and scores are whole inner products.  Every vector's cosine and sine of the angle to a
few reference directions, and its norm, are stored once.  By the triangle inequality the angle between an anchor and a row
lies between the difference and the sum of their angles to a reference; over all references that gives an interval for the
cosine, and times the norms one for the score, widened so that rounding cannot lose a row.  Only rows whose interval reaches
the window of scores asked for are scored in whole numbers.

Two passes: first the positives of each anchor, the best rows of its label; then, with their scores as windows, the
negatives.  Blocks of rows meet blocks of anchors, and the best of each block are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import EXACT, FAR, checkpointed, finite_vector, whole_products, within_64_bits

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score between which a negative's lies
REFERENCES = 8
SAMPLE_ROWS = 1_024  # rows with the smallest hashes, from which reference directions are taken
BLOCK_ROWS, BLOCK_ANCHORS = 8_192, 1_024
SLACK = 1e-6  # of the product of two norms; cosines and sines are off by less than 1e-7


def reference_directions(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Up to ``count`` unit vectors of the sample, each the farthest from those before it, starting at the mean's direction."""
    units = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    units = units[np.abs(units).sum(axis=1) > 0]
    if not len(units):
        return np.eye(max(sample.shape[1], 1))[:1]
    chosen = [int(np.argmax(units @ units.mean(axis=0)))]
    nearest = units @ units[chosen[0]]
    while len(chosen) < min(count, len(units)) and nearest.min() < 1 - 1e-9:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def angles(raw: np.ndarray, scale: float, references: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Norms, and cosines and sines of the angles to each reference, of the quantised rows of ``raw``."""
    with np.errstate(over="ignore"):
        whole = np.floor(raw * scale)
        beyond = ~np.isfinite(whole).all(axis=1, keepdims=True)  # so large that rounding down changes no angle
        whole = np.where(beyond, raw, whole)
        largest = np.maximum(np.abs(whole).max(axis=1, initial=0.0), 1.0)
        shrunk = whole / largest[:, None]  # squares of large numbers would leave double precision
        length = np.linalg.norm(shrunk, axis=1)
        cosine = np.clip(shrunk @ references.T / np.maximum(length, 1e-300)[:, None], -1, 1)
        return length * largest * np.where(beyond[:, 0], scale, 1.0), cosine, np.sqrt(1 - cosine * cosine)


def score_bounds(
    norm: float, cosine: np.ndarray, sine: np.ndarray, norms: np.ndarray, cosines: np.ndarray, sines: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that one vector can have with each of the others: cos(a + b) and cos(a - b) times the norms.

    Where a product of norms leaves double precision the bounds are infinite.
    """
    straight, across = cosines * cosine, sines * sine
    with np.errstate(over="ignore", invalid="ignore"):
        reach = norms * norm
        pad = reach * SLACK + 1
        low, high = reach * (straight - across).max(axis=1) - pad, reach * (straight + across).min(axis=1) + pad
    return np.where(np.isfinite(pad), low, -np.inf), np.where(np.isfinite(pad), high, np.inf)


class Block:
    """Rows of one block with their stored angles."""

    def __init__(self, record: dict, dims: int, references: np.ndarray) -> None:
        self.ids = np.array(record["ids"], np.int64)
        n = len(self.ids)
        self.raw = np.frombuffer(record["x"], np.float64).reshape(n, dims)
        # Worked out once for all anchors that meet the block: labels as numbers, vectors rounded down, their largest component.
        self.codes = {label: code for code, label in enumerate(dict.fromkeys(record["labels"]))}
        self.coded = np.array([self.codes[label] for label in record["labels"]], np.int64)
        with np.errstate(over="ignore"):
            self.whole = np.floor(self.raw * SCALE)
        self.peak = float(np.abs(self.raw).max(initial=0.0))
        self.reach = float(np.abs(self.whole).max(initial=0.0))
        table = lambda name, width: np.frombuffer(record[name], np.float64).reshape(n, width)
        self.norms, self.cosines, self.sines = table("norms", 1)[:, 0], table("cosines", len(references)), table("sines", len(references))

    def bounds(self, norm: float, cosine: np.ndarray, sine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(norm, cosine, sine, self.norms, self.cosines, self.sines)

    def scores(self, rows: np.ndarray, query: np.ndarray, scale: float) -> np.ndarray:
        """Whole inner products of some rows with a vector: in doubles where no sum can leave them, else in unbounded integers."""
        if scale == SCALE and self.peak < 1e100 and np.abs(query).max(initial=0.0) < 1e100:
            far = np.floor(query * scale)
            if self.reach * np.abs(far).sum() < EXACT:  # whole numbers, exact in any order
                return ((self.whole @ far)[rows] if 2 * len(rows) > len(self.whole) else self.whole[rows] @ far).astype(np.int64)
        return whole_products(self.raw[rows], query, scale)

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` highest ``(id, score)``, ties to the smaller id."""
        if len(rows) > 4 * k:
            floor = np.partition(scores, -k)[-k]
            rows, scores = rows[scores >= floor], scores[scores >= floor]
        order = sorted(zip(self.ids[rows].tolist(), scores.tolist(), strict=True), key=lambda x: (-x[1], x[0]))[:k]
        return [(i, max(-FAR, min(FAR, s))) for i, s in order]

    def positives(self, anchor: dict, query: np.ndarray, sight: tuple, k: int, scale: float) -> list[tuple[int, int]]:
        """The best ``k`` other rows of the anchor's label.  A row whose upper bound is under the ``k``-th lower bound is none."""
        mine = np.flatnonzero((self.coded == self.codes.get(anchor["label"], -1)) & (self.ids != anchor["id"]))
        if not len(mine):
            return []
        low, high = self.bounds(*sight)
        if len(mine) > k:
            mine = mine[high[mine] >= np.partition(low[mine], -k)[-k]]
        return self.best(mine, self.scores(mine, query, scale), k)

    def negatives(self, anchor: dict, query: np.ndarray, sight: tuple, k: int, scale: float, low: int, high: int) -> list[tuple[int, int, int]]:
        """``(place of the positive, id, score)``: per positive the best ``k`` rows of other labels in its window."""
        windows = [(-(-low * s // 100), high * s // 100) for s in map(int, anchor["scores"])]
        least, most = self.bounds(*sight)
        apart = self.coded != self.codes.get(anchor["label"], -1)
        out = []
        wanted = np.zeros(len(self.ids), bool)
        for a, b in windows:
            wanted |= apart & (most >= a) & (least <= b)
        rows = np.flatnonzero(wanted)
        scores = self.scores(rows, query, scale)
        for place, (a, b) in enumerate(windows):
            inside = (scores >= a) & (scores <= b)
            out += [(place, i, s) for i, s in self.best(rows[inside], scores[inside], k)]
        return out


def mine(
    vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: float = SCALE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` says which rows of ``vectors`` are anchors.  Components are floor(scale * component); scores are whole inner
    products.  An anchor's positives are its ``positives`` best other rows of the same label.  For each, the best ``negatives``
    rows of other labels whose score lies between ``low`` and ``high`` percent of the positive's are its negatives; a positive
    without any has no rows, one with a negative score has none.  Ties go to the smaller id.

    Rows without id, label or vector, or with a null or non-finite component, take no part.  Rows equal in id, label and vector
    count once; rows that share an id but differ are rows of their own, and none is a partner of its own id.  Shorter vectors
    are filled up with zeros.  Every finite vector takes part; a positive whose score leaves 64 bits is an error.  Empty tables
    give none.
    """
    spark = vectors.sparkSession
    x = F.col(f"`{vector}`").cast("array<double>")
    of = (F.col(f"`{label}`") if isinstance(label, str) else label).cast("string")
    own = F.col(f"`{key}`").cast("bigint")
    usable = own.isNotNull() & of.isNotNull() & finite_vector(x)
    rows = vectors.where(usable).select(own.alias("id"), of.alias("label"), x.alias("x"), anchors.alias("anchor"))
    rows = rows.groupBy("id", "label", "x").agg(F.max("anchor").alias("anchor"))  # equal rows once
    rows = checkpointed(rows.withColumn("uid", F.xxhash64("id", "label", "x")))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d"), F.count_if("anchor").alias("a")).first()
    shape = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not size["a"]:
        return spark.createDataFrame([], shape)
    dims, n_rows, n_anchors = max(size["d"], 1), math.ceil(size["n"] / BLOCK_ROWS), math.ceil(size["a"] / BLOCK_ANCHORS)

    def matrix(lists: list) -> np.ndarray:
        out = np.zeros((len(lists), dims))
        for i, v in enumerate(lists):
            out[i, : len(v)] = v
        return out

    sample = rows.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE_ROWS).select("x").collect()  # a bounded number of rows
    shrunk = matrix([r["x"] for r in sample])
    references = reference_directions(shrunk / np.maximum(np.abs(shrunk).max(axis=1, keepdims=True), 1e-300))

    def index(table: pa.Table) -> pa.Table:
        """A block as one record: ids, labels, vectors, norms and angles."""
        raw = matrix(table.column("x").to_pylist())
        stored = {"x": raw, **dict(zip(("norms", "cosines", "sines"), angles(raw, scale, references), strict=True))}
        return pa.table({
            "block": table.column("block").slice(0, 1), "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())),
            "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.string())),
            **{name: pa.array([np.ascontiguousarray(v, np.float64).tobytes()], pa.binary()) for name, v in stored.items()},
        })

    block = lambda n: F.pmod(F.xxhash64(F.lit(1), "uid"), F.lit(n)).cast("int")
    stored = "block int, ids array<bigint>, labels array<string>, x binary, norms binary, cosines binary, sines binary"
    indexed = checkpointed(rows.withColumn("block", block(n_rows)).groupBy("block").applyInArrow(index, stored))
    parts = indexed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))

    def meet(asked: DataFrame, find, columns: list[str]) -> DataFrame:
        """``find(block, anchor, query, sight)`` for every block and anchor: tuples of whole numbers after the anchor's id."""
        sent = asked.withColumn("part", block(n_anchors)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if left.num_rows and right.num_rows:
                here = Block(left.to_pylist()[0], dims, references)
                people = right.to_pylist()
                raw = matrix([a["x"] for a in people])
                sights = list(zip(*angles(raw, scale, references), strict=True))
                for anchor, query, sight in zip(people, raw, sights, strict=True):
                    out += [(anchor["uid"], anchor["id"], *found) for found in find(here, anchor, query, sight)]
            names = ["uid", "anchor_id", *columns]
            return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * len(names))], names=names)

        kinds = ", ".join(f"{c} bigint" for c in ["uid", "anchor_id", *columns])
        return parts.groupBy("block", "part").cogroup(sent.groupBy("block", "part")).applyInArrow(run, kinds)

    people = rows.where("anchor").select("uid", "id", "label", "x")
    found = meet(people, lambda b, a, q, sight: b.positives(a, q, sight, positives, scale), ["id", "score"])
    place = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), "id"))
    chosen = found.withColumn("place", place).where(F.col("place") <= positives).withColumn("score", within_64_bits(F.col("score")))
    chosen = chosen.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("chosen"))  # few per anchor
    chosen = checkpointed(people.join(chosen, "uid").select("uid", people["id"], "label", "x", F.col("chosen.score").alias("scores"), F.col("chosen.id").alias("partners")))
    found = meet(chosen, lambda b, a, q, sight: b.negatives(a, q, sight, negatives, scale, low, high), ["place", "id", "score"])
    rank = F.row_number().over(Window.partitionBy("uid", "place").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    told = best.join(chosen.select("uid", "partners", "scores"), "uid")
    at = F.col("place").cast("int")
    return told.select(
        "anchor_id", F.get("partners", at).alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.get("scores", at).alias("positive_score"), F.col("score").alias("negative_score"),
    )
