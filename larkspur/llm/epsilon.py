"""Embedding near-dedup by an epsilon grid order join.

Vectors of unit length with cosine of at least ``c`` lie within eps = sqrt(2 - 2 c) of each other.  All vectors are turned
onto the principal axes of the whole table, given the grid cell of width eps they have on the leading axes, and sorted by
cell, axis after axis.  The sorted sequence is cut into blocks.  Pairs of blocks whose boxes on the leading axes are more than
eps apart are skipped; the others are joined by halving their sequence intervals and skipping distant halves until few
vectors are left, which are compared in double precision.

Equal vectors are compared once and counted as often as they occur.  A pair of blocks returns a number per vector and a
spanning forest of its links, never all links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import checkpointed
from larkspur.llm.graph import components, forest

COSINE = 0.95
AXES = 8  # leading principal axes of the grid
JOIN_AXES = 3  # axes whose cells blocks are joined on; unit vectors have some eight cells on each
BLOCK, LEAF = 4_096, 256  # vectors
LANES = 64  # partial sums that are added up together


def matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of equal length; shorter vectors are filled up with zeros."""
    lists = vectors.to_pylist()
    out = np.zeros((len(lists), dims))
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the first step keeps squares of very large or small numbers in range."""
    values = values / np.abs(values).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame, dims: int, axes: int) -> np.ndarray:
    """``[dims, axes]``: directions of largest variance of all unit vectors, from sums of one row per lane."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = unit(matrix(batch.column("vec"), dims))
            x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            total += x.T @ x
        yield pa.record_batch([pa.array([TaskContext.get().partitionId() % LANES], pa.int32()), pa.array([total.tobytes()])], ["lane", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, float) for s in table.column("sums").to_pylist())
        return pa.table({"lane": table.column("lane").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    shape = "lane int, sums binary"
    lanes = classes.select("vec").mapInArrow(partial, shape).groupBy("lane").applyInArrow(add, shape).collect()  # at most LANES
    total = sum(np.frombuffer(r["sums"], float) for r in lanes).reshape(dims + 1, dims + 1)
    mean = total[-1, :-1] / max(total[-1, -1], 1)
    spread = total[:-1, :-1] / max(total[-1, -1], 1) - np.outer(mean, mean)
    return np.linalg.eigh(spread)[1][:, ::-1][:, :axes]


def blocks(classes: DataFrame, axes: np.ndarray, eps: float, block: int) -> DataFrame:
    """``(blk, ids, ns, vecs, low, high)``: consecutive vectors in grid order, with their box on the axes."""
    dims, lead = axes.shape
    cells = [f"c{i}" for i in range(lead)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.floor(unit(matrix(batch.column("vec"), dims)) @ axes / eps).astype(np.int32)
            columns = [batch.column("id"), batch.column("n"), batch.column("vec"), *[pa.array(cell[:, i]) for i in range(lead)]]
            yield pa.record_batch(columns, ["id", "n", "vec", *cells])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def one() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            x = matrix(table.column("vec"), dims)
            at = unit(x) @ axes
            lists = [pa.array([v], pa.list_(pa.float64())) for v in (at.min(axis=0), at.max(axis=0))]
            binary = [pa.array([table.column("id").to_numpy().tobytes()]), pa.array([table.column("n").to_numpy().tobytes()]), pa.array([x.tobytes()])]
            return pa.record_batch([pa.array([number], pa.int64()), *binary, *lists], ["blk", "ids", "ns", "vecs", "low", "high"])

        rows = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - rows)
                held.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == block:
                    yield one()
                    number, held, rows = number + 1, [], 0
        if rows:
            yield one()

    kind = classes.schema["vec"].dataType.simpleString()
    placed = classes.select("id", "n", "vec").mapInArrow(place, f"id bigint, n bigint, vec {kind}, " + ", ".join(f"{c} int" for c in cells))
    placed = checkpointed(placed)
    order = [*cells, "id"]
    sorted_rows = placed.repartitionByRange(max(1, math.ceil(placed.count() / block)), *order).sortWithinPartitions(*order)
    shape = "blk bigint, ids binary, ns binary, vecs binary, low array<double>, high array<double>"
    return checkpointed(sorted_rows.select("id", "n", "vec").mapInArrow(cut, shape))


def near_blocks(cut: DataFrame, eps: float, axes: int) -> DataFrame:
    """``(a, b)``, a <= b: blocks whose boxes are within ``eps``, by a band join on cells of up to ``JOIN_AXES`` axes at once.

    A pair meets in every cell that the first box covers and the second, widened by one cell, covers as well; it counts in
    the first such cell only.
    """
    reach, used = eps * (1 + 1e-9), range(min(axes, JOIN_AXES))
    cell = lambda column, k: F.floor(F.col(column)[k] / eps)

    def spread(rows: DataFrame, wider: int, first: str) -> DataFrame:
        for k in used:
            rows = rows.withColumn(f"{first}{k}", cell("low", k) - wider)
            rows = rows.withColumn(f"cell{k}", F.explode(F.sequence(F.col(f"{first}{k}"), cell("high", k) + wider)))
        return rows

    left = spread(cut.select(F.col("blk").alias("a"), "low", "high"), 0, "afirst").withColumnsRenamed({"low": "alow", "high": "ahigh"})
    right = spread(cut.select(F.col("blk").alias("b"), "low", "high"), 1, "bfirst").withColumnsRenamed({"low": "blow", "high": "bhigh"})
    gap = F.zip_with(
        F.zip_with("alow", "bhigh", lambda x, y: x - y), F.zip_with("blow", "ahigh", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))
    )
    apart = F.aggregate(gap, F.lit(0.0), lambda total, g: total + g * g)
    near = left.join(right, [f"cell{k}" for k in used]).where((F.col("a") <= F.col("b")) & (apart <= reach * reach))
    for k in used:
        near = near.where(F.col(f"cell{k}") == F.greatest(f"afirst{k}", f"bfirst{k}"))
    return near.select("a", "b")


def _boxes(at: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Box of every interval that halving the sequence ``at`` gives."""
    out = {}

    def fill(lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        if hi - lo <= LEAF:
            box = at[lo:hi].min(axis=0), at[lo:hi].max(axis=0)
        else:
            mid = (lo + hi) // 2
            one, two = fill(lo, mid), fill(mid, hi)
            box = np.minimum(one[0], two[0]), np.maximum(one[1], two[1])
        out[lo, hi] = box
        return box

    fill(0, len(at))
    return out


def join_sequences(x: np.ndarray, y: np.ndarray, axes: np.ndarray, eps: float, cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two sequences of unit vectors in grid order, as index arrays; with ``same``, each pair once."""
    boxes_x, boxes_y = _boxes(x @ axes), _boxes(y @ axes)
    reach, open_pairs = eps * (1 + 1e-9), [(0, len(x), 0, len(y))]
    while open_pairs:
        a, b, c, d = open_pairs.pop()
        if same and c > a and b > d or same and d <= a:
            continue  # the mirror image of another pair of intervals
        (xl, xh), (yl, yh) = boxes_x[a, b], boxes_y[c, d]
        gap = np.maximum(0.0, np.maximum(xl - yh, yl - xh))
        if gap @ gap > reach * reach:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            near = x[a:b] @ y[c:d].T
            i, j = np.nonzero(near >= cosine - 1e-12)
            close = near[i, j] < cosine + 1e-12
            for k in np.flatnonzero(close):  # at the very threshold, sums without rounding decide
                p, q = x[a + i[k]], y[c + j[k]]
                close[k] = math.fsum(p * q) / math.sqrt(math.fsum(p * p) * math.fsum(q * q)) < cosine
            i, j = i[~close] + a, j[~close] + c
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
        elif b - a >= d - c:
            mid = (a + b) // 2
            open_pairs += [(a, mid, c, d), (mid, b, c, d)]
        else:
            mid = (c + d) // 2
            open_pairs += [(a, b, c, mid), (a, b, mid, d)]


def link_blocks(cut: DataFrame, axes: np.ndarray, eps: float, cosine: float) -> DataFrame:
    """``(a, b, n)``: per pair of near blocks, ``n`` linked vectors of class ``a`` (b null), and links (n null) of a forest."""
    dims = axes.shape[0]
    one = cut.select(F.col("blk").alias("a"), F.col("ids").alias("aids"), F.col("ns").alias("ans"), F.col("vecs").alias("avecs"))
    two = cut.select(F.col("blk").alias("b"), F.col("ids").alias("bids"), F.col("ns").alias("bns"), F.col("vecs").alias("bvecs"))
    paired = near_blocks(cut, eps, len(axes[0])).join(one, "a").join(two, "b")

    def run(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        same = row["a"] == row["b"]
        ids = [np.frombuffer(row[c], np.int64) for c in ("aids", "bids")]
        ns = [np.frombuffer(row[c], np.int64) for c in ("ans", "bns")]
        x, y = (unit(np.frombuffer(row[c], float).reshape(-1, dims)) for c in ("avecs", "bvecs"))
        shift = 0 if same else len(x)
        size = len(x) if same else len(x) + len(y)
        found, kept = np.zeros(size, np.int64), [np.zeros((2, 0), np.int64)]
        for i, j in join_sequences(x, y, axes, eps, cosine, same):
            np.add.at(found, i, ns[1][j])
            np.add.at(found, j + shift, ns[0][i])
            names, local = np.unique(np.concatenate([i, j + shift]), return_inverse=True)
            label = forest(len(names), local[: len(i)], local[len(i) :])
            moved = label != np.arange(len(names))
            kept.append(np.stack([names[moved], names[label[moved]]]))
        tree = np.concatenate(kept, axis=1)
        label = forest(size, tree[0], tree[1]) if tree.size else np.arange(size)
        moved, some = np.flatnonzero(label != np.arange(size)), np.flatnonzero(found)
        every = ids[0] if same else np.concatenate(ids)
        return pa.table({
            "a": pa.array(np.concatenate([every[some], every[moved]])),
            "b": pa.array([None] * len(some) + every[label[moved]].tolist(), pa.int64()),
            "n": pa.array(found[some].tolist() + [None] * len(moved), pa.int64()),
        })

    return paired.groupBy("a", "b").applyInArrow(run, "a bigint, b bigint, n bigint")


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, axes: int = AXES, block: int = BLOCK
) -> DataFrame:
    """``(id, n_links, component, kept)`` per vector: links at ``cosine`` or more, and the smallest id reachable by them.

    Cosines are in double precision.  Vectors that are null, zero, or hold a null or non-finite component link with nothing;
    so do rows without an id, which are kept and have no component.  Vectors of fewer dimensions are filled up with zeros.
    Rows repeated with the same id and vector count once and give one row.  An empty table gives an empty result.
    """
    source = vectors.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("vec")).distinct()
    sound = F.forall("vec", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))) & F.exists("vec", lambda c: c != 0)
    rows = checkpointed(source.withColumn("sound", F.coalesce(sound, F.lit(False)) & F.col("id").isNotNull()))
    classes = checkpointed(rows.where("sound").groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    dims = classes.agg(F.max(F.size("vec"))).first()[0]
    if dims is None:  # nothing that could link
        return rows.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"), F.lit(True).alias("kept"))

    eps = math.sqrt(2 - 2 * cosine)
    turned = principal_axes(classes, dims, min(axes, dims))
    linked = checkpointed(link_blocks(blocks(classes, turned, eps, block), turned, eps, cosine))
    counts = linked.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    roots = components(linked.where("b is not null").select("a", "b"))
    named = (
        classes.select("id", "n", "vec").join(counts, F.col("id") == F.col("a"), "left").join(roots, F.col("id") == F.col("node"), "left")
        .select("vec", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("component"))
    )
    judged = rows.join(named.withColumn("sound", F.lit(True)), ["vec", "sound"], "left")
    component = F.coalesce("component", "id")
    return judged.select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
