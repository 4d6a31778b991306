"""Encoding of feature tables as vectors, weights for unbalanced classes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.scale import attach_small, keep

_INDEX, _VECTOR = "__index", "__levels"  # ends of the names of columns between two stages


def _dummy_name(column: str, level: str) -> str:
    return f"{column}_{level}"


@dataclass(frozen=True)
class Encoder:
    """0/1 columns for each category level but the alphabetically first; fixed when fitted.

    A level not seen at fitting, like a missing value, becomes all zeros.
    """

    levels: dict[str, tuple[str, ...]]

    @classmethod
    def fit(cls, rows: DataFrame, columns: list[str]) -> Encoder:
        """Levels are part of the model, and so come to the driver: one short text per level."""
        if not columns:
            return cls({})
        pairs = rows.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("level")) for c in columns])).alias("p")
        )
        distinct = pairs.select("p.c", "p.level").where(F.col("level").isNotNull()).distinct()
        found = distinct.collect()
        return cls({c: tuple(sorted(r["level"] for r in found if r["c"] == c)[1:]) for c in columns})

    @property
    def names(self) -> list[str]:
        return [_dummy_name(c, level) for c, levels in self.levels.items() for level in levels]

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` with each category column replaced by its 0/1 columns."""
        return rows.withColumns(self._columns()).drop(*self.levels) if self.levels else rows

    def _columns(self) -> dict[str, Column]:
        return {
            _dummy_name(c, level): F.when(F.col(c) == level, 1).otherwise(0)
            for c, levels in self.levels.items()
            for level in levels
        }

    def stages(self) -> list[Transformer | Estimator]:
        """The same 0/1 values as sparse vectors, one per column, by stages that are saved with the model.

        The indexer knows all levels but the first and puts the first, unseen and missing ones in a place of their own,
        which the encoder drops.
        """
        out: list = []
        for c, levels in self._coded():
            indexer = StringIndexerModel.from_labels(list(levels), c, f"{c}{_INDEX}", handleInvalid="keep")
            out += [indexer, OneHotEncoder(inputCol=f"{c}{_INDEX}", outputCol=f"{c}{_VECTOR}", dropLast=True)]
        return out

    def _coded(self) -> list[tuple[str, tuple[str, ...]]]:
        return [(c, levels) for c, levels in self.levels.items() if levels]

    @property
    def vectors(self) -> list[str]:
        return [f"{c}{_VECTOR}" for c, _ in self._coded()]


@dataclass(frozen=True)
class LevelIndex:
    """Places of category levels as a table: levels stay in Spark, and plans do not grow with their number.

    ``table(column, level, place)`` numbers the levels of each column but the alphabetically first from 0.  ``sizes`` has
    one number per column.
    """

    table: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(cls, rows: DataFrame, columns: list[str]) -> LevelIndex:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in columns])
        distinct = rows.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("level").isNotNull()).distinct()
        place = F.row_number().over(Window.partitionBy("column").orderBy("level")) - 2  # a row per level
        table = keep(distinct.withColumn("place", place).where("place >= 0"), "levels")
        counts = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        return cls(table, {c: counts.get(c, 0) for c in columns})

    def places(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``<column>__index``: the place of the row's level, or the number of places if it has none."""
        for c, size in self.sizes.items():
            side = self.table.where(F.col("column") == c).select(F.col("level").alias(c), F.col("place").alias("_place"))
            rows = attach_small(rows, side, [c], "left", f"places-{c}")
            rows = rows.withColumn(f"{c}{_INDEX}", F.coalesce("_place", F.lit(size)).cast("double")).drop("_place")
        return rows

    def vectors(self, rows: DataFrame, numeric: list[str], output: str = "features") -> DataFrame:
        """``rows`` with one sparse vector of numbers and 0/1 levels; a first, unseen or missing level is all zeros."""
        placed, made = self.places(rows), list(numeric)
        for c, size in self.sizes.items():
            if size:
                every = rows.sparkSession.range(size + 1).select(F.col("id").cast("double").alias(f"{c}{_INDEX}"))
                placed = OneHotEncoder(inputCol=f"{c}{_INDEX}", outputCol=f"{c}{_VECTOR}", dropLast=True).fit(every).transform(placed)
                made.append(f"{c}{_VECTOR}")
        packed = VectorAssembler(inputCols=made, outputCol=output).transform(placed)
        return packed.drop(*[f"{c}{end}" for c in self.sizes for end in (_INDEX, _VECTOR)])


def one_hot_sparse(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` without the columns, with ``places``: the ascending places of its levels among those of all columns."""
    index = LevelIndex.fit(rows, columns)
    placed, before, found = index.places(rows), 0, []
    for c, size in index.sizes.items():
        place = F.col(f"{c}{_INDEX}").cast("bigint")
        found.append(F.when(place < size, place + before))
        before += size
    return placed.withColumn("places", F.array_compact(F.array(*found))).drop(*columns, *[f"{c}{_INDEX}" for c in columns])


def vector_levels(indexer: StringIndexerModel) -> tuple[str, list[str]]:
    """The vector column an indexer feeds, and the names of its places."""
    c = indexer.getInputCol()
    return f"{c}{_VECTOR}", [_dummy_name(c, level) for level in indexer.labels]


def one_hot_drop_first(rows: DataFrame, columns: list[str]) -> DataFrame:
    return Encoder.fit(rows, columns).apply(rows)


def align_features(rows: DataFrame, expected: list[str]) -> DataFrame:
    """Exactly the expected columns in that order; those missing are 0."""
    present = set(rows.columns)
    return rows.select(*[F.col(f"`{c}`") if c in present else F.lit(0).alias(c) for c in expected])


def assembler(numeric: list[str], encoder: Encoder) -> VectorAssembler:
    return VectorAssembler(inputCols=[*numeric, *encoder.vectors], outputCol="features")


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """Weight per class, rows / (classes x rows of the class), for a 0/1 label."""
    counts = rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    all_classes = Window.partitionBy()  # over two rows
    weight = F.sum("n").over(all_classes) / (F.count(F.lit(1)).over(all_classes) * F.col("n"))
    return counts.select(label, "n", weight.cast("double").alias("weight"))


def with_class_weights(rows: DataFrame, label: str) -> DataFrame:
    """Rows with the weight of their class; the weights are two rows, so the join moves nothing."""
    return rows.join(F.broadcast(class_weights(rows, label).drop("n")), label)
