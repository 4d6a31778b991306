"""Reading the tables: by declared schema from files, over JDBC in parallel slices, or from any DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources.schemas import PRIMARY_KEYS, SCHEMAS, STORAGE_DATES


def read_table(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Table ``name`` from files under ``path`` with its declared schema; filters and columns reach the scan.

    ``since`` and ``until`` limit a dated fact to a range of days.  Where it is stored by month, other months are not
    even listed.
    """
    reader = spark.read.schema(SCHEMAS[name]).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return in_range(reader.load(path), name, since, until).select(*SCHEMAS[name].names)


def in_range(rows: DataFrame, name: str, since: date | None, until: date | None) -> DataFrame:
    """Rows of fact ``name`` from ``since`` to ``until``, both included; a ``month`` column is limited as well."""
    for day, compare in ((since, "__ge__"), (until, "__le__")):
        if day is not None:
            rows = rows.where(getattr(F.col(STORAGE_DATES[name]), compare)(F.lit(day)))
            if "month" in rows.columns:
                rows = rows.where(getattr(F.col("month").cast("string"), compare)(f"{day:%Y-%m}"))
    return rows


def read_jdbc(
    spark: SparkSession,
    name: str,
    url: str,
    lower: int,
    upper: int,
    slices: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table ``name`` from a database, read in ``slices`` key ranges at once instead of through one connection."""
    raw = spark.read.jdbc(
        url,
        name,
        column=PRIMARY_KEYS[name],
        lowerBound=lower,
        upperBound=upper,
        numPartitions=slices,
        properties=dict(properties or {}),
    )
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])


class Tables:
    """The named tables, each built on first use: ``t.customers``, ``t.orders``, ..."""

    def __init__(self, source: Callable[..., DataFrame]):
        self._source = source
        self._seen: dict[str, DataFrame] = {}

    def between(self, since: date | None = None, until: date | None = None) -> Tables:
        """The same tables with the dated facts limited to a range of days.

        Of facts stored by month only the months of the range are read; other tables are whole.
        """

        def limited(name: str) -> DataFrame:
            if name not in STORAGE_DATES:
                return getattr(self, name)
            ranged = getattr(self._source, "ranged", None)
            return ranged(name, since, until) if ranged else in_range(getattr(self, name), name, since, until)

        return Tables(limited)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._seen:
            self._seen[name] = self._source(name)
        return self._seen[name]

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, fmt: str = "parquet") -> Tables:
        """One sub-folder per table."""
        def whole(name: str, since: date | None = None, until: date | None = None) -> DataFrame:
            return read_table(spark, name, f"{folder.rstrip('/')}/{name}", fmt, since, until)

        whole.ranged = whole
        return cls(whole)

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> Tables:
        return cls(lambda name: frames[name])
