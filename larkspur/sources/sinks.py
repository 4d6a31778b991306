"""Writing results: CSV and JSON datasets, appends, guarded first loads and refreshes readers never see half done."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, NumericType, StringType

from larkspur.operators.scale import in_parallel, work_folder
from larkspur.sources.schemas import SCHEMAS, STORAGE_DATES

COPY_BYTES = 1 << 20


def store_table(rows: DataFrame, name: str, folder: str, files_per_month: int = 1) -> None:
    """Base table as Parquet.  Dated facts are partitioned by month, so reports of a year prune the rest.

    Rows move once, by month and a spread over ``files_per_month`` parts: no tiny file per task and month, and a month
    that holds much of the data is written by several tasks.
    """
    day = STORAGE_DATES.get(name)
    if day is None:
        rows.write.mode("overwrite").parquet(folder)
        return
    dated = rows.withColumn("month", F.date_format(day, "yyyy-MM"))
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_month))
    dated.repartition("month", part).write.mode("overwrite").partitionBy("month").parquet(folder)


def write_csv(rows: DataFrame, folder: str, one_file: bool = False) -> None:
    """CSV with a header.  ``one_file`` is for reports of a few rows; larger data keep one file per task."""
    out = rows.coalesce(1) if one_file else rows
    out.write.mode("overwrite").option("header", True).csv(folder)


def write_csvs(datasets: Mapping[str, DataFrame], folder: str) -> None:
    """One sub-folder per dataset, written side by side."""
    in_parallel(
        [lambda n=name, r=rows: write_csv(r, f"{folder}/{n}", one_file=True) for name, rows in datasets.items()]
    )


def json_ready(rows: DataFrame) -> DataFrame:
    """Numbers, flags and text as they are, decimals as numbers, any other type as text."""

    def shown(name: str, kind: DataType) -> Column:
        if isinstance(kind, DecimalType):
            return F.col(name).cast("double")
        if isinstance(kind, (NumericType, StringType, BooleanType)):
            return F.col(name)
        return F.col(name).cast("string")

    return rows.select(*[shown(f.name, f.dataType).alias(f.name) for f in rows.schema.fields])


def write_json(datasets: Mapping[str, DataFrame], folder: str) -> None:
    """One sub-folder of JSON lines per dataset, written by the executors, side by side."""

    def write(name: str, rows: DataFrame) -> None:
        json_ready(rows).write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}")

    in_parallel([lambda n=name, r=rows: write(n, r) for name, rows in datasets.items()])


def write_json_document(datasets: Mapping[str, DataFrame], path: str) -> None:
    """All datasets as record lists of one JSON document in one file, in their order.

    Tasks write the records as part files, side by side and each dataset in its own order; the parts are then strung together
    by the file system in blocks of ``COPY_BYTES``, so no process ever holds a dataset.  The file gets its name when it is
    complete.
    """
    spark = next(iter(datasets.values())).sparkSession
    parts = f"{work_folder(spark)}/document-{uuid.uuid4().hex}"

    def write(name: str, rows: DataFrame) -> None:
        ready = json_ready(rows)
        record = F.to_json(F.struct(*[F.col(c) for c in ready.columns]), {"ignoreNullFields": "false"})
        ready.select(F.concat(F.lit(",   "), record)).write.text(f"{parts}/{list(datasets).index(name)}")

    in_parallel([lambda n=name, r=rows: write(n, r) for name, rows in datasets.items()])
    _string_together(spark, [(json.dumps(n), f"{parts}/{i}") for i, n in enumerate(datasets)], path)


def _string_together(spark: SparkSession, sections: list[tuple[str, str]], path: str) -> None:
    """Part files of each section, in order of their names, inside the frame of a document; lines begin with a comma."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(settings)
    unfinished = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = files.create(unfinished, True)
    for i, (name, folder) in enumerate(sections):
        out.write(bytearray(f"{',' if i else '{'}\n  {name}: [\n".encode()))
        place = jvm.org.apache.hadoop.fs.Path(folder)
        source = place.getFileSystem(settings)
        listed = [(f.getPath().getName(), f) for f in source.listStatus(place)]
        full = [f.getPath() for name, f in sorted(listed, key=lambda x: x[0]) if name.startswith("part-") and f.getLen()]
        for k, part in enumerate(full):
            block = source.open(part)
            if k == 0:
                block.skip(1)  # the comma before the first record
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(block, out, COPY_BYTES, False)
            block.close()
        out.write(bytearray(b"  ]"))
    out.write(bytearray(b"\n}\n" if sections else b"{}\n"))
    out.close()
    files.delete(target, True)
    if not files.rename(unfinished, target):
        raise OSError(f"cannot rename {unfinished} to {path}")


def typed(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the declared columns, order and types of table ``name``."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])


def full_refresh(rows: DataFrame, table: str, folder: str) -> str:
    """Replace the contents of a catalog table; returns the folder of the new contents.

    The rows go to a new folder and the table is pointed there in one catalog change at the end.  Readers see the old
    rows or the new ones, never none, and a write that fails leaves the old rows in place.  Rows with other columns or types
    than the table's are refused before anything is written.  Old folders stay, for readers still at them; give the
    parent folder an expiry rule.
    """
    spark = rows.sparkSession
    fresh = f"{folder.rstrip('/')}/run-{uuid.uuid4().hex}"
    known = spark.catalog.tableExists(table)
    if known:
        kinds = [(f.name, f.dataType) for f in spark.table(table).schema]
        if kinds != [(f.name, f.dataType) for f in rows.schema]:
            raise ValueError(f"{table} has other columns or types than the new rows")
    rows.write.mode("errorifexists").parquet(fresh)
    if known:
        place = fresh.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=fresh, source="parquet", schema=rows.schema)
    return fresh


def truncate_reset(spark: SparkSession, table: str, folder: str) -> str:
    """Empty a table.  Ids start again at 1 with the next load, because ``assign_ids`` computes them."""
    return full_refresh(spark.table(table).limit(0), table, folder)


def _has_rows(spark: SparkSession, folder: str) -> bool:
    try:
        return not spark.read.parquet(folder).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def load_once(rows: DataFrame, folder: str) -> None:
    """First load of a table; refused when the folder already holds rows, so a second run adds no duplicates."""
    if _has_rows(rows.sparkSession, folder):
        raise ValueError(f"{folder} already has rows")
    rows.write.mode("append").parquet(folder)


def bulk_append(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").parquet(folder)
