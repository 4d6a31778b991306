from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from places import STAR  # noqa: E402

from larkspur import Tables, build_session  # noqa: E402
from larkspur.sources.schemas import SCHEMAS  # noqa: E402
from larkspur.sources.star import star_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "larkspur-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir="/tmp/larkspur-test-warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return star_tables(spark, STAR)


@pytest.fixture(scope="session")
def make(spark):
    """``make(orders=[{...}], ...)``: Tables of a few rows; absent columns are NULL, absent tables empty."""

    def build(**tables: list[dict]) -> Tables:
        frames = {}
        for name, schema in SCHEMAS.items():
            loose = schema.__class__([f.__class__(f.name, f.dataType, True) for f in schema.fields])
            rows = [tuple(row.get(f.name) for f in schema.fields) for row in tables.get(name, [])]
            frames[name] = spark.createDataFrame(rows, loose)
        return Tables.from_frames(frames)

    return build


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as plain tuples."""
    return lambda frame: [tuple(r) for r in frame.collect()]
