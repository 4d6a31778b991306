from __future__ import annotations

import duckdb
import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """``docs(texts)`` or ``docs({id: text})``: a documents table; with ``extra`` it has columns whose names could clash."""

    def build(texts, extra: bool = False):
        pairs = list(texts.items()) if isinstance(texts, dict) else list(enumerate(texts))
        rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in pairs]
        made = spark.createDataFrame(rows, DOCS).repartition(3)
        if extra:
            for name in ("row", "grp", "ids", "fp", "key", "score", "bucket", "text_bytes", "h1", "s", "i"):
                made = made.selectExpr("*", f"'x' as {name}")
        return made

    return build


@pytest.fixture(scope="session")
def in_duckdb(tmp_path_factory):
    """``in_duckdb(sql, pages=frame)``: rows of the SQL over the given Spark tables, with its column names."""

    def run(sql: str, **tables):
        con = duckdb.connect()
        for name, frame in tables.items():
            folder = tmp_path_factory.mktemp(name) / "t"
            frame.coalesce(1).write.parquet(str(folder))
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/*.parquet')")
        got = con.execute(sql)
        return [c[0] for c in got.description], got.fetchall()

    return run
