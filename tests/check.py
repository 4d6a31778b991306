"""Compare queries with their SQL: ``python tests/check.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larkspur.catalog import QUERIES  # noqa: E402
from larkspur.oracles import ORACLES  # noqa: E402

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
         "timestamp": "TIMESTAMP"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def differences(spark, con, name: str, folder: str) -> list[str]:
    """What differs between a query and its SQL; empty when columns, types and all values agree."""
    ours = QUERIES[name](spark, folder)
    order = sorted(ours.columns)
    theirs = con.execute(ORACLES[name])
    columns = {c[0]: str(c[1]) for c in theirs.description}
    if sorted(columns) != order:
        return [f"columns {order} against {sorted(columns)}"]
    found = [
        f"type of {c}: {kind} against {columns[c]}" for c, kind in ours.dtypes if TYPES.get(kind) != columns[c]
    ]
    at = [list(columns).index(c) for c in order]
    want = sorted((tuple(r[i] for i in at) for r in theirs.fetchall()), key=_key)
    got = sorted((tuple(r) for r in ours.select(*[f"`{c}`" for c in order]).collect()), key=_key)
    if len(got) != len(want):
        found.append(f"{len(got)} rows against {len(want)}")
    wrong = [(g, w) for g, w in zip(got, want, strict=False) if g != w]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]} ({order})")
    return found


if __name__ == "__main__":
    from larkspur import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in sys.argv[2:] or list(ORACLES):
        start = time.time()
        try:
            found = differences(spark, con, name, folder)
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {' | '.join(found)}", flush=True)
    print(f"{failed} failed")
