"""Run registered queries against DuckDB: ``python -m checks.compare [SF_DIR] [NAME...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb

from checks import load
from voicetide.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, (float, Decimal)):
        return round(float(value), 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def duck(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def compare(spark, con, sf: str, name: str) -> tuple[str, str]:
    """('ok' | 'rows' | 'FAIL', detail) for one query."""
    registry = load()
    frame = registry.QUERIES[name](spark, sf)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    sql = registry.ORACLES.get(name)
    if sql is None:
        return "rows", f"{len(got)} rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return "FAIL", f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = _rows(names, cursor.fetchall())
    if got == want:
        return ("ok" if got else "EMPTY"), f"{len(got)} rows"
    extra = [r for r in got if r not in want][:2]
    missing = [r for r in want if r not in got][:2]
    return "FAIL", f"{len(got)} vs {len(want)} rows; extra {extra!r:.400}; missing {missing!r:.400}"


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("8", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    con = duck(sf)
    names = argv[1:] or list(load().QUERIES)
    bad = 0
    for name in names:
        start = time.time()
        try:
            status, detail = compare(spark, con, sf, name)
        except Exception as error:  # report and go on with the next query
            status, detail = "FAIL", f"{type(error).__name__}: {str(error)[:700]}"
        bad += status in ("FAIL", "EMPTY")
        print(f"{status:5} {time.time() - start:6.1f}s {name}: {detail}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
