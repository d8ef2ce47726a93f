"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import datetime as dt
import math
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> dict:
    """Outcome of one query: match, row counts, timings and the first difference."""
    from agora.catalog import ORACLES, QUERIES

    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    found = df.collect()
    spark_seconds = time.time() - start
    result = {"query": name, "rows": len(found), "spark_s": round(spark_seconds, 2)}
    if name not in ORACLES:
        return result | {"match": None}
    start = time.time()
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    result["sql_s"] = round(time.time() - start, 2)
    if sorted(columns) != sorted(df.columns):
        return result | {"match": False, "why": f"columns {df.columns} and {columns}"}
    ours, theirs = _rows(df.columns, found), _rows(columns, wanted)
    if ours == theirs:
        return result | {"match": True}
    extra = next((a for a, b in zip(ours, theirs) if a != b), None)
    other = next((b for a, b in zip(ours, theirs) if a != b), None)
    return result | {
        "match": False,
        "why": f"{len(ours)} and {len(theirs)} rows; {str(extra)[:400]} <> {str(other)[:400]}",
    }
