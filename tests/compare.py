"""Run registered queries against their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def normal(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(item) for item in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def differences(spark, connection, sf_dir, name, query, sql) -> str:
    """Empty if both sides agree in column names, kinds and rows."""
    result = query(spark, sf_dir)
    rows = result.collect()
    cursor = connection.execute(sql)
    names = [item[0] for item in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} and {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    sides = {item[0]: str(item[1]) for item in cursor.description}
    for field in result.schema.fields:
        kind = kinds.get(field.dataType.simpleString())
        if kind and sides[field.name].upper() not in {kind, "STRING" if kind == "VARCHAR" else kind}:
            return f"column {field.name}: {kind} and {sides[field.name]}"
    left, right = bag(result.columns, rows), bag(names, expected)
    if left != right:
        return f"{len(rows)} and {len(expected)} rows; only in Spark {list((left - right).items())[:3]}; " \
               f"only in SQL {list((right - left).items())[:3]}"
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tallywright.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark, connection, sql = local_session(8), connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in sql:
                note = differences(spark, connection, sf_dir, name, query, sql[name])
                state = "ok" if not note else "DIFF"
            else:
                note, state = f"{len(query(spark, sf_dir).collect())} rows", "rows"
        except Exception as error:  # report and go on with the next query
            note, state = f"{type(error).__name__}: {str(error)[:600]}", "FAIL"
        bad += state in {"DIFF", "FAIL"}
        print(f"{state:5} {name:36} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
