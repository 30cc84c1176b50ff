"""Compares the registered queries with DuckDB: ``python tests/oracle.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def normal(rows):
    return sorted((tuple(map(plain, row)) for row in rows), key=repr)


def compare(frame, connection, sql):
    """What differs, or None."""
    columns = sorted(frame.columns)
    found = normal(map(tuple, frame.select(*columns).collect()))
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = [names.index(name) for name in sorted(names)]
    expected = normal(tuple(row[i] for i in order) for row in result.fetchall())
    if sorted(names) != columns:
        return f"columns {columns} but {sorted(names)} in SQL"
    if len(found) != len(expected):
        return f"{len(found)} rows but {len(expected)} in SQL"
    for mine, theirs in zip(found, expected, strict=True):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} but {theirs} in SQL"
    return None if found else "no rows"


def main():
    from sluice.queries import ALL
    from sluice.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or ALL:
        begun = time.time()
        try:
            problem = compare(ALL[name].run(spark, sf_dir), connection, ALL[name].sql)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:2000]}"
        bad += problem is not None
        print(f"{name:30} {time.time() - begun:6.1f}s  {problem or 'same'}", flush=True)
    print("all the same" if not bad else f"{bad} differ")


if __name__ == "__main__":
    main()
