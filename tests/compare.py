"""Compare registered queries with their SQL on the same parquet files.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in filter(os.path.isfile, glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


SAME_TYPE = {
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def differences(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """Empty when column names, types and all rows (as multisets) agree."""
    con.register("ours", spark_df.toArrow())
    con.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {sql}")
    theirs = {row[0]: row[1] for row in con.execute("DESCRIBE theirs").fetchall()}
    columns = sorted(spark_df.columns)
    if columns != sorted(theirs):
        return [f"columns {columns} / {sorted(theirs)}"]
    problems = [
        f"type of {name}: {kind} / {theirs[name]}"
        for name, kind in spark_df.dtypes
        if SAME_TYPE.get(kind) != theirs[name]
    ]
    named = ", ".join(f'"{c}"' for c in columns)
    for one, other in (("ours", "theirs"), ("theirs", "ours")):
        extra = f"SELECT {named} FROM {one} EXCEPT ALL SELECT {named} FROM {other}"
        count = con.execute(f"SELECT COUNT(*) FROM ({extra})").fetchall()[0][0]
        if count:
            first = con.execute(f"SELECT * FROM ({extra}) ORDER BY ALL LIMIT 1").fetchall()[0]
            problems.append(f"{count} rows only in {one}, e.g. {first}")
    return problems


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from daytally.session import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wanted = sys.argv[2:] or list(queries())
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"{name}: {df.count()} rows, no SQL, {time.time() - started:.1f} s", flush=True)
                continue
            problems = differences(df, sql, con)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{name}: {problems or 'equal'}, {time.time() - started:.1f} s", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
