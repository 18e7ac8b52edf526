"""Compare queries with their SQL twins in DuckDB.

    python tests/oracle.py [--sf DIR] [--slices] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _kind(dtype) -> str:
    if pd.api.types.is_bool_dtype(dtype):
        return "bool"
    if pd.api.types.is_integer_dtype(dtype):
        return "int"
    return "float" if pd.api.types.is_float_dtype(dtype) else "other"


def canonical(table) -> pd.DataFrame:
    """Columns by name, rows in a fixed order, values as text."""
    pdf = table.to_pandas(types_mapper=pd.ArrowDtype)
    pdf = pdf[sorted(pdf.columns)]
    text = pdf.astype("object").where(pdf.notna(), None).map(repr)
    return text.sort_values(list(text.columns), ignore_index=True)


def compare(spark, con, name: str, query, sql: str | None, sf: str) -> tuple[str, int, float, float]:
    started = time.time()
    got = query(spark, sf).toArrow()
    spent = time.time() - started
    if sql is None:
        return "rows", got.num_rows, spent, 0.0
    started = time.time()
    want = con.sql(sql).to_arrow_table()
    sql_spent = time.time() - started
    if sorted(got.column_names) != sorted(want.column_names):
        return f"COLUMNS {got.column_names} {want.column_names}", got.num_rows, spent, sql_spent
    types = {
        c: (str(got.schema.field(c).type), str(want.schema.field(c).type))
        for c in got.column_names
        if str(got.schema.field(c).type) != str(want.schema.field(c).type)
    }
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"ROWS {len(a)} {len(b)}", got.num_rows, spent, sql_spent
    if not a.equals(b):
        bad = (a != b).any(axis=1)
        diff = pd.concat([a[bad].head(4), b[bad].head(4)], keys=["spark", "sql"])
        return f"VALUES {int(bad.sum())}\n{diff.to_string()}", got.num_rows, spent, sql_spent
    return ("ok" if not types else f"ok (types {types})"), got.num_rows, spent, sql_spent


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from ctrflow.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--slices", action="store_true", help="keep shuffle partitions apart")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    if args.slices:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    con, sqls = connect(args.sf), oracle_sql()
    failed = 0
    for name, query in queries().items():
        if args.names and name not in args.names:
            continue
        try:
            result, rows, spent, sql_spent = compare(spark, con, name, query, sqls.get(name), args.sf)
        except Exception as error:
            result, rows, spent, sql_spent = f"ERROR {str(error)[:600]}", -1, 0.0, 0.0
        failed += not result.startswith(("ok", "rows"))
        print(f"{name:28s} {rows:7d} rows {spent:6.2f} s  sql {sql_spent:5.2f} s  {result}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
