"""Run registered queries beside their SQL in DuckDB: ``python tests/oracle_check.py [sf_dir] [name...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    order = frame.map(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs between two results, order aside, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    left, right = _sorted(spark_frame), _sorted(sql_frame)
    unequal = (left != right) & ~(left.isna() & right.isna())
    if unequal.any().any():
        row = unequal.any(axis=1).idxmax()
        return f"row {row}: {str(left.loc[row].to_dict())[:300]} / {str(right.loc[row].to_dict())[:300]}"
    return None


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def type_difference(spark_types: list[tuple[str, str]], description) -> str | None:
    left = {name: SQL_TYPES.get(kind, kind) for name, kind in spark_types}
    right = {column[0]: str(column[1]) for column in description}
    return None if left == right else f"types {left} / {right}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from lexitab.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(queries())
    spark = local_session(8)
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        frame = queries()[name](spark, sf_dir)
        result = frame.toPandas()
        took = time.time() - start
        sql = oracle_sql().get(name)
        if sql is None:
            print(f"{name:26} rows only {len(result):8} {took:6.2f}s")
            continue
        twin = con.execute(sql)
        problem = type_difference(frame.dtypes, twin.description) or difference(result, twin.fetch_df())
        bad += problem is not None
        print(f"{name:26} {problem or 'ok'} {len(result):8} {took:6.2f}s", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
