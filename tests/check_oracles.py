"""Run queries next to their SQL and report differences.

    python tests/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value) if isinstance(value, decimal.Decimal) else value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def close(a, b) -> bool:
    """Equal, or doubles that differ only in the last rounded digit."""
    for x, y in zip(a, b, strict=True):
        if isinstance(x, (int, float)) and isinstance(y, (int, float)) and not isinstance(x, bool):
            if x != y and not (isinstance(x, float) or isinstance(y, float)):
                return False
            if abs(x - y) > 1.0e-6 + 1e-9:
                return False
        elif x != y:
            return False
    return True


def duck(folder):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def compare(spark_df, connection, sql):
    """(verdict, detail)"""
    mine_columns, mine = normalized(spark_df.columns, spark_df.collect())
    cursor = connection.execute(sql)
    their_columns, theirs = normalized([d[0] for d in cursor.description], cursor.fetchall())
    if mine_columns != their_columns:
        return "COLUMNS", f"{mine_columns} / {their_columns}"
    if len(mine) != len(theirs):
        extra = [r for r in mine if r not in set(theirs)][:2] if len(mine) < 200000 else []
        missing = [r for r in theirs if r not in set(mine)][:2] if len(mine) < 200000 else []
        return "ROWS", f"{len(mine)} / {len(theirs)} extra {extra} missing {missing}"
    if mine == theirs:
        return "ok", f"{len(mine)} rows"
    bad = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    if all(close(a, b) for a, b in bad):
        return "near", f"{len(bad)} of {len(mine)} rows differ in the last digit: {bad[0]}"
    return "VALUES", f"{len(bad)} of {len(mine)} rows: {str(bad[0])[:600]}"


def main() -> None:
    import __spark_entry__ as contract
    from reviewmill.session import local_session

    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    spark = local_session()
    connection = duck(folder)
    sqls, all_queries = contract.oracle_sql(), contract.queries()
    for name in arguments or all_queries:
        started = time.time()
        try:
            result = all_queries[name](spark, folder)
            if name not in sqls:
                verdict, detail = "rows-only", f"{result.count()} rows"
            else:
                verdict, detail = compare(result, connection, sqls[name])
        except Exception as error:  # report and go on
            verdict, detail = "ERROR", f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{verdict:10} {name:28} {time.time() - started:7.2f}s  {detail[:900]}", flush=True)


if __name__ == "__main__":
    main()
