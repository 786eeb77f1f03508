"""Compare registered queries with their SQL: ``python -m checks.compare [folder] [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"create view {name} as from read_parquet('{folder}/{name}.parquet')")
    return con


def _sorted_rows(columns: list[str], rows: list) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def difference(spark: SparkSession, con, query, sql: str, folder: str) -> str | None:
    """None when names, types and rows agree, else what differs first."""
    result = query(spark, folder)
    rows = [tuple(r) for r in result.collect()]
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    mine, theirs = _sorted_rows(result.columns, rows), _sorted_rows(names, answer.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    same = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    for name, kind in result.dtypes:
        if same.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    if mine[1] != theirs[1]:
        only_mine, only_theirs = set(mine[1]) - set(theirs[1]), set(theirs[1]) - set(mine[1])
        return (
            f"rows {len(mine[1])} / {len(theirs[1])};"
            f" only here {sorted(only_mine)[:2]}; only in SQL {sorted(only_theirs)[:2]}"
        )
    return None


def main() -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from obsengine.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("compare")
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        if name in ORACLES:
            text = difference(spark, con, QUERIES[name], ORACLES[name], folder)
        else:
            text = None if QUERIES[name](spark, folder).count() else "no rows"
        bad += text is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {text or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
