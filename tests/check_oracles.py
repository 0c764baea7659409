"""Compare registered queries with their SQL: ``python tests/check_oracles.py SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf: str) -> str:
    df = queries()[name](spark, sf)
    mine = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows only ({len(mine)})"
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    theirs = canonical(res.fetchall(), cols)
    if sorted(cols) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} {sorted(cols)}"
    if mine == theirs:
        return f"ok ({len(mine)})"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"DIFFERENT {len(mine)} {len(theirs)} first {str(wrong[:1])[:600]}"


def main() -> None:
    from bibspark.session import get_session

    sf, names = sys.argv[1], sys.argv[2:] or list(queries())
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, con, name, sf)
        except Exception as error:  # report and go on with the next query
            verdict = f"FAILED {str(error)[:700]}"
        print(f"{name}: {verdict} [{time.time() - start:.1f}s]", flush=True)


if __name__ == "__main__":
    main()
