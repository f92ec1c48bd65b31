"""Run registered queries against their SQL: ``python -m tests.compare [--large] [sf_dir] [key ...]``.

``--large`` takes the plans for large tables whatever the size.
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from linkhoard.sources import tables

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "binary": "BLOB"}


def expected(sf_dir: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    rel = con.sql(sql)
    names = sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    quoted = ", ".join(f'"{n}"' for n in names)
    rows = con.execute(f"SELECT {quoted} FROM ({sql})").fetchall()
    return {n: types[n] for n in names}, rows


def actual(df: DataFrame) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(df.columns)
    types = {n: KINDS.get(df.schema[n].dataType.simpleString(), df.schema[n].dataType.simpleString()) for n in names}
    return types, [tuple(r) for r in df.select(*names).collect()]


def _key(row: tuple) -> tuple:
    return tuple((v is not None, v) for v in row)


def difference(df: DataFrame, sf_dir: str, sql: str) -> str | None:
    """None when schema and rows agree, else a description."""
    want_types, want = expected(sf_dir, sql)
    have_types, have = actual(df)
    if list(want_types) != list(have_types):
        return f"columns {list(have_types)} instead of {list(want_types)}"
    wrong = {n: (have_types[n], want_types[n]) for n in want_types if have_types[n] != want_types[n] and want_types[n] != '"NULL"'}
    if wrong:
        return f"types {wrong}"
    want, have = sorted(want, key=_key), sorted(have, key=_key)
    if want != have:
        missing = [r for r in want if r not in set(have)][:3]
        extra = [r for r in have if r not in set(want)][:3]
        return f"{len(have)} rows instead of {len(want)}; missing {missing}; extra {extra}"
    return None


def main() -> None:
    import __spark_entry__ as entry

    args = sys.argv[1:]
    if "--large" in args:
        args.remove("--large")
        tables.SMALL_ROWS = -1
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for key in keys:
        started = time.time()
        try:
            df = entry.queries()[key](spark, sf_dir)
            note = difference(df, sf_dir, entry.oracle_sql()[key])
        except Exception as error:  # report and go on
            note = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += note is not None
        print(f"{key:20s} {time.time() - started:6.2f}s {'ok' if note is None else 'DIFFERS ' + note}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} agree")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
