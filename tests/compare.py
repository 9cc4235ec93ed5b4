"""Holds queries against their SQL in DuckDB; also a script: python tests/compare.py FOLDER [NAME...]."""

import math
import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connection(folder: str):
    c = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}{'/*.parquet' if f.is_dir() else ''}')")
    return c


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(clean(r[k]) for k in order) for r in values), key=repr), sorted(columns)


def differences(spark, folder: str, name: str, make, sql: str) -> str:
    df = make(spark, folder)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    result = connection(folder).execute(sql)
    theirs = rows([d[0] for d in result.description], result.fetchall())
    if mine == theirs:
        return ""
    odd = next(((a, b) for a, b in zip(mine[0], theirs[0], strict=False) if a != b), None)
    return f"{name}: columns {mine[1]} and {theirs[1]}, rows {len(mine[0])} and {len(theirs[0])}, first difference {odd}"


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or [x for x in queries if not x.startswith(("op", "pipeline"))]:
        began = time.time()
        try:
            said = differences(spark, sys.argv[1], name, queries[name], sql[name]) if name in sql else f"{name}: {queries[name](spark, sys.argv[1]).count()} rows, no SQL"
        except Exception as e:
            said = f"{name}: {type(e).__name__} {str(e)[:400]}"
        print(f"{time.time() - began:5.1f} s", said or f"{name}: same", flush=True)
