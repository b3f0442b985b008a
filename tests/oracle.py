"""Run registered queries and their SQL side by side and compare the rows."""

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty if the rows agree, else what differs."""
    got = query(spark, sf_dir).toArrow()
    want = con.execute(sql).to_arrow_table()
    names = sorted(got.column_names)
    if names != sorted(want.column_names):
        return f"columns {names} and {sorted(want.column_names)}"
    got, want = got.select(names), want.select(names)
    types = [(str(a), str(b)) for a, b in zip(got.schema.types, want.schema.types)]
    differing = [t for t in types if t[0].replace("large_", "") != t[1].replace("large_", "")]
    if differing:
        return f"types {differing}"
    if got.num_rows != want.num_rows:
        return f"{got.num_rows} and {want.num_rows} rows"
    order = [(n, "ascending") for n in names]
    got, want = got.sort_by(order), want.cast(got.schema).sort_by(order)
    if got.combine_chunks().equals(want.combine_chunks()):
        return ""
    for name in names:
        pairs = zip(got[name].to_pylist(), want[name].to_pylist())
        bad = [p for p in pairs if p[0] != p[1]]
        if bad:
            return f"{len(bad)} values of {name}, such as {bad[:3]}"
    return "unequal"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.maxResultSize", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, query in queries().items():
        if names and name not in names or name not in oracle_sql():
            continue
        start = time.time()
        problem = compare(spark, con, query, oracle_sql()[name], sf_dir)
        failed += bool(problem)
        print(f"{name:26} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
    print("failed:", failed)
