"""Run queries beside their DuckDB text: python tests/oracle.py [folder] [name ...]."""

import glob
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def connect(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(str(r[i]) for i in order) for r in rows))


def compare(spark, db, folder, name, query, sql):
    """None if equal, else what differs."""
    df = query(spark, folder)
    names, got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    result = db.execute(sql)
    want_names, want = rows_of([c[0] for c in result.description], result.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if got == want:
        return None if got else "equal but empty"
    left, right = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"rows {len(got)} / {len(want)}; only Spark {len(left)} {left[:2]}; only SQL {len(right)} {right[:2]}"[:1500]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract
    from crawlstrata.session import drop_staged

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="oracle-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:]
    db = connect(FOLDER)
    failed = 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, db, FOLDER, name, query, contract.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    drop_staged(spark)
    print("failed", failed)
