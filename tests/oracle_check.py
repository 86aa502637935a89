"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/oracle_check.py [folder] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    """Rows with their columns in name order, as sorted text; floats to 12 digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v + 0.0:.12g}"
        return f"{v:.12g}" if isinstance(v, int) and not isinstance(v, bool) else repr(v)
    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name):
    """None when they agree, else a description of the difference."""
    df = queries()[name](spark, folder)
    got = canonical(df.columns, df.collect())
    cursor = con.execute(oracle_sql()[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got == expected:
        return None
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    extra, missing = set(got[1]) - set(expected[1]), set(expected[1]) - set(got[1])
    return (f"{len(got[1])} rows against {len(expected[1])}; only here {sorted(extra)[:4]}, "
            f"only there {sorted(missing)[:4]}")


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in sys.argv[2:] or oracle_sql():
        started = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("all agree" if not bad else f"{bad} differ")
