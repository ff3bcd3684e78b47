"""Run queries next to their DuckDB SQL and compare all rows: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value, digits):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.{digits}g}") + 0.0
    return value


def rows_of(names, rows, digits=17):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i], digits) for i in order) for r in rows)


def difference(spark_df, con, sql: str, digits: int = 17):
    """None if equal; else a short text."""
    names = spark_df.columns
    ours = rows_of(names, [tuple(r) for r in spark_df.collect()], digits)
    cur = con.execute(sql)
    theirs_names = [c[0] for c in cur.description]
    theirs = rows_of(theirs_names, cur.fetchall(), digits)
    if sorted(names) != sorted(theirs_names):
        return f"columns {sorted(names)} != {sorted(theirs_names)}"
    if ours == theirs:
        return None
    return (
        f"rows {sum(ours.values())} vs {sum(theirs.values())}; columns {sorted(names)}\n"
        f"   only ours   {list((ours - theirs).elements())[:2]}\n   only theirs {list((theirs - ours).elements())[:2]}"
    )


def local_session(cores: int = 8, partitions: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main(argv):
    from __spark_entry__ import oracle_sql, queries

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    built, sqls = queries(), oracle_sql()
    bad = 0
    for name, build in built.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sqls:
                verdict = difference(df, con, sqls[name])
                if verdict and difference(build(spark, folder), con, sqls[name], 10) is None:
                    verdict = "equal to 10 digits only: " + verdict
            else:
                verdict = None if df.count() else "no rows"
        except Exception as error:  # report every failing query, not only the first
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += verdict is not None
        tag = "ok " if verdict is None else "BAD"
        print(f"{tag} {name:34s} {time.time() - start:6.2f}s {'' if name in sqls else 'rows only'} {verdict or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
