"""Compare a registered query with its SQL on the same tables (order-insensitive, all columns, all rows)."""
from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def differences(spark, con, sf_dir, query, sql, show=3):
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return [f"columns {names} != {sorted(rel.columns)}"]
    order = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"SELECT {order} FROM ({sql})").fetchall(), key=_key)
    out = []
    if len(mine) != len(theirs):
        out.append(f"rows {len(mine)} != {len(theirs)}")
    if not mine:
        out.append("no rows")
    bad = [(a, b) for a, b in zip(mine, theirs) if _key(a) != _key(b)]
    out += [f"{names}\n   spark {a}\n   sql   {b}" for a, b in bad[:show]]
    if bad:
        out.append(f"{len(bad)} rows differ")
    return out


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    sqls = entry.oracle_sql()
    for name, q in entry.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in sqls:
                res = differences(spark, con, sf, q, sqls[name])
                verdict = "ok" if not res else "DIFF"
            else:
                res, verdict = [], f"rows-only {q(spark, sf).count()}"
        except Exception as e:  # noqa: BLE001
            res, verdict = [str(e)[:1500]], "ERROR"
        print(f"{verdict:6} {name} {time.time() - t:.1f}s", *res, sep="\n   " if res else " ", flush=True)
