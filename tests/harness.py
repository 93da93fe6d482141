"""Compare a Spark result with DuckDB SQL the way the driver does:
row count, column names, and an order-insensitive multiset of values."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_names, s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_names, d_rows = rows_of(d_cols, cur.fetchall())
    if s_names != d_names:
        return False, f"columns differ: spark={s_names} duckdb={d_names}"
    n_s, n_d = sum(s_rows.values()), sum(d_rows.values())
    if s_rows != d_rows:
        only_s = list((s_rows - d_rows).items())[:5]
        only_d = list((d_rows - s_rows).items())[:5]
        return False, f"rows spark={n_s} duckdb={n_d}; only spark: {only_s}; only duckdb: {only_d}"
    return True, f"{n_s} rows"


def crosstab_direct(df, spec):
    """The one-step rollup over detail rows, to compare with the two-step form."""
    from pyspark.sql import functions as F

    sets = [[F.col(k) for k in s] for s in spec.grouping_sets()]
    return df.groupingSets(sets, *[F.col(k) for k in spec.keys]).agg(
        *[F.grouping(k).cast("int").alias(f"g_{k}") for k in spec.keys],
        F.count(F.col(spec.measure)).cast("long").alias("n"))
