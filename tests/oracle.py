"""Holds Spark rows against DuckDB's."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, int):
        return v
    if getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)
