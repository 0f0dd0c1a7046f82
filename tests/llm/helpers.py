"""Shared by the tests of the training-data operators."""

import duckdb

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir, sql, tables=TABLES):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(sql).fetchall()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
