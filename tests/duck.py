"""Query results against their SQL on DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(repr(r) for r in frame[names].astype(object).where(frame[names].notna(), None).values.tolist())
