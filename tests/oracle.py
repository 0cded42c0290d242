"""Compare a query with its SQL in DuckDB, as sorted rows."""

import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def norm(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value + 0.0, 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(norm, value)) + "]"
    return repr(value)


def differences(spark, con, query, sql, sf_dir):
    """What differs: columns, the number of rows, or the first rows of each side alone."""
    got, want = query(spark, sf_dir), con.execute(sql)
    columns = [d[0] for d in want.description]
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} against {sorted(columns)}"
    mine = sorted(tuple(norm(r[c]) for c in sorted(columns)) for r in got.collect())
    place = [columns.index(c) for c in sorted(columns)]
    theirs = sorted(tuple(norm(r[i]) for i in place) for r in want.fetchall())
    if mine != theirs:
        a, b = [r for r in mine if r not in set(theirs)], [r for r in theirs if r not in set(mine)]
        return f"{sorted(columns)}: {len(mine)} rows against {len(theirs)}; only here {a[:3]}; only in SQL {b[:3]}"
    return ""
