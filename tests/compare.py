"""Compare a registered query with its SQL as value multisets."""

import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return int(v) if v == int(v) and abs(v) < 1e15 else v
    return v if isinstance(v, (int, str, bool, type(None))) else str(v)


def difference(frame, con, sql):
    """None when both hold the same rows under the same column names, or a short text."""
    got_columns = sorted(frame.columns)
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rel.fetchall()
    if sorted(names) != got_columns:
        return f"columns {got_columns} != {sorted(names)}"
    place = [names.index(c) for c in got_columns]
    wanted = Counter(tuple(_plain(r[i]) for i in place) for r in want)
    found = Counter(tuple(_plain(v) for v in r) for r in frame.select(
        *[f"`{c}`" for c in got_columns]).collect())
    if wanted == found:
        return None
    extra, lost = list((found - wanted).items())[:2], list((wanted - found).items())[:2]
    return f"rows {sum(found.values())} vs {sum(wanted.values())}; only Spark {extra}; only SQL {lost}"[:900]
