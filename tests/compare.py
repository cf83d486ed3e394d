"""Compare a registered query with its DuckDB SQL: column names, row count and values in any order."""

from __future__ import annotations

import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return float(value) if isinstance(value, Decimal) and value % 1 else int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda n: names[n])
    return sorted((tuple(_plain(row[n]) for n in order) for row in rows), key=repr)


def spark_side(frame):
    return sorted(frame.columns), _rows([tuple(row) for row in frame.collect()], frame.columns)


def duck_side(con, sql):
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), _rows(cursor.fetchall(), names)


def differences(left, right, limit=3):
    if left[0] != right[0]:
        return f"columns differ: {left[0]} / {right[0]}"
    if left[1] == right[1]:
        return None
    only_left = [row for row in left[1] if row not in set(right[1])][:limit]
    only_right = [row for row in right[1] if row not in set(left[1])][:limit]
    return f"{len(left[1])} / {len(right[1])} rows; only Spark: {only_left}; only SQL: {only_right}"
