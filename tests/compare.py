"""Strict comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def kind(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, (list, tuple)):
        return "list"
    return type(value).__name__


def canonical(value: object) -> str:
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, value types, row count and all values agree."""
    spark_names = sorted(df.columns)
    spark_rows = [[r[c] for c in spark_names] for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    duck_rows = [[r[i] for i in order] for r in result.fetchall()]
    if spark_names != sorted(names):
        return [f"columns {spark_names} != {sorted(names)}"]
    problems = []
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows {len(spark_rows)} != {len(duck_rows)}")
    for i, name in enumerate(spark_names):
        a = {kind(r[i]) for r in spark_rows} - {""}
        b = {kind(r[i]) for r in duck_rows} - {""}
        if a != b:
            problems.append(f"type of {name}: {a} != {b}")
    left = sorted("|".join(canonical(v) for v in r) for r in spark_rows)
    right = sorted("|".join(canonical(v) for v in r) for r in duck_rows)
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        problems.append(f"values: {[s[:400] for s in only_left]} != {[s[:400] for s in only_right]}")
    return problems
