"""Run registered queries against their SQL on the same tables.

``python tests/oracle.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, query, sql):
    """Empty string if the two agree, else what differs."""
    df = query(spark, folder)
    mine = canonical(df.columns, df.collect())
    result = con.execute(sql)
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    different = [pair for pair in zip(mine[1], theirs[1]) if pair[0] != pair[1]]
    return f"{len(different)} rows differ, first {different[0]}" if different else ""


def main(folder, names):
    import __spark_entry__ as entry
    from quernel.session import get_spark

    spark = get_spark("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    con = connect(folder)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, folder, query, oracles[name]) or "ok"
            else:
                verdict = f"ok (rows only: {len(query(spark, folder).collect())})"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {str(error)[:1500]}"
        failed += not verdict.startswith("ok")
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
