"""Run registered queries beside their SQL and compare rows as bags.

    python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import decimal
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda place: names[place])
    return Counter(tuple(plain(row[place]) for place in order) for row in rows)


def connect(sf: str):
    import duckdb

    base = duckdb.connect()
    for name in TABLES:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return base


def differences(spark, base, sf: str, build, sql: str | None) -> tuple[str, int]:
    """Empty text when equal; otherwise what differs. Also the number of rows."""
    frame = build(spark, sf)
    got = frame.collect()
    if sql is None:
        return "", len(got)
    result = base.execute(sql)
    names = [column[0] for column in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}", len(got)
    left, right = bag(frame.columns, got), bag(names, want)
    if left == right:
        return "", len(got)
    extra, lacking = left - right, right - left
    return (
        f"{len(got)} rows against {len(want)}; only Spark {sum(extra.values())}: "
        f"{list(extra)[:2]}; only SQL {sum(lacking.values())}: {list(lacking)[:2]}"
    ), len(got)


def main() -> int:
    from feedloom.plans.registry import oracle_sql, queries
    from feedloom.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    base = connect(sf)
    wanted, statements = queries(), oracle_sql()
    failed = 0
    for name in sys.argv[2:] or wanted:
        begun = time.time()
        try:
            text, rows = differences(spark, base, sf, wanted[name], statements.get(name))
        except Exception as error:  # noqa: BLE001
            text, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0
        failed += bool(text)
        label = "DIFF" if text else ("ok" if name in statements else "rows")
        print(f"{label:5}{name:24}{rows:8} rows {time.time() - begun:6.2f} s {text}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
