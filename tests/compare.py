"""Run registered queries next to their SQL and report differences.

    python tests/compare.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


# DuckDB type names and the Spark types that carry the same values.
TYPE_NAMES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """Problems found: columns, types, then rows as multisets with exact values."""
    cols = sorted(spark_df.columns)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return [f"columns {cols} vs {sorted(names)}"]
    expected = [tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()]
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    spark_types = dict(spark_df.dtypes)
    problems = [
        f"type of {c}: {spark_types[c]} vs {types[c]}"
        for c in cols
        if TYPE_NAMES.get(types[c], types[c]) != spark_types[c]
    ]
    got = [tuple(r) for r in spark_df.select(*cols).collect()]
    a, b = Counter(got), Counter(expected)
    if a != b:
        only_a, only_b = list((a - b).elements()), list((b - a).elements())
        problems.append(f"rows {len(got)} vs {len(expected)}; {len(only_a)} only in Spark, {len(only_b)} only in SQL")
        key = lambda r: tuple((x is None, str(x)) for x in r)
        problems += [f"  {cols}"]
        problems += [f"  spark {r}" for r in sorted(only_a, key=key)[:3]]
        problems += [f"  sql   {r}" for r in sorted(only_b, key=key)[:3]]
    problems += [] if got else ["no rows"]
    return problems


def main() -> int:
    from zonecast.plans.catalog import CATALOG
    from zonecast.session import local_session

    sf, *names = sys.argv[1:] or ["0.01"]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    con = oracle_connection(sf_dir)
    failed = []
    for name in names or CATALOG:
        query, sql = CATALOG[name]
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if sql is None:
                rows = df.count()
                problems = [] if rows else ["no rows"]
                note = f"rows only: {rows}"
            else:
                problems = differences(df, con, sql)
                note = ""
        except Exception as exc:  # noqa: BLE001
            problems, note = [str(exc)[:1500]], ""
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
        failed += [name] if problems else []
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
