"""Run registered queries against their SQL twins: ``python tests/compare.py SF [name part ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session():
    from annoframe.session import build

    spark = build(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=_key)


def compare(df, con, text) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(text)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = df.collect()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0][0]} against {bad[0][1]}"
    return None


def main() -> None:
    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    parts = sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    twins = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in twins:
                what = compare(df, con, twins[name])
                n = f"equal, {len(con.execute(twins[name]).fetchall())} rows"
            else:
                n, what = f"{len(df.collect())} rows (no twin)", None
        except Exception as e:  # noqa: BLE001
            what, n = f"{type(e).__name__}: {str(e)[:1200]}", ""
        if what:
            failed.append(name)
        print(f"{'FAIL' if what else 'ok  '} {name} {time.time() - t0:.1f}s {what or n}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
