"""Run registered queries next to their SQL oracles and compare rows, columns and values.

    python tools/check_oracles.py [--distributed] [sf_dir] [name or prefix ...]

With --distributed no lookup is broadcast and keys of 20 rows count as hot.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskspark.catalog import oracles, queries  # noqa: E402
from riskspark.operators import lookups  # noqa: E402
from riskspark.session import local_session  # noqa: E402


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable", key=lambda s: s.astype(str)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if got[c].dtype != want[c].dtype}
    got, want = canonical(got), canonical(want)
    for c in got.columns:
        a, b = got[c], want[c]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = same.idxmin()
            return f"{(~same).sum()} values of {c}, first {a[i]!r} against {b[i]!r}"
    return f"types {kinds}" if kinds else None


def main() -> None:
    words = [w for w in sys.argv[1:] if w != "--distributed"]
    if len(words) < len(sys.argv) - 1:
        lookups.BROADCAST_ROWS, lookups.HOT_ROWS = -1, 20
    sf_dir = words[0] if words else "/root/testdata/sf0.01"
    wanted = tuple(words[1:])
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    sql, failed, total = oracles(), 0, 0
    for name, fn in queries().items():
        if wanted and not name.startswith(wanted):
            continue
        total += 1
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            spent = time.time() - start
            verdict = f"rows {len(got)}" if name not in sql else difference(got, con.execute(sql[name]).df())
            bad = (name in sql and verdict is not None) or (name not in sql and len(got) == 0)
        except Exception as e:  # report and go on with the next query
            spent, bad, verdict = time.time() - start, True, f"{type(e).__name__}: {str(e)[:600]}"
        failed += bad
        spark.catalog.clearCache()
        print(f"{'FAIL' if bad else 'ok  '} {name:34s} {spent:6.2f}s {verdict or ''}", flush=True)
    print(f"{total - failed} of {total} pass")


if __name__ == "__main__":
    main()
