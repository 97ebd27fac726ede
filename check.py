"""Run registered queries and compare them with their SQL: python check.py [folder] [name part ...]"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd

from massloom import build_session
from massloom.catalog.inputs import TABLES
from massloom.catalog.registry import oracle_sql, queries


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA:
            return None
        if isinstance(v, float):
            return None if v != v else (float(f"{v:.9g}") + 0.0)
        if isinstance(v, pd.Timestamp):
            return str(v.tz_localize(None) if v.tzinfo else v)
        if hasattr(v, "item"):
            return cell(v.item())
        if type(v).__name__ == "Decimal":
            return float(v)
        return float(v) if isinstance(v, int) and not isinstance(v, bool) else v

    rows = [tuple(cell(v) for v in r) for r in df.astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = [a for a in sys.argv[2:] if not a.startswith("-")]
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    oracles, bad = oracle_sql(), []
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            got = fn(spark, folder).toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"ROWS  {name} {len(got)} {took:.1f}s", flush=True)
                continue
            want = con.execute(oracles[name]).df()
            if sorted(got.columns) != sorted(want.columns):
                bad.append(name)
                print(f"COLS  {name} {sorted(got.columns)} {sorted(want.columns)}", flush=True)
                continue
            a, b = normal(got), normal(want)
            ok = a == b
            print(f"{'ok   ' if ok else 'DIFF '} {name} {len(a)} {len(b)} {took:.1f}s", flush=True)
            if not ok:
                bad.append(name)
                sa, sb = set(map(repr, a)), set(map(repr, b))
                print("   columns", sorted(got.columns))
                print("   spark only", len(sa - sb), sorted(sa - sb)[:3])
                print("   sql only  ", len(sb - sa), sorted(sb - sa)[:3], flush=True)
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            text = str(error).split("JVM stacktrace")[0]
            print(f"FAIL  {name} {type(error).__name__} {text[:900]}", flush=True)
            if "--trace" in sys.argv:
                traceback.print_exc()
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
