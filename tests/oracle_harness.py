"""Run registered Spark queries next to their DuckDB oracles and compare.

Mirrors the driver's check: row count, column names and an
order-insensitive hash of the values (columns sorted by name).

    python -m tests.oracle_harness [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], lines, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            results[name] = ("spark-error", str(exc)[:400])
            if verbose:
                print(f"{name}: SPARK ERROR {type(exc).__name__}: {exc}"[:800])
            continue
        dt = time.time() - t0
        if name not in oracles:
            results[name] = ("rows-only", len(s_rows))
            if verbose:
                print(f"{name}: rows-only {len(s_rows)} rows {dt:.1f}s")
            continue
        try:
            cur = con.execute(oracles[name])
            d_cols = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[name] = ("oracle-error", repr(exc)[:400])
            if verbose:
                print(f"{name}: ORACLE ERROR {exc!r}"[:600])
            continue
        sc, sl, sh = canon(s_cols, s_rows)
        dc, dl, dh = canon(d_cols, d_rows)
        ok = sc == dc and len(sl) == len(dl) and sh == dh
        results[name] = ("match" if ok else "MISMATCH", len(s_rows), len(d_rows))
        if verbose:
            print(f"{name}: {'match' if ok else 'MISMATCH'} spark={len(s_rows)} duck={len(d_rows)} {dt:.1f}s")
            if not ok:
                if sc != dc:
                    print("   cols spark", sc, "\n   cols duck ", dc)
                a, b = set(sl), set(dl)
                for x in sorted(a - b)[:3]:
                    print("   spark-only", x[:300])
                for x in sorted(b - a)[:3]:
                    print("   duck-only ", x[:300])
    return results


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from orderlens.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("match", "rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
