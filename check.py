"""Run proof queries and their SQL side by side: ``python check.py [sf] [name ...]``."""

import sys
import time
import traceback

import duckdb

from admere.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(None if v is None else (float(v) if isinstance(v, float) else v) for v in (r[i] for i in order))) for r in records)


def main(sf: str, names: list[str]) -> int:
    from admere.proofs import ORACLES, QUERIES

    folder = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            got, columns = [tuple(r) for r in df.collect()], df.columns
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows  {name:28s} {len(got):7d} {took:6.1f}s", flush=True)
                continue
            start = time.time()
            result = duck.execute(ORACLES[name])
            want_columns = [d[0] for d in result.description]
            want = result.fetchall()
            slow = time.time() - start
            a, b = rows(got, columns), rows(want, want_columns)
            ok = a == b and sorted(columns) == sorted(want_columns)
            print(f"{'ok   ' if ok else 'DIFF '} {name:28s} {len(a):7d} {len(b):7d} {took:6.1f}s {slow:6.1f}s", flush=True)
            if not ok:
                bad += 1
                print("   columns", sorted(columns))
                only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
                for x, y in list(zip(only_a, only_b))[:3] or [(only_a[:2], only_b[:2])]:
                    print("   spark", str(x)[:900], "\n   duck ", str(y)[:900])
        except Exception:
            bad += 1
            print(f"FAIL  {name}", flush=True)
            print("   ", "\n    ".join(traceback.format_exc().splitlines()[-12:])[:1500])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:]) > 0)
