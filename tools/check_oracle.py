"""Run registered queries against their DuckDB oracle statements.

    python tools/check_oracle.py [sf_dir] [key ...]
"""
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from grainline import catalog, testing  # noqa: E402
from grainline.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(catalog.REGISTRY)
    spark = local_session()
    con = testing.duck(sf_dir)
    bad = 0
    for k in keys:
        fn, sql = catalog.REGISTRY[k]
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if sql is None:
                n = df.count()
                print(f"{k:36s} ROWS-ONLY {n} rows  {time.time() - t:.1f}s", flush=True)
                continue
            ok, msg = testing.compare(df, con, sql)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{k:36s} {'OK ' if ok else 'BAD'} {msg}  {time.time() - t:.1f}s", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
