"""Compare registered queries with their SQL: ``python tests/check.py [sf] [name part ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402
from terrier.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("check", master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.driver.host": "127.0.0.1"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            if name in sqls:
                got = compare(spark, con, fn, sqls[name], sf)
                ok = got["equal"] and got["names"] and not got["types"] and got["rows"][0] > 0
                print("ok " if ok else "BAD", name, got["rows"], got["seconds"], flush=True)
                if not ok:
                    bad.append(name)
                    print("    names", got["names"], "types", got["types"])
                    for pair in got["diff"]:
                        print("    ", str(pair[0])[:900], "\n     ", str(pair[1])[:900])
            else:
                t = time.time()
                n = fn(spark, sf).count()
                print("rows", name, n, round(time.time() - t, 2), flush=True)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print("ERR", name, str(e)[:1500], flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
