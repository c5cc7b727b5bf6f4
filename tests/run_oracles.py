"""python -m tests.run_oracles [sf] [name ...] : compare queries with their SQL and print timings."""

import sys
import time

import __spark_entry__ as contract
from tarmac.session import build_session
from tests.oracle import compare, connect

if __name__ == "__main__":
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(**{"spark.master": "local[8]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), contract.oracle_sql()
    bad = 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                found = compare(df, con, oracles[name])
                rows = df.count() if found is None else -1
            else:
                found, rows = None, df.count()
        except Exception as error:  # report and go on with the next query
            found, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name:28} {rows:8} rows {time.time() - start:6.2f}s {found or ''}{'' if name in oracles else ' (no SQL)'}", flush=True)
    print("mismatches:", bad)
