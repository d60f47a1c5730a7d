"""All queries against DuckDB over one folder of tables: ``python tests/check_oracle.py [folder] [names]``."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from oracle import connect, duck_rows, spark_rows  # noqa: E402

import bench  # noqa: E402
from strata.queries import registry  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picked = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark, duck, wrong = bench.session("8"), connect(folder), 0
    for name, (run, sql) in registry().items():
        if picked and name not in picked:
            continue
        started = time.perf_counter()
        result = run(spark, folder)
        found = spark_rows(result)
        seconds = time.perf_counter() - started
        expected = duck_rows(duck, sql) if sql else None
        verdict = "rows only" if sql is None else "ok" if found == expected else "DIFFERENT"
        wrong += verdict == "DIFFERENT"
        print(f"{name:24} {verdict:10} {len(found[1]):8} rows {seconds:7.2f} s", flush=True)
        if verdict == "DIFFERENT":
            print("  columns", found[0], expected[0], "rows", len(found[1]), len(expected[1]))
            pairs = [p for p in zip(found[1], expected[1]) if p[0] != p[1]]
            print("  ", pairs[:3])
    return wrong


if __name__ == "__main__":
    sys.exit(main())
