"""Run every registered query at one scale next to its SQL twin: ``python tests/check_all.py [names]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.session import assert_same_rows, build_session, duckdb_tables  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    spark, tables = build_session(), duckdb_tables(sf_dir)
    oracle, queries = entry.oracle_sql(), entry.queries()
    for name in sys.argv[1:] or queries:
        started = time.perf_counter()
        try:
            result = queries[name](spark, sf_dir)
            if name in oracle:
                assert_same_rows(result, tables.execute(oracle[name]).df())
                verdict = "same"
            else:
                verdict = f"{result.count()} rows, no SQL"
        except Exception as problem:  # report and go on
            verdict = f"FAILED {type(problem).__name__}: {str(problem)[:700]}"
        print(f"{name:28s} {time.perf_counter() - started:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
