"""Command line: python tests/check_all.py [folder] [query ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402

from churnkit.session import local_session  # noqa: E402


def main(folder="/root/testdata/sf0.001", *names):
    spark = local_session(8)
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names or queries:
        t = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, name, queries[name], oracles[name], folder)
            else:
                problems = [] if queries[name](spark, folder).count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        if problems:
            failed.append(name)
        print(f"{'FAIL' if problems else 'ok':5}{time.time() - t:6.1f}s {name}{'' if name in oracles else ' (rows)'} {problems or ''}", flush=True)
    print(f"{len(failed)} failed of {len(names or queries)}: {failed}")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
