"""Run queries against their SQL: ``python tests/check_queries.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from stratalake.session import local_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    builders, oracles = queries(), oracle_sql()
    bad = 0
    con = connect(folder)
    for name in names or list(builders):
        begun = time.time()
        try:
            df = builders[name](spark, folder)
            if name in oracles:
                problems = differences(df, con, oracles[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = ["".join(traceback.format_exception_only(error))[:700]]
        bad += bool(problems)
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - begun:.1f}s", flush=True)
        for p in problems:
            print("     ", p[:900], flush=True)
    print(f"{bad} of {len(names or builders)} failed")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    where = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, args) else 0)
