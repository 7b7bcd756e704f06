"""Run registered queries against their SQL and print what differs.

``python tests/check_queries.py SF_DIR [NAME ...]``
"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import connect, differences  # noqa: E402

from releasecat.registry import ORACLES, QUERIES  # noqa: E402
from releasecat.session import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = differences(df, connection, ORACLES[name])
                note = "ok"
            else:
                problems, note = [], f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problems, note = [str(error)[:1500]], ""
            if len(names) == 1:
                traceback.print_exc()
        failed += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s {note if not problems else 'FAILED'}", flush=True)
        for problem in problems:
            print("    ", problem, flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
