"""Check named queries against their SQL: ``python tests/run_checks.py FOLDER [NAME …]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rillmart import config  # noqa: E402
from rillmart.fixtures.oracle import ORACLES  # noqa: E402
from rillmart.fixtures.queries import QUERIES  # noqa: E402
from tests.checking import compare, connect  # noqa: E402


def main() -> int:
    folder, *wanted = sys.argv[1:]
    spark = config.session("checks", **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name, query in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.time()
        try:
            problems = compare(query(spark, folder), connection, ORACLES[name]) if name in ORACLES else ["no SQL"]
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - began:.1f}s {'; '.join(problems)}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
