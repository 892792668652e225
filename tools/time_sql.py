"""Time the SQL twins of the headline queries on DuckDB, one process, as a single-node yardstick.

    python tools/time_sql.py [data folder]
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bench import HEADLINE  # noqa: E402
from tools.check_queries import views  # noqa: E402
from workload.queries import SQL  # noqa: E402


def main() -> None:
    con = views(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
    con.execute("SET threads = 8")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(3):
            start = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {SQL[name]}")
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({"value": round(sum(seconds.values()), 3), "queries": seconds}))


if __name__ == "__main__":
    main()
