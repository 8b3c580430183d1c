"""Compare queries with their SQL: python check.py [sf_dir] [query ...]"""

from __future__ import annotations

import sys
import time

from feedlake.plans import catalog
from feedlake.session import build_session
from tests.oracle import connect, difference


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(catalog())
    spark = build_session(
        "check", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8",
                                "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        query = catalog()[name]
        start = time.time()
        try:
            frame = query.run(spark, sf_dir).toPandas()
            mid = time.time()
            wrong = difference(frame, con.execute(query.sql).df()) if query.sql else None
            took = f"{mid - start:.1f}s spark {time.time() - mid:.1f}s sql {len(frame)} rows"
        except Exception as e:  # report and go on with the next query
            wrong, took = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += wrong is not None
        print("ok  " if wrong is None else "BAD ", name, took, wrong or "", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
