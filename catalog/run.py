"""Run registered queries and time them: ``python -m catalog.run SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time

from catalog import QUERIES
from proxysift import build_session


def main(sf_dir: str, *names: str) -> None:
    spark = build_session("catalog", "local[8]", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        start = time.time()
        rows = QUERIES[name](spark, sf_dir).count()
        print(f"{name:32s} {rows:8d} rows {time.time() - start:6.2f} s", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
