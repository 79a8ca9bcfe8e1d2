"""Run a registered query: ``python -m kestrel.plans KEY [DATA_DIR] [ROWS]``.

Without KEY, lists the keys (``*`` marks those with a DuckDB oracle).
"""

import sys

from ..session import get_session
from . import ORACLES, QUERIES


def main(argv: list[str]) -> int:
    if not argv:
        for key in sorted(QUERIES):
            print(("* " if key in ORACLES else "  ") + key)
        return 0
    key = argv[0]
    data_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    rows = int(argv[2]) if len(argv) > 2 else 20
    if key not in QUERIES:
        print(f"unknown key {key!r}; run without arguments for the list", file=sys.stderr)
        return 2
    spark = get_session()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[key](spark, data_dir).show(rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
