"""Run a registered query from the command line.

    python -m souk                       # list the keys
    python -m souk <key> [data_dir] [n]  # show the first n rows (default 20)
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    from .catalog import QUERIES
    if len(argv) < 2:
        print("\n".join(QUERIES))
        return 0
    key = argv[1]
    if key not in QUERIES:
        print(f"unknown key {key!r}; run without arguments to list them", file=sys.stderr)
        return 2
    root = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
    n = int(argv[3]) if len(argv) > 3 else 20
    from .session import local_session
    spark = local_session()
    QUERIES[key](spark, root).show(n, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
