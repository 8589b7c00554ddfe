"""Write ``.explain("formatted")`` of every registered key to a folder.

Usage: python tools/plans.py [data_dir] [out_dir]
Keys that write while being built (etl_end_to_end, etl_published) are skipped.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.getcwd(), "plans")
    os.makedirs(out, exist_ok=True)
    from souk.catalog import QUERIES, WRITING_KEYS
    from souk.session import local_session
    spark = local_session()
    for key, fn in QUERIES.items():
        if key in WRITING_KEYS:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, data).explain("formatted")
        with open(os.path.join(out, f"{key}.txt"), "w") as f:
            f.write(buf.getvalue())
    print(f"plans written to {out}")


if __name__ == "__main__":
    main()
