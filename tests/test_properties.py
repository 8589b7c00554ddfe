"""Property tests: duplicate flagging and the message rules against a plain
Python brute force over random small tables (NULL keys and exact copies)."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from souk.operators.dedupe import flag_duplicates
from souk.plans import pipeline as P
from souk.plans import quality as Q

RAW = ("product_id string, product_category_name string, product_name_lenght int, "
       "product_description_lenght int, product_photos_qty int, product_weight_g int, "
       "product_length_cm int, product_height_cm int, product_width_cm int")

maybe = lambda s: st.one_of(st.none(), s)
row = st.tuples(maybe(st.sampled_from(["a", "b", "c"])), maybe(st.sampled_from(["X", "Y"])),
                st.just(5), st.just(5), maybe(st.integers(0, 3)),
                maybe(st.integers(-2, 2)), st.integers(-1, 2), st.integers(-1, 2),
                st.integers(-1, 2))
tables = st.lists(row, min_size=1, max_size=25).flatmap(
    lambda rows: st.lists(st.sampled_from(rows), min_size=0, max_size=10)
    .map(lambda extra: rows + extra))              # add exact copies


def as_table(spark, rows):
    path = tempfile.mkdtemp(prefix="souk-prop-") + "/t"
    spark.createDataFrame(rows, RAW).write.parquet(path)
    return spark.read.parquet(path)


def sort_key(r):
    """Ascending, NULLs first (the documented tie-break)."""
    return tuple((v is not None, v if v is not None else 0) for v in r)


def brute_messages(rows):
    seen, out = set(), []
    for r in sorted(rows, key=sort_key):
        dup = r[0] in seen
        seen.add(r[0])
        pid, cat, _, _, _, w, ln, h, wd = r
        parts = [cat is None and "Product category name is null; ",
                 pid is None and "Product id is null; ",
                 w is not None and w < 0 and "Product weight is negative; ",
                 ln < 0 and "Product length is negative; ",
                 h < 0 and "Product height is negative; ",
                 dup and "Duplicate product; ",
                 wd < 0 and "Product width is negative; "]
        msg = "".join(p for p in parts if p) or None
        out.append((r, msg))
    return sorted(out, key=lambda x: (sort_key(x[0]), x[1] or ""))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(tables)
def test_duplicate_flags_and_messages_match_brute_force(spark, rows):
    df = as_table(spark, rows)
    flagged = flag_duplicates(df, ["product_id"], "dup").collect()
    n_keys = len({r[0] for r in rows})
    assert sum(not r.dup for r in flagged) == n_keys
    assert len(flagged) == len(rows)
    staged = P.stage(df, Q.PRODUCTS, 1)
    got = sorted(((tuple(r[:9]), r.error_flags) for r in
                  P.validate_staged(staged, Q.PRODUCTS).collect()),
                 key=lambda x: (sort_key(x[0]), x[1] or ""))
    assert got == brute_messages(rows)
