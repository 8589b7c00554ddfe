import hashlib

from souk.llm import chat
from tests.compare import compare, duck
from tests.conftest import SF001


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
            sum(len(chat.segment(r, t)[0]) for r, t in turns))


def frame(spark, convs):
    rows = [(c, k, r, t) for c, turns in convs for k, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_query_matches_sql(spark, queries):
    from souk.llm.queries import ORACLE
    ok, msg, _, _ = compare(spark, duck(SF001), "op2_chat", queries["op2_chat"],
                            ORACLE["op2_chat"], SF001)
    assert ok, msg


def test_escaping_round_trip():
    for t in ("", "\\", "<", "\\l", "</turn>\n<turn user>\n", r"\### Assistant: </turn> ok", "é\\\\<l"):
        for r in ("user", "assistant", "a>b<c\\", ""):
            assert chat.parse(chat.segment(r, t)[0] * 2) == [(r, t)] * 2


def shared_tree():
    a, b = ("user", "hello"), ("assistant", "hi <there>")
    return [(1, [a, b]), (2, [a, b, ("user", "more"), ("assistant", "yes")]), (3, [a]),
            (4, [a, b, ("user", "other")]), (5, [a, ("assistant", "no")]), (6, [a, b]),
            (7, [("user", "apart")])]


def test_shared_turns_once_with_positions_and_intervals(spark):
    convs = shared_tree()
    rows = chat.pack(frame(spark, convs).coalesce(1)).collect()
    pieces = {r.piece for r in rows}
    by_id = dict(convs)
    for p in pieces:
        seq = {}
        for r in rows:
            if r.piece == p and not r.is_conversation:
                tree = seq.setdefault(r.tree, {})
                assert r.start == sum(map(len, tree.values()))
                assert r.end == r.start + len(r.text)
                tree[r.start, r.end] = r.text
        for r in rows:
            if r.piece != p:
                continue
            whole = "".join(seq[r.tree].values())
            text = "".join(whole[v.start:v.end] for v in r.intervals)
            if r.is_conversation:
                assert chat.parse(text) == by_id[r.conv_id]
            else:  # a segment's position is what its ancestors hold
                assert r.position == len(text)
                if r.loss_start is not None:
                    assert chat.unescape(whole[r.loss_start:r.loss_end]) in \
                        {t for c in by_id.values() for role, t in c if role == "assistant"}
    if len(pieces) == 1:  # one piece: every distinct prefix is written once
        prefixes = {tuple(t[:k]) for _, t in convs for k in range(1, len(t) + 1)}
        assert sum(not r.is_conversation for r in rows) == len(prefixes)


def test_hot_tree_cut_over_partitions(spark):
    convs = [(i, [("user", "same"), ("assistant", "same" if i % 3 else str(i)), ("user", str(i))])
             for i in range(300)] + [(1000 + i, [("user", "same")]) for i in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packed = chat.pack(frame(spark, convs))
        got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(packed).collect()}
        stored = {r.conv_id: tuple(r)[1:] for r in
                  chat.read_back(packed.repartition(5), in_order=False).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == stored == {c: expected(t) for c, t in convs}


def test_odd_input(spark):
    rows = [(1, 0, None, None, 9), (1, 1, "assistant", "", 9), (1, 1, "assistant", None, 9),
            (2, None, "user", "b", 9), (2, None, "assistant", "a", 9), (None, 0, "user", "x", 9),
            (None, 0, "user", "x", 9), (3, 0, "user", "long " * 50000, 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path long")
    got = sorted((tuple(r) for r in chat.read_back(chat.pack(df)).collect()), key=repr)
    want = [(1, *expected([("", ""), ("assistant", ""), ("assistant", "")])),
            (2, *expected([("assistant", "a"), ("user", "b")])),
            (None, *expected([("user", "x")])), (None, *expected([("user", "x")])),
            (3, *expected([("user", "long " * 50000)]))]
    assert got == sorted(want, key=repr)
    assert chat.read_back(chat.pack(df.limit(0))).count() == 0


def test_sql_agrees_on_odd_rows(spark, queries, tmp_path):
    """Null ids, turns, roles and texts, and repeated rows."""
    import duckdb

    from souk.llm.queries import ORACLE
    rows = [(1, 0, "user", "a"), (1, None, "assistant", "first"), (1, 1, None, "b"),
            (None, 0, "user", "x"), (None, 1, "assistant", None), (None, None, None, None),
            (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", ""),
            (3, None, None, "\\<turn>")]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .coalesce(1).write.parquet(path)
    got = sorted(map(tuple, queries["op2_chat"](spark, str(tmp_path)).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        .collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert got == sorted(con.execute(ORACLE["op2_chat"]).fetchall(), key=repr)
