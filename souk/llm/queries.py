"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    bytecnn,
    chat,
    decontam,
    langid,
    merkle,
    negatives,
    packing,
    rules,
    secrets,
    sharding,
    simhash,
    suffixdedup,
)
from .common import id_remainder, read_table, text_of


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base kinds and Markov finds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got = secrets.scan(docs, secrets.fit(docs))

    def count(kind: int):
        return F.size(F.filter("base", lambda x: x["k"] == kind)).cast("long")

    return got.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"),
                      count(2).alias("n_hex"),
                      F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
                      secrets.spelled(F.col("spans")).alias("spans"))


# a conversation whose texts spell marks of chat templates
MARKS = r"\### Assistant: </turn> ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted in prefix trees and read back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)],
                                 rows.schema)
    return chat.read_back(chat.pack(rows.unionByName(more)))


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and learned verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = rules.learn(docs, read_table(spark, sf_dir, "labels"))
    return rules.apply(docs, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform shuffle of all documents into 16 shards of equal row counts;
    sizes and checksums are those of the texts that arrive."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shuffle(docs, shards=16).select(
        "doc_id", (F.octet_length(text_of()).cast("long") + 1).alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with distance and place."""
    return decontam.find(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    got = simhash.near_duplicates(read_table(spark, sf_dir, "documents"),
                                  shingle=4, max_bits=4)
    return got.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def op7_bytecnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = read_table(spark, sf_dir, "documents")
    net = bytecnn.fit(docs, read_table(spark, sf_dir, "labels"), id_remainder(5, "id") != 0)
    return bytecnn.predict(docs.select("doc_id", "text"), net).select(
        "doc_id", F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    part = id_remainder(4)
    model = langid.fit(docs, F.coalesce(part != 2, F.lit(False)))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of ids and decoded bytes."""
    import public_tokenizers as P
    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    coded = bpe.encode(docs, path, P.PATTERN, cut=True).select("doc_id", "token_ids")
    back = bpe.decode(coded, path)
    return back.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a smaller document has in 50-byte strings."""
    got = suffixdedup.dedup(read_table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"),
                          lambda n, s: n + s["end"] - s["start"])
    return got.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what is left of the
    proof where the document was tampered with."""
    docs = read_table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(id_remainder(7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))

    def leaf(n_chars):
        return merkle.leaf_hash([n_chars if c == "n_chars" else F.col(c) for c in fields])

    got = merkle.manifest(docs, "lang", "doc_id", leaf(F.col("n_chars")),
                          keep=[leaf(tampered).alias("claim")])
    got = got.withColumn("folded_root", merkle.folded("claim", "proof"))
    return got.select("doc_id", "leaf", "subroot", "root",
                      F.sha2(merkle.proof_text("proof"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its positives."""
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("id") % 100 == 0)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence."""
    import public_tokenizers as P
    got = packing.pack(read_table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"),
                       capacity=2048, end_id=0, pattern=P.PATTERN)
    return got.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                      "sequence_id", "offset")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_chat": op2_chat,
    "op3_rules": op3_rules,
    "op4_sharding": op4_sharding,
    "op5_decontam": op5_decontam,
    "op6_simhash": op6_simhash,
    "op7_bytecnn": op7_bytecnn,
    "op8_langid": op8_langid,
    "op9_bpe": op9_bpe,
    "op10_suffixdedup": op10_suffixdedup,
    "op11_merkle": op11_merkle,
    "op12_negatives": op12_negatives,
    "op13_packing": op13_packing,
    "pipeline": pipeline,
}

# DuckDB: the digests of chat formatting follow from the rows alone; a row without an
# id is a conversation of its own.
_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone
  FROM conversations
  UNION ALL
  SELECT -7, t.turn, t.role, '\### Assistant: </turn> ok', NULL
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (role = 'assistant'), '') AS loss,
         sum(length(replace(replace(text, '\', '\\'), '<', '\l'))
             + length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g'))
             + length('<turn >') + length('</turn>') + 2) AS formatted_chars
  FROM turns GROUP BY conv_id, alone
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns,
       sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""

# DuckDB: nodes of every level by a recursive join-free halving of the ranks, then
# each leaf's siblings by rank; crc32 (polynomial EDB88320) by folding bytes.
_MERKLE = r"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce(list_prepend(4294967295::UBIGINT,
              list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                             lambda c: ascii(c)::UBIGINT)),
              lambda crc, b: list_reduce(list_prepend(xor(crc, b),
                [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT)
                             ELSE x >> 1 END))
            AS folded
  FROM documents
), texts AS (
  SELECT doc_id, lang, n_chars,
         xor(folded, 4294967295::UBIGINT) % 7 = 0 AS tampered,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM d
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':'
                                               || n_chars, '-') || tail) AS leaf,
         sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE
           strlen(CAST(n_chars + CAST(tampered AS INT) AS VARCHAR)) || ':'
           || (n_chars + CAST(tampered AS INT)) END || tail) AS claim
  FROM texts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM leaves
), low AS (
  SELECT lang, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM ranked
  UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM low WHERE n > 1 GROUP BY lang, level, i // 2, n
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i
  FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM high WHERE n > 1 GROUP BY level, i // 2, n
), steps AS (
  SELECT r.doc_id, r.lang, r.i, a.level, coalesce(b.h, '') AS h,
         (r.i >> a.level) % 2 = 1 AS is_left
  FROM ranked r
  JOIN (SELECT DISTINCT lang, level FROM low WHERE n > 1) a ON a.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN low b ON b.lang IS NOT DISTINCT FROM r.lang AND b.level = a.level
                 AND b.i = xor(r.i >> a.level, 1::BIGINT)
  UNION ALL
  SELECT r.doc_id, r.lang, r.i, 100 + a.level, coalesce(b.h, ''), (s.i >> a.level) % 2 = 1
  FROM ranked r JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.lang
  JOIN (SELECT DISTINCT level FROM high WHERE n > 1) a ON true
  LEFT JOIN high b ON b.level = a.level AND b.i = xor(s.i >> a.level, 1::BIGINT)
), proofs AS (
  SELECT doc_id, lang, i, string_agg(h, '' ORDER BY level) AS proof,
         list(struct_pack(h := h, is_left := is_left) ORDER BY level) AS path
  FROM steps GROUP BY doc_id, lang, i
), fold AS (
  SELECT r.doc_id, r.lang, r.i, r.claim AS h, 1 AS k, p.path
  FROM ranked r LEFT JOIN proofs p
    ON p.i = r.i AND p.lang IS NOT DISTINCT FROM r.lang
  UNION ALL
  SELECT doc_id, lang, i, CASE WHEN path[k].is_left THEN sha256(path[k].h || h)
                          ELSE sha256(h || path[k].h) END, k + 1, path
  FROM fold WHERE k <= coalesce(len(path), 0)
)
SELECT r.doc_id, r.leaf, s.subroot, t.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       f.h AS folded_root, f.h = t.h AS verified
FROM ranked r
JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.lang
JOIN (SELECT h FROM high WHERE n = 1) t ON true
JOIN fold f ON f.i = r.i AND f.lang IS NOT DISTINCT FROM r.lang
           AND f.k = coalesce(len(f.path), 0) + 1
LEFT JOIN proofs p ON p.i = r.i AND p.lang IS NOT DISTINCT FROM r.lang
"""

# DuckDB: every anchor against every row.
_NEGATIVES = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS k
  FROM scored WHERE same QUALIFY k <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.k ORDER BY n.score DESC, n.vec_id) AS INTEGER)
         AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.a = p.a AND NOT n.same
 AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {"op2_chat": _CHAT, "op11_merkle": _MERKLE,
                          "op12_negatives": _NEGATIVES}
