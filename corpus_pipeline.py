"""The corpus pipeline: raw documents to token ids, five stages.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept and returns a DataFrame; all but the last return the columns they got.
``run`` applies them to the ``documents`` table.

Odd input: rows with null ids or texts, repeated rows and extra columns pass
through like others where no stage says otherwise; the first stage rejects
texts without a letter (null and empty ones too) and those that are mostly not
in a learned language (symbols, other scripts), the second keeps one row of
each group of near copies (the smallest id; a null id only if the group has no
other). An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import bpe, decontam, langid, secrets, simhash
from souk.llm.common import id_remainder, pinned, read_table

MIN_LIKENESS = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a language or with a doubtful one: with less
    than a quarter of the known letters that learned texts of the language have."""
    model = langid.fit(docs, F.coalesce(id_remainder(4) != 2, F.lit(False)), known=True)
    named = langid.predict(docs, model, lang_out="__lang__", score_out="__score__",
                           likeness_out="__likeness__")
    return named.filter((F.col("__lang__") != "und")
                        & (F.col("__likeness__") >= MIN_LIKENESS)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component."""
    # rows are told apart by their place in the scan, as ids may repeat
    rows = docs.withColumn("__row__", F.monotonically_increasing_id())
    ranked = rows.select("text", F.struct(F.col("doc_id").isNull(), "doc_id", "__row__")
                         .alias("__rank__"))
    groups = simhash.near_duplicates(ranked, shingle=4, max_bits=4, id_col="__rank__")
    first = groups.filter(F.col("id") == F.col("component_id")) \
        .select(F.col("id")["__row__"].alias("__row__"))
    return rows.join(first, "__row__", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; ``n_chars`` follows where a text changes."""
    found = secrets.scan(docs, secrets.fit(docs), base_out="__base__", all_out="__spans__")
    clean = found.withColumn("__clean__", secrets.redacted(F.col("text"), F.col("__spans__")))
    changed = F.size("__spans__") > 0
    columns = {c: F.col(c) for c in docs.columns} | {"text": F.col("__clean__").alias("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("__clean__").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars")
    return clean.select(*columns.values())


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    import public_tokenizers as P
    path = P.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs.select("doc_id", "text"), path, P.PATTERN, cut=True)
    back = bpe.decode(coded, path, out_col="__decoded__")
    return back.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                       "token_ids", (F.col("__decoded__") == F.coalesce("text", F.lit("")))
                       .alias("round_trip"))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("byte-level BPE encoding and decoding", tokenize),
]

# The stages learn models, follow links and match by edit distance, which SQL
# does not express; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each pinned before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
