"""Secret scan: base patterns plus character Markov models, in Spark SQL.

Base kinds, each matched leftmost and without overlaps within the kind:
``assign`` (a credential name, a sign and a value of 12 characters or more),
``access`` (AKIA keys of 18 or more) and ``hex`` (runs of 16 or more).

The ``markov`` kind adds runs of 16 or more token characters that no base span
touches and that read like random text: two first-order character models, one
of random strings and one of ordinary words and identifiers, are trained from
labelled samples, and a run is reported where its log-likelihood ratio passes
``log_odds``.

All of it is column expressions; nothing shuffles but the training counts (at
most 2 x 67 x 67 of them are collected). The training sample is bounded:
about ``sample_docs`` distinct texts, picked by a hash of the text.

Results for odd input: a null text has no span and stays null when redacted;
offsets are code points, ends exclusive; repeated rows get equal results; an
empty table trains on the random strings alone, which changes nothing. Other
columns stay; one named like an output is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, sample_fraction, text_of

# The three base patterns.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
# A greedy run that is long enough is the same run asked for with its least
# length, so the two plain kinds carry the length in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
RUN = "[A-Za-z0-9+/_=-]"
SPAN = "array<struct<s:int,k:int,e:int>>"
BLOCK = 256  # spans that are gathered, or cut from the text, at a time


def _span(s: Column, k: Column, e: Column) -> Column:
    return F.struct(s.alias("s"), k.alias("k"), e.alias("e"))


def _none() -> Column:
    return F.array().cast(SPAN)


def swept(items: Column, state: Column, step) -> Column:
    """One pass over an array: ``step(state, item)`` gives the next state and the
    spans that the item adds. Struct of the last state and all spans (``out``).

    Appending copies what it appends to, so spans are gathered BLOCK items at a
    time and joined once at the end.
    """
    def add(acc: Column, x: Column) -> Column:
        state, more = step(acc["state"], x)
        return let(F.struct(state.alias("state"), more.alias("more")), lambda got: F.struct(
            got["state"].alias("state"), F.concat(acc["out"], got["more"]).alias("out")))

    def block(acc: Column, some: Column) -> Column:
        begin = F.struct(acc["state"].alias("state"), _none().alias("out"))
        return let(F.aggregate(some, begin, add), lambda got: F.struct(
            got["state"].alias("state"),
            F.concat(acc["out"], F.array(got["out"])).alias("out")))

    def all_of(xs: Column) -> Column:
        last = F.greatest(F.floor((F.size(xs) - 1) / BLOCK).cast("int"), F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last),
                             lambda b: F.slice(xs, b * BLOCK + 1, F.lit(BLOCK)))
        begin = F.struct(state.alias("state"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return let(F.aggregate(blocks, begin, block), lambda got: F.struct(
            got["state"].alias("state"), F.flatten(got["out"]).alias("out")))

    return let(items, all_of)


def _located(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Spans of all matches: the text between matches gives their offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ok = F.transform(found, lambda m: F.lit(True)) if keep is None else keep
    between = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.filter(F.arrays_zip(between.alias("gap"), F.transform(found, F.length).alias("len"),
                                  ok.alias("ok")), lambda z: z["len"].isNotNull())

    def step(at: Column, z: Column) -> tuple[Column, Column]:
        s = at + z["gap"]
        e = s + z["len"]
        return e, F.when(z["ok"], F.array(_span(s, F.lit(kind), e))).otherwise(_none())

    return F.when(text.rlike(pattern), swept(steps, F.lit(0), step)["out"]).otherwise(_none())


def base_spans(text: Column) -> Column:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_value = F.transform(values, lambda v: F.length(v) >= 12)
    return F.sort_array(F.concat(_located(text, ASSIGN, 0, long_value),
                                 _located(text, ACCESS, 1), _located(text, HEX, 2)))


# ------------------------------------------------------------------- training ----
def random_strings(spark: SparkSession, n: int = 3000) -> DataFrame:
    """Labelled random strings in the usual spellings of keys."""
    seed = F.sha2(F.col("id").cast("string"), 256)
    raw = F.base64(F.unhex(seed))
    kinds = [F.regexp_replace(raw, "=", ""), F.translate(F.regexp_replace(raw, "=", ""), "+/", "-_"),
             F.substring(seed, 1, 40), F.upper(F.substring(seed, 1, 32)),
             F.upper(F.regexp_replace(raw, "[^A-Za-z0-9]", ""))]
    return spark.range(n).select(F.explode(F.array(*kinds)).alias("sample"),
                                 F.lit(True).alias("random"))


def ordinary_strings(docs: DataFrame, text_col: str = "text",
                     sample_docs: int = 400) -> DataFrame:
    """Words and identifiers of a bounded sample of texts, base spans cut out;
    neighbouring words are also joined the ways identifiers are."""
    texts = docs.select(text_of(text_col).alias("t"))
    share = min(1.0, sample_docs / max(docs.count(), 1))
    t = F.col("t")
    for p in (ASSIGN, ACCESS, HEX):
        t = F.regexp_replace(t, p, " ")
    picked = texts.filter(sample_fraction(F.lit(share), "t")).distinct().limit(2 * sample_docs)
    words = picked.select(F.regexp_extract_all(t, F.lit(RUN + "{3,}"), F.lit(0)).alias("w"))
    at = F.sequence(F.lit(0), F.size("w") - 2)
    joined = F.transform(at, lambda i: F.element_at(F.array(
        F.concat_ws("_", F.get("w", i), F.get("w", i + 1)),
        F.upper(F.concat_ws("_", F.get("w", i), F.get("w", i + 1))),
        F.concat_ws("-", F.get("w", i), F.get("w", i + 1)),
        F.upper(F.concat(F.get("w", i), F.get("w", i + 1))),
        F.concat(F.get("w", i), F.initcap(F.get("w", i + 1))),
        F.concat_ws("/", F.get("w", i), F.get("w", i + 1)),
        F.concat(F.get("w", i), F.lit("---===___+++==="))), i % 7 + 1))
    both = F.when(F.size("w") > 1, F.concat("w", joined)).otherwise(F.col("w"))
    return words.select(F.explode(both).alias("sample"), F.lit(False).alias("random"))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each character pair, row by row of ALPHABET.

    ``samples`` has a string ``sample`` and a boolean ``random``; pairs with a
    character outside the alphabet are not counted. Half a count is added to
    every pair.
    """
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("sample") - 1),
                                 lambda i: F.col("sample").substr(i, F.lit(2))))
    rows = samples.filter(F.length("sample") > 1).select("random", pair.alias("p")) \
        .filter(F.col("p").rlike(f"^{RUN}{{2}}$")).groupBy("random", "p").count().collect()
    n = len(ALPHABET)
    model = {}
    for label in (True, False):
        got = {r["p"]: r["count"] for r in rows if r["random"] == label}
        for a in ALPHABET:
            counts = [got.get(a + b, 0) + 0.5 for b in ALPHABET]
            total = sum(counts)
            model[label, a] = [math.log(c / total) for c in counts]
    return [x - y for a in ALPHABET
            for x, y in zip(model[True, a], model[False, a], strict=True)][:n * n]


def log_ratio(word: Column, ratios: list[float]) -> Column:
    """Sum of the pair ratios along a word of ALPHABET characters."""
    n = len(ALPHABET)
    table = F.split(F.lit(" ".join(f"{r:.6f}" for r in ratios)), " ").cast("array<double>")
    codes = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.aggregate(
        codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(
            c.alias("last"),
            (acc["sum"] + F.when(acc["last"] < 0, F.lit(0.0))
             .otherwise(F.get(table, acc["last"] * n + c))).alias("sum")))["sum"]


# ----------------------------------------------------------------------- scan ----
def scan(docs: DataFrame, ratios: list[float], text_col: str = "text",
         log_odds: float = 12.0, least: int = 16, base_out: str = "base",
         all_out: str = "spans") -> DataFrame:
    """Append ``base_out`` and ``all_out``: arrays of (s, k, e), start, number
    in KINDS, end, ordered by start and kind."""
    text = text_of(text_col)
    run = f"{RUN}{{{least},}}"
    words = F.regexp_extract_all(text, F.lit(run), F.lit(0))
    random = F.transform(words, lambda w: log_ratio(w, ratios) > log_odds)
    more = _located(text, run, 3, random)

    none = F.lit(None).cast("struct<s:int,k:int,e:int>")

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        # a run waits until the next span shows that no base span touches it
        run, end = state["run"], state["end"]
        is_run = x["k"] == KINDS.index("markov")
        stays = run.isNotNull() & (is_run | (x["s"] >= run["e"]))
        return (F.struct(F.when(is_run, end).otherwise(F.greatest(end, x["e"])).alias("end"),
                         F.when(is_run & (x["s"] >= end), x).alias("run")),
                F.concat(F.when(stays, F.array(run)).otherwise(_none()),
                         F.when(is_run, _none()).otherwise(F.array(x))))

    def joined(base: Column, runs: Column) -> Column:
        begin = F.struct(F.lit(0).alias("end"), none.alias("run"))
        both = let(swept(F.sort_array(F.concat(base, runs)), begin, step), lambda got: F.concat(
            got["out"], F.when(got["state"]["run"].isNotNull(), F.array(got["state"]["run"]))
            .otherwise(_none())))
        return F.when(F.size(runs) == 0, base).when(F.size(base) == 0, runs).otherwise(both)

    return docs.withColumn(base_out, base_spans(text)) \
        .withColumn(all_out, let(more, lambda runs: joined(F.col(base_out), runs)))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``."""
    def step(last: Column, x: Column) -> tuple[Column, Column]:
        apart = x["s"] >= last["e"]  # the first one too: no stretch ends at 0
        return (_span(F.when(apart, x["s"]).otherwise(last["s"]), F.lit(0),
                      F.when(apart, x["e"]).otherwise(F.greatest(last["e"], x["e"]))),
                F.when(apart & (last["e"] > 0), F.array(last)).otherwise(_none()))

    def parts(cuts: Column) -> Column:
        """The text between the stretches; substr counts from the start of its
        text, so a block of parts is cut out first."""
        n = F.size(cuts)

        def left(i: Column) -> Column:
            return F.coalesce(F.get(cuts, i - 1)["e"], F.lit(0))

        def right(i: Column) -> Column:
            return F.coalesce(F.get(cuts, i)["s"], F.length(text))

        def block(b: Column) -> Column:
            first, last = b * BLOCK, F.least(b * BLOCK + BLOCK - 1, n)
            return let(text.substr(left(first) + 1, right(last) - left(first)),
                       lambda t: F.transform(F.sequence(first, last), lambda i: t.substr(
                           left(i) - left(first) + 1, right(i) - left(i))))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int")), block))

    merged = let(swept(spans, _span(F.lit(0), F.lit(0), F.lit(0)), step),
                 lambda got: F.concat(got["out"], F.array(got["state"])))
    return F.when(F.size(spans) > 0, F.array_join(let(merged, parts), mark)).otherwise(text)


def fit(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Ratios from the random strings and the corpus's own ordinary strings."""
    return train(random_strings(docs.sparkSession).unionByName(ordinary_strings(docs, text_col)))
