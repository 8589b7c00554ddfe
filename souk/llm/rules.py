"""Quality rules: text statistics and a learned decision list, in Spark SQL.

Statistics are column expressions over one text at a time: no shuffle, no
Python. A base rule fails texts that are too short or mostly repetition. For
the others a decision list gives the verdict: it is learned from labelled
statistics by sequential covering. Each rule is a conjunction of thresholds,
grown on one part of the sample by information gain, pruned back on the other,
and kept if it is precise there; the rows it covers go, and the next rule is
grown. The list is emitted as one ordered conditional expression: a text that
meets a rule is rejected, any other is kept.

Learning reads a bounded sample (about ``sample_rows`` labelled documents,
picked by a hash of the id); their statistics are collected, a few numbers a row.

Results for odd input: a null text has no words, zero statistics and fails the
base rule. Unlabelled, repeated and conflicting labels are rows like any other
(a null label teaches nothing). Without labels the list is empty and keeps
whatever passes the base rule. Other columns stay; one named like an output is
replaced.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, WORD, let, sample_fraction, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_capitals", "n_marks", "n_digits", "n_lines")
FEATURES = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "words_a_line": "n_words / greatest(n_lines, 1)",
}


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeat_words(hashes: Column) -> Column:
    """Words in windows of WINDOW words that stand twice or more in a text.

    ``hashes`` has a 64-bit hash per word. Windows are compared by a hash built
    up from pairs, pairs of pairs and so on (WINDOW is a power of two). The positions of repeated ones, in order, cover WINDOW
    words each, less what the one before covers already.
    """
    none = F.lit(0).cast("long")

    def pairs(h: Column, step: int) -> Column:
        """Hashes of stretches twice as long: each with the one ``step`` on."""
        return F.zip_with(F.slice(h, 1, F.size(h) - step), F.slice(h, step + 1, F.size(h)),
                          lambda a, b: F.xxhash64(a, b))

    def windows(h: Column) -> Column:
        return F.when(F.size(h) > WINDOW, let(let(pairs(h, 1), lambda x: pairs(x, 2)),
                                              lambda x: pairs(x, 4))).otherwise(F.array(none))

    def covered(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, k: F.coalesce(
            F.get(ordered, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)))
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        # one pass: (last position, words so far)
        return F.aggregate(
            at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (
                acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n")))["n"]

    def repeated(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # most texts repeat no window: a set of the hashes tells
        return F.when(F.size(F.array_distinct(w)) < F.size(w), let(ordered, covered)) \
            .otherwise(none)

    return let(let(hashes, windows), repeated)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the COUNTS of each whole text as long columns."""
    t, words = "__text__", "__words__"
    df = docs.withColumn(t, text_of(text_col)) \
        .withColumn(words, F.regexp_extract_all(F.col(t), F.lit(WORD), F.lit(0)))
    text = F.col(t)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    counts = {
        "n_words": F.size(words),
        "word_chars": _without(text, BLANKS),
        "n_symbols": F.length(text) - _without(text, SYMBOLS),
        "n_capitals": F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", "")),
        "n_marks": F.length(text) - _without(text, "!?;|"),
        "n_digits": F.length(text) - _without(text, "0123456789"),
        "__lines__": lines,
        "__hashes__": F.transform(words, lambda w: F.xxhash64(w)),
    }
    df = df.withColumns(counts)
    df = df.withColumns({
        "n_lines": F.size("__lines__"),
        "n_dup_lines": F.size("__lines__") - F.size(F.array_distinct("__lines__")),
        "n_repeat_words": _repeat_words(F.col("__hashes__")),
    })
    return df.withColumns({c: F.col(c).cast("long") for c in COUNTS}) \
        .drop(t, words, "__lines__", "__hashes__")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


# ------------------------------------------------------------------- learning ----
@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        x = row[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        x = F.expr(FEATURES[self.feature])
        return x > self.threshold if self.above else x <= self.threshold


Rule = tuple[Test, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(t.holds(row) for t in rule)


def _tests(rows: list[dict], steps: int = 12) -> list[Test]:
    """Thresholds halfway between neighbouring values, at quantiles of each
    feature over all rows and over the bad ones (which may be rare)."""
    out = []
    for f in FEATURES:
        xs = sorted({r[f] for r in rows})
        few = sorted(r[f] for r in rows if r["bad"])
        at = {len(xs) * i // steps for i in range(1, steps)}
        for i in range(steps + 1):
            x = few[min(len(few) * i // steps, len(few) - 1)]
            at |= {bisect_left(xs, x), bisect_left(xs, x) + 1}
        cuts = sorted({(xs[k - 1] + xs[k]) / 2 for k in at if 0 < k < len(xs)})
        out += [Test(f, above, c) for c in cuts for above in (True, False)]
    return out


def _grow(rows: list[dict], bad: str) -> Rule:
    rule: list[Test] = []
    inside = rows
    while True:
        p = sum(r[bad] for r in inside)
        if not p or p == len(inside) or len(rule) == 4:
            return tuple(rule)
        here, best, gain = math.log2(p / len(inside)), None, 1e-9
        for t in _tests(inside):
            hit = [r for r in inside if t.holds(r)]
            q = sum(r[bad] for r in hit)
            g = q * (math.log2(q / len(hit)) - here) if q else 0.0
            if g > gain:
                best, gain, kept = t, g, hit
        if best is None:
            return tuple(rule)
        rule.append(best)
        inside = kept


def _worth(rule: Rule, rows: list[dict], bad: str) -> tuple[float, int]:
    """(share of covered rows that are bad, one good row added; covered)"""
    hit = [r for r in rows if covers(rule, r)]
    return sum(r[bad] for r in hit) / (len(hit) + 1), len(hit)


def learn_list(rows: list[dict], precision: float = 0.9, most: int = 12) -> list[Rule]:
    """Sequential covering; ``rows`` have FEATURES and a boolean ``bad``."""
    order = sorted(rows, key=lambda r: r["mix"])
    grow, prune = order[::3] + order[1::3], order[2::3]
    rules: list[Rule] = []
    while len(rules) < most and any(r["bad"] for r in grow):
        rule = _grow(grow, "bad")
        if not rule:
            break
        while len(rule) > 1 and _worth(rule[:-1], prune, "bad") >= _worth(rule, prune, "bad"):
            rule = rule[:-1]
        worth, covered = _worth(rule, prune, "bad")
        if covered < 3 or worth * (covered + 1) < precision * covered:
            break
        rules.append(rule)
        grow = [r for r in grow if not covers(rule, r)]
        prune = [r for r in prune if not covers(rule, r)]
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 5000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
          ) -> list[Rule]:
    """A list that rejects label 0, from the rows that pass the base rule."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("q")) \
        .filter("id is not null and q is not null")
    n = known.count()
    picked = known.filter(sample_fraction(F.lit(min(1.0, sample_rows / max(n, 1))), "id")) \
        .groupBy("id", "q").agg(F.count("*").alias("n")).limit(2 * sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    got = statistics(texts.join(F.broadcast(picked), "id")).filter(~base_failed()) \
        .select((F.col("q") == 0).alias("bad"), F.xxhash64("id").alias("mix"),
                *[F.expr(e).cast("double").alias(f) for f, e in FEATURES.items()]) \
        .limit(4 * sample_rows).collect()  # an id may stand on many rows
    return learn_list([r.asDict() for r in got])


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression: false for a text that a rule meets."""
    out = F.lit(True)
    for rule in reversed(rules):
        meets = F.lit(True)
        for t in rule:
            meets = meets & t.column()
        out = F.when(meets, F.lit(False)).otherwise(out)
    return out


def apply(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """Append COUNTS, ``base_failed`` and ``kept``."""
    return statistics(docs, text_col).withColumn("base_failed", base_failed()) \
        .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules)))
