"""Language identification by hierarchical discrimination.

A text's features are the square roots of its letter n-gram counts (two and
three bytes of the lower-cased text, hashed), scaled to length one. Linear
support vector machines, one for each pair of families, choose the family;
one for each pair of its languages then choose among closely related ones.
Each pairwise machine votes for a side; the sum of margins breaks ties, then
the alphabet. The score is the logistic of the winner's smallest margin, so it
is never below 0.5: it ranks learned languages, and says nothing of a text in
none of them. For that, ``fit(known=True)`` also learns which pairs of letter
bytes each language has, and ``likeness`` is the share of a text's bytes (but
blanks) that are letters starting a pair of the chosen language, divided by the
share that all but one in a hundred learned texts of it reach when judged by the
pairs of the others; at most 1.

Training reads a bounded sample: about ``per_language`` distinct texts of each
learned language, picked by a hash of the text. Feature vectors are made on
the executors and fitted on the driver (per_language x languages x 8 KB).

Results for odd input: a null text, or one without any letter, is "und" with
score 0; so is every text if there is nothing to learn from. A null id is in
neither part of the split (held_out is false, and the row is not learned
from). Repeated rows get the same answer; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANKS, map_columns, sample_fraction, text_of

DIM = 4096
SLICE = 1 << 20  # bytes of a text that are counted at a time

# Families of the ISO 639-1 codes met most in web text. A code
# that is not listed forms a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

# every byte that is no ASCII letter and starts or continues no longer
# character counts as a blank
_KEEP = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, f"only {lang}")


def features(text: str) -> np.ndarray | None:
    """Unit vector of hashed n-grams; None if the text has no letter."""
    if not any(map(str.isalpha, text)):
        return None
    data = (" " + text.lower() + " ").encode("utf-8", "replace").translate(_KEEP)
    total = np.zeros(DIM)
    for at in range(0, len(data), SLICE):
        b = np.frombuffer(data[at:at + SLICE + 2], np.uint8).astype(np.uint32)
        two = b[:-1] * 251 + b[1:] * 40503
        three = two[:-1] * 31 + b[2:] * 65599
        total += np.bincount(two % DIM, minlength=DIM)
        total += np.bincount((three ^ (three >> 9)) % DIM, minlength=DIM)
    for blank in (32 * 251 + 32 * 40503, ):  # runs of blanks say nothing
        total[blank % DIM] = 0
    out = np.sqrt(total)
    norm = np.linalg.norm(out)
    return (out / norm if norm else out).astype(np.float32)


def letter_pairs(text: str) -> tuple[np.ndarray, int]:
    """Numbers of the byte pairs that start with a letter's byte, and how many
    bytes the text has without blanks."""
    data = text.lower().encode("utf-8", "replace")
    b = np.frombuffer((data + b" ").translate(_KEEP), np.uint8)
    at = np.nonzero(b[:-1] != 32)[0]
    return b[at].astype(np.uint16) << 8 | b[at + 1], len(data.translate(None, BLANKS.encode()))


def learn_pairs(texts: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """From (distinct pairs, their counts, bytes) of each text of a language:
    the pairs it has, and the share nearly all texts reach by the others' pairs."""
    times = np.zeros(1 << 16, np.int32)
    for pairs, _, _ in texts:
        times[pairs] += 1
    shares = [counts[times[pairs] > 1].sum() / max(n, 1) for pairs, counts, n in texts]
    return times > 0, float(np.quantile(shares, 0.01, method="lower"))


def fit_svm(x: np.ndarray, y: np.ndarray, reg: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, both
    classes counting alike; plain accelerated gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    v, rate = w.copy(), 0.2
    for k in range(steps):
        gap = np.maximum(0.0, 1.0 - y * (x @ v))
        new = v - rate * (2 * reg * v - 2 * x.T @ (weight * gap * y))
        v = new + k / (k + 3) * (new - w)
        w = new
    return w


@dataclass
class Model:
    """groups: family -> its languages; pairs: (group, a, b, column of w)."""
    groups: dict[str, list[str]]
    pairs: list[tuple[str, str, str]]
    w: np.ndarray
    known: dict[str, tuple[np.ndarray, float]] = field(default_factory=dict)

    def likeness(self, lang: str, text: str) -> float:
        """How well a text's letters are of the language, 0 to 1."""
        if lang not in self.known:
            return 0.0 if lang == "und" else 1.0
        table, usual = self.known[lang]
        pairs, n = letter_pairs(text)
        share = float(table[pairs].sum()) / max(n, 1)
        return min(1.0, share / usual) if usual else 1.0

    def choose(self, group: str, names: Sequence[str], margins) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], np.inf
        votes = {n: [0, 0.0, np.inf] for n in names}
        for (g, a, b), m in zip(self.pairs, margins, strict=True):
            if g == group:
                win, lose, m = (a, b, m) if m >= 0 else (b, a, -m)
                votes[win][0] += 1
                votes[win][1] += m
                votes[lose][1] -= m
                votes[win][2] = min(votes[win][2], m)
        best = min(names, key=lambda n: (-votes[n][0], -votes[n][1], n))
        return best, float(votes[best][2])

    def predict(self, text: str) -> tuple[str, float]:
        x = features(text) if self.groups else None
        if x is None:
            return "und", 0.0
        margins = x @ self.w[:-1] + self.w[-1]
        family, m1 = self.choose("", sorted(self.groups), margins)
        lang, m2 = self.choose(family, self.groups[family], margins)
        low = min(m1, m2)
        return lang, 1.0 if low == np.inf else float(1 / (1 + np.exp(-3 * min(low, 50))))


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
        per_language: int = 400, known: bool = False) -> Model:
    """Learn from the rows where ``learn`` holds and the language is known."""
    rows = docs.select(text_of(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       learn.alias("learn")).filter("learn and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
              .collect()}  # one row per language
    if not counts:
        return Model({}, [], np.zeros((DIM + 1, 0)))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, per_language / n)))
                         for k, n in counts.items()])
    picked = (rows.filter(sample_fraction(share, "text")).select("text", "lang").distinct()
              .limit(2 * per_language * len(counts)))

    def start():
        def fn(texts):
            got = [features(t.as_py()) for t in texts]
            out = [pa.array([None if g is None else g.astype(np.float16).tobytes()
                             for g in got], pa.binary())]
            if known:
                pairs = [letter_pairs(t.as_py()) for t in texts]
                sets = [np.unique(p, return_counts=True) for p, _ in pairs]
                out += [pa.array([s.tobytes() for s, _ in sets], pa.binary()),
                        pa.array([c.astype(np.int64).tobytes() for _, c in sets], pa.binary()),
                        pa.array([n for _, n in pairs], pa.int64())]
            return out
        return fn

    fields = [T.StructField("x", T.BinaryType(), True)]
    if known:
        fields += [T.StructField("pairs", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                   T.StructField("n", T.LongType())]
    got = map_columns(picked, [F.col("text")], start, fields) \
        .select("lang", *[f.name for f in fields]).filter("x is not null").collect()
    rows = sorted((r["lang"], bytes(r["x"])) for r in got)
    seen: dict[str, list] = {}
    for r in got if known else []:
        seen.setdefault(r["lang"], []).append(
            (np.frombuffer(r["pairs"], np.uint16), np.frombuffer(r["counts"], np.int64), r["n"]))
    x = np.stack([np.frombuffer(b, np.float16) for _, b in rows]).astype(np.float32) \
        if rows else np.zeros((0, DIM), np.float32)
    lang = np.array([k for k, _ in rows])
    fam = np.array([family_of(k) for k in lang])
    groups: dict[str, list[str]] = {}
    for k in sorted(set(lang.tolist())):
        groups.setdefault(family_of(k), []).append(k)
    pairs, ws = [], []
    for group, names, of in [("", sorted(groups), fam)] + \
            [(g, names, lang) for g, names in sorted(groups.items())]:
        for a, b in combinations(names, 2):
            at = (of == a) | (of == b)
            pairs.append((group, a, b))
            ws.append(fit_svm(x[at], np.where(of[at] == a, 1.0, -1.0)))
    w = np.stack(ws, axis=1) if ws else np.zeros((DIM + 1, 0))
    return Model(groups, pairs, w, {k: learn_pairs(v) for k, v in seen.items()})


def predict(docs: DataFrame, model: Model, text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score",
            likeness_out: str | None = None) -> DataFrame:
    """Append the predicted language and its score to every row, and the
    likeness if a name for it is given."""
    def start():
        def fn(texts):
            got = [model.predict(t.as_py()) for t in texts]
            out = [[g[0] for g in got], [g[1] for g in got]]
            if likeness_out:
                out.append([model.likeness(g[0], t.as_py())
                            for g, t in zip(got, texts, strict=True)])
            return out
        return fn

    fields = [T.StructField(lang_out, T.StringType(), False),
              T.StructField(score_out, T.DoubleType(), False)]
    if likeness_out:
        fields.append(T.StructField(likeness_out, T.DoubleType(), False))
    return map_columns(docs, [text_of(text_col)], start, fields)
