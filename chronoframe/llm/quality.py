"""Quality rules whose cutoffs come with a bound on how many good documents they reject.

Each rule compares a ratio of two counts of a text with a cutoff from a fixed list.  A quarter of the labelled
documents (by a hash of the id) orders the cutoffs of a stratum: at every step the rule and cutoff follow that catch most
bad documents for each good one lost.  The others, the holdout, are not looked at until then.  On it the steps are
tested in that order: the cutoffs up to a step stand if the exact binomial (Clopper-Pearson) upper bound of the share
of good documents that they reject together is at most ``risk``; the first step that fails ends the stratum (a
fixed sequence needs no correction of its own).  Strata share the error ``delta`` equally (Bonferroni).  So with
probability ``1 - delta`` no stratum loses more than ``risk`` of its good documents to the rules.  A stratum with too few
labels to show this gets no cutoff.  Good documents that fail the fixed base rule are not counted, since no cutoff
decides on them.

Only counts pass the driver or meet in a task: of documents by (stratum, rule, cutoff, label) and (stratum, step).

Rows: a null text has no words (it fails the base rule), like an empty one; null ids have no label and are kept or not
like other rows; each of several rows of an id counts; of several labels of an id the worst holds; a null stratum and
'' are one; an empty table gives no rows; without labels only the base rule decides; other columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import arrow_groups, id_text, ragged

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals", "n_calls")

# Rule, numerator, denominator, factor of the numerator, whether high values are bad, and the cutoffs
# from the one that rejects least.
RULES = (
    ("symbols", "n_symbols", "word_chars", 1000, True, (400, 300, 200, 150, 100, 70, 50, 30, 20, 10, 5, 2)),
    ("capitals", "n_capitals", "n_letters", 1000, True, (950, 900, 800, 700, 600, 500, 400, 300, 200)),
    ("calls", "n_calls", "n_words", 1000, True, (1500, 1000, 900, 800, 600, 400, 300, 200, 100)),
    ("repeats", "n_repeat_words", "n_words", 1000, True, (290, 250, 200, 150, 100, 50)),
    ("equal_lines", "n_dup_lines", "n_lines", 1000, True, (900, 800, 700, 600, 500, 400, 300, 200, 100)),
    ("long_words", "word_chars", "n_words", 100, True, (3000, 2000, 1500, 1200, 1000, 900, 800)),
    ("short_words", "word_chars", "n_words", 100, False, (100, 150, 200, 250, 300, 350)),
    ("no_letters", "n_letters", "word_chars", 1000, False, (50, 100, 200, 300, 400, 500, 600, 700)),
)
MIN_WORDS, MAX_REPEAT, WINDOW = 20, 30, 8
LEAST_BAD = 3


# ---------------------------------------------------------------- counts of texts

@cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point is a letter, and whether it is a capital."""
    kind = [unicodedata.category(chr(i)) for i in range(0x110000)]
    return np.array([k[0] == "L" for k in kind]), np.array([k == "Lu" for k in kind])


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_BLANK, _SYMBOL, _CALL = _flags(b" \t\n\v\f\r"), _flags(b"#*$%&|<>"), _flags(b"!?")


def _numbered(values) -> tuple[np.ndarray, int]:
    """Equal values get equal whole numbers below the second result."""
    d = pa.array(values).dictionary_encode() if isinstance(values, np.ndarray) else values.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(d.dictionary)


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary array of ``data[starts[i]: ends[i]]``."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    flat = np.ascontiguousarray(data[ragged(starts, ends - starts)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def count_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """:data:`COUNTS` of UTF-8 texts."""
    n = len(texts)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)

    def per_text(flag: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return run[at[1:]] - run[at[:-1]]

    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, dtype=bool)          # a text begins here
    edge[at] = True
    before = np.concatenate([[False], inside[:-1]])[: len(data)]
    after = np.concatenate([inside[1:], [False]])[: len(data)]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    text_of = np.searchsorted(at, starts, side="right") - 1
    out = {"n_words": np.bincount(text_of, minlength=n), "word_chars": per_text(inside & ((data & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOL[data]), "n_calls": per_text(_CALL[data])}
    out["n_lines"], out["n_dup_lines"] = _line_counts(data, at, inside, n)
    out["n_repeat_words"] = _repeats(_slices(data, starts, ends), text_of, n)
    out["n_letters"], out["n_capitals"] = _letter_counts(data, at, per_text)
    return {c: out[c].astype(np.int64) for c in COUNTS}


def _line_counts(data: np.ndarray, at: np.ndarray, inside: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that are equal to an earlier one of the text."""
    feed = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([at[:-1], feed + 1]))
    starts = starts[starts < len(data)]
    text_of = np.searchsorted(at, starts, side="right") - 1
    ends = np.minimum(np.append(feed, len(data))[np.searchsorted(feed, starts)], at[text_of + 1])
    run = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    full = run[ends] > run[starts]
    starts, ends, text_of = starts[full], ends[full], text_of[full]
    line, size = _numbered(_slices(data, starts, ends))
    _, first = np.unique(text_of * size + line, return_index=True)
    lines = np.bincount(text_of, minlength=n)
    return lines, lines - np.bincount(text_of[first], minlength=n)


def _repeats(words: pa.Array, text_of: np.ndarray, n: int) -> np.ndarray:
    """Words inside a window of ``WINDOW`` (a power of two) words that stands twice or more in its text.  Windows of
    2, 4, 8 words are numbered from pairs of the half as long, so equal numbers mean equal words."""
    code, size = _numbered(words)
    width = 1
    while width < WINDOW:
        if len(code) <= width:
            return np.zeros(n, dtype=np.int64)
        code, size = _numbered(code[:-width] * size + code[width:])
        width *= 2
    inside = np.flatnonzero(text_of[: len(code)] == text_of[WINDOW - 1:])
    key, kinds = _numbered(text_of[inside] * size + code[inside])
    again = inside[np.bincount(key, minlength=kinds)[key] > 1]
    step = np.zeros(len(text_of) + 1, dtype=np.int64)
    np.add.at(step, again, 1)
    np.add.at(step, again + WINDOW, -1)
    return np.bincount(text_of[np.cumsum(step[:-1]) > 0], minlength=n)


def _letter_counts(data: np.ndarray, at: np.ndarray, per_text) -> tuple[np.ndarray, np.ndarray]:
    if len(data) and data.max() >= 0x80:
        letter, capital = _classes()
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])[at]
        first = np.minimum(first, len(points))          # bytes that are no UTF-8 may give fewer points
        runs = [np.concatenate([[0], np.cumsum(kind[points], dtype=np.int64)]) for kind in (letter, capital)]
        return tuple(r[first[1:]] - r[first[:-1]] for r in runs)
    up = (data >= 0x41) & (data <= 0x5A)
    return per_text(up | ((data >= 0x61) & (data <= 0x7A))), per_text(up)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id``, ``stratum`` and :data:`COUNTS` of the whole text of each document."""
    schema = "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in arrow_groups(pa.array(np.arange(len(batch))), batch.column(1)):
                got = count_texts([t or b"" for t in texts.cast(pa.binary()).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), *[pa.array(got[c]) for c in COUNTS]], ["doc_id", "stratum", *COUNTS])

    rows = id_text(docs, id_col, text_col, (stratum_col,)).select("_id", "_text", F.coalesce(F.col("_c0").cast("string"), F.lit("")))
    return rows.mapInArrow(run, schema)


# ---------------------------------------------------------------- exact binomial bounds

def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for ``k <= n p``: the terms from ``k`` downwards shrink, and are summed until they no longer count."""
    if k < 0:
        return 0.0
    if p <= 0 or k >= n:
        return 1.0
    if p >= 1:
        return 0.0
    top = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total, log_term, j = 1.0, 0.0, k
    while j > 0 and log_term > -45:
        i = np.arange(j, max(j - 4096, 0), -1, dtype=np.float64)      # term(i - 1) / term(i)
        logs = log_term + np.cumsum(np.log(i) + math.log1p(-p) - np.log(n - i + 1) - math.log(p))
        total += float(np.exp(logs).sum())
        log_term, j = float(logs[-1]), int(i[-1]) - 1
    return min(1.0, math.exp(top) * total)


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the share above which ``k`` or fewer of ``n`` have a probability of less than ``delta``."""
    if n <= 0 or k >= n:
        return 1.0
    lo, hi = k / n, 1.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if binomial_cdf(k, n, mid) > delta else (lo, mid)
    return hi


# ---------------------------------------------------------------- cutoffs

def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def levels() -> Column:
    """For each rule the place (from 0) of the first of its cutoffs that rejects the row, or their number."""
    out = []
    for _, num, den, factor, high, cuts in RULES:
        beyond = (lambda c: F.col(num) * factor > c * F.col(den)) if high else (lambda c: F.col(num) * factor < c * F.col(den))
        passed = F.lit(0)
        for c in cuts:      # bind num, den in this turn of the loop
            passed = passed + F.when(beyond(F.lit(c).cast("long")), 1).otherwise(0)
        out.append(F.lit(len(cuts)) - passed)
    return F.array(*out)


def _path(pdf: pd.DataFrame) -> pd.DataFrame:
    """Steps of one stratum from its counts (rule, level, good, bad): again and again the tightening with the
    most bad rows for each good one, as long as it catches ``LEAST_BAD`` bad rows and more than ten for each good one."""
    good, bad = {}, {}
    for rule, level, g, b in zip(pdf["rule"], pdf["level"], pdf["good"], pdf["bad"]):
        good[rule, level], bad[rule, level] = g, b
    at = [-1] * len(RULES)
    steps = []
    while True:
        best = None
        for r, rule in enumerate(RULES):
            g = b = 0
            for level in range(at[r] + 1, len(rule[5])):
                g += good.get((r, level), 0)
                b += bad.get((r, level), 0)
                if b >= LEAST_BAD and b > 10 * g and (best is None or (b / (g + 1), b) > best[0]):
                    best = ((b / (g + 1), b), r, level)
        if best is None:
            return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "rules": [[s[0] for s in steps]], "cuts": [[s[1] for s in steps]]})
        steps.append(best[1:])
        at[best[1]] = best[2]


def _step(level: str = "levels") -> Column:
    """The first step (from 1) that rejects the row; null if none does."""
    hit = F.transform(F.arrays_zip("rules", "cuts"), lambda s: F.get(F.col(level), s["rules"]) <= s["cuts"])
    return F.nullif(F.array_position(hit, True), F.lit(0))


def certify(pdf: pd.DataFrame, risk: float, delta: float, strata: int) -> int:
    """How many steps stand: ``pdf`` has (step, good) counts of the holdout, step null where none rejects."""
    n = int(pdf["good"].sum())
    by_step = {int(s): int(g) for s, g in zip(pdf["step"], pdf["good"]) if not pd.isna(s)}
    lost, stand = 0, 0
    for s in range(1, int(pdf["steps"].iloc[0]) + 1):
        lost += by_step.get(s, 0)
        if n == 0 or lost > risk * n or binomial_cdf(lost, n, risk) > delta / strata:
            break
        stand = s
    return stand


def fit(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Cutoffs (``stratum``, ``rules``, ``cuts`` in the order of the steps, ``steps`` tried, ``stand`` how many hold, and of the
    holdout ``n_good``, ``n_lost`` by the steps that hold, ``bound`` of their share) from the counts of documents and their labels (1 good,
    0 bad, null unknown)."""
    worst = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
                   .where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label")))
    known = (rows.where(~base_failed()).join(worst, "doc_id")
                 .select("stratum", "label", levels().alias("levels"), (F.crc32(F.col("doc_id").cast("string")) % 4 != 0).alias("holdout")))
    known = materialize(known, "quality-labels")
    good = F.count_if(F.col("label") == 1).alias("good")
    cells = (known.where(~F.col("holdout")).select("stratum", "label", F.posexplode("levels").alias("rule", "level"))
                  .groupBy("stratum", "rule", "level").agg(good, F.count_if(F.col("label") != 1).alias("bad")))
    paths = materialize(cells.groupBy("stratum").applyInPandas(_path, "stratum string, rules array<int>, cuts array<int>"), "quality-paths")
    strata = max(1, paths.count())
    held = (known.where("holdout AND label = 1").join(paths, "stratum").withColumn("step", _step())
                 .groupBy("stratum", "step").agg(F.count(F.lit(1)).alias("good")))
    held = held.join(paths.select("stratum", F.size("rules").alias("steps")), "stratum")

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        stand = certify(pdf, risk, delta, strata)
        n, lost = int(pdf["good"].sum()), int(pdf["good"][pdf["step"].fillna(np.inf) <= stand].sum())
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "steps": [int(pdf["steps"].iloc[0])], "stand": [stand], "n_good": [n], "n_lost": [lost],
                             "bound": [upper_bound(lost, n, delta / strata)]})

    shown = held.groupBy("stratum").applyInPandas(test, "stratum string, steps int, stand int, n_good long, n_lost long, bound double")
    return materialize(paths.join(shown, "stratum"), "quality-cutoffs")


def judge(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The counts with ``base_failed``, ``step`` (the first standing step that rejects the row, or null), ``rule`` (its name) and ``kept``."""
    names = F.array(*[F.lit(r[0]) for r in RULES])
    seen = rows.withColumn("levels", levels()).join(cutoffs.select("stratum", "rules", "cuts", "stand"), "stratum", "left")
    seen = seen.withColumn("base_failed", base_failed()).withColumn("_s", _step())
    seen = seen.withColumn("step", F.when(F.col("_s") <= F.col("stand"), F.col("_s")))
    return seen.select("doc_id", "stratum", *COUNTS, "base_failed", F.col("step").cast("int").alias("step"),
                       F.get(names, F.get("rules", F.col("step").cast("int") - 1)).alias("rule"), (~F.col("base_failed") & F.col("step").isNull()).alias("kept"))


def filter_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                   label_col: str = "quality", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Counts, the base rule's result and the verdict for each document."""
    rows = materialize(counts(docs, id_col, text_col, stratum_col), "quality-counts")
    return judge(rows, fit(rows, labels, id_col, label_col, risk, delta))
