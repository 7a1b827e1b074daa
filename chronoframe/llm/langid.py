"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and cut into character n-grams; each n-gram hashes to one of ``buckets`` rows of an
embedding matrix, the rows are averaged over the whole text, and a linear layer with softmax gives the
probability of each language.  Embeddings and layer are trained by mini-batch stochastic gradient descent in
numpy on the driver, on a bounded sample: at most ``sample_rows`` rows, as many of each language, taken in the order of
a hash of the id.  Languages are counted over all labelled rows, and as many of the most common take part as the bound
gives ``LEAST_ROWS`` rows each (or ``max_languages``).  Texts over ``train_chars`` characters come last, as a piece of
that length from their first letter on, where a language has too few others (the bounds concern the fit only; every
text is predicted whole).  A fifth of the sample is held back: it sets the
temperature of the softmax and, for each of ``LENGTHS``, two limits below which a prediction counts as rejected: the
score, and the share of 3- and 4-grams that training has seen (of 1- and 2-grams where a text has no longer one), held
in a bit table of their own that is at most a 64th full, as far as 2**26 bits go.  The limits are the values that at
most the share ``REJECTS`` of the rightly predicted texts and pieces of that length from the held-back texts stays below;
the score limit is never less than a tenth of the way from 1/languages to 1.

The averaged layer is linear, so executors receive one table of bucket scores (``buckets`` x languages floats).

Rows: a null text or one without a letter gets ``und`` with score 0 and is rejected; a null id is never
learned from; repeated rows are predicted each for itself; an empty or unlabelled table makes every text
``und``; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import codes, id_text, text_groups

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
LENGTHS = tuple(2 << k for k in range(10))  # code points; a text has the limits of the greatest that it reaches
REJECTS = 0.001
PIECES = 4  # of each length from each held-back text
BITS = 1 << 26
LEAST_ROWS = 20
WORD = re.compile(r"[^\W\d_]")  # letters, and a few numbers that are not decimal digits


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in WORD.finditer(text))


def fold(id_col: Column) -> Column:
    """Remainder of crc32 of the id as text; fold 2 is held out of all training."""
    return F.crc32(id_col.cast("string")) % 4


def hashed(text: str) -> list[np.ndarray]:
    """Hash of every n-gram of a text, order by order."""
    c = codes(text.lower()).astype(np.uint32)
    out, h = [], np.zeros(len(c), dtype=np.uint32)
    for k in range(1, max(ORDERS) + 1):
        if len(c) < k:
            break
        h = h[: len(c) - k + 1] * np.uint32(0x01000193) + c[k - 1:]
        if k in ORDERS:
            x = (h ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            out.append(x ^ (x >> np.uint32(15)))
    return out


def grams(text: str, buckets: int) -> np.ndarray:
    """Bucket of every n-gram of a text (``buckets`` is a power of two)."""
    out = hashed(text)
    return np.concatenate(out) & np.uint32(buckets - 1) if out else np.zeros(0, dtype=np.uint32)


def marks(orders: list[np.ndarray]) -> np.ndarray:
    """Of :func:`hashed`, what the share of seen n-grams is taken over."""
    return np.concatenate(orders[2:] or orders) if orders else np.zeros(0, dtype=np.uint32)


def blocks(text: str, size: int = 1 << 18) -> Iterator[str]:
    """A long text in parts that overlap so that no n-gram is lost or counted twice for orders above one."""
    step = max(ORDERS) - 1
    if len(text) <= size:
        yield text
        return
    for a in range(0, len(text), size):
        yield text[a: a + size + step]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray      # buckets x languages: scores
    bias: np.ndarray
    bits: np.ndarray       # one bit for each hash of an n-gram (its low digits): training has seen it
    temperature: float = 1.0
    least_score: tuple[float, ...] = (0.0,) * len(LENGTHS)
    least_seen: tuple[float, ...] = (0.0,) * len(LENGTHS)

    def raw(self, text: str) -> tuple[np.ndarray, float]:
        """Logits and the share of n-grams that training has seen."""
        total, n, seen, m = np.zeros(self.table.shape[1]), 0, 0, 0
        for part in blocks(text):
            orders = hashed(part)
            for x in orders:
                total += self.table[x & np.uint32(len(self.table) - 1)].sum(axis=0, dtype=np.float64)
                n += len(x)
            x = marks(orders)
            at = x & np.uint32(8 * len(self.bits) - 1)
            seen += int(np.count_nonzero(self.bits[at >> np.uint32(3)] & (np.uint8(1) << (at & np.uint32(7)).astype(np.uint8))))
            m += len(x)
        return total / max(n, 1) + self.bias, seen / max(m, 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, rejected."""
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        logits, seen = self.raw(text)
        p = softmax(logits / self.temperature)
        k, reach = int(p.argmax()), max(0, bisect.bisect_right(LENGTHS, len(text)) - 1)
        return self.languages[k], float(p[k]), bool(p[k] < self.least_score[reach] or seen < self.least_seen[reach])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[str], buckets: int = 1 << 16, dim: int = 16, epochs: int = 6, rate: float = 0.5,
          batch: int = 16, seed: int = 42) -> Model:
    """Fit on four fifths of the rows, calibrate on the rest."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((buckets, 0), dtype=np.float32), np.zeros(0), np.zeros(1, dtype=np.uint8))
    y = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held, fit = order[: len(order) // 5], order[len(order) // 5:]
    sparse, known = [], np.zeros(BITS, dtype=bool)
    for i in fit.tolist():
        orders = hashed(texts[i])
        for x in orders:
            known[x & np.uint32(BITS - 1)] = True
        g, n = np.unique(np.concatenate(orders) & np.uint32(buckets - 1), return_counts=True)
        sparse.append((g.astype(np.int64), (n / max(n.sum(), 1)).astype(np.float32)))
    e = rng.normal(0, 1 / dim, (buckets, dim)).astype(np.float32)
    w = np.zeros((dim, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    steps = epochs * -(-len(fit) // batch)
    done = 0
    for _ in range(epochs):
        turn = rng.permutation(len(fit))
        for a in range(0, len(turn), batch):
            rows = [sparse[k] for k in turn[a: a + batch].tolist()]
            rows_y = y[fit[turn[a: a + batch]]]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = np.stack([f @ e[g] for g, f in rows])
            d = softmax(hidden @ w + bias)
            d[np.arange(len(rows)), rows_y] -= 1
            d /= len(rows)
            back = d @ w.T
            w -= lr * len(languages) * (hidden.T @ d)
            bias -= lr * 0.1 * d.sum(axis=0)
            for (g, f), b in zip(rows, back):
                e[g] -= (lr * buckets ** 0.5) * f[:, None] * b  # n-gram shares are small: a larger step for them
    count = np.count_nonzero(known)
    while len(known) > max(64 * count, 1 << 12):
        known = known[: len(known) // 2] | known[len(known) // 2:]
    model = Model(languages, e @ w, bias, np.packbits(known, bitorder="little"))
    test = held if len(held) else fit
    logits = np.stack([model.raw(texts[i])[0] for i in test.tolist()])
    grid = np.geomspace(0.05, 5, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(test)), y[test]] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    model.least_score, model.least_seen = limits(model, [texts[i] for i in test.tolist()], [labels[i] for i in test.tolist()], rng)
    return model


def limits(model: Model, texts: list[str], labels: list[str], rng: np.random.Generator) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Least score and least share of seen n-grams for each of ``LENGTHS``, from texts that were held back.  A length
    that no text reaches has the limits of the one before; no length has a higher limit than a longer one, since short
    texts vary more."""
    floor = 0.9 / len(model.languages) + 0.1
    scores, shares = [], []
    for m in LENGTHS:
        got = []
        for text, label in zip(texts, labels):
            pieces = [text[a: a + m] for a in rng.integers(0, len(text) - m, PIECES, endpoint=True).tolist()] if len(text) >= m else []
            if m <= len(text) < 2 * m or m == LENGTHS[-1] <= len(text):  # the text itself has this length's limits
                pieces.append(text)
            for piece in pieces:
                if has_letter(piece):
                    logits, seen = model.raw(piece)
                    p = softmax(logits / model.temperature)
                    if model.languages[int(p.argmax())] == label:
                        got.append((float(p.max()), seen))
        for out, values, least in ((scores, [x for x, _ in got], floor), (shares, [x for _, x in got], 0.0)):
            out.append(max(least, lowest(values)) if values else out[-1] if out else least)
    return tuple(np.minimum.accumulate(scores[::-1])[::-1].tolist()), tuple(np.minimum.accumulate(shares[::-1])[::-1].tolist())


def lowest(values: list[float]) -> float:
    """What at most the share ``REJECTS`` of values stays below: as many of the sample as are sure (two standard deviations
    of the count) not to be more; of a few alike, where a normal tail would have it."""
    want = REJECTS * len(values)
    tail = np.mean(values) + NormalDist().inv_cdf(REJECTS) * np.std(values)
    return float(min(np.sort(values)[max(0, int(want - 2 * want ** 0.5))], tail))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 6000,
        max_languages: int | None = None, train_chars: int = 12_000, **options) -> Model:
    """Train on a bounded sample of the rows with a label outside the held-out fold."""
    text = F.col(f"`{text_col}`").cast("string")
    piece = F.when(F.length(text) <= train_chars, text).otherwise(F.regexp_extract(text, rf"(?s)\p{{L}}.{{0,{train_chars - 1}}}", 0))
    rows = (df.select(F.col(f"`{id_col}`").alias("i"), text.alias("t"), piece.alias("piece"), F.col(f"`{lang_col}`").cast("string").alias("l"))
            .where((fold(F.col("i")) != 2) & F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}")))
    keys = rows.select("l", "i", F.pmod(F.xxhash64("i"), F.lit(1 << 40)).alias("h"), (F.length("t") > train_chars).cast("int").alias("long"))
    keys = keys.groupBy("l", "i", "h").agg(F.min("long").alias("long"))          # an id counts once for a language
    most = max(1, sample_rows // LEAST_ROWS) if max_languages is None else max_languages
    common = keys.groupBy("l").agg(F.sum("long").alias("n_long"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(most).collect()
    if not common:
        return train([], [], **options)
    per_language = max(1, sample_rows // len(common))
    wanted = []  # language, long, rows wanted and rows there are: long texts fill up what the others leave
    for r in common:
        short = r["n"] - r["n_long"]
        wanted += [(r["l"], 0, per_language, short), (r["l"], 1, max(0, per_language - short), r["n_long"])]
    wanted = df.sparkSession.createDataFrame([w for w in wanted if w[2] and w[3]], "l string, long int, want long, count long")
    near = F.col("h") < F.lit(2.0 * (1 << 40)) * F.col("want") / F.col("count")  # some twice the wanted rows of a language
    pick = (keys.join(F.broadcast(wanted), ["l", "long"]).where(near).withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy("long", "h", "i")))
            .where(F.col("n") <= per_language).select("i").distinct())
    # one row for each id: of an id with many rows the one of the least hash, so that what is collected is bounded
    one = rows.join(F.broadcast(pick), "i").groupBy("i").agg(F.min(F.struct(F.xxhash64("piece").alias("x"), F.col("piece").alias("t"), "l")).alias("m"))
    chosen = sorted((r.i, r.t, r.l) for r in one.select("i", "m.t", "m.l").collect())
    return train([t for _, t, _ in chosen], [lang for _, _, lang in chosen], **options)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col, held_out, lang_pred, score, rejected`` for every row, then the columns named in ``carry``
    (which pass through beside the text, so that a filter on the prediction needs no join)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    base = id_text(df, id_col, text_col, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [m.predict(t) for _, texts in text_groups(b.column(0), b.column(1)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_()),
                                              *b.columns[2:]], names=["_id", "_lang", "_score", "_rejected", *b.schema.names[2:]])

    schema = ", ".join(["_id long, _lang string, _score double, _rejected boolean", *[f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields[2:]]])
    out = base.mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id_col), F.coalesce(fold(F.col("_id")) == 2, F.lit(False)).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
                      F.col("_rejected").alias("rejected"), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)])
