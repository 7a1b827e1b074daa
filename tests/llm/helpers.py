"""Small tables with the cases that every operator must take: nulls, empty and long texts, ties, repeats,
clashing column names."""

import random
from collections import Counter

# Names that operators use inside; they must not matter as extra columns.
CLASH = ["_id", "_text", "ids", "start", "offset", "shard", "slot", "size", "rep", "band", "key", "n", "label", "h", "chunk", "_ord", "_block", "text_key"]


def documents(spark, rows, clash=True):
    """``rows`` of (doc_id, text) or (doc_id, text, lang) as a table like ``documents``."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASH])
    return df


def words(n, seed, letters="abcdefghij"):
    r = random.Random(seed)
    return [r.choice(letters) * r.randint(1, 3) + r.choice(letters) for _ in range(n)]


EDGE = [(None, "null id text here"), (1, None), (2, ""), (3, "   \n\t "), (4, "Hello world"), (5, "Hello world"), (5, "Hello world"), (6, "é ß 語 🙂\x1c end"),
        (7, "x" * 3000), (8, " ".join(words(4000, 1))), (-9, "a\n\nb\n"), (2**62, "<|endoftext|> two  spaces ")]


def bag(text, k=5):
    import re
    w = re.findall(r"[^ \t\n\r\f\v]+", text or "")
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
