"""Operator 11: counts against plain Python, exact bounds, the certified share of lost good documents, edge rows."""

import random
import re
from collections import Counter
from math import comb
from zlib import crc32

import pandas as pd
from helpers import EDGE, documents, words

from chronoframe.llm import quality as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if win[tuple(w[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    import unicodedata
    kinds = [unicodedata.category(c) for c in text]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_letters": sum(k[0] == "L" for k in kinds),
            "n_capitals": kinds.count("Lu"), "n_calls": text.count("!") + text.count("?")}


def test_counts_against_plain_python():
    r = random.Random(1)
    signs = ["a", "B", "é", "Ä", " ", " ", "\n", "\t", "\x0b", "\x1c", " ", "#", "|", "!", "語", "🙂", "a b\n", "x y z a b c d e "]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 120))) for _ in range(500)] + ["", "\n", " ", "a\n", "\na", "b a " * 30, "one\ntwo\none\n"]
    for size in (1, 7, len(texts)):
        for a in range(0, len(texts), size):
            part = texts[a:a + size]
            got = q.count_texts([t.encode() for t in part])
            for i, t in enumerate(part):
                assert {c: int(got[c][i]) for c in q.COUNTS} == brute(t), t
    assert q.count_texts([])["n_words"].tolist() == []
    q.count_texts([b"\xff\xfe bad \x80", b"next \xc3"])


def test_binomial_bounds_are_exact():
    for n, k, p in [(10, 2, 0.3), (50, 0, 0.02), (200, 3, 0.02), (400, 20, 0.06), (5, 1, 0.5)]:
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(q.binomial_cdf(k, n, p) - want) < 1e-12
    assert abs(q.upper_bound(0, 100, 0.05) - (1 - 0.05 ** (1 / 100))) < 1e-9
    assert abs(q.binomial_cdf(3, 100, q.upper_bound(3, 100, 0.01)) - 0.01) < 1e-9
    assert q.upper_bound(5, 5, 0.1) == 1.0 and q.upper_bound(0, 0, 0.1) == 1.0
    z = (10**6 - 0.0101 * 10**8) / (0.0101 * 0.9899 * 10**8) ** 0.5          # about a tenth of a million terms count
    assert q.binomial_cdf(10**6, 10**8, 0.0101) < 1e-10 and z < -9
    assert 0.4 < q.binomial_cdf(10**6, 10**8, 0.01) < 0.6


def test_certify_stops_at_the_first_step_that_fails():
    pdf = pd.DataFrame({"step": [1, 2, 3, None], "good": [0, 100, 0, 900], "steps": [3] * 4})
    assert q.certify(pdf, 0.02, 0.05, 1) == 1
    few = pd.DataFrame({"step": [None], "good": [50], "steps": [3]})
    assert q.certify(few, 0.02, 0.05, 1) == 0          # 50 good rows cannot show 2 %


def test_lost_good_documents_stay_below_the_risk():
    """Simulation: scores where the best cutoffs lose more than the risk; in at most delta of the trials more is lost."""
    import numpy as np
    r, risk, delta, broken = np.random.default_rng(2), 0.05, 0.1, 0
    true = np.array([0.0, 0.02, 0.045, 0.06, 0.1])     # share of good rows that the steps up to i reject
    for _ in range(400):
        lost = r.multinomial(600, np.append(np.diff(true), 1 - true[-1]))
        pdf = pd.DataFrame({"step": [1, 2, 3, 4, None], "good": lost, "steps": [4] * 5})
        broken += true[q.certify(pdf, risk, delta, 1)] > risk
    assert broken <= 400 * delta


def corpus():
    r = random.Random(8)
    rows, labels = [], []
    for i in range(2400):
        w = words(r.randint(25, 60), i)
        lang = "xy"[i % 2]
        bad = i % 5 == 0
        if bad:
            w = [x + "###" for x in w] if lang == "x" else [x.upper() + "!!" for x in w]
        elif lang == "y" and i % 3 == 0:
            w = [x + "#" if j % 2 else x for j, x in enumerate(w)]       # good texts of y hold symbols
        rows.append((i, " ".join(w), lang))
        if i % 7:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def test_rules_follow_the_stratum_and_plain_python(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    lab = spark.createDataFrame(labels + [(3, 1), (None, 0), (99999, 0)], "doc_id long, quality int").selectExpr("*", "1 AS label", "'x' AS stratum", "2 AS step")
    got = {r["doc_id"]: r for r in q.filter_quality(docs, lab).collect()}
    assert len(got) == len(rows)
    for i, _, lang in rows:
        assert got[i]["kept"] == (i % 5 != 0), (i, lang)
    assert {got[i]["rule"] for i, _, lang in rows if lang == "y" and not got[i]["kept"]} <= {"capitals", "calls"}
    known = dict(labels)
    held = [i for i, _, lang in rows if i in known and known[i] == 1 and crc32(str(i).encode()) % 4 != 0]
    cut = q.fit(q.counts(docs), lab).collect()
    assert sum(c["n_good"] for c in cut) == len(held)
    assert all(c["bound"] <= 0.02 and c["n_lost"] == 0 and c["stand"] >= 1 for c in cut)


def test_few_labels_or_none_decide_nothing(spark):
    rows, labels = corpus()
    docs = documents(spark, rows[:200])
    for some in (labels[:100], []):
        lab = spark.createDataFrame(some, "doc_id long, quality int")
        assert all(r["kept"] for r in q.filter_quality(docs, lab).collect())


def test_edge_rows(spark):
    lab = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    got = q.filter_quality(documents(spark, EDGE), lab).collect()
    want = [(i, *brute(t).values()) for i, t in EDGE]
    assert sorted([(r["doc_id"], *[r[c] for c in brute("")]) for r in got], key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])
    assert q.filter_quality(documents(spark, []), lab).collect() == []
