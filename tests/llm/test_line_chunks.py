"""Operator 6: against plain Python, shift resistance, hot chunks, edge rows."""

import random
from hashlib import md5

from helpers import EDGE, documents, words

from chronoframe.llm import line_chunks

DIGEST = lambda x: md5(x.encode()).hexdigest()


def cut(text):
    lines = text.split("\n")
    h = [DIGEST(x) for x in lines]
    r = [None] + [DIGEST(h[i - 1] + h[i]) for i in range(1, len(h))]
    starts = [0] + [i for i in range(2, len(lines) - 1) if r[i] < r[i - 1] and r[i] <= r[i + 1]]
    return ["\n".join(lines[a:b]) for a, b in zip(starts, starts[1:] + [len(lines)])]


def brute(rows):
    first = {}
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0)):
        for k, c in enumerate(cut(t)):
            if "\n" in c and c.strip():
                first.setdefault(c, (i, k))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        parts = cut(t)
        keep = [c for k, c in enumerate(parts) if not ("\n" in c and c.strip()) or first[c] == (i, k)]
        gone = sum(c.count("\n") + 1 for c in parts) - sum(c.count("\n") + 1 for c in keep)
        out.append((i, "\n".join(keep), t.count("\n") + 1, gone))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(11)
    line = lambda: " ".join(words(6, r.random()))
    shared = [line() for _ in range(14)]
    rows = []
    for k in range(60):
        own = [line() for _ in range(r.randint(0, 9))]
        rows.append((k, "\n".join(own + (shared if k % 3 == 0 else []) + [line()] * (k % 4))))
    rows += [(100, rows[0][1]), (101, "\n".join(["same"] * 500)), (102, "\n".join(f"{x}" for x in range(3000)) + "\n" + "\n".join(f"{x}" for x in range(3000)))]
    return rows


def test_against_plain_python(spark):
    rows = corpus()
    got = line_chunks.dedup(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=repr) == brute(rows)
    gone = {r.doc_id: r.n_removed for r in got}
    assert gone[100] == len(rows[0][1].split("\n")) and sum(gone[k] > 0 for k in range(3, 60, 3)) == 19


def test_edge_rows_and_carried_columns(spark):
    rows = EDGE + [(20, "one\ntwo"), (21, "one\ntwo"), (22, "\n \n\t"), (23, "\n \n\t"), (None, "one\ntwo")]
    got = line_chunks.dedup(documents(spark, rows), carry=("lang", "_ord")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.text, r.n_removed))
        assert r["_ord"] == "x"
    assert by[1] == [(None, 0)] and by[2] == [("", 0)] and by[20] == [("one\ntwo", 0)] and by[21] == [("", 2)]
    assert by[22] == by[23] == [("\n \n\t", 0)] and by[5] == [("Hello world", 0)] * 2
    assert sorted(by[None]) == [("", 2), ("null id text here", 0)]
    assert line_chunks.dedup(documents(spark, rows).where("false")).count() == 0


def test_rows_that_repeat_an_id_are_one_document(spark):
    got = line_chunks.dedup(documents(spark, [(1, "a\nb"), (1, "a\nb"), (2, "a\nb")])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "a\nb"), (1, "a\nb"), (2, "")]


def test_each_row_of_null_id_is_a_document(spark):
    rows = [(None, "p\nq")] * 3 + [(None, "one\ntwo"), (None, None), (2**63 - 1, "one\ntwo"), (2**63 - 1, "x")]
    got = line_chunks.dedup(documents(spark, rows), carry=("lang",)).collect()
    assert len(got) == 7
    assert sorted((r.text or "", r.n_removed) for r in got if r.doc_id is None) == [("", 0), ("", 2), ("", 2), ("", 2), ("p\nq", 0)]
    assert sorted((r.text, r.n_removed) for r in got if r.doc_id is not None) == [("one\ntwo", 0), ("x", 0)]
