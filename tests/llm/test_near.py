"""Operators 9 and 1: signatures, links and components against brute force; edge rows."""

import random

import numpy as np
import pytest
from helpers import EDGE, bag, components, documents, jaccard, words

from chronoframe.llm import bagminhash as bm
from chronoframe.llm import components as cc
from chronoframe.llm import metric_join as mj


def test_components_of_a_path_a_star_and_single_links(spark):
    r = random.Random(1)
    path = list(range(100, 160))
    r.shuffle(path)
    links = list(zip(path, path[1:])) + [(7, k) for k in range(200, 260)] + [(1, 1), (5, 6), (6, 5)]
    want = components({n for e in links for n in e}, links)
    got = cc.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((n, c) for n, c in want.items() if n != 1)


def test_bagminhash_agreement_is_the_weighted_jaccard_index():
    r = random.Random(2)
    for top in (1, 3, 40):
        a = {k: r.randint(1, top) for k in range(0, 60)}
        b = {k: r.randint(1, top) for k in range(25, 90)}
        both = sum(min(a[k], b[k]) for k in set(a) & set(b))
        want = both / (sum(a.values()) + sum(b.values()) - both)
        pack = lambda d: (bm.mix64(np.array(sorted(d), dtype=np.uint64)), np.array([d[k] for k in sorted(d)]))
        s = bm.bag_minhash([pack(a), pack(b), pack(a)], 4096)
        assert np.isfinite(s).all() and (s[0] == s[2]).all()
        assert abs((s[0] == s[1]).mean() - want) < 4.5 * (want * (1 - want) / 4096) ** 0.5


def test_tile_links_are_exact():
    r = random.Random(3)
    sh = bm.Shingler(2)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(1, 14))) for _ in range(120)]
    sets = [bm.elements(sh.shingles(t)) for t in texts]
    bags = [bag(t, 2) if len(t.split()) > 1 else bag(t, 1) for t in texts]
    want = [[i != j and jaccard(bags[i], bags[j]) >= 0.5 - 1e-9 for j in range(120)] for i in range(120)]
    links, a, b = bm.tile_links(sets, None, 0.5)
    assert links.tolist() == [sum(w) for w in want]
    pairs = [(i, j) for i in range(120) for j in range(120) if want[i][j]]
    assert components(range(120), zip(a.tolist(), b.tolist())) == components(range(120), pairs)
    left, right = sets[:50], sets[50:]
    total = bm.tile_links(left, None, 0.5)[0].tolist() + bm.tile_links(right, None, 0.5)[0].tolist()
    total = [x + y for x, y in zip(total, bm.tile_links(left, right, 0.5)[0].tolist())]
    assert total == links.tolist()


def near_corpus():
    r = random.Random(4)
    rows = []
    for k in range(25):
        base = words(r.choice([8, 60, 200]), k)
        for v in range(r.choice([1, 3, 9])):
            t = list(base)
            for _ in range(v % 4 * max(1, len(t) // 90)):
                t[r.randrange(len(t))] = f"edit{r.random()}"
            rows.append((len(rows), " ".join(t)))
    rows += [(900, "again and " * 300), (901, "again and " * 290), (902, "again and " * 100), (903, "two words"), (904, "two words"), (905, "two  words"), (906, "words two")]
    return rows


@pytest.mark.parametrize("block", [8 << 20, 600])
def test_near_duplicates_against_brute_force(spark, block):
    rows = near_corpus()
    got = {r.doc_id: r for r in bm.near_duplicates(documents(spark, rows), block_bytes=block).collect()}
    bags = {i: bag(t) if len(t.split()) >= 5 else bag(t, max(1, len(t.split()))) for i, t in rows}
    rep = {}
    for i, t in rows:
        rep.setdefault(t, i)
    reps = sorted(rep.values())
    links = [(a, b) for a in reps for b in reps if a < b and jaccard(bags[a], bags[b]) >= 0.8]
    comp = components(reps, links)
    for i, t in rows:
        me = rep[t]
        assert (got[i].rep_id, got[i].n_links, got[i].component_id, got[i].kept) == (me, sum(me in e for e in links), comp[me], i == comp[me])


def test_near_duplicates_of_edge_rows(spark):
    df = documents(spark, EDGE)
    got = bm.near_duplicates(df).collect()
    assert len(got) == len(EDGE)
    assert [(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id in (4, 5)].count((5, 4, False)) == 2
    assert all(r.kept for r in got if r.doc_id != 5)
    assert bm.near_duplicates(df.where("false")).count() == 0


def vectors(n=240, dims=16):
    r = np.random.default_rng(5)
    base = r.normal(size=(20, dims))
    rows = []
    for k in range(n):
        v = base[k % 20] + r.normal(size=dims) * r.choice([0.02, 0.08, 0.15])
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 20 % 3)))
    return rows + [(1000 + k, rows[0][1], rows[0][2]) for k in range(4)]


def brute_vectors(rows, cosine=0.98):
    links = []
    for i, x, a in rows:
        for j, y, b in rows:
            if i < j and a == b:
                x_, y_ = np.array(x), np.array(y)
                if x_ @ y_ / np.sqrt((x_ @ x_) * (y_ @ y_)) >= cosine:
                    links.append((i, j))
    comp = components([i for i, _, _ in rows], links)
    return {i: (sum(i in e for e in links), comp[i], i == comp[i]) for i, _, _ in rows}


@pytest.mark.parametrize("cell, block", [(2048, 2048), (4, 2048), (8, 5)])
def test_vector_links_against_brute_force(spark, cell, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, cell string, rep int")
    got = mj.near_vectors(df, cell_rows=cell, block_rows=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_vectors(rows)


def test_vector_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1),
            (9, [inf, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [-1.0, 0.0], 1), (14, [1e-300, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = mj.near_vectors(df).collect()
    assert len(got) == len(rows)
    linked = {r.vec_id: (r.n_links, r.component_id) for r in got if r.n_links}
    assert linked == {1: (3, 1), 2: (3, 1), 14: (3, 1), 12: (3, 1)}          # id 12 twice is one vector
    assert all(r.kept for r in got if r.vec_id not in (2, 12, 14))
    assert mj.near_vectors(df.where("false")).count() == 0
