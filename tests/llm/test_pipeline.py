"""The pipeline against its stages in plain Python, and the registered queries against their SQL."""

import math
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
from helpers import bag, components, documents, jaccard, words
from test_line_chunks import brute as brute_lines
from tokenizers import Tokenizer

import corpus_pipeline
from chronoframe.llm import bagminhash, langid, queries
from chronoframe.plans.catalog import table

SF = "/root/testdata/sf0.001"


def test_run_against_plain_python(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    model = langid.fit(table(spark, SF, "documents"))
    rows = [(i, x) for i, x in zip(t.doc_id.tolist(), t.text) if not model.predict(x)[2]]
    rows = [(i, x) for i, x, _, gone in brute_lines(rows) if not gone or x]
    rep = {}
    for i, x in sorted(rows):
        rep.setdefault(x, i)
    bags = {i: bag(x) if len(x.split()) >= 5 else bag(x, max(1, len(x.split()))) for x, i in rep.items()}
    reps = sorted(bags)
    links = [(a, b) for a in reps for b in reps if a < b and bags[a] and bags[b] and jaccard(bags[a], bags[b]) >= 0.8]
    comp = components(reps, links)
    kept = {i: x for i, x in rows if i == comp[rep[x]] or not bags[rep[x]]}
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {i: zlib.crc32(np.array(tok.encode(x, add_special_tokens=False).ids + [2], dtype="<u4").tobytes()) for i, x in kept.items()}
    got = {}
    for p in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda p: (p.doc_id, p.start)):
        got[p.doc_id] = got.get(p.doc_id, b"") + bytes(p.ids)
    assert {i: zlib.crc32(x) for i, x in got.items()} == want


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(queries.SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(dict(zip(names, r))[c]) for c in cols) for r in res.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == want


def test_stages_on_edge_rows(spark):
    """Null ids, null and empty texts, repeats and columns of clashing names, stage by stage."""
    text = {k: " ".join(words(60, k)) for k in range(4)}
    rows = [(1, text[0], "x"), (5, text[0], None), (5, text[1], None), (5, text[1], None), (None, text[2], "x"), (None, text[2], "x"), (None, None, None),
            (7, None, None), (8, "", None), (9, "  ", None), (10, text[3] * 50, "x")]
    docs = documents(spark, rows)
    kept = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    near = kept(corpus_pipeline.near_dedup(spark, docs, SF))
    assert near == sorted([(1, text[0]), (5, text[1]), (None, text[2]), (None, None), (7, None), (8, ""), (9, "  "), (10, text[3] * 50)], key=repr)
    other = corpus_pipeline.near_dedup(spark, documents(spark, [(5, text[0]), (5, text[1]), (6, text[1])]), SF)
    assert kept(other) == sorted([(5, text[0]), (5, text[1])], key=repr)
    lines = kept(corpus_pipeline.line_dedup(spark, docs, SF))
    assert lines == sorted([(i, t) for i, t, _ in rows], key=repr)          # texts of one line are never cut
    seen = kept(corpus_pipeline.language(spark, docs, SF))
    assert all(t and t.strip() for _, t in seen) and len(seen) <= 7
    tokens = {}
    for p in corpus_pipeline.pack(spark, docs, SF).collect():
        tokens.setdefault(p.doc_id, []).append(p.length)
    assert tokens[7] == tokens[8] == tokens[9] == [1] and sum(1 for i, _, _ in rows if i is None) <= len(tokens[None])


def test_op9_sql_and_operator_agree_on_wordless_and_null_texts(spark):
    rows = [(1, ""), (2, ""), (3, None), (4, "  "), (5, "  "), (6, None), (7, "one two"), (8, "one two"), (9, "one two\n")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = bagminhash.near_duplicates(documents(spark, rows))
    res = con.execute(queries.SQL["op9_bagminhash"])
    cols = [d[0] for d in res.description]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(res.fetchall())
