"""Operator 3: held-out accuracy, calibration and defined results of odd rows."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
from helpers import EDGE, documents

from chronoframe.llm import langid

SF = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF)
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    t = pq.read_table(SF).to_pandas()
    held = [(i, lang) for i, lang in zip(t.doc_id, t.lang) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(got) == len(t) and {i for i, r in got.items() if r.held_out} == {i for i, _ in held}
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(r.rejected for r in got.values()) <= len(got) // 200


def test_label_source_and_id_are_not_inputs(spark):
    docs = spark.read.parquet(SF)
    model = langid.fit(docs, sample_rows=240)
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    b = {r.doc_id - 5: (r.lang_pred, r.score) for r in langid.predict(docs.selectExpr("doc_id + 5 AS doc_id", "text"), model).collect()}
    assert a == b


def test_edge_rows(spark):
    rows = [(i, t, "en") for i, t in EDGE] + [(1000 + k, "the cat sat on the mat " * 5, "en") for k in range(30)] + [(2000 + k, "der hund und die katze " * 5, "de") for k in range(30)]
    rows += [(3000, "12345 !! ² Ⅷ ①", "de"), (3001, "THE CAT SAT ON THE MAT", None), (3002, "ζξψω θλπ βγδ " * 9, None)]
    df = documents(spark, rows)
    model = langid.fit(df)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in langid.predict(df, model, carry=("text", "_id")).collect()}
    for i in (1, 2, 3, 3000):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[3001].lang_pred == "en" and not got[3001].rejected and got[3001]["_id"] == "x"
    assert got[3002].rejected
    assert len(langid.predict(df, model).collect()) == len(rows)
    empty = df.where("false")
    none = langid.fit(empty)
    assert none.languages == [] and langid.predict(empty, none).count() == 0
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}


def test_the_sample_is_bounded_when_ids_repeat(spark, monkeypatch):
    rows = [(1, f"the cat and the dog number {k} " * 3, "en") for k in range(400)] + [(k, f"der hund und die katze {k} " * 3, "de") for k in range(10, 200)]
    taken = []
    train = langid.train
    monkeypatch.setattr(langid, "train", lambda texts, labels, **o: taken.append(len(texts)) or train(texts, labels, **o))
    model = langid.fit(documents(spark, rows), sample_rows=60)
    assert taken[0] <= 60 and model.languages == ["de", "en"]


def test_long_text_is_read_whole():
    model = langid.train(["the cat and the dog " * 3, "der hund und die katze "] * 40, ["en", "de"] * 40)
    text = "the cat and the dog " * 200 + "der hund und die katze " * 100_000
    assert model.predict(text)[0] == "de"
    parts = list(langid.blocks(text, 1000))
    assert sum(len(langid.grams(p, 1 << 16)) for p in parts) >= len(langid.grams(text, 1 << 16))


def test_other_scripts_languages_and_random_letters_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(docs)
    r = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    strange = ["Съешь же ещё этих мягких французских булок, да выпей чаю. ", "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία. Όλοι οι άνθρωποι. ",
               "我能吞下玻璃而不伤身体。人人生而自由,在尊严和权利上一律平等。", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności. ",
               "".join(r.choice("0123456789abcdef") for _ in range(600)), "".join(r.choice(letters) for _ in range(600)),
               " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(120))]
    for text in strange:
        for n in (16, 32, 64, 128, 600):
            assert model.predict((text * 40)[:n])[2], (text, n)
    assert min(model.least_score) > 1 / len(model.languages)
    t = pq.read_table("/root/testdata/sf0.1/documents.parquet").to_pandas()
    held = [x for i, x in zip(t.doc_id, t.text) if zlib.crc32(str(i).encode()) % 4 == 2 and x and langid.has_letter(x)]
    assert sum(model.predict(x)[2] for x in held) <= 2 * langid.REJECTS * len(held) + 3


def test_languages_with_long_texts_alone_and_many_languages_are_learned(spark):
    r = random.Random(2)
    alphabets = [[chr(0x4E00 + 20 * k + j) for j in range(20)] for k in range(71)]  # one for each language
    text = lambda a, n: "".join(r.choice(a) if j % 6 else " " for j in range(1, n))
    rows = [(100 * k + j, text(a, 15_000 if k == 70 else 120), f"l{k:02}") for k, a in enumerate(alphabets) for j in range(12 if k == 70 else 24)]
    model = langid.fit(documents(spark, rows, clash=False), epochs=1)
    assert model.languages == [f"l{k:02}" for k in range(71)]
    model = langid.fit(documents(spark, [x for x in rows if x[2] in ("l00", "l70")], clash=False), epochs=60)  # few rows: more turns
    assert model.predict(text(alphabets[70], 400))[0] == "l70"
