import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martloom.llm import language
from tests.llm.common import LONG, no_documents, odd_documents, rows_of

FOLDER = "/root/testdata/sf0.01"


def grams(text):
    text = text.lower()
    return {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}


def test_kernel_is_brute_force():
    random.seed(2)
    texts = ["".join(random.choice("abcdé Ü中\n𝒳") for _ in range(random.randint(1, 60))) for _ in range(40)]
    spanned = [language._different(t) for t in texts[:10]]
    assert [len(s) for s in spanned] == [len(grams(t)) for t in texts[:10]]
    vocabulary = np.unique(np.concatenate(spanned))
    matrix = np.zeros((len(vocabulary), 10), np.float32)
    for k, s in enumerate(spanned):
        matrix[np.searchsorted(vocabulary, s), k] = 1 / np.sqrt(len(s))
    model = language.Model(*language._table(vocabulary), matrix, np.zeros((0, 0)), [])
    known = set.union(*map(grams, texts[:10]))
    want = [[len(grams(x) & grams(z)) / math.sqrt(len(grams(x) & known) * len(grams(z))) for z in texts[:10]] for x in texts]
    got = language._kernel(model, texts)
    assert np.allclose(got, want, atol=1e-5)


def test_segments_change_nothing(monkeypatch):
    whole = language._different("abcdefg hij " * 50 + "xyz")
    monkeypatch.setattr(language, "SEGMENT", 7)
    assert whole.tolist() == language._different("abcdefg hij " * 50 + "xyz").tolist()
    vocabulary = language._different("abc xyz")
    model = language.Model(*language._table(vocabulary), np.ones((len(vocabulary), 1), np.float32), np.zeros((0, 0)), [])
    texts = ["abc", "zzz xyz abc" * 5, "q", "bc"]
    small = language._kernel(model, texts)
    monkeypatch.setattr(language, "SEGMENT", 1 << 20)
    assert np.allclose(small, language._kernel(model, texts))
    # Batches of bounded size cover every text with a letter once.
    monkeypatch.setattr(language, "SEGMENT", 9)
    parts = np.concatenate([p for p, _ in language._kernels(model, pa.array(["abc", None, "", "12", "x" * 50, "é", "bc", "z"]))])
    assert parts.tolist() == [0, 4, 5, 6, 7]


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = language.predict(docs, language.fit(docs))
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows} == {True}
    assert all(0 <= r.score <= 1 for r in rows)
    for lang in ("en", "de", "fr", "es"):
        mine = [r for r in rows if r.held_out and r.lang == lang]
        assert len(mine) > 10 and sum(r.lang_pred == lang for r in mine) / len(mine) >= 0.95


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    other = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert language.fit(other).langs == language.fit(docs).langs
    a, b = (sorted(rows_of(language.predict(d, language.fit(d)))) for d in (docs, other))
    assert [r[:3] for r in a] == [r[:3] for r in b]


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = rows_of(language.predict(docs, language.fit(docs)))
    assert len(got) == docs.count()
    by_id = {}
    for doc_id, _, lang, score in got:
        by_id.setdefault(doc_id, set()).add((lang, score))
    assert by_id[2] == by_id[3] == by_id[4] == {("und", 0.0)}
    assert all(lang != "und" for i in (1, 5, 6, None) for lang, _ in by_id[i])
    assert rows_of(language.predict(no_documents(spark), language.fit(docs))) == []
    assert language.fit(no_documents(spark)) is None
    assert {r[2:] for r in rows_of(language.predict(docs, None))} == {("und", 0.0)}


def test_a_repeated_id_does_not_fill_the_sample(spark):
    rows = [(1, "le la les et une", "fr")] * 400 + [(i, f"the of and to {i}", "en") for i in range(3, 60)] + [(2, LONG, "la")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language._sample(docs, 20).collect()
    assert len(sample) == 20 and len({r.doc_id for r in sample}) == 20


@pytest.mark.parametrize("text, lang", [("the of and they", "en"), ("le la les et une", "fr"), ("12 34 !", "und"), ("", "und")])
def test_one_text(spark, text, lang):
    rows = [(i, w, k) for i in range(40) for k, w in (("en", "the of and to they"), ("fr", "le la les et une"))]
    docs = spark.createDataFrame([(i, w, k) for i, (_, w, k) in enumerate(rows)], "doc_id long, text string, lang string")
    asked = spark.createDataFrame([(1, text, None)], "doc_id long, text string, lang string")
    assert language.predict(asked, language.fit(docs)).first()["lang_pred"] == lang
