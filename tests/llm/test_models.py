import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import decontamination, quality, toxicity
from tests.llm.common import no_documents, odd_documents, rows_of

SF = "/root/testdata/sf0.1"
ITEM = "Then Anna buys 12 apples for 3 dollars each and gives 4 of them to Peter before she walks 5 km back home to rest"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def benchmark(spark, *texts):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "item_id long, text string, template int")


@pytest.mark.parametrize("text, hit", [
    (f"Before. {ITEM}. After", True), (ITEM, True),
    (ITEM.replace("Anna", "Maria").replace("Peter", "Omar").replace("12", "30").replace("km", "miles"), True),
    (ITEM.replace("12", "twenty"), True),  # a number in words
    (ITEM.lower().replace("anna", "Anna").replace("peter", "Peter").replace("then", "THEN"), True),
    (ITEM.replace("Peter", "Anna"), False),  # two names become one: another question
    (" ".join(ITEM.split()[:9]), False), ("Completely different prose about nothing at all, in many more words than that", False),
    (None, False), ("", False)])
@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_templates_and_slots(spark, monkeypatch, text, hit, broadcast):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", broadcast)
    docs = spark.createDataFrame([(7, text, "x")], "doc_id long, text string, item_id string")
    row = decontamination.contamination(docs, benchmark(spark, ITEM, None, "", "too short")).first()
    assert (row["contaminated"], row["item_id"]) == (hit, 0 if hit else None)


@pytest.mark.parametrize("item, text", [
    ("Bright lanterns hang above the old stone bridge", "Question: {}"),
    ("Bright lanterns hang above the old stone bridge near our harbour", "as before\n{}"),
    ("Bright lanterns hang above the old stone bridge near our quiet little harbour", "see \u201c{}\u201d and (more"),
    ("It rains. Birds rest. Cats sleep. Dogs bark. We wait inside", "so it rains birds rest cats sleep dogs bark we wait inside"),
    ("Then we meet Anna and Peter and Omar and Maria at noon", "THEN We Meet Anna And Peter And Omar And Maria At Noon"),
    ("What is 17 times 23?", "He asked: what is 17 times 23"),
    ("12 14 17 23 39 41 52 60 75", "sums of 12, 14, 17, 23, 39, 41, 52, 60, 75 and so on"),
    ("Anna Peter Omar Maria Jonas Lena Igor Paul Olga", "Those were Anna Peter Omar Maria Jonas Lena Igor Paul Olga then")])
def test_exact_copies_after_marks_and_in_other_case(spark, item, text):
    docs = spark.createDataFrame([(1, text.format(item)), (2, "What is 17 times 24? " + " ".join(item.split()[1:7]))],
                                 "doc_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontamination.contamination(docs, benchmark(spark, item, "a b")).collect()}
    assert got == {1: True, 2: False}


LONG_COPY = " ".join(f"word{chr(97 + i)} other{chr(97 + i)}" for i in range(26))
PEARS = "Our cook takes 3 apples and 5 pears out of this basket then bakes one cake for every guest"


@pytest.mark.parametrize("item, text, hit", [
    (f"In 2019 {LONG_COPY} again 2019 ends", f"In 2019 {LONG_COPY} again 2020 ends", True),
    (f"Today Anna {LONG_COPY} as Peter left", f"Today Anna {LONG_COPY} as Anna left", True),
    (PEARS, PEARS.replace("3", "4").replace("5", "4"), True), (PEARS.replace("5", "3"), PEARS, True),
    (PEARS.replace("Our", "Then Anna tells Omar that"), PEARS.replace("Our", "Then Lena tells Lena that"), False)])
def test_slots_that_do_not_map_one_to_one(spark, item, text, hit):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert decontamination.contamination(docs, benchmark(spark, item)).first()["contaminated"] == hit


SHORT = ["Capital of France?", "12 * 13 = ?", "这本书的作者是谁？他在哪里出生？请写出他的名字。", "東京タワー", "42?"]


@pytest.mark.parametrize("text, hit", [
    ("Quiz. capital  of\nfrance? Paris.", {0}), ("The capital of France is Paris.", set()), ("Ask: 12 * 13 = ? now", {1}),
    ("rows 12, 13 and 14", set()), ("前言。这本书的作者是谁？他在哪里出生？请写出他的名字。后记。", {2}), ("这本书的作者是张三。他在北京出生。", set()),
    ("昨日東京タワーへ行った", {3}), ("東京へ行ったタワー", set()), ("Is it 42? Yes", {4}), ("It is 42.", set()), ("", set()), (None, set())])
def test_items_of_any_length_and_script(spark, text, hit):
    items = spark.createDataFrame([*enumerate(SHORT), (8, "?!"), (9, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, text), (2, "nothing of this")], "doc_id long, text string")
    assert {r.item_id for r in decontamination.find_items(docs, items).collect()} == hit
    assert decontamination.without_items(docs, items).count() == 2 - bool(hit)


def test_decontamination_of_odd_tables(spark):
    docs = odd_documents(spark)
    items = benchmark(spark, "lorem ipsum dolor " * 6, ITEM, ITEM)
    got = rows_of(decontamination.contamination(docs, items))
    assert len(got) == docs.count() and [r[0] for r in got if r[1]] == [5]
    kept = decontamination.without_items(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontamination.without_items(docs, spark.createDataFrame(
        [], "item_id long, text string")).count() == docs.count()
    assert decontamination.contamination(no_documents(spark), items).count() == 0


def test_decontamination_is_brute_force(spark):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    token = re.compile(r"[^\W\d_]+|[0-9]+(?:[.,][0-9]+)*")
    grams = set()
    for row in items.collect():
        words = token.findall(row.text.lower())
        grams |= {tuple(words[k : k + 12]) for k in range(len(words) - 11)}
    brute = set()
    for row in docs.select("doc_id", "text").collect():
        words = token.findall((row.text or "").lower())
        if any(tuple(words[k : k + 12]) in grams for k in range(len(words) - 11)):
            brute.add(row.doc_id)
    got = {r.doc_id for r in decontamination.contamination(docs, items).filter("contaminated").collect()}
    assert brute and got == brute


def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = quality.fit(docs, labels, labelled=2000)
    judged = quality.score_quality(docs, model).select("row.doc_id", "judged.*").join(labels, "doc_id").filter(
        F.crc32(F.col("doc_id").cast("string")) % 5 == 0).toPandas()
    assert (judged.keep == (judged.quality == 1)).mean() > 0.98
    assert (judged.keep | (judged.quality == 0)).mean() > 0.995  # clean documents stay


def test_quality_of_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    judged = quality.score_quality(docs, model)
    assert judged.select("row.*").columns == docs.columns and judged.count() == docs.count()
    assert judged.filter("judged.score is null or judged.score < 0 or judged.score > 1").count() == 0
    assert quality.score_quality(no_documents(spark), model).count() == 0
    assert quality.fit(no_documents(spark), labels.limit(0)) is not None
    assert quality.score_quality(docs.select("doc_id", "text"), model).count() == docs.count()  # no metadata


def test_co_training_teaches_the_blind_view():
    rng = np.random.default_rng(0)
    truth = rng.random(1200) < 0.5
    text = (truth + rng.normal(0, 0.2, 1200)).astype(np.float32)[:, None]
    meta = (truth + rng.normal(0, 0.3, 1200)).astype(np.float32)[:, None]
    taken = set()

    def pick(views, counts):
        new = [(v, y, i + 80) for v, y, _, i in quality.confident(views, text[80:], meta[80:], counts) if i + 80 not in taken]
        taken.update(i for *_, i in new)
        return [(v, y, text[i], meta[i]) for v, y, i in new]

    _, _, score = quality.co_train(text[:80], meta[:80], truth[:80].astype(int), pick).score(text, meta)
    assert ((score > 0.5) == truth).mean() > 0.98 and len(taken) > 200


def test_picks_are_the_surest_of_all_rows(spark):
    rng = np.random.default_rng(1)
    text = rng.normal(0, 1, (400, quality.TEXT_FEATURES)).astype(np.float32)
    meta = rng.normal(0, 1, (400, quality.META_FEATURES)).astype(np.float32)
    views = [quality.View(rng.normal(0, 1, x.shape[1] + 1), np.array([1.0, 0.0])) for x in (text, meta)]
    pool = spark.createDataFrame([(i, bytearray(t.tobytes()), bytearray(m.tobytes())) for i, (t, m) in enumerate(zip(text, meta))],
                                 "row_id long, text binary, meta binary").repartition(7)
    pick, counts = quality._best_of_all(pool), {1: 5, 0: 9}
    seen = set()
    for _ in range(2):  # the second round takes the next ones
        free = [i for i in range(400) if i not in seen]
        want = {(v, y, free[i]) for v, y, _, i in quality.confident(views, text[free], meta[free], counts)}
        got = [(v, y, int(np.flatnonzero((text == t).all(axis=1))[0])) for v, y, t, _ in pick(views, counts)]
        assert set(got) <= want and {i for *_, i in got} == {i for *_, i in want} and len(got) > 10
        seen |= {i for *_, i in got}


def test_toxicity_on_held_out_labels(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels))
    assert scored.count() == docs.count()
    # In this small table, labels of other languages mark documents without any word that toxic ones share.
    english = docs.filter("lang = 'en'").select("doc_id")
    held = scored.join(labels, "doc_id").join(english, "doc_id").filter("held_out").toPandas()
    assert (held.predicted == held.toxic).mean() > 0.97
    assert held.score.between(0, 1).all()


def test_toxicity_learns_from_an_id_once_however_often_it_is_repeated(spark):
    docs = spark.createDataFrame([(1, "b"), (2, None), (3, "c")] + [(1, "a")] * 50 + [(2, None)] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    got = toxicity._labelled(docs, labels).select("doc_id", "text", "toxic").collect()
    assert sorted(map(tuple, got)) == [(1, "a", 1), (2, None, 0)]


def test_toxicity_of_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None), (8, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.score_toxicity(docs, model).filter("score is not null").count() == docs.count()
    empty = toxicity.fit(no_documents(spark), labels.limit(0))
    assert toxicity.score_toxicity(docs, empty).filter("score between 0 and 1").count() == docs.count()
    assert toxicity.score_toxicity(no_documents(spark), model).count() == 0
