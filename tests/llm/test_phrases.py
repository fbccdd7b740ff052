import random
import re
from collections import Counter

import pytest

from martloom.llm import phrases
from tests.llm.common import EXTRA, no_documents, odd_documents, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

pytestmark = pytest.mark.usefixtures("many_parts")


def brute_force(rows, least, best=2000, most=4):
    """The contract, word by word: rows are (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, most + 1):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, *longer), b in candidates.items())
        if not inside:
            cuts = [(2_000_000 * a // (f[lang, *words[:k]] + f[lang, *words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.append((lang, " ".join(words), a, f[lang, *words[:k]], f[lang, *words[k:]], n[lang], score))
    rows = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        rows += [(lang, i, *r[1:]) for i, r in enumerate(mine[:best], 1)]
    return sorted(rows)


def made_up(seed):
    random.seed(seed)
    words = ["a", "B", "b", "of", "é", "É", "New", "York", "new", "x\x00y", "中文", "o'k", "-"]
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", "\r", ";", "?"]
    fixed = ["new york city hall", "of the of the of the", "a a a a a"]
    rows = []
    for i in range(120):
        text = "".join(random.choice(words) + random.choice(ends) for _ in range(random.randint(0, 40)))
        rows.append((i, random.choice([None, "en", "und", "de", ""]), text + " " + random.choice(fixed)))
    return rows


@pytest.mark.parametrize("seed, least, best, chunk", [(1, 5, 2000, 50), (2, 30, 2000, 10**6), (3, 3, 7, 400), (4, 1, 50, 300)])
def test_phrases_are_brute_force(spark, seed, least, best, chunk):
    rows = made_up(seed)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    got = sorted(rows_of(phrases.collocations(docs, least, best=best, chunk_words=chunk, bucket_text=999, bucket_pairs=77)))
    assert got == brute_force([r[1:] for r in rows], least, best)


def test_phrases_of_odd_documents(spark):
    docs = odd_documents(spark).unionByName(odd_documents(spark)).repartition(2)
    want = brute_force([(r.lang, r.text) for r in docs.collect()], 2)
    assert sorted(rows_of(phrases.collocations(docs, 2))) == want and len(want) > 5
    assert rows_of(phrases.collocations(no_documents(spark))) == []
    assert rows_of(phrases.collocations(odd_documents(spark), 10**9)) == []


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000
    stream = spark.createDataFrame(
        [("en", 1, -1, -1, -1, 1, big + 1), ("en", 2, -1, -1, -1, 1, big + 2), ("en", 1, 2, -1, -1, 2, big)],
        "lang string, w1 long, w2 long, w3 long, w4 long, n_words int, f long")
    row = phrases._merged(stream, 4).withColumn("cut", phrases._worst_cut(3)).select("cut.*").first()
    assert tuple(row) == (2_000_000 * big // (2 * big + 3), 1, big + 1, big + 2)


def test_a_hot_language_and_phrase(spark):
    rows = [(i, "en", "the end of the line", *EXTRA[:1]) for i in range(3000)] + [(i, "fr", f"w{i}", "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, w1 string")
    want = brute_force([r[1:3] for r in rows], 30)
    assert sorted(rows_of(phrases.collocations(docs, chunk_words=500))) == want
