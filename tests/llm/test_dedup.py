import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.llm import components, exact_dedup, simhash
from tests.llm.common import no_documents, odd_documents, rows_of


def expected_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda i: (i != keep, i is None, i or 0))):
            out.append((i, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("block_bytes", [4, 8192])
def test_exact_dedup_is_brute_force(spark, block_bytes):
    docs = odd_documents(spark).filter("doc_id <> 5 or doc_id is null") if block_bytes == 4 else odd_documents(spark)
    got = rows_of(exact_dedup.exact_duplicates(docs, block_bytes))
    assert order(got) == order(expected_exact([(r.doc_id, r.text) for r in docs.collect()]))


def test_exact_dedup_survives_equal_digests(spark):
    random.seed(3)
    rows = [(i, "".join(random.choice("ab ") for _ in range(random.randint(0, 12)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for digest in (lambda c: F.lit(1).cast("long"), lambda c: F.length(c).cast("long")):
        assert order(rows_of(exact_dedup.exact_duplicates(docs, 3, digest))) == order(expected_exact(rows))


def test_exact_dedup_of_nothing(spark):
    assert rows_of(exact_dedup.exact_duplicates(no_documents(spark))) == []


def union_find(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def test_components_of_chains_stars_and_noise(spark):
    random.seed(1)
    links = [(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 90)] + [
        (random.randint(100, 160), random.randint(100, 160)) for _ in range(40)] + [(200, 200)]
    got = dict(rows_of(components.components(spark.createDataFrame(links, "a long, b long"))))
    roots = union_find(201, links)
    assert got == {i: roots[i] for a, b in links if a != b for i in (a, b)}
    assert rows_of(components.components(spark.createDataFrame([], "a long, b long"))) == []


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
@settings(max_examples=300, deadline=None)
def test_masks_cover_every_pair_within_the_radius(value, bits):
    other = value ^ sum(1 << i for i in bits)
    assert any(value & m == other & m for m in simhash.covering_masks())


def test_masks_leave_half_of_the_bits():
    assert len(simhash.covering_masks()) == 15
    assert all(30 <= m.bit_count() <= 36 for m in simhash.covering_masks())


def expected_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "One TWO three", "a b c a b c a b c d", "É x\x0by z\u00a0w v"])
def test_fingerprint_is_brute_force(text):
    assert simhash.simhash(text.encode() if text is not None else None) & (2**64 - 1) == expected_fingerprint(text)


@pytest.mark.parametrize("dense", [2, 5, 256])
def test_links_of_small_and_large_buckets_connect_alike(spark, dense):
    rng = np.random.default_rng(dense)
    values = set()
    for _ in range(6):
        centre = int(rng.integers(0, 2**63))
        for _ in range(25):
            values.add(centre ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))))
    values = sorted(v - 2**64 if v >> 63 else v for v in values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    found = rows_of(simhash.links(fps, dense=dense))
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    assert all(near(a, b) for a, b in found)
    place = {v: i for i, v in enumerate(values)}
    brute = [(i, j) for i in range(len(values)) for j in range(i) if near(values[i], values[j])]
    assert union_find(len(values), [(place[a], place[b]) for a, b in found]) == union_find(len(values), brute)


def test_near_duplicates_of_odd_documents(spark):
    docs = odd_documents(spark)
    got = rows_of(simhash.near_duplicates(docs))
    assert len(got) == docs.count()
    prints = {r.doc_id: expected_fingerprint(r.text) for r in docs.filter("doc_id not in (1, 5)").collect()}
    found = {i: (int(f, 16), c) for i, f, c in got if i not in (None, 1, 5)}
    assert {i: f for i, (f, _) in found.items()} == prints
    assert found[2][1] == found[3][1] == found[4][1] == 2  # without words: fingerprint zero, linked
    assert found[6][1] == found[8][1] == 6
    assert {c for i, _, c in got if i is None} == {1}  # the same words as document 1
    assert rows_of(simhash.near_duplicates(no_documents(spark))) == []


def test_one_document_of_each_component_stays(spark):
    docs = odd_documents(spark)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 5, 6, 7, 9]  # id 1 names two different texts
    nameless = spark.createDataFrame([(None, "x y z"), (None, "x  y z"), (None, "q")], "doc_id long, text string")
    assert simhash.without_near_duplicates(nameless).count() == 2
    assert simhash.without_near_duplicates(no_documents(spark)).count() == 0
