from fractions import Fraction
from itertools import islice

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import mixing
from tests.llm.common import no_documents, odd_documents, rows_of


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 40), min_size=1, max_size=12))
@settings(max_examples=80, deadline=None)
def test_every_prefix_is_less_than_one_block_off(shares):
    period, plan = sum(shares.values()), mixing.pfair_period(shares)
    assert [p[4] for p in plan] == list(range(period))
    run = dict.fromkeys(shares, 0)
    for source, k, release, due, slot in plan:
        assert run[source] == k and release <= slot < due
        run[source] += 1
        assert all(abs(run[s] * period - shares[s] * (slot + 1)) < period for s in shares)
    assert run == shares


def test_whole_shares_follow_weights():
    shares = mixing.whole_shares({"a": 1.0, "b": 2.0, "c": 0.001})
    assert sum(shares.values()) >= 10_000 and abs(shares["b"] - 2 * shares["a"]) <= 2 and shares["c"] >= 3
    for bad in ({}, {"a": 0.0}, {"a": 1.0, "b": 1e-9}):
        with pytest.raises(ValueError):
            mixing.whole_shares(bad)


def test_schedule_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = mixing.schedule(docs, ["doc_id", "text"], block_chars=10).select("row.*", "mix.*").collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert sum(r.epoch == 0 for r in rows) == docs.count()  # each row once, repeats in later epochs
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(no_documents(spark)).count() == 0


def test_schedule_keeps_the_weights(spark):
    docs = spark.createDataFrame([(i, "x" * 10, "hot" if i % 3 else f"s{i % 4}") for i in range(900)],
                                 "doc_id long, text string, source string")
    weights = {"hot": 3.0, "s0": 1.0, "s1": 1.0, "s2": 1.0, "s3": 2.0}
    rows = mixing.schedule(docs, ["doc_id"], weights, block_chars=20).select("row.*", "mix.*").collect()
    slots = {r.slot: r.source for r in rows}
    assert sorted(slots) == list(range(len(slots)))
    run = dict.fromkeys(weights, 0)
    for slot in range(len(slots)):
        run[slots[slot]] += 1
        assert all(abs(run[s] - w / 8 * (slot + 1)) < 1.02 for s, w in weights.items())
    order = [r.doc_id for r in sorted((r for r in rows if r.source == "hot" and r.epoch == 0), key=lambda r: (r.slot, r.at))]
    assert order == [i for i in range(900) if i % 3]
    with pytest.raises(ValueError):
        mixing.schedule(docs, ["doc_id"], {**weights, "hot": 0.001}, block_chars=20)
    with pytest.raises(ValueError):
        mixing.schedule(docs, ["doc_id"], {"hot": 1.0})


def test_a_tiny_source_beside_many_blocks():
    blocks = {"": 1, "a": 500_000, **{f"s{i}": 52_632 for i in range(19)}}
    shares = mixing.whole_shares({s: b**0.9 for s, b in blocks.items()}, 0)
    assert all(p[2] <= p[4] < p[3] for p in islice(mixing.pfair(shares, blocks), 20_000))
    blocks = {"": 1, "a": 1_500_000}
    shares = mixing.whole_shares({s: b**0.9 for s, b in blocks.items()}, 0)
    assert shares["a"] / shares[""] == pytest.approx(1_500_000**0.9)
    many = {f"s{i}": 1 for i in range(300_000)}
    assert sum(1 for _ in mixing.pfair(mixing.whole_shares(many, 0), many)) == 300_000


def test_schedule_takes_a_source_under_four_millionths(spark):
    docs = spark.createDataFrame([(0, "x", None), (1, "x" * 300_000, "a"), (2, "x", "a")],
                                 "doc_id long, text string, source string")
    weights = {"": 1.0, "a": 300_001.0}
    joined, looked_up = [sorted(mixing.schedule(docs, ["doc_id"], weights, block_chars=1, broadcast_slots=n).select(
        "row.*", "mix.*").collect()) for n in (0, 500_000)]
    assert joined == looked_up and {r.doc_id for r in joined} == {0, 1, 2}
    assert max(r.slot for r in joined) >= 300_000


def test_a_long_run_stays_at_the_unrounded_weights():
    blocks = {"hot": 100_000, **{f"s{i}": 10_526 for i in range(19)}}
    weights = {s: b**0.9 for s, b in blocks.items()}
    total = sum(map(Fraction, weights.values()))
    run = dict.fromkeys(blocks, 0)
    for source, _, _, _, slot in mixing.pfair(mixing.whole_shares(weights, 0), blocks):
        run[source] += 1
    assert slot > 300_000 and all(abs(run[s] - (slot + 1) * Fraction(w) / total) < 1 for s, w in weights.items())
