import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from martloom.llm import prefix_trie
from tests.llm.common import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, depth string, `leaf` int, h int, head string"
EXTRA = ("x", 1, 2, "y")

pytestmark = pytest.mark.usefixtures("many_parts")


def brute_force(rows):
    """The contract over rebuilt texts."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append(c)
        ends[whole].append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        out.append((
            members[0], len(p), nodes[p[:-1]][0] if p else None, len(members), sum(len(q) == len(p) + 1 for q in below),
            sum(not any(r[:-1] == q for r in nodes if r) for q in below),
            sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q),
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()))
    return sorted(out, key=str)


def made_up(seed, convs, most):
    random.seed(seed)
    rows = []
    for c in random.sample(range(0, 700), convs) + [0, 100, 300]:
        for t in range(random.randint(1, most)):
            rows.append((c, t, random.choice(["user", "bot"]), random.choice("ab") * random.randint(0, 2), *EXTRA))
    return rows


def got(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(rows_of(prefix_trie.prefix_trie(frame, **options)), key=str)


@pytest.mark.parametrize("seed, convs, most", [(1, 60, 8), (2, 120, 3), (3, 10, 40)])
def test_trie_is_brute_force(spark, seed, convs, most):
    rows = made_up(seed, convs, most)
    assert got(spark, rows) == brute_force(rows)


def test_odd_conversations(spark):
    rows = [(None, 0, "user", "lost"), (7, None, None, None), (7, None, "user", "é" * 9), (7, 3, "user", "x" * 300_000), (7, 3, "user", "x" * 300_000),
            (7, 3, "bot", "y"), (200, 0, "user", "hi"), (201, 5, "user", "only"), (202, 1, "", None), (202, 1, None, ""),
            (299, 0, "user", "hi"), (10**15, 0, "user", "hi"), (10**15 + 1, 0, "1:user", "a"), (10**15 + 2, 0, "1", "usera")]
    rows = [(*r, *EXTRA) for r in rows]
    assert got(spark, rows) == brute_force(rows)
    assert got(spark, rows[:1]) == [] and rows_of(prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA))) == []


def test_large_groups_of_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 3)
    rows = [(c, t, "user", "same", *EXTRA) for c in range(100, 400) for t in range(3)]
    rows += [(500, t, "bot", str(t % 5), *EXTRA) for t in range(300)]
    rows += [(c, 0, "user", "first", *EXTRA) for c in range(600, 640)] + [(c, 1, "user", str(c), *EXTRA) for c in range(600, 640)]
    assert got(spark, rows) == brute_force(rows)


def test_clashing_references_are_noticed(spark):
    rows = made_up(9, 30, 4)
    turns = prefix_trie._turns(spark.createDataFrame(rows, SCHEMA), 0, 15)
    assert not prefix_trie._clashing(turns)
    # With one digit a half two turns share a reference: found, and another salt is tried, up to the last.
    many = [(c, t, "user", str(c * 10 + t), *EXTRA) for c in range(100) for t in range(6)]
    with pytest.raises(RuntimeError, match="clash"):
        got(spark, many, digits=1)


def test_clashing_fingerprints_are_noticed(spark, monkeypatch):
    rows = made_up(4, 40, 6)
    monkeypatch.setattr(prefix_trie, "PRIMES", (2, 2, 3))
    turns = prefix_trie._turns(spark.createDataFrame(rows, SCHEMA), 0, 15)
    members, _ = prefix_trie._members(turns, 0)
    assert not prefix_trie._nodes(members).filter("not whole").isEmpty()
