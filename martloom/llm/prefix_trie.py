"""The trie of conversations that share their first turns, by composable fingerprints.

A conversation is rebuilt from the first turns of its base and its own later turns.  The
fingerprint of a sequence is the pair (length, sum of the turns' numbers times powers of a
base, modulo primes): a monoid, in which the head of a base and the suffix of a conversation
are combined without writing a rebuilt text.  Prefixes with the same length and fingerprint
are a node.  Nodes are verified: all members refer to the same stored turn and to the same
parent, and a turn's reference stands for one role and text only; else another base is taken.

Each conversation owns the nodes of which it is the smallest member: an unbroken chain at
its end, as the members of a node are members of its parent.  So a sum over the subtree of a
node is the sum over the chain below it, and the whole chains of the other members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import blank, stored
from martloom.operators.ranges import in_ranges, running
from martloom.operators.skew import skew_join
from martloom.operators.windows import top_n

GROUP = 100  # conversations from a multiple of this on share its head
HEADS = 6  # a head has fewer turns than this
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
BASE = 1_000_003
ATTEMPTS = 20
DIGIT = 256
DIGITS = 4  # exponents below DIGIT ** DIGITS
CHUNK_IDS = 256
HOT_SHARE = 1000
FP = ["f1", "f2", "f3"]
PARENT = ["g1", "g2", "g3"]
NODE = ["depth", *FP]
TURN = ["n1", "n2"]


def _power(exponent: Column, base: int, prime: int) -> Column:
    """base ** exponent modulo the prime, from a table for each digit of the exponent."""
    out = F.lit(1).cast("long")
    for level in range(DIGITS):
        table = F.lit([pow(base, d * DIGIT**level, prime) for d in range(DIGIT)])
        digit = F.shiftright(exponent, 8 * level).bitwiseAND(F.lit(DIGIT - 1)).cast("int")
        out = (out * table[digit]) % prime
    return out


def _numbers(attempt: int) -> list[Column]:
    """A number modulo each prime for a turn, from its reference."""
    return [F.pmod(F.xxhash64(F.lit(attempt), F.lit(i), *TURN), F.lit(p).cast("long")) for i, p in enumerate(PRIMES)]


def _turns(conversations: DataFrame, attempt: int, digits: int) -> DataFrame:
    """The stored turns with the reference (n1, n2) of role and text: SHA-256 digits."""
    role, text = blank(F.col("role")), blank(F.col("text"))
    digest = F.sha2(F.concat(F.lit("" if not attempt else f"{attempt}#"), F.length(role).cast("string"), F.lit(":"), role, text), 256)
    part = lambda at: F.conv(F.substring("digest", at, digits), 16, 10).cast("long")
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        digest.alias("digest")).select("*", part(1).alias("n1"), part(16).alias("n2")).drop("digest")


def _clashing(turns: DataFrame) -> bool:
    """Whether a reference stands for two different turns."""
    return not turns.select(*TURN, "role", "text").distinct().groupBy(*TURN).count().filter("count > 1").isEmpty()


def _print_after(number: str, base: int, prime: int) -> Callable[[Column], Column]:
    """The fingerprint of the first turns of `head`, as a function of how many."""

    def add(state: Column, turn: Column) -> Column:
        return F.struct(((state["f"] + turn[number] * state["m"]) % prime).alias("f"), (state["m"] * base % prime).alias("m"))

    start = F.struct(F.lit(0).cast("long").alias("f"), F.lit(1).cast("long").alias("m"))
    return lambda d: F.aggregate(F.slice("head", 1, d), start, add, lambda state: state["f"])


def _members(turns: DataFrame, attempt: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, node, parent, turn, chars) for each prefix of each rebuilt conversation,
    and the node at which each ends.  No text is read."""
    base = BASE + 2 * attempt
    rows = turns.select(
        "conv_id", "turn", *TURN, F.length("text").cast("long").alias("chars"),
        F.expr(f"conv_id - conv_id % {GROUP}").alias("base"), (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"))

    # Heads: the first turns of the bases, with the fingerprint after each.
    first = top_n(rows.filter("conv_id = base"), ["base"], ["turn", *TURN], HEADS - 1)
    listed = F.array_sort(F.collect_list(F.struct("turn", *TURN, "chars", *[n.alias(f"t{i}") for i, n in enumerate(_numbers(attempt))])))
    heads = first.groupBy("base").agg(listed.alias("head"))
    prints = [F.transform(F.sequence(F.lit(1), F.size("head")), _print_after(f"t{i}", base, p)) for i, p in enumerate(PRIMES)]
    heads = stored(heads.select("base", "head", *[c.alias(k) for c, k in zip(prints, FP)]), "heads")

    k = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0))).cast("int")
    after = [F.when(F.col("k") > 0, F.expr(f"{f}[k - 1]")).otherwise(F.lit(0).cast("long")) for f in FP]
    convs = rows.groupBy("conv_id", "base", "h").agg(F.count(F.lit(1)).alias("n")).join(heads, "base", "left").withColumn("k", k)
    convs = stored(convs, "convs")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in [*FP, *PARENT, *TURN, "chars"]])
    zipped = F.posexplode(F.slice(F.arrays_zip("head", *FP), 1, F.col("k"))).alias("at", "x")
    before = [F.when(F.col("at") > 0, F.col(f)[F.col("at") - 1]).otherwise(F.lit(0).cast("long")).alias(g) for f, g in zip(FP, PARENT)]
    in_head = convs.filter("k > 0").select("conv_id", *FP, zipped).select(
        "conv_id", (F.col("at") + 1).cast("long").alias("depth"), *before,
        *[F.col(f"x.{f}").alias(f"_{f}") for f in FP], *[F.col(f"x.head.{c}").alias(c) for c in [*TURN, "chars"]])
    in_head = in_head.withColumnsRenamed({f"_{f}": f for f in FP})

    # Suffixes: running products over a conversation's own turns after its first h.
    order = ["conv_id", "turn", *TURN]
    joined = skew_join(rows, heads, "base", "left").withColumn("k", k).select(
        "conv_id", "turn", *TURN, "chars", "h", "k", *[c.alias(f) for c, f in zip(after, FP)])
    numbered = running(in_ranges(joined, order), ["conv_id"], order, {"place": F.lit(1).cast("long")})
    numbered = numbered.withColumn("e", F.col("place") - 1 - F.col("h"))
    own = F.col("e") >= 0
    exponent = F.greatest("e", F.lit(0))
    numbered = numbered.withColumns({
        f"t{i}": F.when(own, t * _power(exponent, base, p) % p).otherwise(F.lit(0).cast("long"))
        for i, (t, p) in enumerate(zip(_numbers(attempt), PRIMES))})
    summed = running(numbered, ["conv_id"], order, {f"s{i}": F.col(f"t{i}") for i in range(len(PRIMES))}).filter("e >= 0")
    lift = [F.lit([pow(base, d, p) for d in range(HEADS)])[F.col("k")] for p in PRIMES]
    combined = [(F.col(f) + m * (F.col(f"s{i}") % p)) % p for i, (f, m, p) in enumerate(zip(FP, lift, PRIMES))]
    parents = [(F.col(f) + m * ((F.col(f"s{i}") - F.col(f"t{i}")) % p)) % p for i, (f, m, p) in enumerate(zip(FP, lift, PRIMES))]
    in_suffix = summed.select(
        "conv_id", (F.col("k") + F.col("e") + 1).alias("depth"), *[c.alias(f) for c, f in zip(combined, FP)],
        *[c.alias(g) for c, g in zip(parents, PARENT)], *TURN, "chars")
    in_suffix = stored(in_suffix, "suffixes")
    last = in_suffix.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = in_suffix.join(last, ["conv_id", "depth"]).select("conv_id", *NODE).unionByName(
        convs.filter("n <= h").select("conv_id", F.col("k").cast("long").alias("depth"), *[c.alias(f) for c, f in zip(after, FP)]))
    columns = ["conv_id", *NODE, *PARENT, *TURN, "chars"]
    return root.select(columns).unionByName(in_head.select(columns)).unionByName(in_suffix.select(columns)), ends


def _nodes(members: DataFrame) -> DataFrame:
    """A row for each node; `whole` unless members differ in their turn or parent."""
    same = [*PARENT, *TURN, "chars"]
    return stored(members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in same],
        *[F.max(c).alias(f"max_{c}") for c in same]).select(
        *NODE, "conv_id", "n_convs", *same, F.expr(" and ".join(f"{c} = max_{c}" for c in same)).alias("whole")), "nodes")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the sorted ids that end at each node.  Ids are joined in chunks; the
    chunks of a larger group go through one hash one after the other, never together."""
    order = [*NODE, "conv_id"]
    chunks = running(in_ranges(ends, order), NODE, order, {"place": F.lit(1).cast("long")}).withColumn(
        "chunk", F.expr(f"(place - 1) div {CHUNK_IDS}")).groupBy(*NODE, "chunk").agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    chunks = stored(chunks, "ends")
    large = chunks.filter("chunk = 1").select(*NODE, F.lit(True).alias("large"))
    marked = chunks.join(large, NODE, "left")
    small = marked.filter("large is null").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for rows in batches:
            done = []
            for *node, ids in rows[[*NODE, "ids"]].itertuples(index=False):
                if node != at:
                    if at is not None:
                        done.append([*at, state.hexdigest()])
                    at, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([[*at, state.hexdigest()]], columns=[*NODE, "ends_sha256"])

    schema = ", ".join(f"{c} long" for c in NODE) + ", ends_sha256 string"
    big = marked.filter("large").repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
    return small.unionByName(big.mapInPandas(digest, schema))


def _parents(tops: DataFrame, nodes: DataFrame, attached: DataFrame) -> DataFrame:
    """The smallest member of the parent of each chain's first node.  Parents with more
    than a thousandth of all chains, a thousand at most, are broadcast."""
    hot = attached.filter(F.col("attached") > max(1, tops.count() // HOT_SHARE)).join(nodes, NODE).select(
        *NODE, F.col("conv_id").alias("hot_id"))
    above = [(F.col("depth") - 1).alias("depth"), *[F.col(g).alias(f) for g, f in zip(PARENT, FP)]]
    asked = tops.select(F.struct(*NODE).alias("node"), *above).join(F.broadcast(hot), NODE, "left")
    asked = stored(asked, "tops")
    found = asked.filter("hot_id is not null").select("node.*", F.col("hot_id").alias("above"))
    rest = asked.filter("hot_id is null").join(nodes.select(*NODE, F.col("conv_id").alias("above")), NODE).select("node.*", "above")
    return found.unionByName(rest)


def prefix_trie(conversations: DataFrame, digits: int = 15) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Rows without conv_id belong to no conversation; a null role or text is empty; a null
    turn comes first, and rows of one turn follow in the order of the SHA-256 of role and
    text, repeated rows one after the other.  Texts of any length are read twice, once for
    their digest and once to verify it (`digits`: hexadecimal digits of each half of a
    reference, at most 15).  No conversations: no rows, not even a root.
    """
    for attempt in range(ATTEMPTS):
        turns = _turns(conversations, attempt, digits)
        if _clashing(turns):
            continue
        members, ends = _members(turns, attempt)
        nodes = _nodes(members)
        if nodes.filter("not whole").isEmpty():
            break
    else:
        raise RuntimeError("references of turns or fingerprints clash with every base")

    tops = stored(nodes.groupBy("conv_id").agg(F.min("depth").alias("depth")).join(nodes, ["conv_id", "depth"]).filter("depth > 0"), "chains")
    attached = stored(tops.groupBy((F.col("depth") - 1).alias("depth"), *[F.col(g).alias(f) for g, f in zip(PARENT, FP)]).agg(
        F.count(F.lit(1)).alias("attached")), "attached")
    order = ["conv_id", "up"]
    chain = in_ranges(nodes.join(attached, NODE, "left").select(
        "conv_id", *NODE, "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        F.coalesce("attached", F.lit(0)).alias("attached"), (-F.col("depth")).alias("up")), order)
    chain = running(chain, ["conv_id"], order, {"below": F.col("saved"), "place": F.lit(1).cast("long")})
    leaf = F.when((F.col("place") == 1) & (F.col("attached") == 0), 1).otherwise(0).cast("long")
    chain = stored(running(chain, ["conv_id"], order, {"leaf": leaf}), "chain")

    whole = chain.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max("below").alias("below"), F.max("leaf").alias("leaf"))
    others = skew_join(members.select("conv_id", *NODE), whole, "conv_id").filter("depth < top").groupBy(*NODE).agg(
        F.sum("below").alias("more_below"), F.sum("leaf").alias("more_leaves"))
    parent = _parents(tops, nodes, attached)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return chain.join(others, NODE, "left").join(parent, NODE, "left").join(_end_hashes(ends), NODE, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs",
        (F.col("attached") + F.when(F.col("place") > 1, 1).otherwise(0)).alias("n_children"),
        (F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("below") + F.coalesce("more_below", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


ORACLE = r"""
WITH crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS r(i))),
own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM own), crc_table),
rebuilt AS (
    SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY part, i) AS d, role, text FROM (
        SELECT c.conv_id, 1 AS part, i, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND i <= h
        UNION ALL
        SELECT c.conv_id, 2, i, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND i > h) c),
members AS (
    SELECT conv_id, d AS depth, list(sha256(length(role) || ':' || role || text)) OVER (
        PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS p, length(text) AS chars FROM rebuilt
    UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
ending AS (
    SELECT p, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS s
    FROM (SELECT conv_id, p FROM members QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY p),
nodes AS (
    SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM members GROUP BY p, depth),
children AS (SELECT p[1 : depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (
    SELECT n.p[1 : e] AS p, e AS depth, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM nodes) n LEFT JOIN children c ON c.p = n.p GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves,
    CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(s, sha256('')) AS ends_sha256
FROM nodes n JOIN below b ON b.p = n.p AND b.depth = n.depth
LEFT JOIN children c ON c.p = n.p LEFT JOIN ending e ON e.p = n.p
LEFT JOIN nodes q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.p = n.p[1 : n.depth - 1]
"""
