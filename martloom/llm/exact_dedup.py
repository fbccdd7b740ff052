"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import blank, stored

BLOCK_BYTES = 8192
KEY = ["doc_id", "sha"]


def normalised(text: Column) -> Column:
    """Null as empty, every run of ASCII white space as one space."""
    return F.regexp_replace(blank(text), "[\\x20\\x09-\\x0D]+", " ")


def _sorted_names(values: DataFrame) -> DataFrame:
    """An integer for each different value: its place among the sorted values of its partition."""
    columns = values.columns
    return values.distinct().sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def _name_blocks(blocks: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """`blocks` with the integer name of each block in place of its bytes.

    Only names and 64-bit digests are joined back, so the bytes are shuffled once.  A
    digest that different blocks share names none of them: those blocks, normally
    none, are named by a join on the bytes themselves, with negative names.
    """
    names = stored(_sorted_names(blocks.select("block")).select(digest(F.col("block")).alias("digest"), "name"), "names")
    shared = stored(names.groupBy("digest").count().filter("count > 1").select("digest"), "shared-digests")
    rows = blocks.withColumn("digest", digest(F.col("block")))
    if shared.isEmpty():
        return stored(rows.drop("block").join(names, "digest").drop("digest"), "named")
    plain = rows.drop("block").join(names.join(shared, "digest", "left_anti"), "digest").drop("digest")
    odd = rows.join(shared, "digest", "left_semi").drop("digest")
    odd_names = stored(_sorted_names(odd.select("block")).withColumn("name", -1 - F.col("name")), "odd-names")
    return stored(plain.unionByName(odd.join(odd_names, "block").drop("block")), "named")


def _name_pairs(level: DataFrame) -> DataFrame:
    """One level up: adjacent names of a document become one."""
    even = F.col("pos") % 2 == 0
    pairs = stored(
        level.groupBy(*KEY, F.expr("pos div 2").alias("pos"), F.expr("(n + 1) div 2").alias("n")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(~even, F.col("name"))).alias("b"),
            F.max("copies").alias("copies")), "pairs"
    ).withColumn("has_b", F.col("b").isNotNull()).withColumn("b", F.coalesce("b", F.lit(0)))
    names = stored(_sorted_names(pairs.select("a", "b", "has_b")), "pair-names")
    return stored(pairs.join(names, ["a", "b", "has_b"]).drop("a", "b", "has_b"), "named")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, digest: Callable[[Column], Column] = F.xxhash64):
    """A row for each different (doc_id, normalised text): doc_id, sha, copies (rows
    that say so), level and name.  Two rows have the same level and name exactly if
    their normalised texts are the same.
    """
    texts = docs.select(F.col("doc_id"), normalised(F.col("text")).alias("text")).select(
        "doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.col("text").cast("binary").alias("bytes"))
    blocks = texts.withColumn("n", F.greatest(F.lit(1), F.ceil(F.length("bytes") / block_bytes))).select(
        *KEY, "bytes", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("pos")
    ).select(*KEY, "n", "pos", F.substring(
        F.col("bytes"), (F.col("pos") * block_bytes + 1).cast("int"), F.lit(block_bytes)).alias("block"))
    named = _name_blocks(blocks, digest)
    # Repeated rows fold here: one row per (doc_id, text, place), with their number.
    level = stored(named.groupBy(*KEY, "n", "pos", "name").agg(F.count(F.lit(1)).alias("copies")), "level")
    depth, done = 0, []
    longest = level.agg(F.max("n")).first()[0] or 0
    while longest:
        done.append(level.filter("n = 1").select(*KEY, "copies", F.lit(depth).alias("level"), "name"))
        if longest == 1:
            break
        level, longest, depth = _name_pairs(level.filter("n > 1")), (longest + 1) // 2, depth + 1
    if not done:
        return level.select(*KEY, "copies", F.lit(0).alias("level"), "name")
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, digest: Callable[[Column], Column] = F.xxhash64):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are cut into blocks of `block_bytes` bytes, sorted blocks become integers,
    and adjacent integers become one, level by level, until one is left per document:
    equal for equal normalised texts and for no others.  Null text is the empty text.
    A null doc_id counts as a document but is kept only where no row of its group
    has an id (keep_id is then null).  Of rows that repeat both doc_id and text one is kept.
    """
    ids = identities(docs, block_bytes, digest)
    groups = stored(ids.groupBy("level", "name").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups")
    return ids.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", F.lower(F.hex("sha")).alias("text_sha256"),
        F.posexplode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy", "one"),
    ).select("doc_id", "keep_id", "group_size",
             (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"), "text_sha256")


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM texts"""
