"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.llm.shared import stored

BITS = 64
WORDS = 3
SEED = 42
RADIUS = 3
DENSE = 256


def simhash(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """Fingerprint of a text as a signed 64-bit integer; 0 without words."""
    parts = (text or b"").lower().split()  # bytes: only A-Z and ASCII white space
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    span = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[: len(parts) - span + 1].tolist(), ends[span - 1 :].tolist())),
        np.uint64, len(parts) - span + 1)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded memory for long texts
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0].astype(np.int64))


def fingerprint(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    """SimHash of the whole text; null counts as empty."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, words, seed) for t in texts], dtype="int64")

    return hashed(text.cast("binary"))


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks; any two values that differ in at most `radius` bits are
    equal under one of them.

    Bit i gets a nonzero vector of radius+1 bits, and mask v holds the bits whose vector
    has an odd product with v.  The vectors of `radius` differing bits span no more than
    `radius` dimensions, so some nonzero v is orthogonal to all of them: mask v leaves
    every differing bit out.
    """
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _within(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links inside one bucket that connect whatever its links within the radius connect."""
    values = members.view(np.uint64)
    group = np.arange(len(values))
    out = []
    for i in range(len(values) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius)
        for j in near:
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                out.append((int(members[i]), int(members[j])))
    return out


def _small_buckets(members: DataFrame, radius: int) -> DataFrame:
    """Links of buckets with a bounded number of members: one task reads a whole bucket."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for rows in batches:
            out = []
            for table, key, fp in zip(rows["table"], rows["key"], rows["fp"]):
                if (table, key) != at:
                    out += _within(np.array(held, np.int64), radius)
                    at, held = (table, key), []
                held.append(fp)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(_within(np.array(held, np.int64), radius), columns=["a", "b"], dtype="int64")

    return members.repartition("table", "key").sortWithinPartitions("table", "key", "fp").mapInPandas(
        pairs, "a long, b long")


def _large_buckets(members: DataFrame, radius: int, masks: list[int]) -> DataFrame:
    """Links of buckets of any size, without a task that holds one.

    Two members within the radius have a value between them, no more than radius // 2
    bits from one (near) and radius - radius // 2 from the other.  Members of a bucket
    are equal under its mask, so only its free bits are flipped.  All members that
    meet at a value are linked to its smallest near member, which is within the radius
    of each of them.
    """
    near, far = radius // 2, radius - radius // 2
    flips = []
    for v, mask in enumerate(masks):
        free = [i for i in range(BITS) if not mask >> i & 1]
        sums = {0: 0}
        for step in range(1, far + 1):
            for value in [s for s, d in sums.items() if d == step - 1]:
                for i in free:
                    if not value >> i & 1:
                        sums.setdefault(value | 1 << i, step)
        flips += [(v, _signed(s), d <= near) for s, d in sums.items()]
    spark = members.sparkSession
    table = F.broadcast(spark.createDataFrame(flips, "table int, flip long, near boolean"))  # bounded by the radius
    met = members.join(table, "table").select(
        "table", "key", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "fp", "near")
    hub = met.filter("near").groupBy("table", "key", "value").agg(F.min("fp").alias("a"))
    return met.join(hub, ["table", "key", "value"]).filter("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """Links (a, b) between different fingerprints of the column fp, such that two
    fingerprints are connected exactly if links of at most `radius` differing bits
    connect them.

    Every fingerprint goes to one bucket per covering mask.  Buckets of two are
    compared in their aggregate, those of up to `dense` members by all their pairs,
    larger ones through the values between their members; no bucket is cut.
    """
    masks = covering_masks(radius)
    keys = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(v).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
        for v, m in enumerate(masks)])).alias("k")).select("fp", "k.table", "k.key")
    buckets = stored(keys.groupBy("table", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"), "buckets")
    twos = buckets.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    members = stored(keys.join(buckets.filter("n > 2").select("table", "key", "n"), ["table", "key"]), "members")
    out = twos.unionByName(_small_buckets(members.filter(F.col("n") <= dense), radius))
    large = members.filter(F.col("n") > dense).drop("n")
    return out if large.isEmpty() else out.unionByName(_large_buckets(large, radius, masks))


def classes(fps: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """(fp, label, component_id) for rows (doc_id, fp): one row per different
    fingerprint; label is the smallest fingerprint and component_id the smallest doc_id that links reach."""
    ids = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    labels = components(links(ids.select("fp"), radius, dense)).withColumnRenamed("node", "fp")
    labelled = stored(ids.join(labels, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), "first_id"), "labelled")
    firsts = stored(labelled.groupBy("label").agg(F.min("first_id").alias("component_id")), "firsts")
    return labelled.join(firsts, "label").select("fp", "label", "component_id")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, seed: int = SEED, radius: int = RADIUS, dense: int = DENSE,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and blank texts have fingerprint zero and are linked like any other.
    Null ids are never the smallest of a component; one without any id has a null component_id.
    """
    fps = stored(docs.select("doc_id", fingerprint(F.col("text"), words, seed).alias("fp")), "simhash")
    found = stored(classes(fps, radius, dense), "classes")
    return fps.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(
    docs: DataFrame, words: int = WORDS, seed: int = SEED, radius: int = RADIUS, dense: int = DENSE,
) -> DataFrame:
    """The columns of docs, one row per component: the one with the smallest doc_id, or
    any one where no row of the component has an id."""
    rows = stored(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("doc_id"),
        fingerprint(F.col("text"), words, seed).alias("fp")), "rows")
    found = stored(classes(rows.select("doc_id", "fp"), radius, dense), "classes")
    first = rows.join(found, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["label"]).select("row.*")
