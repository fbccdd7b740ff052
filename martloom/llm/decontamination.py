"""Benchmark decontamination by template canonicalisation, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import blank, stored, up_to

WINDOW = 8
LEAST_LITERALS = 4  # words of a window that are no placeholders
LEAST_WORDS = 12  # words of an item that a document must repeat in line, or the whole item
BROADCAST_WINDOWS = 500_000  # about 20 MB; above that the windows meet in a shuffle
NUMBER, NAME, UNIT = "#number", "#name", "#unit"  # no word has a #
LEAST_SHORT = 4  # an item of fewer words must stand in the document with its marks too
# Words, numbers, and the marks after which a sentence, a line or a quotation starts.
MARKS = list(".!?:\n\"([{\u201c\u201d\u201e\u00ab\u00bb")
# Scripts written without spaces: Thai, Lao, Burmese, Khmer, Chinese, Japanese.  Each sign is a word.
SIGNS = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
OTHERS = r"[0-9]+(?:[.,][0-9]+)*|[.!?:\n\"(\[{\u201c\u201d\u201e\u00ab\u00bb]+"
TOKEN = r"[\p{L}\p{M}]+|" + OTHERS
TOKEN_OR_SIGN = r"[\p{L}\p{M}&&[^" + SIGNS + r"]]+|[\p{L}\p{M}&&[" + SIGNS + r"]]|" + OTHERS  # the slower one
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion").split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre "
    "kilometres g kg mg gram grams kilogram kilograms ton tons tonne tonnes lb lbs pound pounds oz ounce ounces l ml "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees c f k w kw "
    "watt watts v volt volts j joule joules n newton newtons pa hz mph kmh").split()
NO_ID = -(1 << 63)


def tokens(text: Column, signs: bool = True) -> Column:
    """Words, numbers and sentence marks of a text; null has none.  Without `signs` runs of
    letters of any script are words, which is faster."""
    return F.regexp_extract_all(blank(text), F.lit(TOKEN_OR_SIGN if signs else TOKEN), F.lit(0))


def _is_mark(token: Column) -> Column:
    return F.substring(token, 1, 1).isin(MARKS)


def flat(text: Column) -> Column:
    """A text in lower case with single spaces."""
    return F.lower(F.regexp_replace(blank(text), r"\s+", " "))


def words(found: Column) -> Column:
    """The words and numbers among tokens."""
    return F.filter(found, lambda t: ~_is_mark(t))


def _is_number(word: Column) -> Column:
    return ((word >= "0") & (word < ":")) | F.lower(word).isin(NUMBER_WORDS)


def canonical(found: Column) -> Column:
    """For each word its lower case or the placeholder of its type: a number in digits
    or words, a unit if it follows a number, a name if it starts with a capital inside a
    sentence.  Words all in capitals are no names: a shouted text is the same text."""

    def one(token: Column, i: Column) -> Column:
        low = F.lower(token)
        before = F.get(found, i - 1)
        name = (F.substring(token, 1, 1) != F.substring(low, 1, 1)) & (F.length(token) > 1) & (
            F.substring(token, 2, 1 << 20) == F.substring(low, 2, 1 << 20)) & (i > 0) & ~_is_mark(before)
        return (F.when(_is_mark(token), F.lit(None)).when(_is_number(token), F.lit(NUMBER))
                .when(low.isin(UNITS) & (i > 0) & _is_number(before), F.lit(UNIT))
                .when((low != token) & name, F.lit(NAME)).otherwise(low))

    return F.filter(F.transform(found, one), lambda w: w.isNotNull())


def lowered(found: Column) -> Column:
    """The words and numbers among tokens in lower case."""
    return F.transform(words(found), F.lower)


def _hashed(of: Column, at: Column, width: int, literal: bool) -> Column:
    return F.struct(at.alias("at"), F.lit(width).alias("width"), F.xxhash64(F.slice(of, at + 1, width)).alias("hash"),
                    F.lit(literal).alias("literal"))


def _windows(template: Column, low: Column, window: int, short: list[int] = []) -> Column:
    """(at, width, hash, literal) of each window of the template, of the words themselves where a
    window has placeholders, and of the words of windows of the widths `short`."""
    n = F.size(template)
    none = F.array().cast("array<struct<at:int,width:int,hash:bigint,literal:boolean>>")
    slots = F.filter(F.transform(template, lambda w, i: F.when(w.startswith("#"), i)), lambda i: i.isNotNull())
    changed = F.array_distinct(F.flatten(F.transform(
        slots, lambda p: F.sequence(F.greatest(p - window + 1, F.lit(0)), F.least(p, n - window)))))

    def all_of(of: Column, width: int, literal: bool) -> Column:
        return F.transform(F.sequence(F.lit(0), n - width), lambda i: _hashed(of, i, width, literal))

    parts = [F.when(n >= window, F.concat(
        all_of(template, window, False),
        F.transform(changed, lambda i: _hashed(low, i, window, True)))).otherwise(none)]
    parts += [F.when(n >= width, all_of(low, width, True)).otherwise(none) for width in short]
    return F.concat(*parts)


def _literals(template: Column) -> Column:
    return F.size(F.filter(template, lambda w: ~w.startswith("#")))


def _fits(pairs: Column, run: Column, least_words: int) -> Column:
    """Whether the values of slots fit a text made from the item: names and units map one to
    one and at least half of the different pairs of numbers do.  A run of `least_words` words that are the
    same settles it for numbers, one of twice as many for all."""

    def counts(of: Column) -> list[Column]:
        return [F.size(F.array_distinct(x)) for x in (
            of, F.transform(of, lambda p: p["of_doc"]), F.transform(of, lambda p: p["of_item"]))]

    n, doc, item = counts(F.filter(pairs, lambda p: p["kind"] == NUMBER))
    all_names, doc_names, item_names = counts(F.filter(pairs, lambda p: p["kind"] != NUMBER))
    numbers = (2 * F.least(doc, item) >= n) | (run >= least_words)
    return (numbers & (all_names == doc_names) & (all_names == item_names)) | (run >= 2 * least_words)


def _longest_run(first: Column, last: Column, same: Callable[[Column], Column]) -> Column:
    """The most places in a row for which `same` holds."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, place: Column) -> Column:
        now = F.when(same(place), state["now"] + 1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(F.sequence(first, last), zero, step, lambda state: state["most"])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the key of a row: its id (nulls have one number) and a hash of its text."""
    return docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(blank(F.col("text"))).alias("digest"))


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per row key of docs and benchmark item found in it: id, digest, item_id,
    matched_words, changed (slots that differ).

    Both texts become templates; windows of `window` words are joined by hash, those of the
    templates and those of the words in lower case.  Windows in line with each other (same
    distance between their places) are one candidate, and word by word comparison of
    the two texts along it counts the words that agree.
    The candidate holds if these are `least_words` or the whole item, and the
    values in the slots fit: a question with other numbers or names is found, a
    text that only has the same form is not.  An item shorter than a window is found where
    all its words follow each other; one of fewer than four words only where its marks stand
    there as well, so that "12 * 13 = ?" is not any 12 before a 13.  An item without a word
    and template windows with fewer than four literal words find nothing.  In scripts
    without spaces each sign counts as a word if any item has one.
    """
    # Signs are told from words only if an item has any.
    signs = not benchmark.filter(F.col("text").rlike(f"[{SIGNS}]")).isEmpty()
    items = benchmark.groupBy(blank(F.col("text")).alias("text")).agg(F.min("item_id").alias("item_id")).select(
        F.xxhash64("text").alias("item"), "item_id", tokens(F.col("text"), signs).alias("found"), F.trim(flat(F.col("text"))).alias("item_text")).select(
        "item", "item_id", "item_text", lowered(F.col("found")).alias("item_words"), canonical(F.col("found")).alias("item_template"))
    items = stored(items, "items")
    size = F.size("item_words")
    short = sorted(r["n"] for r in items.select(size.alias("n")).filter(
        F.col("n").between(1, window - 1)).distinct().collect())
    with_marks = any(n < LEAST_SHORT for n in short)  # else no whole text is needed beside its words
    found_in = F.explode(_windows(F.col("item_template"), F.col("item_words"), window, short)).alias("w")
    item_windows = stored(items.select("item", "item_template", size.alias("n"), found_in).filter(
        F.when(F.col("n") < window, F.col("w.width") == F.col("n")).otherwise((F.col("w.width") == window) & (
            F.col("w.literal") | (_literals(F.slice(F.col("item_template"), F.col("w.at") + 1, F.lit(window))) >= LEAST_LITERALS)))
    ).select("w.hash", "item", F.col("w.at").alias("item_at"), (F.col("w.at") + F.col("w.width") - 1).alias("item_end")), "item-windows")
    few = up_to(item_windows, BROADCAST_WINDOWS)
    keyed = _keyed(docs)
    templates = keyed.select("id", "digest", tokens(F.col("text"), signs).alias("found")).select(
        "id", "digest", canonical(F.col("found")).alias("template"), lowered(F.col("found")).alias("words"))
    windows = templates.select("id", "digest", F.explode(
        _windows(F.col("template"), F.col("words"), window, short)).alias("w")).select("id", "digest", "w.at", "w.hash")
    met = windows.join(F.broadcast(item_windows) if few else item_windows, "hash")
    lines = stored(met.groupBy("id", "digest", "item", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.min("item_at").alias("first"), F.max("item_end").alias("last")), "lines")
    named = lines.join(items, "item")
    texts = keyed.join(lines.select("id", "digest").distinct(), ["id", "digest"], "left_semi").dropDuplicates(
        ["id", "digest"]).select("id", "digest", tokens(F.col("text"), signs).alias("found"), (
            flat(F.col("text")) if with_marks else F.lit("")).alias("flat")).select(
        "id", "digest", "flat", lowered(F.col("found")).alias("words"), canonical(F.col("found")).alias("template"))
    both = texts.join(named, ["id", "digest"]).withColumn("places", F.filter(
        F.sequence("first", "last"),
        lambda p: (F.get("item_template", p) == F.get("template", p + F.col("shift")))
        | (F.get("item_words", p) == F.get("words", p + F.col("shift")))))
    slots = F.transform(
        F.filter("places", lambda p: F.get("item_template", p).startswith("#") & (
            F.get("item_template", p) == F.get("template", p + F.col("shift")))),
        lambda p: F.struct(F.get("words", p + F.col("shift")).alias("of_doc"), F.get("item_words", p).alias("of_item"),
                           F.get("item_template", p).alias("kind")))
    run = _longest_run(F.col("first"), F.col("last"), lambda p: F.coalesce(
        F.get("item_words", p) == F.get("words", p + F.col("shift")), F.lit(False)))
    held = both.withColumns({"slots": slots, "matched_words": F.size("places"), "run": run}).filter(
        (F.col("matched_words") >= F.least(F.lit(least_words), F.size("item_template"))) & _fits(
            F.col("slots"), F.col("run"), least_words))
    held = held.filter((F.size("item_words") >= LEAST_SHORT) | F.contains("flat", F.col("item_text")))
    return held.withColumn("changed", F.size(F.filter("slots", lambda s: s["of_doc"] != s["of_item"]))).groupBy(
        "id", "digest", "item_id").agg(F.max("matched_words").alias("matched_words"), F.min("changed").alias("changed"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_id (the smallest one
    found), matched_words (the most of one item).

    Null and empty texts hold no item; an empty benchmark finds nothing; repeated rows get the same answer."""
    found = stored(find_items(docs, benchmark, window, least_words).groupBy("id", "digest").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("item_id").alias("item_id"),
        F.max("matched_words").alias("matched_words")), "found")
    return _keyed(docs).drop("text").join(found, ["id", "digest"], "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "item_id", F.coalesce("matched_words", F.lit(0)).alias("matched_words"))


def without_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows and columns of docs in which no benchmark item is found."""
    found = stored(find_items(docs, benchmark, window, least_words).select("id", "digest").distinct(), "found")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(blank(F.col("row.text"))).alias("digest"))
    return rows.join(found, ["id", "digest"], "left_anti").select("row.*")
