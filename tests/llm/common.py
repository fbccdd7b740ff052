"""Small tables with every odd case, shared by the tests of the operators."""

from __future__ import annotations

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, fp string, label string, "
          "`row` int, key int, units int, judged int, mix int, id int, digest int, `block` int, `a.b` int")
EXTRA = ("s", "f", "l", 1, 2, 3, 4, 5, 6, 7, 8, 9)
LONG = "lorem ipsum dolor " * 60_000


def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, clashing names."""
    rows = [
        (1, "Some text of a few words.", "en", "a", 25), (1, "Some text of a few words.", "en", "a", 25),
        (1, "Another text under the same id", "en", "a", 30), (2, None, None, None, None), (3, "", "de", "", 0),
        (4, " \t\n ", "fr", "b", 4), (None, "Some text  of a few\nwords.", None, "b", 26),
        (None, "Some text  of a few\nwords.", None, "b", 26), (5, LONG, "en", "b", len(LONG)), (6, "word", "en", "c", 4),
        (7, "two words", "en", "c", 9), (8, "word", "en", "c", 4), (9, "çà ü 中文 \u3000 <|endoftext|> !", "xx", "d", None),
    ]
    return spark.createDataFrame([r + EXTRA for r in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]
