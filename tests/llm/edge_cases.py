"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashes."""

LONG = "lorem ipsum dolor sit amet, " * 4000

#: Columns beyond those of documents, with names that operators use inside.
CLASHES = [
    "row", "key", "hash", "size", "rate", "copies", "spans", "base", "kept", "n_words", "vec",
    "id", "blank", "token", "cid", "rare", "component", "line", "held_out", "__x", "kind",
    "__id", "__h", "h", "times", "__blank", "__first", "first", "__hash", "__spans", "__row",
    "__size", "__key", "__copies", "__copy", "copy", "__language", "language", "masked", "_whole",
    "keep", "component_id", "n_shingles", "a dot . in it", "tick`ed", "batch", "t1", "gone", "at",
]

ROWS = [
    (1, "One short text.", "en", "a", 15),
    (1, "One short text.", "en", "a", 15),
    (1, "Another text under the same id.", "en", "a", 31),
    (2, "", "en", "b", 0),
    (3, None, "en", "b", None),
    (4, " \n\t ", None, None, 4),
    (None, "A text that has no id at all, but a few words more than others.", "fr", None, 63),
    (None, None, None, None, None),
    (7, LONG, "es", "c", len(LONG)),
    (8, "12345 67890 !!! ###", "xx", "c", 19),
    (9, "Ünïcödé 😀 text with wide characters 😀.", "de", "d", 39),
    (10, "same words here again\nsame words here again\nsame words here again", "en", "d", 65),
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_frame(spark, rows=ROWS):
    """The rows with one more column for each clashing name."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.selectExpr("*", *[f"'c {i}' AS `{c.replace('`', '``')}`" for i, c in enumerate(CLASHES)])


def no_rows(spark):
    return edge_frame(spark, [])
