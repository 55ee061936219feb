"""Small frames with the cases every operator must handle."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} part{i}" for i in range(60_000))

ROWS = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 63),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 63),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 63),
    (3, None, None, None, None),
    (3, None, None, None, None),
    (4, "", "de", "", 0),
    (None, "a text without an id\nin two lines", "fr", "b", 34),
    (None, None, None, None, None),
    (5, " \t\n ", "es", None, 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, "éé ÜÜ ß 日本語 😀 <|endoftext|> don't", None, "c", None),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def clashing(spark, rows=ROWS):
    """The rows beside columns that have the names operators use inside."""
    from pyspark.sql import functions as F

    names = ("id", "text_hash", "row", "key", "kept", "part", "lines", "spans", "items", "n", "shard",
             "curve", "n_words", "quarter", "covered", "_weight", "range", "slot", "window", "value")
    return docs(spark, rows).withColumns({name: F.lit("x") for name in names})
