"""Small inputs that every operator of the package must handle."""

from pyspark.sql import functions as F

#: names that operators use inside; an input may hold columns of the same names
CLASHING = ["k", "t", "id", "n", "row", "f", "d", "r", "doc", "set", "sig", "words", "label", "part", "f1", "tokens", "b", "s"]
LONG = "Alpha beta gamma.\n" + "word " * 60_000 + "\nomega"
ROWS = [
    (0, "", "en", "a", 0),
    (1, None, None, None, None),
    (2, "short", "xx", "a", 5),
    (3, LONG, "en", "b", len(LONG)),
    (3, LONG, "en", "b", len(LONG)),
    (4, " \t\n \n", "fr", "b", 5),
    (5, "Ünïcode İ Σ ς 日本語 🙂 <|endoftext|> é", "de", "c", 30),
    (None, "A row without an id and with a line that repeats\nx", "en", "a", 40),
    (6, "A row without an id and with a line that repeats\nx", "en", "a", 40),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


def no_documents(spark):
    return edge_documents(spark, [])


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
