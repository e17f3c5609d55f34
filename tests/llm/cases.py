"""Hard rows for every operator on documents: nulls, empties, long texts, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = "the long text goes on and on " * 4000
ROWS = [
    (1, "A first plain text about rivers and the towns along them, written to be read.", "en"),
    (2, None, "en"), (3, "", "en"), (4, " \t\n ", None), (5, "12345 67890 !!!", "de"), (6, LONG, "en"),
    (7, "日本語のテキスト ▁ ▁▁ \U0001F600 \x00 end", "fr"), (8, "x" * 3000, "de"),
    (9, "same text twice over here", "en"), (9, "same text twice over here", "en"), (None, "a row without an id", "en"),
    (10, "same text twice over here", None),
]
CLASHING = ("key", "digest", "component", "score", "n", "lang_pred", "spans", "bucket", "a", "b", "words", "mass", "host",
            "kept", "sketch", "base", "value", "c0", "_key", "rep", "pieces", "label", "size")


def documents(spark: SparkSession, rows=ROWS) -> DataFrame:
    df = spark.createDataFrame([(i, t, x, f"s{(i or 0) % 2}") for i, t, x in rows],
                               "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).withColumn("n_chars", F.length("text").cast("long"))


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark).limit(0)
