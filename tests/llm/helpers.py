"""Frames with every odd case, and plain versions of what the operators compute."""

import re

from pyspark.sql import functions as F

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PROSE = ("The quick brown fox jumps over the lazy dog while seven wizards box quietly near the frozen lake and nobody writes down "
         "what happened to the silver key that opened the tower door last winter in the old town by the sea ") * 6


def messy_rows():
    return [
        (1, PROSE + "one", "en", "a"), (2, PROSE + "two", "en", "a"), (3, PROSE + "one", "en", "b"), (3, PROSE + "one", "en", "b"),
        (None, PROSE + "one", "en", None), (4, None, None, "b"), (5, "", "en", None), (6, "   \n\t ", "de", "c"), (7, "Word", "en", "a"),
        (8, "é ü 中文 😀 ▁x  y\x00z", "fr", "a"), (9, "a " * 40_000, "en", "b"), (10, "x" * 30_000, "en", "c"),
        (11, "mail me: a.b@c-d.org or +1 (521) 555-2373, 10.0.0.1 and 4111 1111 1111 1111.", "en", "a"),
        (12, "Licensed under the Apache License, Version 2.0.\nMIT License, mit license", "en", "a"), (-13, "one two three four", "en", "a"),
        (14, "one two three four", "en", ""), (15, "line\nline\nline\n\nother", "en", "a"),
    ]


def messy(spark):
    """Documents with nulls, empty and long texts, ties and repeated rows, and columns named as results are."""
    df = spark.createDataFrame(messy_rows(), "doc_id bigint, text string, lang string, source string")
    clash = ["score", "n_words", "kept", "found", "label", "token", "rid", "n", "size", "host", "features", "id", "text_key", "a", "b"]
    return df.withColumn("n_chars", F.length("text")).withColumns({c: F.lit("x") for c in clash})


def empty(spark):
    return messy(spark).limit(0)


def words(text):
    return SPACE_WORD.findall(text or "")


def lower_words(text):
    return SPACE_WORD.findall((text or "").translate(LOWER))


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def documents(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
