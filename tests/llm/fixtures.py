"""Documents with nulls, empty and long texts, copies, repeated rows and columns whose names clash with internal ones."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h string, keep string, start int, key string, fp string"


def words(text):
    return WORDS.findall(text or "")


def sentence(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def edge_rows():
    common = sentence(30, 1)
    texts = [
        None, "", " \t\n ", "one", "one two three", sentence(19, 2), sentence(20, 3), sentence(400, 4), sentence(400, 4),
        f"{sentence(40, 5)}\n{common}\n{sentence(35, 6)}", f"{common} {sentence(25, 7)}", f"{sentence(25, 8)}\t{common}",
        f"{sentence(9, 9)} {common} {common} {common}", sentence(6000, 10), "Ünï — 日本語 \x0b tab\x0cfeed\r\n" * 8, " lead " + sentence(50, 11) + " ",
    ]
    rows = []
    for i, text in enumerate(texts):
        source = [None, "b", "a", "ä", "a"][i % 5]
        rows.append((100 + i if i != 3 else None, text, [None, "en", "de"][i % 3], source, len(text or ""), -1, "x", "y", 7, None, "z"))
    rows += [rows[7], rows[7], (None, None, None, None, None, None, None, None, None, None, None), (-5, common, "en", "a", 9, 1, "", "", 1, "", "")]
    return rows


def edge_documents(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, docs):
    return docs.filter("doc_id IS NOT NULL").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
