"""A small corpus with copies, near copies, shared passages and odd rows, and brute-force helpers."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns whose names the operators also use inside
    T.StructField("row", T.StringType()), T.StructField("h", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("key", T.StringType()), T.StructField("_id", T.StringType()),
    T.StructField("deleted", T.StringType()), T.StructField("order", T.StringType()),
])


def words(n, seed, vocabulary=300):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}é" if pick.random() < 0.1 else f"W{pick.randrange(vocabulary)}" for _ in range(n)]


def texts():
    passage = " ".join(words(60, "passage"))
    lines = [" ".join(words(9, f"line{i}")) for i in range(12)]
    out = []
    for i in range(30):
        out.append(" ".join(words(40 + 7 * i, i)))
    out[3] = out[2]  # copies
    out[4] = out[2]
    out[6] = out[5] + " tail"  # near copy
    for i in (8, 11, 17):
        out[i] = out[i] + " " + passage + " " + " ".join(words(20, f"after{i}"))
    out[12] = "\n".join(lines)
    out[13] = "\n".join(lines[:5] + ["and one of its own here in the middle"] + lines[5:])
    out[14] = "\n".join(lines[6:] + lines[:6])
    out[15] = "short\n\n" + lines[0] + "\nshort"
    out[16] = " ".join(["same"] * 120)  # one word again and again
    out[18] = " ".join(words(20_000, "long", 5000))
    out[19] = out[18][:60_000]
    return [*out, "", " \t\n\v", None, None, "x", "Ünïcödé ß " * 30, "a\r\nb c", "\x1c\x85 not blank\x00"]


def rows():
    found = [
        (i, t, ("en", "de", None)[i % 3], None if i % 7 == 0 else f"s{i % 4}", len(t or ""), *["x"] * 8)
        for i, t in enumerate(texts())
    ]
    found.append(found[9])  # a repeated row
    found.append((None, "no id at all " * 20, None, None, 3, *[None] * 8))
    found.append((None, None, None, None, None, *[None] * 8))
    found.append((9, "another text under a known id", "en", "s1", 4, *["x"] * 8))
    return found


def documents(spark, given=None):
    return spark.createDataFrame(rows() if given is None else given, SCHEMA).repartition(3)
