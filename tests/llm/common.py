"""Small documents with every awkward case, and the words of a text."""

import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names the operators use inside, as columns of the input.
CLASHES = ["id", "sum", "rank", "before", "shard", "part", "__id", "__sum", "__drop", "__starts", "component", "size", "key", "node", "a.b"]


def documents(spark, texts, first=0, clashes=False):
    """Documents of texts, or of (id, text)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, first)]
    df = spark.createDataFrame([(i, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, len(t or "")) for k, (i, t) in enumerate(rows)], SCHEMA)
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(7).alias(c) for c in CLASHES])
    return df


def awkward():
    """Nulls, empty and very long texts, repeated rows, ties, odd white space."""
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
    line = "A line that is long enough to count."
    return [
        (1, None),
        (2, ""),
        (3, "   \n\t "),
        (4, "one"),
        (5, "one two"),
        (6, long),
        (7, long + "\n" + line),
        (8, line + "\n" + line + "\nshort\n"),
        (8, line + "\n" + line + "\nshort\n"),
        (9, "  " + line.upper() + "\x0b\nother text here\r\n"),
        (None, line + "\n"),
        (None, None),
        (10, "a " * 70),
        (11, "a b " * 40 + "tail"),
        (12, "é日本 " * 30 + "\U0001f600"),
    ]
