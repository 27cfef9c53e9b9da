"""Documents with every odd case, and words as the contracts define them."""

import re

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

SPACES = b" \t\n\x0b\x0c\r"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = " ".join(f"passage{i}" for i in range(60))
LONG = " ".join(f"w{i % 701} Of the" for i in range(9000))

TEXTS = [
    (1, "The quick brown fox. All rights reserved.\nReleased under the MIT license."),
    (2, ""),
    (3, None),
    (4, " \t\n "),
    (5, "one"),
    (6, LONG),
    (7, f"before it {PASSAGE} after it"),
    (8, f"other words {PASSAGE} at the end"),
    (9, f"other words {PASSAGE} at the end"),
    (9, f"other words {PASSAGE} at the end"),
    (10, "Of " * 500),
    (11, "ÉCLAIR naïve 文字文字文字 \U0001f600 İstanbul K elvin x\x1cy"),
    (12, "a" * 5000),
    (13, "cc by CC-BY cc\nby General   Public-License general public LICENSES"),
    (14, "文字" * 3000),
    (15, "it's they're I'LL don't 12 3456 7, ... !!! $$$ ### | | <a> & %"),
    (None, f"no id {PASSAGE}"),
    (None, "no id"),
    (None, None),
]


def documents(spark, rows=TEXTS):
    """Columns of documents, and extra ones whose names the operators use themselves."""
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("text", StringType()),
            StructField("lang", StringType()),
            StructField("source", StringType()),
            StructField("n_chars", LongType()),
            StructField("row", StringType()),
            StructField("kept_id", LongType()),
            StructField("matches", IntegerType()),
            StructField("stratum", StringType()),
        ]
    )
    return spark.createDataFrame(
        [(i, t, None, "s", None, "r", i, 1, "x") for i, t in rows], schema
    )


def spaced(text):
    return (text or "").encode().split()


def worded(text):
    return WORD.findall((text or "").encode().lower())
