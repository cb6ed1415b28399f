"""Small tables with the awkward rows every operator must take."""

import os
import random

#: The driver tables the tests read.
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; a table may have them as columns of its own.
CLASHING = ("hash", "set", "n", "kept", "score", "label", "gram", "seed", "at", "digest", "row", "h", "words", "text_sha256", "host", "task", "rank", "length")


def prose(rng: random.Random, words: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(words))


def docs_frame(spark, texts, clash: bool = True):
    """``texts``: (doc_id, text); further columns have clashing names."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' as {name}")
    return df


AWKWARD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "one"), (None, None), (5, "a b c d"), (6, "A b C d"), (7, "word " * 30_000)]
