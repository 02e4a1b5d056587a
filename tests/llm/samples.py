"""Small tables with every awkward case, and plain-Python forms of what operators compute."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "_row string, _digest string, size int, score double, keep_id long, rate double, fp long, _id long, x int, b int"


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(words)) for _ in range(n))


def awkward():
    """Rows of (doc_id, text, lang, source, n_chars): nulls, empty and long texts, ties, repeats."""
    base = prose(1, 300)
    near = base.split()
    near[150] = "changed"
    rows = [
        (1, base, "en", "b", 1), (2, base.replace(" ", "\n\t ", 5), "en", "b", 2), (3, " ".join(near), "en", "a", 3),
        (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \n\t", "de", None, 3), (7, "one", "de", "c", 3),
        (8, "ONE two", "de", "c", 7), (9, "one TWO", "fr", "d", 7), (10, prose(2, 30_000), "fr", "d", 9),
        (11, "été 日本語 \U0001f600 " * 40, "fr", "d", 9), (12, prose(3, 50), "en", "a", 5),
        (12, prose(3, 50), "en", "a", 5), (13, prose(4, 900), "en", "b", 5), (None, prose(5, 60), "en", "a", 1),
        (None, "", None, None, None), (14, base + " ", "es", "e", 4), (15, "x\x1cy", "es", "e", 3),
    ]
    return rows + [(20 + i, prose(100 + i, 40 + 7 * i), "en", "abc"[i % 3], i) for i in range(40)]


def docs(spark, rows=None, clashing=False, parts=3):
    """As a table; ``clashing`` adds columns whose names an operator might use itself."""
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(parts)
    if clashing:
        from pyspark.sql import functions as F

        for field in CLASHING.split(", "):
            name, kind = field.split()
            df = df.withColumn(name, F.lit(7).cast(kind))
    return df


def whole(text):
    return text or ""


def squeezed(text):
    return SPACE.sub(" ", whole(text))
