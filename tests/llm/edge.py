"""Documents with every awkward case that the operators must handle: nulls in any column, empty and very long texts,
repeated rows, one doc_id with two texts, and extra columns whose names the operators use themselves."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "kept", "fp", "h1", "pos", "col", "_t", "text_hash", "window", "match", "group", "ids", "start", "key")


def sentence(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))


def rows():
    long_line = "the same long line that many of the documents share, word for word"
    out = [
        (None, None, None, None, None), (None, sentence(1, 80), "en", None, 5), (1, "", "en", "a", 0),
        (2, None, "en", "a", None), (3, " \t\n\n \r", "en", "a", 5), (4, "one", None, "a", 3),
        (5, sentence(2, 60), "en", "a", 1), (5, sentence(2, 60), "en", "a", 1), (5, sentence(3, 60), "en", "b", 1),
        (6, sentence(4, 60) + "\n" + "\n".join([long_line] * 3), "en", "a", 1), (-7, sentence(5, 12000), "en", "a", 1),
        (1 << 40, "<|endoftext|> <|im_end|> İ é 한국 \U0001f600 \x00 \x1c x y", "xx", "a", 1),
    ]
    out += [(100 + i, sentence(10 + i, 55) + "\n" + long_line.upper() + " \n", "en", "a", 1) for i in range(6)]
    return out


def documents(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})


def none(spark):
    return documents(spark).limit(0)
