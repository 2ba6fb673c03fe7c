"""Helpers of the tests of the llm subpackage."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """``df`` with extra columns named like the operators' own ones, NULL in all of them."""
    names = "w1 w2 w3 phrase f a l r level whole salt id digest place key n h1 h2 first size token part n_lines n_dropped kept score target taken g c t __id".split()
    for name in names:
        if name not in df.columns:
            df = df.selectExpr("*", f"cast(null as string) AS {name}")
    return df


def prose(seed, n, vocabulary=60, newline=0.1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 7))) for _ in range(vocabulary)]
    text = ""
    for _ in range(n):
        text += rng.choice(words) + ("\n" if rng.random() < newline else " ")
    return text
