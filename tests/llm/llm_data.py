"""Small awkward tables for the operators' tests."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))


def awkward(spark):
    """Null and repeated ids, null, empty, wordless, short and very long texts, clashing column names."""
    base = prose(1, 60)
    rows = [
        (1, base, "en", "x", 5),
        (1, base, "en", "x", 5),
        (2, base, None, None, None),
        (3, base + " tail1", "en", "y", 1),
        (4, None, "fr", "y", 1),
        (5, "", "fr", "y", 1),
        (6, "... !!! ???", "en", "y", 1),
        (7, "two words", "en", "y", 1),
        (None, prose(2, 50), "en", "y", 1),
        (None, "no id here", "en", "y", 1),
        (8, prose(3, 12000), "en", "z", 1),
        (9, "één Ünïcode – тест 日本語 text 123 4567", "fr", "z", 1),
        (5, prose(4, 40), "en", "z", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    clash = {"id": F.lit("own"), "key": F.lit(1.5), "score": F.lit("s"), "bands": F.lit("b"), "rid": F.lit(0), "length": F.lit("l"), "ids": F.lit(7)}
    return df.withColumns(clash)


def rows_of(df):
    return [tuple(r) for r in df.collect()]
