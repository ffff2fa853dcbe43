"""Small fixtures: invented words, edge cases, columns with clashing names."""

import random

WORDS = ("river stone green lantern walks under quiet bridge while seven gentle foxes carry copper kettles "
         "toward winter harbour singing about salt bread candles orchard thunder marble paper window").split()


def text(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", str(rng.randrange(50))]) for _ in range(n))


def frame(spark, rows, schema, clashing):
    """``rows`` with extra columns whose names operators use inside."""
    df = spark.createDataFrame(rows, schema)
    for name in clashing:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def thue_morse(n: int) -> tuple[str, str]:
    """The word of ``n`` letters a and b that repeats nothing three times, and
    the same with the letters swapped; polynomial hashes modulo a power of two
    take them for one another."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))
