"""Small corpora with the cases that every operator has to stand."""

import random

WORDS = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "Eta", "theta", "iota", "kappa", "la", "mu", "nu", "xi", "pi"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) * (rng.random() < 0.5) for _ in range(n))


def rows(seed: int = 5, n: int = 60) -> list[tuple]:
    """Plain texts, nulls, empty and very long texts, copies, repeated rows, null ids and sources."""
    rng = random.Random(seed)
    out = [(i, prose(rng, rng.randrange(1, 200)), "en", f"src{i % 4}" if i % 3 else "src0") for i in range(n)]
    out += [(n, None, None, None), (n + 1, "", "en", "src1"), (n + 2, " \n\t ", "en", "src2"), (n + 3, "!!! ...", "en", "src2")]
    long = prose(rng, 30_000)
    out += [(n + 4, long, "en", "src1"), (n + 5, long + " more", "en", "src3")]
    out += [(n + 6 + i, out[7][1], "en", "src0") for i in range(20)]  # copies
    out += [out[3], out[3], (None, "an id is missing here", "en", None)]  # repeated rows
    return [(*r, None if r[1] is None else len(r[1])) for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def clashing(df, *names):
    """The same documents with extra columns that operators may want for themselves."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("x"))
    return df
