"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed=0, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def documents(spark, extra=()):
    long = words(6000, 3, 5000)
    rows = [(1, words(80, 1), "en", "a", 5), (2, words(80, 1), "en", "a", 5), (3, None, "en", "a", None), (4, "", None, None, 0),
            (5, long, "de", "b", 9), (None, words(60, 4), "de", None, 1), (None, words(60, 4), "de", None, 1),
            (6, "\n\t  ", "en", "b", 4), (7, words(70, 5) + " naïve café́ \U0001f642 \n" + words(30, 6), "fr", "b", 2),
            (8, words(80, 1) + " tail", "en", "b", 3), (8, words(55, 9), "en", "b", 3), *extra]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs, names):
    """The table with columns named like the operator's own results."""
    from pyspark.sql import functions as F
    return docs.withColumns({n: F.lit("mine") for n in names if n not in docs.columns})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
