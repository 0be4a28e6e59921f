"""Small inputs shared by the tests of the training-data operators."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, size: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(words))


def docs(spark, rows):
    """Documents from (doc_id, text) pairs, with the other columns filled in."""
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)
