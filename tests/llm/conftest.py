import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs or texts, with columns of other names that clash with inner ones."""

    def make(*texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        schema = "doc_id long, text string, id long, key string, row int, score string, words int, shard string, n long, component string"
        return spark.createDataFrame([(i, t, 1, "k", 2, "s", 3, "x", 4, "c") for i, t in rows], schema)

    return make


def prose(n, seed, vocabulary=4000):
    """n words without meaning."""
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
