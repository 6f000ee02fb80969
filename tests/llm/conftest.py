import random

import pytest

from harvestry.llm.queries import tokenizer_path

WORDS = "sun river stone green walk over under light dark house tree bird song rain cloud moss field winter early silent".split()


@pytest.fixture(scope="session")
def vocabulary():
    return tokenizer_path()


@pytest.fixture(scope="session")
def table(spark):
    """table(rows): documents (doc_id, text) with extra columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, "en", "s", 1.0, True, "x", 5, 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, score double, kept boolean, id string, n bigint, rank int")

    return make


@pytest.fixture(scope="session")
def odd():
    """Null ids and texts, empty texts, white space alone, a very long text, ties and repeated rows."""
    r = random.Random(5)
    long = " ".join(r.choice(WORDS) + str(r.randrange(900)) for _ in range(30_000))
    same = "one two three four five six seven eight nine ten\nlast line here that is long enough"
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, same), (6, same), (6, same), (None, same), (None, None), (7, "short"), (8, "ünï çødé — 中文 \U0001f372\nx")]


@pytest.fixture(scope="session")
def prose():
    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + (str(r.randrange(60)) if r.random() < 0.6 else "") for _ in range(n))

    return make
