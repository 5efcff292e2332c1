import random

import pytest

WORDS = "the quick brown fox jumps over lazy dog and then runs home again with some more words der die und für le café ñandú".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): null, empty, blank, short, repeated, near and very long texts."""
    rng = random.Random(7)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(30)]
    texts = [None, "", " \t\n", "one", "two words", "three little words", "A\x0bB\x1cC\x85 D", " wide space"]
    texts += base + base[:10] + [b.replace(" ", "  \n") for b in base[:5]]
    texts += [" ".join(b.split()[:-1] + ["changed"]) for b in base[:12]]
    texts += ["same line\n" * 40, "x" * 70_000, prose(rng, 30_000), "### $$$ " * 60, "Straße ΣΑΣ ÉCOLE İstanbul é 日本語 😀 <|endoftext|> don't"]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names clash with names that operators use."""
    extra = [(i, t, "en", "s", "fp", 1, None) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, digest string, task int, votes string"
    return spark.createDataFrame(extra, schema).repartition(5)


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")
