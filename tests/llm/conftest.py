import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words=3000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with groups of exact and near copies, a shared passage, nulls, empty, short and long texts."""
    rng = random.Random(3)
    passage = prose(rng, 60)
    texts = [prose(rng, rng.randrange(20, 200)) for _ in range(60)]
    base = prose(rng, 120).split()
    for _ in range(40):  # a large group of near copies of one text
        w = list(base)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [texts[0]] * 9 + [texts[1].upper(), texts[1], "Same  words\there", "same words here", "a b c", "A B C", "one", "One", "É", "é"]
    texts += [f"{prose(rng, 90)} {passage}" for _ in range(15)] + [None, None, "", " \n\t", "...", "　", prose(rng, 20_000)]
    langs, sources = ["en", "fr", None], ["a", "b", "c", "é", None]
    rows = [(i * 3, t, langs[i % 3], sources[0 if i % 3 == 0 else i % 5], None) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
