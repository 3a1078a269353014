import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words=60, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, repeated lines, junk and whatever else is awkward."""
    rng = random.Random(4)
    texts = [prose(rng) + "\n" + prose(rng, 30) for _ in range(60)]
    texts += texts[:5]  # copies
    for t in texts[5:10]:  # near copies
        words = t.split(" ")
        words[7] = "changed"
        texts.append(" ".join(words))
    texts += ["", None, " \t\n ", "one", "one", "two words", "\n\n", "The same line\nThe same line", "é ß 日本 😀 ▁ \x00", "long " * 20000]
    return [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with a row repeated as a whole, an id used twice and a row without id."""
    rows = [*corpus, corpus[3], (11, "another text under an id that is taken", "en", "src0", 38), (None, corpus[0][1], None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
