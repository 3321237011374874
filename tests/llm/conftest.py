import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHES = "row int, key int, size int, kept int, stratum int, _id int, _range int, before int, component_id int, word int"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]


@pytest.fixture(scope="session")
def corpus(words):
    """(doc_id, text, lang, source, n_chars): copies, near copies, passages, odd and missing values."""
    rng = random.Random(8)
    passage = " ".join(rng.choices(words, k=25))
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(60)]
    texts += [texts[3], texts[3], texts[10], "", None, " \n\t ", "one", "é" * 60, "é" * 60, "x" * 300, "a b " * 40]
    for base in (5, 6, 7):
        for _ in range(4):
            edited = texts[base].split()
            for _ in range(2):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            texts.append(" ".join(edited))
    texts += [f"{t} {passage} {t[::-1]}" for t in texts[20:30]]
    texts += [" ".join(rng.choices(words, k=9000)), "ß " + texts[8] + "\n" + texts[8]]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[k], rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", "s3", None]), 0) for i, k in enumerate(order)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3)


@pytest.fixture(scope="session")
def odd(spark, corpus):
    """The corpus with rows twice, rows without id, and columns named as inside the operators."""
    extra = ", ".join(CLASHES.split(", "))
    rows = corpus[:30] + corpus[:5] + [(None, "no id here at all", None, None, None), (None, None, None, None, None)]
    wide = [(*r, *range(len(CLASHES.split(", ")))) for r in rows]
    return spark.createDataFrame(wide, f"{DOCS}, {extra}")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
