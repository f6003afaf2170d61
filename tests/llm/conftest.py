import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ti to".split()


def word(r):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def prose(r, n):
    return " ".join(word(r) for _ in range(n))


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, very long, repeated and tied texts; odd characters; clashing columns."""
    r = random.Random(5)
    base = [prose(r, 60) for _ in range(6)]
    near = " ".join(base[0].split()[:-2] + ["other", "end"])
    texts = [
        *base, None, "", " \n\t ", "one two", "One TWO", base[1], base[1], near, prose(r, 30_000),
        "é ñ. 日本語 テスト, x y ▁ z\n\n\nlast 🙂", "don't it's. " * 20, base[2] + "\n" + base[2],
        "key password=32bb02aa3b580bf8ab end", "x " * 40,
    ]
    rows = [(i * 3, t, None if i == 4 else f"s{i % 3}", "en", -1, i) for i, t in enumerate(texts)]
    rows.append((rows[5][0], rows[5][1], "s2", "en", -1, 99))  # a row repeated
    rows.append((None, "a null id with some words in it", "s0", "en", -1, 100))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n long, component_id int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
