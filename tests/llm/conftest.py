import random

import pytest

WORDS = [a + b for a in ("th", "er", "on", "an", "re", "he", "in", "ed") for b in ("at", "is", "ou", "es", "ti", "ar")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    out = []
    while len(out) < n:
        out.append(" ".join(r.choice(WORDS) for _ in range(r.randint(8, 16))))
        out.append("")
    return "\n".join(x for x in out if x)


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, edge cases: (doc_id, text) rows."""
    base = [prose(i, 12) for i in range(8)]
    r = random.Random(5)
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(12):
        words = base[k % 3].split(" ")
        for _ in range(1 + k % 4):
            words[r.randrange(len(words))] = "changed%d" % k
        rows.append((100 + k, " ".join(words)))
    rows += [(200, base[0]), (201, base[0].upper()), (202, base[1])]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "one"), (305, "one two"), (306, "ÉTÉ one"), (307, prose(99, 3000))]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The rows with columns that operators use names of, a repeated row and a row without id."""
    rows = [(i, t, "en", "s", 1, "k", 2.0) for i, t in [*texts, texts[0], (None, texts[1][1])]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, score double")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
