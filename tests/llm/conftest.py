import random

import pytest

WORDS = ("alder basin cobalt dune ember fjord grove harbor inlet juniper kelp ledge marsh north ochre pine quarry "
         "ridge sage thorn umber vale willow yarrow zephyr").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, clashing extra columns."""
    rng = random.Random(5)
    long = " ".join(prose(rng, 12) for _ in range(1500))
    base = prose(rng, 60)
    rows = [(1, base, "en", "a", 9), (2, base.upper(), "en", "a", 9), (2, base.upper(), "en", "a", 9), (3, None, None, None, None),
            (4, "", "en", "b", 0), (None, base, "en", "a", 9), (None, "only here", "de", "b", 9), (5, long, "en", "a", 99),
            (6, long + " x", "en", "a", 99), (7, "\t\n ", "en", "a", 3), (8, "Ünï ÇÖDÉ İ 中文 🎉", "de", "c", 9),
            (9, "one", "en", "a", 3), (10, "one", "en", "a", 3), (11, "b" * 5000, "en", "a", 5000)]
    rows = [(*r, "s", 1, "n", 2.0, "r", 3) for r in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "score string, group_size int, name string, length double, fp string, row int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
