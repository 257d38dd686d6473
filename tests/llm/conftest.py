import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, `key` string, component_id int, label string"

#: Awkward rows: null and empty texts, white space, one very long text, repeated
#: rows, a null id, and extra columns named like what operators make.
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two\nthree four five six"),
    (6, "one two three four five six"), (7, "4242 4242 4242 4242 a@b.co 10.1.2.3 +1 (555) 123-4567"),
    (8, "x" * 30_000), (9, "äöü ß ﬁ 你好 😀 don't 123,456"), (9, "äöü ß ﬁ 你好 😀 don't 123,456"), (None, "no id at all"), (None, None),
]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(1, 5))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    return [*TEXTS, (20, prose(1, 60_000))]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    rows = [(i, t, "en" if n % 2 else None, None, None, "s", "k", n, "l") for n, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
