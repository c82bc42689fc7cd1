import random

import pytest
from pyspark.sql import Row

CLASHING = "id n node key hash row weight votes kept quality shard slot group length word score item at template said lines ll logs k".split()


def prose(seed: int, n: int) -> str:
    """n words of invented prose with sentences."""
    pick = random.Random(seed)
    heads = "the of and to in that it is was for on are with as his they at be this from have or by one had not but what all were".split()
    tails = [a + b for a in ("ka", "mo", "ri", "tu", "ne", "sol", "par", "lin") for b in ("den", "ta", "vor", "mi", "shu", "gal")]
    words = [pick.choice(heads) if pick.random() < 0.4 else pick.choice(tails) + pick.choice(tails) for _ in range(n)]
    return " ".join(w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))


def documents(spark, rows):
    """(doc_id, text, lang, source, n_chars) and a column for every name that the operators use inside."""
    made = [Row(doc_id=i, text=t, lang=lang, source=source, n_chars=None, **dict.fromkeys(CLASHING, "x")) for i, t, lang, source in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(made, schema)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, an empty text, white space only, a very long text, repeated rows and copies."""
    rows = [(i, prose(i, 60 + 9 * i), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(24)]
    rows += [(100, None, "en", "s1"), (101, "", "en", "s1"), (102, " \t\n ", None, None), (103, prose(3, 87), "fr", "s0")]
    rows += [(None, prose(50, 80), "en", "s2"), (None, None, None, None)]
    rows += [(104, prose(60, 20_000), "en", "s1"), (105, prose(61, 200), "en", "s1"), (105, prose(61, 200), "en", "s1")]
    rows += [(106, "one two three", None, "s1"), (107, "x" * 50_000, "de", "s9")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return documents(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
