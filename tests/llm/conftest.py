import random

import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with NULLs in every column, empty, blank and long texts, ties
    and repeated rows."""
    rng = random.Random(7)
    base = [words(rng, rng.choice([1, 2, 3, 8, 40, 120])) for _ in range(60)]
    out = [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(base)]
    near = words(rng, 300)
    out += [(100 + i, near.replace(" ", "  ", i).replace("w1 ", "W1 "), "de", "hot", 9) for i in range(6)]
    out += [(200, "", "en", "s0", 0), (201, None, "en", None, None), (202, " \n\t ", "en", "s1", 4)]
    out += [(None, "no id here at all", None, None, 1), (None, None, None, "s2", None), (None, "no id here at all", "x", "", 3)]
    out += [(300, "twice the same row", "en", "s3", 5)] * 3 + [(300, "the same id again", "en", "s3", 5)]
    out += [(400, words(rng, 6000, 5000) + " é中😀▁x<s>", "en", "hot", 1), (-5, "▁ ▁a  b\n", "en", "é", 2)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMA))


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns named like what the operators make on the way."""
    from pyspark.sql import functions as F

    names = ["_text", "fp", "root", "mark", "_id", "size", "target", "place", "taken", "ids_", "_html", "_part", "row", "block"]
    return docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
