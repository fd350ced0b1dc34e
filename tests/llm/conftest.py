import random
import re

import pytest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    """Words as the operators define them."""
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(n, seed):
    make = random.Random(seed)
    return " ".join("".join(make.choices("abcdefghiklmnoprstu", k=make.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and long texts, ties, repeated rows, and characters of every kind."""
    long = prose(30_000, 1)
    texts = [None, "", None, " ", "A", "a", "é É ß", "\x00 \x1f\x7f", "x  y\n z ", long, long + "!", long]
    rows = [(n, text, "en" if n % 2 else None, "src", n) for n, text in enumerate(texts)]
    rows += [(5, "a", "en", "src", 5), (5, "a", "en", "src", 5), (3, "other", None, None, None)]
    return rows + [(None, "a", None, None, None), (None, None, None, None, None)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that operators make themselves, with other meanings here.
CLASH = (
    "keep_id string, group_size string, kept string, class_id string, links string, keep string, score string, "
    "language string, blob string, spans string, n_hit string, row string, id string, piece string, tag string"
)


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    extra = ("x",) * len(CLASH.split(","))
    return spark.createDataFrame([(*r, *extra) for r in odd_rows], f"{SCHEMA}, {CLASH}").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
