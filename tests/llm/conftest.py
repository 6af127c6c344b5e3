import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reference import prose  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    return SMALL


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "shard string, N_words int, kept string, score int, component string, __q string, x int, u int, h string, d string"
)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, control characters."""
    long = prose(30_000, 1)
    near = long.replace(long[500:540], "quite other words stand here now")
    twin = prose(80, 2)
    texts = [
        (1, ""), (2, None), (3, "  \n\t \r\n "), (4, "one"), (5, long), (6, near), (7, twin), (8, twin), (8, twin),
        (9, twin), (None, twin), (None, "nobody owns this text of only a few words"), (None, None), (10, "é ü\x0bß\x1c\x85 \xa0 x y 🙂🙂"),
        (11, "a\n" * 50), (12, "A a A a A a"), (13, "<|im_start|> <|endoftext|> \\ <\\|"), (14, "\n".join([twin, twin, "", twin])),
        (15, "0" * 5000 + " 1.2.3.4.5.6.7.8 +1 (2) 3-4.5 67 890 a@b.c@d.e " + "4 1-1 1" * 9),
    ]
    extra = ("s", 1, "k", 2, "c", "q", 3, 4, "h", "d")
    return [(i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 5 else None, None if t is None else len(t), *extra) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).coalesce(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(4, 1, 0), (5, 1, 0), (7, 0, 0), (12, 1, 1), (12, 1, 0), (None, 1, 1), (11, None, 1), (10, 1, None), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
