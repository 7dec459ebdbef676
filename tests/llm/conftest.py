import zlib

import pytest

WIDE = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, d bigint, h string, kept string, block int, b int, _row bigint, _d bigint, _h string, _group string, _kept string, row int, doc string, text2 string"


def rows_of(pairs):
    """Documents with columns whose names operators use inside."""
    return [(i, t, "en", None, None if t is None else len(t), 0.5, 7, "x", "y", 1, None, 77, 78, "h", "g", "k", 79, "d", None) for i, t in pairs]


@pytest.fixture(scope="session")
def wide(spark):
    return lambda pairs: spark.createDataFrame(rows_of(pairs), WIDE)


@pytest.fixture(scope="session")
def awkward(wide):
    """Nulls, empty and blank texts, a long one, repeated rows and a row without id."""
    text = "the quick brown fox jumps over the lazy dog and runs far away from here " * 3
    long = " ".join(f"word{i % 997}x{i}" for i in range(20_000))
    return wide([(1, None), (2, ""), (3, " \n\t "), (4, text), (4, text), (5, text), (None, text), (None, None), (6, long), (7, "12 34 !!"), (8, "é")])


@pytest.fixture(scope="session")
def empty(wide):
    return wide([])


@pytest.fixture(scope="session")
def crc():
    return lambda i: zlib.crc32(str(i).encode())
