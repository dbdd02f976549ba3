import zlib

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)

BASE = [f"w{i * 7919 % 1009}" for i in range(120)]
EN = "the house on the hill was old and the wind was cold"
DE = "das haus auf dem berg war alt und der wind war kalt"


def rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, near copies."""
    near = [*BASE[:50], "changed", *BASE[51:]]
    texts = [
        " ".join(BASE), " ".join(near), " ".join(BASE), None, "", "   \n\t ", "one two", "One TWO", "x",
        " ".join(BASE) + " and some more", "a b c d e f g h\n" * 400, " ".join(f"u{i}" for i in range(30_000)),
        "line one of the text is here\nline two of the text\nline one of the text is here", "line one of the text is hers\nother things",
        "é日本😀 <|endoftext|> \x00\x1c tab\tend  two blanks ", "\n\n", "123 456 !!", " ".join(BASE[:60]) + "\r\n" + " ".join(BASE[60:]),
    ]
    texts += [f"{EN} {i} {EN}" for i in range(12)] + [f"{DE} {i} {DE}" for i in range(12)]
    out = [(i, t, ["en", "de", None][i % 3] if i < 18 else ("en" if i < 30 else "de"), ["a", "b", None, "ü"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[0], out[0], (None, " ".join(BASE), "en", "a", 5), (None, None, None, None, None), (7, "another text of id seven", "en", "a", 3), (-5, " ".join(near), "en", "b", 3)]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["id", "size", "score", "n", "h", "row", "key", "component", "kept", "copies", "node", "th", "_id", "_gone", "n_lines", "ids", "lang_pred"]
    return odd.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])


@pytest.fixture(scope="session")
def corpus(spark, data):
    """All documents of the small fixture as Python rows."""
    return [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]


@pytest.fixture
def third():
    return lambda doc_id: zlib.crc32(str(doc_id).encode()) % 3
