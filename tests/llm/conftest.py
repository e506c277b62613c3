import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       # names that the operators use themselves
                       *[T.StructField(n, T.StringType()) for n in
                         ("fp", "component_id", "key", "size", "block", "word", "kept", "h", "removed", "copies")]])


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with copies, near copies, shared passages, nulls, empties and a very long text."""
    rng = random.Random(3)
    out = []
    passage = sentence(rng, 60)
    short = [sentence(rng, 6) for _ in range(6)]
    for i in range(60):
        lines = [sentence(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 6))]
        if i % 7 == 0:
            lines.insert(1, passage)
        if i % 5 == 0:
            lines += short
        out.append("\n".join(lines))
    out += [out[3], out[3], out[4] + " tail", out[10].replace("a", "A"), None, "", "  \n\t ", "one", "two words"]
    words = sentence(rng, 4000).split()
    out.append(" ".join(words))
    out.append(" ".join(words[:2000] + ["x"] + words[2001:]))
    out.append("\n".join(["again and again"] * 50))
    made = [(k, t, "en" if k % 3 else None, None if k % 11 == 0 else f"s{k % 4}", len(t or ""), *["x"] * 10)
            for k, t in enumerate(out)]
    return made


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd(spark, rows):
    """Null ids, repeated ids and repeated rows besides."""
    more = rows + [rows[0], rows[0], (None, "no id here at all", None, None, None, *[None] * 10), (None, None, None, None, None, *[None] * 10),
                   (5, "another text under a known id", "en", "s1", 3, *["x"] * 10)]
    return spark.createDataFrame(more, SCHEMA).repartition(2)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
