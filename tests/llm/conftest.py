import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) or (id, text, lang, source) rows, over a few partitions."""

    def make(rows, parts=3, extra=()):
        full = [(*r, *(["en", "src1"][len(r) - 2 :] if len(r) < 4 else ()), None) for r in rows]
        frame = spark.createDataFrame(full, DOCS).repartition(parts)
        for name in extra:
            frame = frame.withColumn(name, frame["source"])
        return frame

    return make


@pytest.fixture(scope="session")
def table(spark):
    """A given table at sf0.001."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def texts():
    """Seeded texts with copies, shared passages, odd characters, blanks and a very long one."""
    import random

    rng = random.Random(5)
    words = ["the", "of", "ñandú", "über", "zwei", "日本", "x1", "Blue", "RED", "tail", "stone", "é", "mill", "race", "-", "a.b"]
    line = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "s", str(rng.randrange(40))]) for _ in range(n))
    passage = line(60)
    out = [line(rng.randrange(1, 120)) for _ in range(40)]
    for i in range(12):
        parts = out[i].split(" ")
        parts[len(parts) // 2] = "changed"
        out.append(" ".join(parts))
    out += out[:6]
    out += [line(20) + "\n" + passage + "\n" + line(rng.randrange(30)) for _ in range(8)]
    out += ["", " \n\t ", "word", "a" * 700, "ab" * 300, "ab" * 300, line(6000), "one two three four", "..!", passage, None, None]
    return out
