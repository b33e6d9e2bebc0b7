import random

import pytest

DOC_TYPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or (doc_id, text) pairs."""

    def make(texts, source="s", lang="en"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t)) for i, t in rows], DOC_TYPE)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Texts with shared passages, copies, nulls, empty, white space only, non-ASCII and very long ones."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "straße", "日本", "a b", "x'y"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages = [words(n) for n in (13, 14, 30, 60)]
    texts = [None, "", "  \t\n ", "one", " ".join(words(12)), "z" * 3000, "  ", "a " * 300]
    for i in range(60):
        body = words(rng.randint(1, 90))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(body))
            p = rng.choice(passages)
            cut = rng.randint(0, 3)
            body[at:at] = p[cut : len(p) - rng.randint(0, 3)]
        texts.append(rng.choice([" ", "\n", "  "]).join(body))
    texts += texts[10:16] + texts[20:22]
    texts.append(" ".join(words(30000)) + " " + " ".join(passages[3]))
    return texts


@pytest.fixture(scope="session")
def extra(spark):
    """Adds columns whose names clash with those the operators make."""

    def add(df):
        from pyspark.sql import functions as F

        for name in ("text2", "n_words", "doc", "host", "c0", "id", "kept", "items", "cut", "hash", "a"):
            df = df.withColumn(name, F.lit(name))
        return df.withColumn("odd name", F.struct(F.lit(1).alias("a b"), F.array(F.lit("x")).alias("c-d")))

    return add
