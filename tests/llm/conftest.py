import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Rows of `documents` from (doc_id, text[, lang]) tuples."""
    def make(rows, extra=None, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]

        df = spark.createDataFrame(full, DOCS)
        for name, value in (extra or {}).items():
            df = df.withColumn(name, value)
        return df.repartition(partitions) if full else df
    return make


@pytest.fixture
def words():
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(4000)]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(vocab) for _ in range(n))
    return make


#: Rows that every operator has to take: nulls, empty and blank texts, one very long text,
#: repeated rows, a null id, text without words, odd characters.
@pytest.fixture
def odd_rows(words):
    long_text = "\n".join(words(40, 1000 + i) for i in range(3000))
    plain = "\n".join(words(12, i) for i in range(6))
    return [(1, None), (2, ""), (3, " \n\t "), (4, long_text), (5, plain), (5, plain), (None, plain), (6, plain),
            (7, "one two"), (8, "...\n!!!\n--"), (9, "é 日本語 \U0001F600 \x00 x"), (None, None)]
