import random

import pytest

WORDS = "the of and tion ering oneder thansh éoui über the of and".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ly", "."]) for _ in range(n))


def edge_rows(seed=3):
    """(id, text): null ids and texts, empty, blank and very long texts, copies,
    near copies, repeated rows, and ids that are no order of the texts."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(1, 90)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(25, 90):
        a, b = rng.choice(base), rng.choice(base)
        k, m = rng.randint(0, len(a)), rng.randint(0, len(b))
        rows.append((i, rng.choice([a, a[:k] + "Q" + a[k:], a[k:] + b[m:], "a" * rng.randint(0, 200), a + " " + b + " " + a])))
    rows += [(90, None), (91, ""), (92, " \t\n "), (93, "x"), (94, "long " * 30_000 + base[0]), (95, sentence(rng, 20_000)),
             (None, base[1]), (None, None), *rows[5:9]]
    rng.shuffle(rows)
    return rows


#: Columns named like outputs and working columns of the operators.
CLASHING = ["n_words", "spans", "body", "key", "size", "taken", "shard", "slot", "fp", "rep", "score", "rank", "list", "part", "batch",
            "__stats", "sources", "target", "rows", "at", "value", "text_hash"]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows as a table with many clashing columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows(), "doc_id long, text string")
    df = df.withColumns({"lang": F.when(F.col("doc_id") % 3 == 0, "en").when(F.col("doc_id") % 3 == 1, "de"),
                         "source": F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("src"), F.col("doc_id") % 4)),
                         "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def no_docs(edge):
    return edge.limit(0)
