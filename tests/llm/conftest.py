import random

import pytest

WORDS = "the of and in to that is was for on rain river stone cloud field hill bird tree leaf root seed wind sun moon star sea ship port road town".split()


@pytest.fixture(scope="session")
def prose():
    def make(seed, n, lines=4):
        r = random.Random(seed)
        out = [r.choice(WORDS) + str(r.randrange(3) or "") for _ in range(n)]
        for i in range(1, lines):
            out[i * n // lines] += ".\n"
        return " ".join(out).replace("\n ", "\n")

    return make


#: Nulls, empty and blank texts, repeated rows, ties, other scripts, a null id: every operator over texts meets them.
@pytest.fixture(scope="session")
def odd_texts(prose):
    same = prose(1, 120)
    return [(1, same), (2, same), (2, same), (3, None), (4, ""), (5, " \n\t "), (6, "Ünïcödé ÀÉ İstanbul ﬁ 漢字 — “x”"), (None, same), (None, None),
            (7, prose(2, 3000)), (8, "a" * 5000), (9, "x\x1cy\x85z\xa0w v"), (10, prose(3, 80) + "\r\n" + prose(4, 30)), (11, same[:-3] + "zzz")]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with the given (doc_id, text) and, beside them, columns whose names operators use inside."""
    def make(rows, extra=False):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("extra") for c in ("k1", "k", "fp", "start", "end", "node", "leaf", "at", "score", "n_words", "length", "hits", "row")} | {"n_chars": F.length("text")})
        return df

    return make
