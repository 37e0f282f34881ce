from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int, per_line: int = 12) -> str:
    """Deterministic words in lines that end with a stop."""
    import random

    r = random.Random(seed)
    out = [r.choice(WORDS) + r.choice("abcdefgh") + str(r.randrange(9)).replace("0", "") for _ in range(n)]
    return "\n".join(" ".join(out[i : i + per_line]) + "." for i in range(0, n, per_line))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, empty and very long texts, ties, repeated rows, and columns whose names operators use inside."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base.replace("alpha", "alpine", 1), "en", None), (4, None, None, None), (5, "", "en", "b"), (6, " \n\t\n ", "de", "b"),
        (None, prose(2, 60), "fr", "b"), (None, None, None, None), (7, "one two three", "en", "a"), (8, "x" * 30_000, "en", "a"), (9, " ".join(prose(3, 5000).split()), "en", "c"), (9, prose(4, 50), "en", "c"),
        (10, "same line of ten words for every one of us here\n" * 300, "en", "c"), (-11, "é ü ñ 漢字 🙂 <|endoftext|> a b", "es", "c"),
    ]
    names = "doc_id long, text string, lang string, source string"
    extra = {n: 1 for n in ("bucket", "range", "token", "size", "hash", "label", "c", "base", "place", "name", "lines", "words", "kept", "gone", "i", "h", "weight", "topic", "at", "x", "y", "slice")}
    from pyspark.sql import functions as F

    return spark.createDataFrame([(*r,) for r in rows], names).withColumns({k: F.lit(v) for k, v in extra.items()}).withColumn("n_chars", F.length("text").cast("long"))
