from __future__ import annotations

import random

import pytest

# Columns that operators use inside; they must not disturb them.
EXTRA = ["n_words", "key", "path", "part", "block", "score", "tokens", "group", "shard_", "rule"]


@pytest.fixture(scope="session")
def odd_texts() -> list[str | None]:
    """Missing, empty, blank, short, long and repeated texts, and texts with odd letters."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(6)]
    near = [base[0].replace(" w1", " x1", 2), base[0] + " tail end", base[1] + "\n" + base[2]]
    passage = " ".join(rng.choice(words) for _ in range(30))
    held = [f"{' '.join(rng.choice(words) for _ in range(40))} {passage} {' '.join(rng.choice(words) for _ in range(25))}" for _ in range(5)]
    small = [None, "", " ", "\n\n\t ", "a", "a b", "a  b", "A b.\nA b.\n\nc", "é è ü ß 漢字 🎉 á", "x y\x1cz q", "\u0000 z"]
    long = " ".join(rng.choice(words) for _ in range(9000))
    return [*small, *base, *near, *held, base[3], base[3], base[4], passage, long, long[:-40], "same " * 40, "\n".join(["one line of a few words here."] * 30)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """A table of the odd texts with a missing id, repeated rows and columns of clashing names."""
    rows = [(100 - k if k % 7 else k, t, None if k % 5 == 0 else f"s{k % 3}", k) for k, t in enumerate(odd_texts)]
    rows += [(None, odd_texts[12], "s1", 1), rows[14], rows[14]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)
    for name in EXTRA:
        df = df.selectExpr("*", f"'extra' AS {name}")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id < -1")
