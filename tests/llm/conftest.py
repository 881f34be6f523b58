import random

import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """Hard cases: nulls, empty and blank texts, one long text, exact and near copies, repeated rows, clashing column names."""
    rng = random.Random(7)
    words = [f"{a}{b}{c}" for a in ("th", "er", "on", "an") for b in ("e", "ing", "ou") for c in ("r", "nd", "st", "")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(120)
    near = base.split()
    rows = []
    for k in range(12):
        edited = list(near)
        edited[10 * k % 120] = f"changed{k}"
        rows.append((100 + k, " ".join(edited), "src0"))
    rows += [(200 + k, base.upper() if k % 2 else base, "src0") for k in range(6)]
    rows += [(300 + k, prose(rng.randint(1, 90)), f"src{k % 4}") for k in range(40)]
    rows += [(400, None, "src1"), (401, "", "src1"), (402, " \t\n ", None), (403, "one", None), (404, "one", None), (405, "four words are here", "src2"), (406, prose(40_000), "src3")]
    rows += [(407, "x" * 20_000, "src3"), (408, "Übung ÉTÉ 漢字 🎉 <|endoftext|> don't 12", "src3"), (None, "no id here at all", "src2"), (300, rows[18][1], "src0"), (300, rows[18][1], "src0")]
    rows = [(*r, 0, f"k{i}", i, 0.5, "en") for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, key string, label int, score double, n_lines string")
    return df.repartition(3).persist()
