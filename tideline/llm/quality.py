"""Quality classifier by a sparse rule ensemble (operator 2).

Text statistics feed small boosted trees; every path of a tree is a conjunctive rule; a lasso
logistic fit keeps few of the rules; the kept rules become one Spark column
expression over the statistics, so scoring is a projection without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, materialise, text_bytes, word_hashes, word_spans

#: The fit takes at most so many labelled rows, those of least hash; every row is scored.
FIT_ROWS = 20_000
THRESHOLD = 0.7
TREES, DEPTH, BINS, SHRINK, SEED = 40, 3, 32, 0.3, 11
LASSO, STEPS = 2e-3, 300

STATISTICS = (
    "bytes words lines mean_word longest_word space upper lower digit high stop bang hash dollar percent amp star pipe quote bracket "
    "other_mark distinct_words capital_words shout_words marked_words repeated_lines short_words top_word mean_line"
).split()

_MARKS = {"stop": b".,;:", "bang": b"!?", "hash": b"#", "dollar": b"$", "percent": b"%", "amp": b"&", "star": b"*", "pipe": b"|", "quote": b"\"'", "bracket": b"()[]{}<>"}
_CLASS = np.full(256, 15, dtype=np.uint8)
_CLASS[[32, 9, 10, 11, 12, 13]] = 0
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4
for _i, _m in enumerate(_MARKS.values()):
    _CLASS[list(_m)] = 5 + _i
_UPPER, _LETTER = _CLASS == 1, (_CLASS == 1) | (_CLASS == 2) | (_CLASS == 4)


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a whole text; all are 0 for null and empty texts."""
    data = text_bytes(text)
    n = len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    share = np.bincount(_CLASS[data], minlength=16) / n
    start, end = word_spans(data)
    w = len(start)
    breaks = int(np.count_nonzero(data == 10)) + 1
    out = [float(n), float(w), float(breaks)]
    if not w:
        return out + [0.0, 0.0, *share, *[0.0] * (len(STATISTICS) - 5 - len(share))]
    length = end - start
    ups = np.concatenate(([0], np.cumsum(_UPPER[data])))
    letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
    up, let = ups[end] - ups[start], letters[end] - letters[start]
    _, times = np.unique(word_hashes(data), return_counts=True)
    lines = bytes(data).split(b"\n")
    last = _CLASS[data[end - 1]]
    return out + [
        float(length.mean()), float(length.max()), *share.tolist(), len(times) / w, float(np.mean(up > 0)), float(np.mean((up > 1) & (up * 2 > let))),
        float(np.mean((last > 5) & (last != 13))), 1.0 - len(set(lines)) / len(lines), float(np.mean(length < 3)), float(times.max()) / w, n / breaks,
    ]


def with_statistics(docs: DataFrame, column: str = "__stats") -> DataFrame:
    """docs with an array of STATISTICS of the text; other columns pass through untouched."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = [statistics(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(stats, pa.list_(pa.float64()))], names=[*b.schema.names, column])

    return bounded(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(T.DoubleType()))]))


# --- fitting on the bounded sample -------------------------------------------


@dataclass(frozen=True)
class Model:
    """intercept + sum of weights of the rules that hold; a rule is a tuple of (statistic, is_above, limit)."""

    intercept: float
    rules: tuple[tuple[tuple[tuple[int, bool, float], ...], float], ...]

    def column(self, stats: str) -> F.Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            holds = F.lit(True)
            for k, above, limit in rule:
                x = F.col(stats)[k]
                holds = holds & ((x > limit) if above else (x <= limit))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            total += weight * _holds(rule, x)
        return 1.0 / (1.0 + np.exp(-total))


def _holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for k, above, limit in rule:
        ok &= (x[:, k] > limit) if above else (x[:, k] <= limit)
    return ok


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, limits: list[np.ndarray], codes: np.ndarray, columns: np.ndarray) -> list[tuple[tuple, np.ndarray, float]]:
    """Nodes of one gradient tree: (rule, rows, value)."""
    nodes, level = [], [((), np.arange(len(x)))]
    for _ in range(DEPTH):
        below = []
        for rule, rows in level:
            best = (1e-3, None)
            g, h = grad[rows].sum(), hess[rows].sum()
            for k in columns:
                m = len(limits[k]) + 1
                gl = np.cumsum(np.bincount(codes[rows, k], grad[rows], m))[:-1]
                hl = np.cumsum(np.bincount(codes[rows, k], hess[rows], m))[:-1]
                if not len(gl):
                    continue
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                gain[(hl < 0.5) | (h - hl < 0.5)] = 0
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (k, limits[k][i], i))
            if best[1]:
                k, limit, i = best[1]
                left = codes[rows, k] <= i
                for above, part in ((False, rows[left]), (True, rows[~left])):
                    child = (*rule, (int(k), above, float(limit)))
                    nodes.append((child, part, float(-grad[part].sum() / (hess[part].sum() + 1))))
                    below.append((child, part))
        level = below
    return nodes


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Rules from boosted trees, weights by lasso logistic regression (accelerated proximal gradient)."""
    n = len(y)
    if not n:
        return Model(10.0, ())  # nothing to learn from: every document counts as good
    mean = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return Model(base, ())
    rng = np.random.default_rng(SEED)
    limits = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    codes = np.stack([np.searchsorted(q, x[:, k], side="left") for k, q in enumerate(limits)], 1)
    total, rules = np.full(n, base), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        columns = np.sort(rng.choice(x.shape[1], size=max(1, x.shape[1] // 2), replace=False))
        nodes = _grow(x, p - y, p * (1 - p), limits, codes, columns)
        for rule, rows, value in nodes:
            if len(rule) == DEPTH or not any(r[: len(rule)] == rule and len(r) > len(rule) for r, _, _ in nodes):
                total[rows] += SHRINK * value
            rules.setdefault(tuple(sorted(rule)), None)
    rules = [r for r in rules if 0 < _holds(r, x).mean() < 1]
    a = np.stack([_holds(r, x) for r in rules], 1).astype(np.float64)
    step = 4 * n / (np.linalg.norm(a.T @ a, 2) + n)
    w = v = np.zeros(len(rules))
    b = c = base
    t = 1.0
    for _ in range(STEPS):
        r = (1 / (1 + np.exp(-(a @ v + c))) - y) / n
        nw = v - step * (a.T @ r)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * LASSO, 0)
        nb = c - step * r.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c, w, b, t = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b), nw, nb, nt
    return Model(float(b), tuple((r, float(k)) for r, k in zip(rules, w, strict=True) if k))


def fold(doc_id: str = "doc_id", parts: int = 4) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def learn(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on stats (doc_id, __stats) of labelled rows whose fold is not 2; repeated labels count once, as the largest."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where(fold() != 2)
    order = F.xxhash64(F.lit(SEED), "doc_id")
    rows = stats.join(known, "doc_id").orderBy(order, "doc_id", "__stats").limit(fit_rows).select("__stats", "quality").toPandas()
    x = np.array(rows["__stats"].tolist(), dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, rows["quality"].to_numpy(dtype=np.float64))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    Null and empty texts have statistics of 0 and are scored like any other. A null doc_id
    is never learned from and its held_out is false. Repeated rows get equal scores. Without
    labels every document scores near 1. Only text is an input of the score.
    """
    stats = materialise(with_statistics(docs.select("doc_id", "text")).drop("text"))
    model = learn(stats, labels)
    out = stats.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), model.column("__stats").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier predicts as good, in the columns of docs, whatever their names.

    Statistics are computed once and kept beside the rows while the model is fitted. Null and empty texts have statistics
    of 0 and are judged like any other; repeated rows are judged alike; an empty table gives an empty result.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row")
    rows = materialise(with_statistics(docs.select("text", F.col("doc_id").alias("__doc"), rest)))
    model = learn(rows.select(F.col("__doc").alias("doc_id"), "__stats"), labels)
    good = rows.where(model.column("__stats") >= THRESHOLD)
    return good.select(*[F.col("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])
