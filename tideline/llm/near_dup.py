"""MinHash near-duplicates by SetSketch registers (operator 7).

Each document's set of word shingles is sketched into registers, exponentially spaced
truncated minima: ``floor(1 - log_b x)`` of the least exponential hash ``x``. Registers
merge by ``max`` and are locality-sensitive. Bands of registers propose pairs, the
two sets' similarity is estimated jointly by maximum likelihood from the counts of
greater, lesser and equal registers with both sizes known, and pairs that may reach
the threshold are confirmed on the full shingle sets.

No bucket's pairs are listed: a bucket is first linked as a star to its smallest member,
and only members of different verified components are compared further, in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WIDE_ROWS, bounded, by_groups, components, materialise, mix64, shingles, small, unless_large, word_hashes

#: Sketch shape: a pair at the threshold 0.75 meets in a band with probability 1 - (1 - 0.75**3)**20 > 0.9999.
BANDS, ROWS = 20, 3
LEAST_PERCENT = 75
REGISTERS = BANDS * ROWS
#: Base, rate and largest register of the sketch.
BASE, RATE, LIMIT = 1.001, 20.0, 65534
#: Estimates under this and pairs with fewer equal registers are not confirmed (over four standard deviations below 0.75).
LEAST_ESTIMATE, LEAST_EQUAL = 0.55, REGISTERS // 2
#: Members of unsettled buckets get a finer sketch, of low register bytes; estimates from it under
#: 0.69 are over four standard deviations below 0.75.
FINE, LEAST_FINE = 1024, 0.69
#: Members of a bucket, or of a star, that one task compares at once.
BLOCK = 2048
STAR = 64
_SLICE = 1 << 20

_SEEDS = mix64(np.arange(1, REGISTERS + FINE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = mix64(_SEEDS) | np.uint64(1)


def registers(sets: list[np.ndarray], first: int = 0, count: int = REGISTERS) -> np.ndarray:
    """SetSketch registers (sets x count, uint16) of non-empty hash sets, from register number first."""
    out = np.empty((len(sets), count), dtype=np.uint64)
    lengths = np.array([len(s) for s in sets])
    at = 0
    while at < len(sets):
        total = np.cumsum(lengths[at:])
        to = at + max(1, int(np.searchsorted(total, 16_384, side="right")))
        x = np.concatenate(sets[at:to])
        starts = np.concatenate(([0], total[: to - at - 1]))
        h = np.empty_like(x)
        for j in range(count):
            np.bitwise_xor(x, _SEEDS[first + j], out=h)
            np.multiply(h, _ODD[first + j], out=h)
            out[at:to, j] = np.minimum.reduceat(h, starts)
        at = to
    u = ((out >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    k = np.floor(1.0 - np.log(-np.log1p(-u) / RATE) / np.log(BASE))
    return np.clip(k, 0, LIMIT).astype(np.uint16)


def estimate(greater: np.ndarray, lesser: np.ndarray, equal: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Maximum likelihood estimates of the Jaccard similarity from register comparisons and set sizes."""
    u = n_u / (n_u + n_v)
    v = 1.0 - u
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0.0, 1.0, 51)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    for g in grid:
        j = g * top
        a, b = p(u - v * j), p(v - u * j)
        lik = greater * np.log(np.maximum(a, 1e-12)) + lesser * np.log(np.maximum(b, 1e-12)) + equal * np.log(np.maximum(1.0 - a - b, 1e-12))
        better = lik > best
        best, at = np.where(better, lik, best), np.where(better, j, at)
    return at


def _likely(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of register rows may reach the threshold."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    ok = small >= threshold * large
    equal = (ra == rb).sum(1)
    ok &= equal >= LEAST_EQUAL
    at = np.flatnonzero(ok)
    if len(at):
        more = (ra[at] > rb[at]).sum(1)
        ok[at] = estimate(more, REGISTERS - more - equal[at], equal[at], na[at].astype(float), nb[at].astype(float)) >= LEAST_ESTIMATE
    return ok


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            at = 0
            while at < len(texts):
                ids, digests, sizes, sets, size = [], [], [], [], 0
                first = at
                while at < len(texts) and size < _SLICE:
                    t = texts[at] or b""
                    w = word_hashes(np.frombuffer(t, dtype=np.uint8))
                    s = shingles(w, words)
                    digests.append(hashlib.blake2b(w.tobytes(), digest_size=16).digest() if len(w) else None)
                    sizes.append(len(s))
                    if len(s):
                        sets.append(s)
                    size += len(t)
                    at += 1
                rows = iter(registers(sets)) if sets else iter(())
                regs = [next(rows).astype(">u2").tobytes() if n else None for n in sizes]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, at - first), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(regs, pa.binary())],
                    names=["doc_id", "digest", "n_shingles", "regs"],
                )

    return run


def sketch(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, digest, n_shingles, regs) of every document; digest and regs are null without words.

    The digest is of the lower-cased word sequence, regs are REGISTERS big-endian 16-bit registers.
    """
    return bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sketch(words), "doc_id long, digest binary, n_shingles long, regs binary")


def _unpack(regs: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(regs), dtype=">u2").reshape(len(regs), REGISTERS).astype(np.uint16)


def _filter(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                ok = _likely(_unpack(b.ra), _unpack(b.rb), b.na.to_numpy(), b.nb.to_numpy(), threshold)
                yield b.loc[ok, ["a", "b"]]

    return run


def _fine(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(word_hashes(np.frombuffer(t.as_buffer(), dtype=np.uint8)), words) for t in b.column(1).cast(pa.binary())]
            rows = registers(sets, REGISTERS, FINE).astype(np.uint8) if sets else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "fine"])

    return run


def _block_pairs(threshold: float):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame | None:
        left, right = group[group.block == key[1]], group[group.block == key[2]]
        if not len(left) or not len(right):
            return None
        ia, ib = left.id.to_numpy(), right.id.to_numpy()
        na, nb = left.n_shingles.to_numpy(), right.n_shingles.to_numpy()
        open_ = (left.label.to_numpy()[:, None] != right.label.to_numpy()) & (np.minimum.outer(na, nb) >= threshold * np.maximum.outer(na, nb))
        if key[1] == key[2]:
            open_ &= ia[:, None] < ib
        i, j = np.nonzero(open_)
        if not len(i):
            return None
        fa, fb = (np.frombuffer(b"".join(x.fine), dtype=np.uint8).reshape(len(x), FINE) for x in (left, right))
        ra, rb, out = _unpack(left.regs), _unpack(right.regs), []
        for at in range(0, len(i), 4096):
            p, q = i[at : at + 4096], j[at : at + 4096]
            # a pair that meets in several bands is taken in the first of them
            first = (ra[p] == rb[q]).reshape(len(p), BANDS, ROWS).all(2).argmax(1) == group.band.iloc[0]
            p, q = p[first], q[first]
            ok = _likely(ra[p], rb[q], na[p], nb[q], threshold)
            p, q = p[ok], q[ok]
            same = (fa[p] == fb[q]).mean(1)
            ok = (same - 1 / 256) / (1 - 1 / 256) >= LEAST_FINE
            out.append(np.stack((ia[p[ok]], ib[q[ok]])))
        pairs = np.concatenate(out, axis=1)
        return pd.DataFrame({"a": pairs.max(0), "b": pairs.min(0)})

    return run


def _confirm(words: int, percent: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame | None:
        texts = dict(zip(group.id, group.text, strict=True))
        if key[0] not in texts:
            return None
        out, c = [], _set(texts.pop(key[0]), words)
        for i, text in texts.items():
            s = _set(text, words)
            both = len(np.intersect1d(c, s, assume_unique=True))
            if 100 * both >= percent * (len(c) + len(s) - both):
                out.append(i)
        return pd.DataFrame({"a": np.array(out, dtype=np.int64), "b": np.full(len(out), key[0], dtype=np.int64)})

    return run


def _set(text: str, words: int) -> np.ndarray:
    return shingles(word_hashes(np.frombuffer(text.encode(), dtype=np.uint8)), words)


def confirm(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Pairs are gathered about b, at most about STAR of them in a group, so that b's text
    is sent once to each group and a hot b is many groups.
    """
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / STAR).alias("parts"))
    salted = pairs.join(unless_large(parts, pairs.count()), "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("parts")))
    need = salted.select(F.col("a").alias("id"), F.col("b").alias("g"), "salt").unionByName(salted.select(F.col("b").alias("id"), F.col("b").alias("g"), "salt").distinct())
    need = small(materialise(need))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null and text is not null")
    return by_groups(texts.join(need, "id"), ["g", "salt"], _confirm(words, percent), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """Link documents whose shingle sets have ``100 * intersection >= percent * union``, for 75 percent or more; less raises.

    Takes doc_id and text of docs; further columns are ignored. Returns a row per row of docs:
    doc_id, n_shingles, component_id (smallest doc_id reachable, itself included),
    kept (doc_id = component_id).

    doc_id is a whole number, or text that casts to one. Null or empty texts, or those without words, have no shingles and link with nothing.
    Copies are one node, represented by their smallest doc_id. Rows with one doc_id
    are one document. A null doc_id links with nothing, has a null component and is kept.
    An empty table gives an empty result.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"bands and filters lose no link of {LEAST_PERCENT} percent or more, not of {percent}")
    threshold = percent / 100
    rows = materialise(sketch(docs, words))
    nodes = materialise(
        rows.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"))
    )
    n = nodes.count()
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    entries = nodes.select("id", "regs", band).select("id", "band", F.xxhash64("band", F.expr(f"substring(regs, 1 + band * {2 * ROWS}, {2 * ROWS})")).alias("key"))

    hub = unless_large(entries.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("last")).where("b < last").select("key", "b"), n, WIDE_ROWS)
    star = entries.join(hub, "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    side = lambda x: unless_large(nodes.select(F.col("id").alias(x), F.col("regs").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}")), n, WIDE_ROWS)
    tested = materialise(star.join(side("a"), "a").join(side("b"), "b").mapInPandas(_filter(threshold), "a long, b long"))
    edges = materialise(confirm(docs, tested, words, percent))
    labels = unless_large(components(edges), edges.count())

    # buckets whose members are not yet one component
    open_entries = entries.join(hub, "key").select("key", "band", "id").join(labels, "id", "left").select("key", "band", "id", F.coalesce("component_id", "id").alias("label"))
    open_keys = open_entries.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n")).where("x < y")
    members = materialise(
        open_entries.join(open_keys.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    )
    ids = small(materialise(members.select("id").distinct()))
    fine = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id").mapInArrow(_fine(words), "id long, fine binary")
    fine = materialise(fine.groupBy("id").agg(F.first("fine").alias("fine")).join(unless_large(nodes.select("id", "regs", "n_shingles"), n, WIDE_ROWS), "id"))
    paired = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    more = by_groups(paired.drop("other", "blocks").join(unless_large(fine, fine.count(), WIDE_ROWS), "id"), ["key", "i", "j"], _block_pairs(threshold), "a long, b long")
    more = materialise(more.distinct().join(unless_large(tested, tested.count()), ["a", "b"], "left_anti"))
    if more.limit(1).count():
        edges = edges.unionByName(materialise(confirm(docs, more, words, percent)))
        labels = unless_large(components(edges), edges.count())

    ids = nodes.select("digest", "id").join(labels, "id", "left").select("digest", F.coalesce("component_id", "id").alias("found"))
    ids = unless_large(ids, n, WIDE_ROWS)
    # rows without a digest stay out of the join, where they would meet in one task
    plain = rows.select("doc_id", "n_shingles", "digest")
    out = plain.where("digest is not null").join(ids, "digest", "left").unionByName(plain.where("digest is null").withColumn("found", F.lit(None).cast("long")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """docs without the documents that are near-duplicates of one with a smaller doc_id; columns as given.

    Rows of a doc_id that stays all stay; null doc_ids and texts without words stay; an empty table gives an empty result.
    """
    found = small(materialise(near_duplicates(docs, words, percent).where("not kept").select(F.col("doc_id").alias("__dropped")).distinct()))
    return docs.join(found, docs["doc_id"].cast("long") == found["__dropped"], "left_anti")
