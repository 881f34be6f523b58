"""LM scoring by online logistic context mixing (operator 3).

A text is its tokens in order: words, then one end. Two models of bits are mixed from hashed contexts.

The first bit of a token says whether it is the word that followed its context most often in training. The context is
the last two words, or the last three, however often they occur (PART can let it go further back past frequent words). Counters
of the longer and the shorter context give the inputs, weights gated by the evidence mix them, and
what came true at such predictions refines the result. So a score depends on the order of words, and a
repeated passage costs little.

A token that is not so foretold is spelled in bits, with the white space that ends it: each byte by its path in a
prefix code learned from the corpus, so that common bytes take few bits. Every bit is
predicted by several counters under hashed contexts (its last two, three and four bytes, how the word began),
all within the document's gate, which tells the letters that the document uses and is spelled first, at two bits. The
counters' logits are mixed by weights that the evidence selects (the longest context seen before) and that are learned
online, and refined likewise. As spelling depends on the word and the gate alone, each distinct word is spelled once a gate.

What is gathered grows with the corpus: the vocabulary, the counters of all beginnings of words (each in the task that
holds all words with that beginning), and those of all contexts across words (each in the task its hash names). Only contexts
of up to four bytes within a word, which alphabets bound, share hashed tables of a fixed most size. Counts are whole; a
training token is always predicted without its own occurrence. All counts and the order of learning follow from the
rows themselves, not from how they are partitioned.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_groups, bounded, by_groups, discard, materialise, mix64, word_hashes

GATES = 4
ORDERS, LOW = 5, 4  # contexts: byte code alone, last 2, 3, 4 bytes (these are LOW), the word so far
#: Most slots, as powers of two, of the hashed counters of contexts of a few bytes.
MOST_BITS = (13, 18, 20, 22)
BUCKETS = 8  # of how often a context was seen
REFINE = 33  # points of the refinement over the mixed logit
#: The most frequent tokens, whose scores are broadcast; the others meet their documents by a join.
HEAD = 100_000
#: Step of the online learning, and tokens of a step.
RATE, STEP = 0.2, 2_000
#: Words that begin alike are counted together: by so many bytes first, and by more where over MOST_ALIKE do.
DEPTHS, MOST_ALIKE = (4, 8, 16, 32, 64, 128), 20_000
#: About so many training words in a group that is spelled together, and groups that learn in one go.
GROUP, LEARN = 5_000, 8
#: About so many occurrences in a part of the contexts across words. A context of more is held by its distinct rows.
OCCURRENCES = 1_000_000
#: A word that occurs more often is hot: contexts go back past it. No word is by default, so that what a context is does not follow from the input's size.
PART = math.inf
#: A context has at most so many words.
MOST_WORDS = 6
_LN10 = math.log(10)


def gate_of(text: bytes) -> int:
    """Which letters beyond a-z a text uses: none or few, or those of one of three groups."""
    if text.isascii():
        return 0
    n = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    found = [int(n[last].sum()) for last in _LETTERS]
    best = int(np.argmax(found))
    return 0 if found[best] * 200 < len(text) else 1 + best


#: Letters that part the Latin languages roughly, told by the last byte of their UTF-8.
_LETTERS = [np.array([x.encode()[-1] for x in group]) for group in ("äöüß", "éèêçà", "ñóíáú")]


def words(text: bytes) -> list[bytes]:
    """Tokens of a text: words, A-Z lower-cased, then the end."""
    return [*text.lower().split(), b"\n"]


# --- gathering -------------------------------------------------------------------


#: Distinct tokens that a task holds before it hands them on.
HELD = 600_000


def gather(docs: DataFrame) -> DataFrame:
    """(token, c0..c3: training count by gate, s0..s3: seen at all by gate), for all documents; counted per task before the shuffle."""

    def out(counts: list[Counter]) -> Iterator[pa.RecordBatch]:
        for which, c in enumerate(counts):
            keys, n = list(c), list(c.values())
            for i in range(0, len(keys), 50_000):
                part = pa.array(keys[i : i + 50_000], pa.binary())
                yield pa.RecordBatch.from_arrays([part, pa.array([which] * len(part), pa.int32()), pa.array(n[i : i + 50_000], pa.int64())], names=["token", "which", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(2 * GATES)]
        for b in batches:
            for text, held in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts[gate_of(text or b"") + GATES * held].update(words(text or b""))
            if sum(map(len, counts)) > HELD:
                yield from out(counts)
                counts = [Counter() for _ in range(2 * GATES)]
        yield from out(counts)

    rows = bounded(docs).select("text", held_out().alias("held")).mapInArrow(run, "token binary, which int, n long")
    of = lambda g: F.col("which") == g
    trained = [F.coalesce(F.sum(F.when(of(g), F.col("n"))), F.lit(0)).alias(c) for g, c in enumerate(_C)]
    seen = [F.max((of(g) | of(g + GATES)).cast("long")).alias(c) for g, c in enumerate(_S)]
    return rows.groupBy("token").agg(*trained, *seen)


_C, _S = [f"c{g}" for g in range(GATES)], [f"s{g}" for g in range(GATES)]


def held_out(parts: int = 10) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == 0, F.lit(False))


# --- spelling ---------------------------------------------------------------------


def byte_code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A prefix code over 256 bytes by weight: (nodes, bits, lengths) of each byte's path, nodes numbered from 1 at the root."""
    heap = [(float(c) + 1e-3, b, (b,)) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    trees: dict[int, tuple] = {}
    n = 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        trees[n] = (a[1], b[1])
        heapq.heappush(heap, (a[0] + b[0], n, ()))
        n += 1
    nodes, bits, lengths = np.zeros((256, 64), dtype=np.uint64), np.zeros((256, 64), dtype=np.int8), np.zeros(256, dtype=np.int64)
    stack = [(heap[0][1], [], [])]
    while stack:
        at, path, taken = stack.pop()
        if at < 256:
            lengths[at] = len(path)
            nodes[at, : len(path)], bits[at, : len(path)] = path, taken
        else:
            for bit, child in enumerate(trees[at]):
                stack.append((child, [*path, at], [*taken, bit]))
    return nodes, bits, lengths


def slot_sizes(vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the slots of each context of a few bytes, for a training vocabulary, and where its slots begin."""
    bits = np.minimum(MOST_BITS, max(13, math.ceil(math.log2(max(vocabulary, 2))) + 4))
    return bits, np.concatenate(([0], np.cumsum(np.int64(1) << bits)))


def spell(tokens: list[bytes], gates: np.ndarray, depths: np.ndarray, code: tuple, sizes: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bits of tokens under their gates: (token index, slots of contexts of a few bytes, keys of words so far, bit). Each token is spelled with the white space after it.

    A word so far of under its depth of bytes has key 0: contexts of up to four bytes tell as much.
    """
    data = np.frombuffer(b" ".join(tokens) + b" ", dtype=np.uint8)
    lengths = np.array([len(t) + 1 for t in tokens])
    owner = np.repeat(np.arange(len(tokens)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - starts[owner]
    d = data.astype(np.uint64) + np.uint64(1)
    gate = gates[owner].astype(np.uint64)
    back = []
    for k in range(1, 5):
        prev = np.zeros(len(d), dtype=np.uint64)
        prev[k:] = d[:-k]
        prev[place < k] = 0
        back.append(prev)
    # the word so far: a running hash, reset where a word begins
    step = np.multiply.accumulate(np.full(int(lengths.max()) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    weighed = mix64(d) * step[place]
    sums = np.cumsum(weighed, dtype=np.uint64) - weighed
    so_far = sums - sums[starts][owner]
    h = mix64(gate + np.uint64(1))
    contexts = [h]
    for k, prev in enumerate(back):
        h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + prev)
        if k:
            contexts.append(h)
    contexts.append(mix64(so_far + gate * np.uint64(0xA24BAED4963EE407) + np.uint64(7)))
    nodes, bits, lengths_of = code
    n = lengths_of[data]
    at = np.repeat(np.arange(len(data)), n)
    # where a bit is in the table of paths
    step_of = np.arange(len(at)) + np.repeat(data * np.int64(nodes.shape[1]) - (np.cumsum(n) - n), n)
    node = nodes.ravel().take(step_of) * np.uint64(0xC2B2AE3D27D4EB4F)
    slots, keys = np.empty((LOW, len(at)), dtype=np.int32), np.empty((ORDERS - LOW, len(at)), dtype=np.int64)
    for k, c in enumerate(contexts):
        x = c.take(at)
        x += node
        x *= np.uint64(0xFF51AFD7ED558CCD)
        if k < LOW:
            x >>= np.uint64(64 - int(sizes[0][k]))
            slots[k] = x
            slots[k] += np.int32(sizes[1][k])
        else:
            np.copyto(x, 0, where=(place < depths[owner]).take(at))
            keys[k - LOW] = x.view(np.int64)
    return owner.take(at), slots, keys, bits.ravel().take(step_of)


# --- groups of words that begin alike ---------------------------------------------


def grouped(vocab: DataFrame, trained: int) -> DataFrame:
    """vocab with its group and the depth from which on a word so far is known to no other group's words.

    Words that share their first bytes are in one group; where too many training words do, those that share more.
    """
    count = sum(F.col(c) for c in _C)
    begin = lambda d: F.substring("token", 1, d)
    key, depth, left = begin(DEPTHS[0]), F.lit(DEPTHS[0]), vocab.where(count > 0)
    for d, deeper in zip(DEPTHS, DEPTHS[1:], strict=False):
        if trained <= MOST_ALIKE:
            break
        many = [bytes(r[0]) for r in left.groupBy(begin(d).alias("b")).count().where(F.col("count") > MOST_ALIKE).select("b").collect()]  # at most trained / MOST_ALIKE
        if not many:
            break
        hot = begin(d).isin([F.lit(bytearray(b)) for b in many])
        left = left.where(hot)
        key, depth = F.when((depth == d) & hot, begin(deeper)).otherwise(key), F.when((depth == d) & hot, deeper).otherwise(depth)
    groups = max(1, trained // GROUP)
    number = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")
    return vocab.withColumn("depth", depth.cast("int")).withColumn("group", number).withColumn("unit", F.floor(F.col("group") / LEARN).cast("int"))


class Group:
    """The spelled pairs of a token and a gate of a group, with the counts of words so far of its training words."""

    def __init__(self, rows: pd.DataFrame, code: tuple, sizes: tuple):
        self.code, self.sizes = code, sizes
        self.tokens, self.depth = [bytes(t) for t in rows.token], rows.depth.to_numpy()
        self.counts = rows[_C].to_numpy()
        self.row, self.gate = np.nonzero(self.counts)
        self.weight = self.counts[self.row, self.gate]
        if len(self.row):
            self.owner, self.low, keys, self.bit = self.spell(self.row, self.gate)
            self.so, found, n = np.empty(keys.shape, dtype=np.int32), [], []
            w, total = self.weight[self.owner].astype(np.float64), 0
            for k, x in enumerate(keys):
                at, seen = pd.factorize(x)
                count = np.bincount(at * 2 + self.bit, w, 2 * len(seen)).reshape(-1, 2)
                count[seen == 0] = 0
                self.so[k] = at + total
                total += len(seen)
                found.append(pd.Index(seen))
                n.append(count)
            self.found, self.n = found, np.concatenate([*n, np.zeros((1, 2))]).astype(np.float32)
        else:
            self.found, self.n = [pd.Index([], dtype="int64")] * (ORDERS - LOW), np.zeros((1, 2), dtype=np.float32)

    def spell(self, rows: np.ndarray, gates: np.ndarray):
        return spell([self.tokens[i] for i in rows], gates, self.depth[rows], self.code, self.sizes)

    def known(self, keys: np.ndarray) -> np.ndarray:
        """Positions of keys of words so far among the group's counts; the last one is of none."""
        out, total = np.empty(keys.shape, dtype=np.int64), 0
        for k, x in enumerate(keys):
            at = self.found[k].get_indexer(x)
            out[k] = np.where(at < 0, len(self.n) - 1, at + total)
            total += len(self.found[k])
        return out


# --- mixer, refinement --------------------------------------------------------------


class Mixer:
    """Counters of contexts of a few bytes, with mixing weights and refinement; all arrays of bounded size."""

    def __init__(self, code: tuple, sizes: tuple, counts: np.ndarray):
        self.code, self.sizes, self.counts = code, sizes, counts
        self.begin()

    def begin(self) -> None:
        self.weights = np.full((ORDERS, ORDERS, BUCKETS), 0.25)
        grid = 1 / (1 + np.exp(-np.linspace(-12, 12, REFINE)))
        self.ones, self.seen = np.tile(grid, ORDERS), np.ones(ORDERS * REFINE)  # one pseudo-observation each

    def inputs(self, low: np.ndarray, so: np.ndarray, n_so: np.ndarray, bit: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, evidence levels and the gate of each bit; with bit, one occurrence of it is left out of the counts."""
        size = low.shape[1]
        logits, seen, gate = np.empty((ORDERS, size), dtype=np.float32), np.empty((ORDERS, size), dtype=np.int16), np.zeros(size, dtype=np.int64)
        zero = None if bit is None else 1 - bit
        for k in range(ORDERS):
            # a pair of counters is fetched as one number
            n = (self.counts if k < LOW else n_so).view(np.int64).ravel().take(low[k] if k < LOW else so[k - LOW]).view(np.float32)
            n0, n1 = n[0::2].copy(), n[1::2].copy()
            if bit is not None:
                n0 -= zero
                n1 -= bit
                np.maximum(n0, 0, out=n0)
                np.maximum(n1, 0, out=n1)
            both = n0 + n1
            both += np.float32(1)
            n0 += np.float32(0.05)
            n1 += np.float32(0.05)
            n1 /= n0
            np.log(n1, out=logits[k])
            # the exponent of a number is the whole part of its logarithm
            level = both.view(np.int32)
            level >>= 23
            level -= 127
            np.minimum(level, BUCKETS - 1, out=seen[k], casting="unsafe")
            if k:
                np.copyto(gate, k, where=seen[k] > 0)
        return logits, seen, gate

    def mixed(self, logits: np.ndarray, seen: np.ndarray, gate: np.ndarray) -> np.ndarray:
        z = np.zeros(logits.shape[1], dtype=np.float32)
        at, flat = gate * (ORDERS * BUCKETS), self.weights.ravel().astype(np.float32)
        for k in range(ORDERS):
            w = flat[at + (k * BUCKETS + seen[k])]
            w *= logits[k]
            z += w
        return np.clip(z, -12, 12, out=z)

    def points(self, z: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (z + 12) * ((REFINE - 1) / 24)
        low = np.minimum(x.astype(np.int64), REFINE - 2)
        return gate * REFINE + low, x - low

    def learn(self, low: np.ndarray, so: np.ndarray, n_so: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        """One online step over a block of bits, each with one occurrence of its own left out of the counts."""
        logits, seen, gate = self.inputs(low, so, n_so, bit)
        z = self.mixed(logits, seen, gate)
        at, part = self.points(z, gate)
        for shift, share in ((0, weight * (1 - part)), (1, weight * part)):
            self.ones += np.bincount(at + shift, share * bit, ORDERS * REFINE)
            self.seen += np.bincount(at + shift, share, ORDERS * REFINE)
        error = (bit - 1 / (1 + np.exp(-z))) * weight
        size, total = ORDERS * BUCKETS, weight.sum()
        for k in range(ORDERS):
            at = gate * BUCKETS + seen[k]
            up = np.bincount(at, error * logits[k], size)
            curve = np.bincount(at, weight * logits[k] ** 2, size)
            self.weights[:, k, :] += (RATE * up / (0.25 * curve + 1e-3 * total + 1e-9)).reshape(ORDERS, BUCKETS)

    def probability(self, low: np.ndarray, so: np.ndarray, n_so: np.ndarray) -> np.ndarray:
        """Of a one: the mixed probability, averaged with its refinement."""
        logits, seen, gate = self.inputs(low, so, n_so, None)
        z = self.mixed(logits, seen, gate)
        at, part = self.points(z, gate)
        refined = self.ones / self.seen
        p = 0.5 / (1 + np.exp(-z)) + 0.5 * (refined[at] * (1 - part) + refined[at + 1] * part)
        return np.clip(p, 1e-6, 1 - 1e-6)


#: Pairs of a token and gate that are spelled at once, so that they stay in the cache; slots of a part of the counters that tasks sum together.
PAIRS, SLOTS = 2_000, 1 << 17


def _counters(code: tuple, sizes: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(2 * int(sizes[1][-1]))
        for b in batches:
            tokens, c = b.column("token").to_pylist(), _columns(b, _C)
            row, gate = np.nonzero(c)
            depth = np.zeros(len(tokens))
            for at in range(0, len(row), PAIRS):
                r, g = row[at : at + PAIRS], gate[at : at + PAIRS]
                owner, low, _, bit = spell([tokens[i] for i in r], g, depth[r], code, sizes)
                w = c[r, g][owner].astype(np.float64)
                low *= 2
                low += bit
                for k in range(LOW):
                    np.add.at(n, low[k], w)
        # occupied slots only
        at = np.flatnonzero(n.reshape(-1, 2).any(axis=1))
        for part, some in zip(*_runs(at // SLOTS, at), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([int(part)], pa.int32()), pa.array([_squeeze(np.concatenate((some, n[2 * some], n[2 * some + 1])))], pa.binary())], names=["part", "data"])

    return run


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Columns of whole numbers side by side."""
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct sorted keys, and the values of each."""
    found, starts = np.unique(keys, return_index=True)
    return found, np.split(values, starts[1:]) if len(found) else []


def _sum(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((SLOTS, 2))
    for data in rows.data:
        at, n0, n1 = _spread(data).reshape(3, -1)
        total[at - key[0] * SLOTS] += np.stack((n0, n1), 1)
    at = np.flatnonzero(total.any(axis=1))
    return pd.DataFrame({"part": [key[0]], "data": [_squeeze(np.concatenate((at + key[0] * SLOTS, total[at, 0], total[at, 1])))]})


def _squeeze(x: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, of which most are zero."""
    return zstandard.compress(np.ascontiguousarray(x, dtype="<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _spread(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), dtype=np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _learner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, unit, total = Mixer(*shared.value), None, 0.0

        def out() -> pa.RecordBatch:
            found = [pa.array([x.ravel().tolist()], pa.list_(pa.float64())) for x in (mixer.weights, mixer.ones, mixer.seen)]
            return pa.RecordBatch.from_arrays([pa.array([unit], pa.int32()), *found, pa.array([total], pa.float64())], names=["unit", "weights", "ones", "seen", "total"])

        for key, rows in arrow_groups(batches, ["unit", "group"]):
            if key[0] != unit:
                if unit is not None:
                    yield out()
                mixer.begin()
                unit, total = key[0], 0.0
            group = Group(rows, mixer.code, mixer.sizes)
            if not len(group.row):
                continue
            of_bit = (np.random.default_rng(3).permutation(len(group.row)) // STEP)[group.owner]
            for k in range(-(-len(group.row) // STEP)):
                pick = np.flatnonzero(of_bit == k)
                mixer.learn(group.low.take(pick, axis=1), group.so.take(pick, axis=1), group.n, group.bit[pick].astype(np.float32), group.weight[group.owner[pick]].astype(np.float64))
            total += float(group.weight.sum())
        if unit is not None:
            yield out()

    return run


def _scorer(shared, learned: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = Mixer(*shared.value)
        mixer.weights, mixer.ones, mixer.seen = learned
        for _, rows in arrow_groups(batches, ["unit", "group"]):
            group = Group(rows, mixer.code, mixer.sizes)
            out = np.zeros((len(rows), GATES))
            # training pairs are spelled already
            for at in range(0, len(group.row), PAIRS):
                r, g = group.row[at : at + PAIRS], group.gate[at : at + PAIRS]
                i, j = np.searchsorted(group.owner, (at, at + len(r)))
                p = mixer.probability(group.low[:, i:j], group.so[:, i:j], group.n)
                out[r, g] = np.bincount(group.owner[i:j] - at, np.log10(np.where(group.bit[i:j] == 1, p, 1 - p)), len(r))
            row, gate = np.nonzero((rows[_S].to_numpy() > 0) & (group.counts == 0))
            for at in range(0, len(row), PAIRS):
                r, g = row[at : at + PAIRS], gate[at : at + PAIRS]
                owner, low, keys, bit = group.spell(r, g)
                p = mixer.probability(low, group.known(keys), group.n)
                out[r, g] = np.bincount(owner, np.log10(np.where(bit == 1, p, 1 - p)), len(r))
            found = [pa.array(group.tokens, pa.binary()), pa.array(group.counts.sum(axis=1), pa.int64()), *(pa.array(x) for x in out.T)]
            yield pa.RecordBatch.from_arrays(found, names=["token", "c", *(f"g{g}" for g in range(GATES))])

    return run


def spelled(vocab: DataFrame, trained: int) -> DataFrame:
    """(token, c, g0..g3) of a vocabulary: training count, and log10 probability of its spelling under each gate it was seen with."""
    sc = vocab.sparkSession.sparkContext
    code, sizes = byte_code(_byte_counts(vocab)), slot_sizes(trained)
    seen = vocab.where(sum(F.col(c) for c in _C) > 0).select("token", *_C)
    made = by_groups(seen.mapInArrow(_counters(code, sizes), "part int, data binary"), ["part"], _sum, "part int, data binary")
    counts = np.zeros((int(sizes[1][-1]), 2), dtype=np.float32)
    for row in made.toLocalIterator():  # bounded by MOST_BITS, a part at a time
        at, n0, n1 = _spread(bytes(row["data"])).reshape(3, -1)
        counts[at, 0], counts[at, 1] = n0, n1
    shared = sc.broadcast((code, sizes, counts))
    mixer = Mixer(code, sizes, counts)
    dealt_ = materialise(grouped(vocab, trained))
    dealt = lambda rows, key: bounded(rows).repartition(key).sortWithinPartitions("unit", "group", "token")
    trained_ = dealt_.where(sum(F.col(c) for c in _C) > 0).drop(*_S)  # words that are only held out teach nothing
    learned = dealt(trained_, "unit").mapInArrow(_learner(shared), "unit int, weights array<double>, ones array<double>, seen array<double>, total double").where("total > 0").toPandas()
    learned = learned.sort_values("unit", ignore_index=True)  # not by orderBy, which would run the learner a second time to sample its rows
    if len(learned):
        share = learned.total.to_numpy() / learned.total.sum()
        mixer.weights = np.tensordot(share, np.array(learned.weights.tolist()), 1).reshape(mixer.weights.shape)
        mixer.ones, mixer.seen = np.array(learned.ones.tolist()).sum(0), np.array(learned.seen.tolist()).sum(0)
    scorer = _scorer(shared, (mixer.weights, mixer.ones, mixer.seen))
    scored = materialise(dealt(dealt_, "group").mapInArrow(scorer, "token binary, c long, " + ", ".join(f"g{g} double" for g in range(GATES))))
    shared.destroy()
    discard(dealt_)
    return scored


# --- contexts across words ------------------------------------------------------------

#: Upper ends of the levels of a count, and the count that stands for a level.
_ENDS, _STAND = np.array([0, 1, 2, 4, 8, 16]), np.array([0, 1, 2, 3.5, 6.5, 12, 40])
LEVELS = len(_STAND)
CELLS = LEVELS**4
_LEVEL = np.searchsorted(_ENDS, np.arange(_ENDS[-1] + 2))
#: Bits of a context's key within its part.
KEY_BITS = 30


def contexts(words_: np.ndarray, starts: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, context, longer context) of the tokens that have a context, for hashes of the tokens of documents and where each begins.

    A context is the last two words and more until one is not hot; the longer one has a word more. Before a document
    stand blanks, which are hot.
    """
    n = len(words_)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    at, h, settled, taken = np.arange(n), np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool), []
    cool = ~hot
    for k in range(1, MOST_WORDS + 2):
        inside = place[at] >= k
        back = at - k
        back[~inside] = 0
        longer = words_[back]
        longer[~inside] = 0
        longer += h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k)
        longer = mix64(longer)
        if k > 2:
            taken.append((at[settled], h[settled], longer[settled]))
            go = ~settled
            at, longer, inside, back, settled = at[go], longer[go], inside[go], back[go], settled[go]
        settled = settled | (inside & cool[back])
        h = longer
    return tuple(np.concatenate(x) for x in zip(*taken, strict=True))


class Chunk:
    """Tokens of the documents of a batch: hashes of them, documents' starts and whether they are held out."""

    def __init__(self, data: bytes):
        self.lengths, self.held, self.gate, ids, self.tail = pickle.loads(zstandard.decompress(data))
        self.ids = np.ascontiguousarray(np.frombuffer(ids, dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel().astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    @staticmethod
    def pack(lengths: list[int], held: list[bool], gate: list[int], ids: np.ndarray, tail: np.ndarray) -> bytes:
        planes = np.ascontiguousarray(ids, dtype="<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
        return zstandard.compress(pickle.dumps((np.array(lengths, dtype=np.int64), np.array(held, dtype=bool), np.array(gate, dtype=np.int64), planes, tail)), 3)

    def asks(self, head: int, hot: np.ndarray, parts: int, bare: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        """(part, positions, what is asked: context, rest of the longer context, word, trained) in a fixed order; the last only unless bare."""
        words_ = mix64(self.ids.astype(np.uint64) + np.uint64(1))
        rare = self.ids >= head
        if rare.any():
            words_[rare] = self.tail[self.ids[rare] - head]
        is_hot = np.zeros(head + 1, dtype=bool)
        is_hot[hot] = True
        at, short, long = contexts(words_, self.starts, is_hot[np.minimum(self.ids, head)])
        part = ((short >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        key = (short & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64)
        both, spare = part << KEY_BITS | key, max(1, len(at).bit_length())
        if KEY_BITS + parts.bit_length() + spare < 63:  # places ride along, which sorts faster than places by keys
            order = np.sort(both << spare | np.arange(len(at))) & ((1 << spare) - 1)
        else:
            order = np.argsort(both, kind="stable")
        at, part = at[order], part[order]
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(starts[1:], len(part))
        if not bare:
            trained = ~np.repeat(self.held, self.lengths)
            word = np.where(rare, (words_ & np.uint64(0xFFFFFF)).astype(np.int64) | RARE, self.ids)
            rows = np.stack((key[order], (long[order] & np.uint64(0x7FFF)).astype(np.int64), word[at], trained[at].astype(np.int64)))
        for i, j in zip(starts.tolist(), ends.tolist(), strict=True):
            yield int(part[i]), at[i:j], None if bare else rows[:, i:j]


def _ask(head: int, hot: np.ndarray, parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for number, data in zip(b.chunk, b.data, strict=True):
                made = [(number, p, _thin(rows)) for p, _, rows in Chunk(data).asks(head, hot, parts)]
                yield pd.DataFrame(made, columns=["chunk", "part", "data"]).astype({"part": np.int32})

    return run


#: Marks the hash of a rare word; a word of the head travels as its rank, which takes fewer bits than its hash.
RARE = 1 << 24


def _thin(rows: np.ndarray) -> bytes:
    """Rows of a key (rising), 15 bits, a rank or a marked hash of 24 bits, and a flag as compressed planes of bytes."""
    planes = lambda x, n: x.astype("<u4").view(np.uint8).reshape(-1, 4).T[:n]
    steps = np.diff(rows[0], prepend=0) | (rows[2] & RARE) << 7
    return zstandard.compress(np.concatenate((planes(steps, 4), planes(rows[2], 3), planes(rows[1] | rows[3] << 15, 2))).tobytes(), 1)


def _thick(data: bytes) -> np.ndarray:
    """The rows of _thin, with 24 bits of the hash of each word."""
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(9, -1)
    four = lambda at, n: np.ascontiguousarray(np.concatenate((planes[at : at + n], np.zeros((4 - n, planes.shape[1]), dtype=np.uint8))).T).view("<u4").ravel()
    steps, word, rest = four(0, 4), four(4, 3).astype(np.int64), four(7, 2).astype(np.int64)
    of_head = np.flatnonzero(steps < 1 << 31)
    word[of_head] = (mix64(word[of_head].astype(np.uint64) + np.uint64(1)) & np.uint64(0xFFFFFF)).astype(np.int64)
    return np.stack((np.cumsum(steps & 0x7FFFFFFF, dtype=np.int64), rest & 0x7FFF, word, rest >> 15))


def _order(x: np.ndarray) -> np.ndarray:
    """Places of whole numbers from 0 on in rising order; of equal ones as they come."""
    spare = max(1, len(x).bit_length())
    if int(x.max()).bit_length() + spare < 63:  # places ride along, which sorts faster than places by numbers
        return np.sort(x << spare | np.arange(len(x))) & ((1 << spare) - 1)
    return np.argsort(x, kind="stable")


def _numbered(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on of the runs of equal values, in order."""
    return np.cumsum(np.concatenate(([0], x[1:] != x[:-1])))


def _tops(context: np.ndarray, word: np.ndarray, trained: np.ndarray, times: np.ndarray | None, contexts_: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Of each row, without its own occurrence: its context's most frequent word, how often that came, and how often the context. Then the pairs (context, word) in order and how often each came.

    times: how many training occurrences a row stands for; None: one if it is trained.
    """
    if times is None:
        times, both = trained, np.sort((context << 24 | word) << 1 | trained)
        starts = np.flatnonzero(np.diff(both >> 1, prepend=-1))
        pair, n = both[starts] >> 1, np.add.reduceat(both & 1, starts)
    else:
        pair = np.sort(context << 24 | word)
        pair = pair[np.concatenate(([True], pair[1:] != pair[:-1]))]
        of = np.searchsorted(pair, context << 24 | word)
        n = np.bincount(of, times, len(pair)).astype(np.int64)
    # the pairs of a context by falling count, then by word, in one number each
    spare = 63 - 24 - max(1, int(contexts_ - 1).bit_length())
    most = (1 << spare) - 1
    ranked = np.sort(((pair >> 24) << spare | (most - np.minimum(n, most))) << 24 | (pair & 0xFFFFFF))
    sizes = np.bincount(pair >> 24, minlength=contexts_)
    first = np.cumsum(sizes) - sizes
    read = lambda at: (ranked[at] & 0xFFFFFF, most - (ranked[at] >> 24 & most))
    w1, n1 = read(first)
    w2, n2 = read(np.minimum(first + 1, len(ranked) - 1))
    n2 = np.where(sizes > 1, n2, 0)
    # without its own occurrence, the best may come to rank after the second
    own = trained & (word == w1[context])
    low, other = n1[context] - own, n2[context]
    swap = own & ((low < other) | ((low == other) & (w2[context] < word)))
    total = np.bincount(context, times, contexts_).astype(np.int64)[context] - trained
    return np.where(swap, w2[context], w1[context]), np.where(swap, other, low), total, (pair, n)


def foretell(rows: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """For rows (context, rest of the longer context, word, trained): 2 * cell + whether the word is the foretold one; 0 without evidence.

    times: of distinct rows, how often each occurs; None: each is one occurrence. The longer context foretells its most frequent word if it came before, else the shorter one.
    """
    key, rest, word, trained = rows[0], rows[1], rows[2], rows[3] > 0
    out = np.zeros(len(key), dtype=np.int64)
    if not len(key):
        return out
    times = None if times is None else times * trained
    # in the order of contexts, so that what belongs to one lies together
    at = _order(key)
    a = _numbered(key[at])
    # rows of contexts that came with at most one training token, and that their own, neither have evidence nor are any
    alive = np.bincount(a, (trained if times is None else times)[at])[a] - trained[at] > 0
    some = np.flatnonzero(np.bincount(a, alive)[a] > 0)
    if not len(some):
        return out
    at, a = at[some], _numbered(a[some])
    by = _order(a << 15 | rest[at])
    at, a = at[by], a[by]
    b = _numbered(a << 15 | rest[at])
    word, trained, times = word[at], trained[at], None if times is None else times[at]
    top_a, n_a, total_a, (pair, n_pair) = _tops(a, word, trained, times, int(a[-1]) + 1)
    top_b, n_b, total_b, _ = _tops(b, word, trained, times, int(b[-1]) + 1)
    use = total_b > 0
    # how often the word that the longer context foretells came after the shorter one
    n_a[use] = n_pair[np.searchsorted(pair, a[use] << 24 | top_b[use])] - (trained & (word == top_b))[use]
    top, n_b = np.where(use, top_b, top_a), np.where(use, n_b, 0)
    level = lambda n: _LEVEL[np.minimum(n, len(_LEVEL) - 1)]
    cell = ((level(n_b) * LEVELS + level(np.where(use, total_b - n_b, 0))) * LEVELS + level(n_a)) * LEVELS + level(total_a - n_a)
    out[at] = np.where(total_a > 0, 2 * cell + (word == top), 0)
    return out


_TOLD = "chunk long, part int, data binary, cell int, ones long, seen long"


#: Occurrences of a part that are held against each other at once.
HELD_ROWS = OCCURRENCES * 3 // 2


def _answers(asked: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Of the chunks of a part, what foretell says of each one's rows, and how often training tokens had each answer.

    Rows of a part that is large are told in ranges of keys; those of one large context by its distinct rows.
    """
    seen = np.zeros(2 * CELLS, dtype=np.int64)

    def count(told: np.ndarray, trained: np.ndarray) -> None:
        seen[:] += np.bincount(told[trained > 0], minlength=2 * CELLS)

    out = [np.zeros(zstandard.frame_content_size(d) // 9, dtype=np.uint16) for d in asked]
    todo = [(0, 1 << KEY_BITS)]
    while todo:
        low, high = todo.pop()
        whole = high - low == 1 << KEY_BITS
        edges = [(0, len(o)) if whole else tuple(np.searchsorted(_keys(d), (low, high))) for d, o in zip(asked, out, strict=True)]
        n = sum(j - i for i, j in edges)
        if n > HELD_ROWS and high - low > 1:
            cut = (low + high) // 2
            todo += [(cut, high), (low, cut)]
            continue
        if not n:
            continue
        if n <= HELD_ROWS:
            rows = np.concatenate([_thick(d)[:, i:j] for d, (i, j) in zip(asked, edges, strict=True)], axis=1)
            told = foretell(rows)
            count(told, rows[3])
            for o, x, (i, j) in zip(out, np.split(told, np.cumsum([j - i for i, j in edges])[:-1]), edges, strict=True):
                o[i:j] = x
            continue
        codes = lambda d, i, j: (lambda x: x[1] << 25 | x[2] << 1 | x[3])(_thick(d)[:, i:j])
        found, times = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for d, (i, j) in zip(asked, edges, strict=True):
            x, m = np.unique(codes(d, i, j), return_counts=True)
            found, at = np.unique(np.concatenate((found, x)), return_inverse=True)
            times = np.bincount(at, np.concatenate((times, m)), len(found)).astype(np.int64)
        told = foretell(np.stack((np.full(len(found), low), found >> 25, found >> 1 & 0xFFFFFF, found & 1)), times)
        for d, o, (i, j) in zip(asked, out, edges, strict=True):
            x = codes(d, i, j)
            o[i:j] = told[np.searchsorted(found, x)]
            count(o[i:j], x & 1)
    return out, seen


def _keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(9, -1)[:4]
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel() & 0x7FFFFFFF, dtype=np.int64)


def _tell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Answers for each chunk in the order in which it asked, and how often the cells of training tokens came true."""
    rows = rows.sort_values("chunk", kind="stable")
    answers, seen = _answers(list(rows.data))
    out = pd.DataFrame({"chunk": rows.chunk.to_numpy(), "part": key[0], "data": [zstandard.compress(np.ascontiguousarray(x, dtype="<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1) for x in answers], "cell": -1, "ones": 0, "seen": 0})
    n = seen.reshape(-1, 2)
    at = np.flatnonzero(n[1:].any(axis=1)) + 1
    return pd.concat([out, pd.DataFrame({"chunk": -1, "part": key[0], "data": None, "cell": at, "ones": n[at, 1], "seen": n[at].sum(1)})], ignore_index=True)


def foretold(cells: np.ndarray, ones: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Log10 probabilities (2 * cell + came true) by mixing the counters of both contexts, learned over cells in order, and refined by what came true in each.

    Inputs are the logits of the longer and the shorter context and a constant; the weights are gated by the evidence of the longer context.
    """
    at = np.arange(CELLS)
    n1, m1, n2, m2 = (_STAND[(at // LEVELS**k) % LEVELS] for k in (3, 2, 1, 0))
    logit = lambda n, m: np.where(n + m > 0, np.log(n + 0.05) - np.log(m + 0.05), 0.0)
    x = np.stack((logit(n1, m1), logit(n2, m2), np.ones(CELLS)), 1)
    gate = np.searchsorted(_ENDS, n1 + m1)
    weights = np.tile(np.array([0.4, 0.4, -0.5]), (LEVELS, 1))
    order = np.argsort(cells, kind="stable")
    cells, ones, seen = cells[order], ones[order].astype(np.float64), seen[order].astype(np.float64)
    for _ in range(200):
        z = np.clip((weights[gate[cells]] * x[cells]).sum(1), -12, 12)
        p = 1 / (1 + np.exp(-z))
        error, curve = ones - seen * p, seen * np.maximum(p * (1 - p), 0.01)
        for g in range(LEVELS):
            mine = gate[cells] == g
            if mine.any():
                part = x[cells[mine]]
                weights[g] += 0.5 * np.linalg.solve((part * curve[mine, None]).T @ part + np.eye(3), (part * error[mine, None]).sum(0))
    p = 1 / (1 + np.exp(-np.clip((weights[gate] * x).sum(1), -12, 12)))
    kept, came = np.zeros(CELLS), np.zeros(CELLS)
    kept[cells], came[cells] = seen, ones
    p = np.clip((came + 10 * p) / (kept + 10), 1e-6, 1 - 1e-6)
    out = np.log10(np.stack((1 - p, p), 1)).ravel()
    out[:2] = 0  # without evidence nothing is foretold
    return out


# --- reading documents -----------------------------------------------------------------

GATE_COST = -math.log10(GATES)
_READ = "doc_id {0}, held_out boolean, row long, n_bytes long, gate long, n long, known long, base double, rare array<binary>, times array<long>, chunk long, data binary"


def _reader(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, c = shared.value
        held, base = c > 0, np.log10(c + 0.1)
        first, made = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            if not b.num_rows:
                continue
            out, ids_of, tail = [], [], {}
            held_out_ = b.column(1).to_pylist()
            for text in b.column(2).cast(pa.binary()).to_pylist():
                text = text or b""
                tokens = words(text)
                ids = np.fromiter(map(number.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
                rest = ids < 0
                rare, times = [], []
                known = ids[~rest]
                if rest.any():
                    mine = Counter(compress(tokens, rest.tolist()))
                    ids[rest] = [tail.setdefault(t, len(tail)) + len(number) for t in compress(tokens, rest.tolist())]
                    rare = sorted(mine, key=tail.__getitem__)
                    times = [mine[t] for t in rare]
                ids_of.append(ids)
                out.append((len(b" ".join(tokens)), gate_of(text), len(tokens), int(held[known].sum()), float(base[known].sum()), rare, times))
            hashes = word_hashes(np.frombuffer(b" ".join(tail), dtype=np.uint8))
            columns = list(zip(*out, strict=True))
            data = Chunk.pack(columns[2], held_out_, columns[1], np.concatenate(ids_of), hashes)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            n = b.num_rows
            row, chunk = pa.array(range((first + made) * 1, (first + made) + n), pa.int64()), pa.array([first + made, *[None] * (n - 1)], pa.int64())
            names = ["doc_id", "held_out", "row", "n_bytes", "gate", "n", "known", "base", "rare", "times", "chunk", "data"]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), row, *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True)), chunk, pa.array([data, *[None] * (n - 1)], pa.binary())], names=names)
            made += n

    return run


def _settle(shared, hot: np.ndarray, parts: int, logs: np.ndarray):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Of each document of a chunk: its score without its rare words, how many tokens were foretold, and how often each of its rare words is spelled."""
        scores = shared.value
        head = scores.shape[1]
        own = (rows.part == -1).to_numpy()
        chunk = Chunk(rows.data[own].iloc[0])
        told = dict(zip(rows.part[~own].tolist(), rows.data[~own], strict=True))
        code = np.zeros(len(chunk.ids), dtype=np.int64)
        for p, at, _ in chunk.asks(head, hot, parts, bare=True):
            code[at] = np.ascontiguousarray(np.frombuffer(zstandard.decompress(told[p]), dtype=np.uint8).reshape(2, -1).T).view("<u2").ravel()
        doc = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
        spelled_ = (code & 1) == 0
        cost = logs[code]
        of_head = spelled_ & (chunk.ids < head)
        cost[of_head] += scores[chunk.gate[doc[of_head]], chunk.ids[of_head]]
        # rare words in the order of their first places in the chunk, as the reader lists them
        tail = chunk.ids >= head
        pair, back = np.unique(doc[tail] * (1 << 32) + chunk.ids[tail], return_inverse=True)
        left = np.bincount(back, spelled_[tail], len(pair)).astype(np.int64)
        lists = np.split(left, np.searchsorted(pair >> 32, np.arange(1, len(chunk.lengths))))
        return pd.DataFrame({"row": key[0] + np.arange(len(chunk.lengths)), "score": np.bincount(doc, cost, len(chunk.lengths)), "foretold": np.bincount(doc, ~spelled_, len(chunk.lengths)).astype(np.int64), "left": [x.tolist() for x in lists]})

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of every whole text of docs (doc_id, text), learned from those whose crc32(doc_id as text) mod 10 is not 0.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte, n_foretold. score is the
    log10 probability of the text's tokens in order: A-Z lower-cased words, each with one white space after it, then the
    end (that a foretold word might also be spelled is left out, so all texts sum to slightly less than one). base_score is
    that of the tokens' smoothed frequencies. bits_per_byte divides by the bytes that are coded: words, a white space after
    each, and the end. n_foretold counts tokens that were the most frequent word after their context.

    Null texts count as empty: the end alone. Rows repeat if they are repeated; a null doc_id
    is learned from. Words of any length are spelled whole. Other columns are ignored. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    vocab = materialise(gather(docs))
    n, v = vocab.agg(F.coalesce(F.sum(sum(F.col(c) for c in _C)), F.lit(0)), F.count_if(sum(F.col(c) for c in _C) > 0)).first()
    scored = spelled(vocab, v)
    discard(vocab)
    top = scored.orderBy(F.desc("c"), "token").limit(HEAD).collect()  # bounded by HEAD
    table = np.array([tuple(r)[1:] for r in top], dtype=np.float64).reshape(len(top), 1 + GATES).T
    hot, parts = np.flatnonzero(table[0] > PART), max(1, -(-n // min(PART, OCCURRENCES)))
    head, costs = sc.broadcast(({bytes(r["token"]): i for i, r in enumerate(top)}, table[0])), sc.broadcast(np.ascontiguousarray(table[1:]))

    read = bounded(docs).select("doc_id", held_out().alias("held_out"), "text").mapInArrow(_reader(head), _READ.format(docs.schema["doc_id"].dataType.simpleString()))
    rows = materialise(read)
    chunks = rows.where("data is not null").select("chunk", F.lit(-1).alias("part"), "data")
    asked = chunks.mapInPandas(_ask(len(top), hot, parts), "chunk long, part int, data binary")
    told = materialise(by_groups(asked, ["part"], _tell, _TOLD))
    cells = told.where("cell >= 0").groupBy("cell").agg(F.sum("ones").alias("ones"), F.sum("seen").alias("seen")).toPandas()  # at most CELLS rows
    logs = foretold(*(cells[c].to_numpy(dtype=np.int64) for c in ("cell", "ones", "seen")))
    both = chunks.unionByName(told.where("cell < 0").select("chunk", "part", "data"))
    settled = materialise(by_groups(both, ["chunk"], _settle(costs, hot, parts, logs), "row long, score double, foretold long, left array<long>"))
    discard(told)

    rows = rows.drop("chunk", "data").join(settled, "row")
    tail = rows.select("row", "gate", F.explode(F.arrays_zip("rare", "times", "left")).alias("x")).select("row", "gate", F.col("x.rare").alias("token"), F.col("x.times").alias("k"), F.col("x.left").alias("left"))
    of_gate = F.element_at(F.array(*[f"g{g}" for g in range(GATES)]), (F.col("gate") + 1).cast("int"))
    tail = tail.join(scored, "token").groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("k2"), F.sum(F.col("k") * F.log10(F.col("c") + 0.1)).alias("b2"), F.sum(F.col("left") * of_gate).alias("s2"))
    out = rows.drop("rare", "times", "left").join(tail, "row", "left")
    zero = F.lit(0)
    score = F.lit(GATE_COST) + F.col("score") + F.coalesce("s2", zero)
    return out.select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("k2", zero)).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b2", zero) - F.col("n") * math.log10(n + 0.1 * (v + 1))).alias("base_score"), score.alias("score"),
        (-score * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"), F.col("foretold").alias("n_foretold"),
    )


def _byte_counts(vocab: DataFrame) -> np.ndarray:
    """How often each byte is spelled in training, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(256)
        for b in batches:
            if b.num_rows:
                tokens, times = b.column("token").to_pylist(), _columns(b, _C).sum(axis=1)
                data = np.frombuffer(b" ".join(tokens) + b" ", dtype=np.uint8)
                n += np.bincount(data, np.repeat(times, np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1), 256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(n)], names=["byte", "n"])

    got = vocab.select("token", *_C).mapInArrow(run, "byte int, n double").groupBy("byte").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(256)
    out[got.byte] = got.n
    return out
