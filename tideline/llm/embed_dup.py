"""Embedding near-duplicates by product quantisation (operator 1).

Unit vectors are dealt to coarse inverted lists; the residual to a list's centre is coded
by subspaces. A vector looks into every list whose bisecting hyperplane is so near that a vector
within the distance the cosine threshold allows may lie beyond it; it filters members by asymmetric
table-lookup distances less their known coding error (without loss), and links those whose exact cosine in
double precision reaches the threshold.

How far a step of that distance goes across a hyperplane depends on the directions in which vectors vary. The
index measures the spread of residuals along each normal, and then, on a bounded sample of queries compared with every
row by brute force, how many such spreads the links need; a quarter is added to the most that any needed. A step
never goes beyond the whole distance, so where vectors vary in few directions the bound is exact and nothing is lost.

Equal vectors are one node. A list is compared in blocks; within a pair of blocks
only counts of links and a spanning forest leave the task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, by_groups, components, materialise

COSINE = 0.95
#: Centres and codes are fitted on at most so many vectors, those of least hash; all are indexed.
FIT_ROWS = 20_000
#: About so many vectors in a list; lists at most; subspaces and codes in each; vectors of a block.
LIST_ROWS, MOST_LISTS, SUBSPACES, CODES, BLOCK = 512, 4096, 8, 64, 512
#: Spreads that a step across a hyperplane is taken to go at least; sampled queries whose links may show that it goes further, and by how much more it is then taken.
SPREADS, ASKED, MARGIN = 3.5, 512, 1.25
#: Vectors of so many of the most frequent lengths have an index each; those of a rarer length are one list.
LENGTHS = 16
SEED = 17
#: Rows of probes that are handed on at once.
PROBES = 20_000
#: Slack of the lossless filters, for rounding.
SLACK = 1e-6


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.stack([np.bincount(at, x[:, j], len(centres)) for j in range(x.shape[1])], 1)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return np.unique(centres, axis=0)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centres.T - half, 1) for i in range(0, len(x), 4096)]) if len(x) else np.empty(0, dtype=np.int64)


class Index:
    """Centres and subspace codes of vectors of one length; a bounded number of both. Its lists are numbered from first."""

    def __init__(self, sample: np.ndarray, rows: int, first: int = 0):
        self.first = first
        self.centres = _kmeans(sample, max(1, min(MOST_LISTS, rows // LIST_ROWS, len(sample) // 4)))
        rest = sample - self.centres[nearest(sample, self.centres)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.codes = [_kmeans(rest[:, c], CODES) for c in self.cuts]
        self.spreads = SPREADS
        # the spread of residuals along a direction, as a share of their whole length, is the length of its image
        values, vectors = np.linalg.eigh(rest.T @ rest / max(len(rest), 1))
        values = np.maximum(values, 0)
        total = values.sum()
        self.image = vectors * np.sqrt(values / total if total > 0 else np.full(len(values), 1 / len(values)))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of unit vectors."""
        at = nearest(x, self.centres)
        rest = x - self.centres[at]
        codes = np.stack([nearest(rest[:, c], b) for c, b in zip(self.cuts, self.codes, strict=True)], 1).astype(np.uint8)
        error = np.sqrt(sum(((rest[:, c] - b[codes[:, k]]) ** 2).sum(1) for k, (c, b) in enumerate(zip(self.cuts, self.codes, strict=True))))
        return at, codes, error

    def steps(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of some lists and every centre: their distance, and that distance times the spread along its direction."""
        out = []
        for c in (self.centres, self.centres @ self.image):
            squares = (c**2).sum(1)
            out.append(np.sqrt(np.maximum(squares[lists][:, None] + squares - 2 * c[lists] @ c.T, 0)))
        return out[0], out[1]

    def probes(self, x: np.ndarray, at: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every other list that may hold a vector within reach of a row."""
        rows, lists = [], []
        squares = (self.centres**2).sum(1)
        for i in range(0, len(x), 1024):
            own_list = at[i : i + 1024]
            found, back = np.unique(own_list, return_inverse=True)
            gap, spread = self.steps(found)
            step = 2 * reach * np.minimum(gap, self.spreads * spread)
            far = squares - 2 * (x[i : i + 1024] @ self.centres.T)
            own = far[np.arange(len(far)), own_list][:, None]
            r, c = np.nonzero((far - own <= step[back] + SLACK) & (np.arange(len(self.centres)) != own_list[:, None]))
            rows.append(r + i)
            lists.append(c)
        return (np.concatenate(rows), np.concatenate(lists)) if rows else (np.empty(0, dtype=np.int64),) * 2

    def needed(self, x: np.ndarray, y: np.ndarray, reach: float) -> np.ndarray:
        """How many spreads a step from the list of x to that of y, or back, needs, for pairs of rows; the one in the earlier list probes."""
        a, b = nearest(x, self.centres), nearest(y, self.centres)
        turned = a > b
        x, a, b = np.where(turned[:, None], y, x), np.where(turned, b, a), np.where(turned, a, b)
        ca, cb = self.centres[a], self.centres[b]
        step = (cb**2).sum(1) - (ca**2).sum(1) - 2 * (x * (cb - ca)).sum(1)
        spread = np.sqrt((((cb - ca) @ self.image) ** 2).sum(1))
        return np.where(a == b, 0, np.maximum(step, 0) / (2 * reach * np.maximum(spread, 1e-12)))

    def asymmetric(self, queries: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to coded members of a list, by table look-up."""
        rest = queries - self.centres[centre]
        total = np.zeros((len(queries), len(codes)))
        for k, (c, b) in enumerate(zip(self.cuts, self.codes, strict=True)):
            table = (rest[:, c] ** 2).sum(1)[:, None] - 2 * rest[:, c] @ b.T + (b**2).sum(1)
            total += table[:, codes[:, k]]
        return np.sqrt(np.maximum(total, 0))


class Alone:
    """The one list, without codes, of vectors of a rare length."""

    def __init__(self, first: int):
        self.first = first

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.zeros(len(x), dtype=np.int64), np.zeros((len(x), 0), dtype=np.uint8), np.full(len(x), np.inf)

    def probes(self, x: np.ndarray, at: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:  # noqa: ARG002
        return (np.empty(0, dtype=np.int64),) * 2

    def asymmetric(self, queries: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:  # noqa: ARG002
        return np.zeros((len(queries), len(codes)))


class Indexes:
    """Indexes by vector length; kind is the type of packed components."""

    def __init__(self, kind: str):
        self.kind, self.size, self.of = kind, np.dtype(kind).itemsize, {}

    def get(self, length: int) -> Index | Alone:
        return self.of.get(length) or Alone(-length)

    def unit(self, vectors) -> np.ndarray:
        """Unit vectors of packed components of one length."""
        x = np.frombuffer(b"".join(vectors), dtype=self.kind).reshape(len(vectors), -1).astype(np.float64)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def by_length(self, vectors: pd.Series) -> Iterator[tuple[int, np.ndarray]]:
        """(length, positions) of packed vectors."""
        sizes = vectors.map(len).to_numpy() // self.size
        for n in np.unique(sizes):
            yield int(n), np.flatnonzero(sizes == n)


def _pack(kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(vector=[np.asarray(v, dtype=kind).tobytes() for v in b.vector])

    return run


def _place(shared, reach: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indexes: Indexes = shared.value
        for b in batches:
            for length, rows in indexes.by_length(b.vector):
                part, index = b.iloc[rows], indexes.get(length)
                x = indexes.unit(part.vector)
                at, codes, error = index.encode(x)
                row, other = index.probes(x, at, reach)
                own = at + index.first
                one = pd.DataFrame({"id": part.id.to_numpy(), "n": part.n.to_numpy(), "vector": part.vector.to_numpy(), "own": own, "list": own, "codes": [c.tobytes() for c in codes], "error": error})
                yield one
                # each pair of lists is compared once, in the later; codes are needed of members only
                later = other > at[row]
                row, other = row[later], other[later] + index.first
                bare = one.assign(codes=b"")
                for i in range(0, len(row), PROBES):
                    yield bare.iloc[row[i : i + PROBES]].assign(list=other[i : i + PROBES])

    return run


def _needed(shared, asked: dict[int, tuple[np.ndarray, np.ndarray]], cosine: float, reach: float):
    """By vector length: links of the asked vectors among all rows, those that a step of SPREADS finds, and the most spreads that any needs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indexes: Indexes = shared.value
        for b in batches:
            for length, rows in indexes.by_length(b.vector):
                if length not in asked:
                    continue
                (ids, q), index = asked[length], indexes.get(length)
                y, other = indexes.unit(b.vector.iloc[rows]), b.id.to_numpy()[rows]
                links, found, most = 0, 0, 0.0
                for i in range(0, len(q), 64):
                    near = (q[i : i + 64] @ y.T >= cosine) & (ids[i : i + 64, None] != other)
                    k, j = np.nonzero(near)
                    if len(k):
                        need = index.needed(q[i : i + 64][k], y[j], reach)
                        links, found, most = links + len(k), found + int((need <= SPREADS).sum()), max(most, float(need.max()))
                yield pd.DataFrame({"length": [length], "links": [links], "found": [found], "most": [most]})

    return run


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of links, as (larger, smaller)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((max(x, y), min(x, y)))
    return out


def _compare(shared, cosine: float, reach: float):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame | None:
        indexes: Indexes = shared.value
        place, i, j = key
        left, right = group[(group.block == i)], group[(group.block == j) & (group.own == place)]
        if not len(left) or not len(right):
            return None
        x, y = indexes.unit(left.vector), indexes.unit(right.vector)
        index = indexes.get(x.shape[1])
        ia, ib = left.id.to_numpy(), right.id.to_numpy()
        codes = np.frombuffer(b"".join(right.codes), dtype=np.uint8).reshape(len(right), -1)
        near = index.asymmetric(x, place - index.first, codes) - right.error.to_numpy() <= reach + SLACK
        # members of the list meet once, by block and id; probes meet every member
        member = (left.own == place).to_numpy()
        if i == j:
            near &= ~member[:, None] | (ia[:, None] < ib)
        elif i > j:
            near &= ~member[:, None]
        p, q = np.nonzero(near)
        keep = [np.flatnonzero((x[p[k : k + 65536]] * y[q[k : k + 65536]]).sum(1) >= cosine) + k for k in range(0, len(p), 65536)]
        keep = np.concatenate(keep) if keep else np.empty(0, dtype=np.int64)
        p, q = p[keep], q[keep]
        if not len(p):
            return None
        na, nb = left.n.to_numpy(), right.n.to_numpy()
        n = pd.concat([pd.Series(nb[q]).groupby(ia[p]).sum(), pd.Series(na[p]).groupby(ib[q]).sum()])
        links = forest(ia[p], ib[q])
        out = pd.DataFrame({"id": n.index.to_numpy(), "links": n.to_numpy(), "a": -1, "b": -1, "is_edge": False})
        return pd.concat([out, pd.DataFrame({"id": -1, "links": 0, "a": [e[0] for e in links], "b": [e[1] for e in links], "is_edge": True})])

    return run


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, hash): vector and hash are null where it can't link. Doubles are divided by their largest component, so that no square overflows."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "float" if kind == "float" else "double"
    v = F.col("embedding").cast(f"array<{kind}>")
    top = F.array_max(F.transform("v", F.abs))
    usable = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (top > 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).withColumn("ok", F.coalesce(usable, F.lit(False)))
    scaled = F.col("v") if kind == "float" else F.transform("v", lambda x: x / top)
    rows = rows.select("vec_id", F.when(F.col("ok"), scaled).alias("vector"))
    return materialise(rows.withColumn("hash", F.when(F.col("vector").isNotNull(), F.struct(F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")))))


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, str]:
    """(h1, h2, id, n, vector packed) of prepared rows, and the type of packed components."""
    kind = "<f4" if rows.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
    nodes = rows.where("vector is not null").groupBy("hash").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    nodes = nodes.select("hash.*", "id", "n", "vector").toDF("h1", "h2", "id", "n", "vector")
    return materialise(bounded(nodes).mapInPandas(_pack(kind), "h1 long, h2 long, id long, n long, vector binary")), kind


def fitted(nodes: DataFrame, kind: str, cosine: float, reach: float):
    """The broadcast indexes of nodes, whose probes reach as far as the links of a sample of queries need; and what was measured, by length."""
    spark = nodes.sparkSession
    indexes, asked, first = Indexes(kind), {}, 0
    length = (F.octet_length("vector") / indexes.size).cast("int")
    common = nodes.groupBy(length.alias("d")).count().orderBy(F.desc("count"), "d").limit(LENGTHS).collect()
    for d, n in common:
        sample = nodes.where(length == d).select("id", "vector", F.xxhash64(F.lit(SEED), "id").alias("h")).orderBy("h", "id").limit(FIT_ROWS).toPandas()
        x = indexes.unit(sample.vector)
        indexes.of[d] = Index(x, n, first)
        first += len(indexes.of[d].centres)
        if len(indexes.of[d].centres) > 1:
            asked[d] = (sample.id.to_numpy()[:ASKED], x[:ASKED])
    shared = spark.sparkContext.broadcast(indexes)
    if not asked:
        return shared, {}
    measured = nodes.select("id", "vector").mapInPandas(_needed(shared, asked, cosine, reach), "length int, links long, found long, most double")
    measured = {r["length"]: r for r in measured.groupBy("length").agg(F.sum("links").alias("links"), F.sum("found").alias("found"), F.max("most").alias("most")).collect()}
    for d, r in measured.items():
        indexes.of[d].spreads = max(SPREADS, MARGIN * r["most"])
    shared.destroy()
    return spark.sparkContext.broadcast(indexes), measured


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Link all vectors (vec_id, embedding) with a cosine of at least cosine, whatever further columns say.

    Returns a row per row: vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable, itself included), kept (vec_id = component_id).

    Vectors that are null, empty, zero, or hold null or non-finite components, link with
    nothing; vectors of one length link among themselves. Equal vectors link with each other.
    Rows of one vec_id count as many times as they occur. A null vec_id links with nothing, has a
    null component and is kept. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    reach = float(np.sqrt(2 - 2 * cosine))
    rows = prepared(vectors)
    nodes, kind = distinct_vectors(rows)
    total = nodes.count()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    shared, _ = fitted(nodes, kind, cosine, reach)
    schema = "id long, n long, vector binary, own long, list long, codes binary, error double"
    placed = materialise(nodes.select("id", "n", "vector").mapInPandas(_place(shared, reach), schema))
    blocks = placed.groupBy("list").agg(F.ceil(F.count_if(F.col("own") == F.col("list")) / BLOCK).cast("int").alias("blocks"))
    dealt = placed.join(blocks.where("blocks > 0"), "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # pairs of blocks (i, j): j are members; i members of no later block, or any probes
    member = F.col("own") == F.col("list")
    as_left = F.when(member, F.expr("transform(sequence(block, blocks - 1), j -> struct(block as i, j as j))")).otherwise(F.expr("transform(sequence(0, blocks - 1), j -> struct(block as i, j as j))"))
    as_right = F.when(member, F.expr("transform(sequence(0, blocks - 1), i -> struct(i as i, block as j))"))
    where = F.array_distinct(F.concat(as_left, F.coalesce(as_right, F.expr("cast(array() as array<struct<i:int,j:int>>)"))))
    met = dealt.withColumn("at", F.explode(where)).select("id", "n", "vector", "own", "list", "codes", "error", "block", F.col("at.i").alias("i"), F.col("at.j").alias("j"))
    found = materialise(by_groups(met, ["list", "i", "j"], _compare(shared, cosine, reach), "id long, links long, a long, b long, is_edge boolean"))
    counts = found.where("not is_edge").groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.where("is_edge").select("a", "b"))
    of = nodes.select("h1", "h2", "id", "n").join(counts, "id", "left").join(labels, "id", "left")
    of = of.select(F.struct("h1", "h2").alias("hash"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "id").alias("found"))
    # unusable vectors stay out of the join, where they would meet in one task
    plain = rows.select("vec_id", "hash")
    none = [F.lit(None).cast("long").alias(c) for c in ("n_links", "found")]
    out = plain.where("hash is not null").join(of, "hash", "left").unionByName(plain.where("hash is null").select("*", *none))
    component = F.coalesce("found", "vec_id").alias("component_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
