"""Exact top-k search over binary codes by incremental multi-index hashing (operator 4).

A code of 64 bits is cut into segments, each an index. Codes within distance r of a query agree
with it, in some segment, up to floor(r / segments) bits: so a query that has probed all
segments to radius s has met every code within segments * (s + 1) - 1. Radii grow
until a query's kth verified distance is within that bound; only then is it settled. With the radius at a segment's
width every code has been met, so no other way is needed for queries far from all codes.

The codes are dealt into blocks of bounded size, each of which is indexed by itself; the stated
queries meet every block, in chunks, and the blocks' best are merged.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import by_groups, materialise

K = 10
BITS = 64
#: Distinct codes of a block, queries of a chunk, and queries that probe at once.
BLOCK, CHUNK, TOGETHER = 65_536, 4_096, 32


def sign_code(vector: str) -> F.Column:
    """64-bit code of the signs of the first 64 components: bit i is set if component i is over 0; null if one is null, NaN or missing."""
    bits = " | ".join(f"if({vector}[{i}] > 0, shiftleft(1L, {i}), 0L)" for i in range(BITS))
    whole = F.col(vector).isNotNull() & (F.size(vector) >= BITS) & ~F.exists(F.slice(vector, 1, BITS), lambda x: x.isNull() | F.isnan(x))
    return F.when(whole, F.expr(bits))


class Block:
    """Segment indexes of distinct codes. About as many codes as segment values, so that a bucket holds about one."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.segments = int(np.clip(round(BITS / np.log2(max(len(codes), 2))), 4, 16))
        edges = np.linspace(0, BITS, self.segments + 1).astype(int)
        self.shifts, self.widths = edges[:-1], np.diff(edges)
        self.order, self.starts = [], []
        for s in range(self.segments):
            v = self.part(codes, s)
            self.order.append(np.argsort(v, kind="stable"))
            self.starts.append(np.concatenate(([0], np.cumsum(np.bincount(v, minlength=1 << self.widths[s])))))

    def part(self, codes: np.ndarray, s: int) -> np.ndarray:
        return ((codes >> np.uint64(self.shifts[s])) & np.uint64((1 << int(self.widths[s])) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) positions of each query's k nearest codes, with all that tie with the kth."""
        found = [self._some(queries[i : i + TOGETHER], k, i) for i in range(0, len(queries), TOGETHER)]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _some(self, queries: np.ndarray, k: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, k = len(self.codes), min(k, len(self.codes))
        left, met = np.arange(len(queries)), np.zeros((len(queries), BITS + 1), dtype=np.int64)
        out = []
        for radius in range(int(self.widths.max()) + 1):
            for s in range(self.segments):
                masks = np.array([sum(1 << b for b in at) for at in combinations(range(int(self.widths[s])), radius)], dtype=np.int64)
                value = self.part(queries[left], s)[:, None] ^ masks
                low, high = self.starts[s][value], self.starts[s][value + 1]
                size = (high - low).ravel()
                at = np.repeat(low.ravel() - (np.cumsum(size) - size), size) + np.arange(size.sum())
                q, c = np.repeat(np.repeat(left, len(masks)), size), self.order[s][at]
                differ = queries[q] ^ self.codes[c]
                # a code that a query meets in several segments or radii is taken at the first
                new = np.ones(len(q), dtype=bool)
                for t in range(self.segments):
                    if t != s:
                        near = np.bitwise_count(self.part(differ, t))
                        new &= near > radius if t < s else near >= radius
                q, c, d = q[new], c[new], np.bitwise_count(differ[new]).astype(np.int64)
                np.add.at(met, (q, d), 1)
                out.append((q, c, d))
            bound = self.segments * (radius + 1) - 1
            left = left[met[left, : bound + 1].sum(1) < k]
            if not len(left):
                break
        q, c, d = (np.concatenate(x) for x in zip(*out, strict=True))
        last = (np.cumsum(met, 1) >= k).argmax(1)
        keep = d <= last[q]
        return q[keep] + first, c[keep], d[keep]


def _best(k: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame | None:
        asked, codes = group[group.asks], group[~group.asks]
        if not len(asked) or not len(codes):
            return None
        q, c, d = Block(codes.code.to_numpy().astype(np.uint64)).search(asked.code.to_numpy().astype(np.uint64), k + 1)
        ids = codes.ids.to_numpy()
        size = np.array([len(x) for x in ids])[c]
        out = pd.DataFrame({"query_id": np.repeat(asked.id.to_numpy()[q], size), "id": np.concatenate(ids[c]) if len(c) else [], "distance": np.repeat(d, size)})
        out = out[out.query_id != out.id].sort_values(["query_id", "distance", "id"])
        return out[out.groupby("query_id").cumcount() < k].astype("int64")

    return run


def top_k(base: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The k nearest rows of base (id, code) for each query (id, code), by (Hamming distance, id), the query's own id left out.

    Returns query_id, rank (from 1), id, distance: fewer than k rows a query if base has fewer others.
    Null codes and ids are no rows and no queries. Rows of one id and code are one; an id
    with several codes queries by the least. Ties go to the smaller id. Empty tables give an empty result.

    Of rows with one code only the k + 1 smallest ids can be among a query's k, so a code
    is indexed once, however many rows share it.
    """
    base = base.where("id is not null and code is not null").select("id", "code").distinct()
    salted = base.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(256)))
    few = salted.withColumn("r", F.row_number().over(W.partitionBy("code", "salt").orderBy("id"))).where(F.col("r") <= k + 1)
    codes = materialise(few.groupBy("code").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids")))
    asked = materialise(queries.where("id is not null and code is not null").groupBy("id").agg(F.min("code").alias("code")))
    blocks, chunks = max(1, -(-codes.count() // BLOCK)), max(1, -(-asked.count() // CHUNK))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = codes.select(F.lit(False).alias("asks"), F.lit(None).cast("long").alias("id"), "code", "ids", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int").alias("block"), each(chunks).alias("chunk"))
    right = asked.select(F.lit(True).alias("asks"), F.col("id").cast("long"), "code", F.lit(None).cast("array<bigint>").alias("ids"), F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), each(blocks).alias("block"))
    met = by_groups(left.unionByName(right), ["block", "chunk"], _best(k), "query_id long, id long, distance long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("long").alias("rank"), "id", "distance")
