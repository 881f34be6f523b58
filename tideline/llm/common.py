"""Shared pieces of the corpus operators: materialising, word hashing, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as every contract here splits words: space and \t \n \v \f \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where it is unset and Spark runs in one process (tests), a local one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Folders of tables written and not yet deleted.
_WRITTEN: list[str] = []


def materialise(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write df once to the shared folder and read it back: lineage is cut, and a lost executor loses nothing.

    Parquet keeps it columnar, so later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tideline-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    spark.sparkContext._jvm.System.gc()  # lets Spark's cleaner delete the shuffle files of what has been written
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN.append(path)
    out._tideline_path = path
    return out


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(df: DataFrame) -> None:
    """Delete a table that materialise has written and nothing reads any more."""
    _WRITTEN.remove(df._tideline_path)
    _delete(df.sparkSession, df._tideline_path)


def written() -> frozenset[str]:
    """Folders of the tables that materialise has written in this process and that are still there."""
    return frozenset(_WRITTEN)


def release(spark: SparkSession, but: DataFrame | None = None, earlier: frozenset[str] = frozenset()) -> None:
    """Delete the tables that materialise has written in this process, all but one and those written earlier, if given; call it when results that read them are done with."""
    kept = getattr(but, "_tideline_path", None)
    for path in list(_WRITTEN):
        if path != kept and path not in earlier:
            _WRITTEN.remove(path)
            _delete(spark, path)


#: Rows and bytes of a batch that goes to Python: texts are long, and a worker holds a few batches at a time.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """df, after making sure that its session hands Python batches of bounded size."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).lower().rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = bounded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return df.select(*columns) if columns else df


# --- words and shingles, vectorised over a batch of texts -------------------

_B = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 1 << 20
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
_BINV = np.uint64(pow(int(_B), -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base, and of its inverse modulo 2**64, up to n."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_B, _BINV)):
            p = np.full(2 * n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    gap = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a byte array, A-Z lower-cased, in order.

    A polynomial hash over random byte weights from prefix sums modulo 2**64: no
    Python object is made for a word. Long arrays go in pieces cut at white space.
    """
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    if len(data) > _PIECE:
        at = np.flatnonzero(SPACE[data])
        cuts = at[np.unique(np.minimum(np.searchsorted(at, np.arange(_PIECE, len(data), _PIECE)), max(len(at) - 1, 0)))] if len(at) else []
        if len(cuts):
            return np.concatenate([_word_hashes(x) for x in np.split(data, cuts)])
    return _word_hashes(data)


def _word_hashes(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    data = _LOWER[data]
    start, end = word_spans(data)
    up, down = _powers(len(data) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)))
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Distinct hashes of the k-word shingles, sorted; fewer words make one shingle of all; none make none."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, k)
    h = np.zeros(n - size + 1, dtype=np.uint64)
    for j in range(size):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[j : n - size + 1 + j]
    return np.unique(mix64(h + np.uint64(size)))


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


# --- connected components ----------------------------------------------------


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component_id) of every node of edges (a, b): the smallest id reachable.

    Alternating large-star and small-star rounds; each is a shuffle whose groups are
    only aggregated (a minimum), never gathered, so a star of a million leaves is no
    hot task. Each round is written to the shared folder. Ends when a round changes nothing.
    """
    links = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    links = materialise(links)
    before, n = None, links.count()
    for _ in range(rounds):
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(unless_large(least, n), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        kept = large.where("hi <> lo").distinct()
        least = kept.groupBy("hi").agg(F.min("lo").alias("m"))
        shorter = kept.join(unless_large(least, n), "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(least.select("hi", F.col("m").alias("lo")))
        links = materialise(shorter.where("hi <> lo").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before, n = tuple(now), now[0]
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.groupBy("hi").agg(F.min("lo").alias("component_id")).withColumnRenamed("hi", "id")


# --- groups without a call for each ------------------------------------------


def in_groups(batches, keys: list[str]):
    """(key, rows) of each run of equal keys in batches that are sorted by them."""
    rest = None
    for b in batches:
        if rest is not None and len(rest):
            b = pd.concat([rest, b], ignore_index=True)
        if not len(b):
            continue
        edge = np.zeros(len(b), dtype=bool)
        for k in keys:
            v = b[k].to_numpy()
            edge[1:] |= v[1:] != v[:-1]
        starts = np.concatenate(([0], np.flatnonzero(edge)))
        for i, j in zip(starts[:-1], starts[1:], strict=True):
            yield tuple(b[k].iloc[i] for k in keys), b.iloc[i:j]
        rest = b.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield tuple(rest[k].iloc[0] for k in keys), rest


def arrow_groups(batches, keys: list[str]):
    """(key, rows) of each run of equal keys in Arrow batches that are sorted by them; a group's rows become a pandas table once, not with every batch."""
    key, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        values = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        edges = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        for i, j in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows], strict=True):
            now = tuple(v[i] for v in values)
            if held and now != key:
                yield key, pa.Table.from_batches(held).to_pandas()
                held = []
            key = now
            held.append(b.slice(i, j - i))
    if held:
        yield key, pa.Table.from_batches(held).to_pandas()


def by_groups(df: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    """run(key, rows) for each group of df, where groups are many and small.

    Groups are dealt by hash and sorted, and a task goes through its groups batch by batch,
    which costs a fraction of a grouped-map call for each group.
    """

    def through(batches):
        for key, rows in in_groups(batches, keys):
            out = run(key, rows)
            if out is not None and len(out):
                yield out

    return bounded(df).repartition(*keys).sortWithinPartitions(*keys).mapInPandas(through, schema)


#: Tables of numbers with up to so many rows (some MB) are broadcast; above, joins shuffle.
BROADCAST_ROWS = 500_000
#: Bytes of a broadcast table whose rows differ in size.
BROADCAST_BYTES = 64 << 20


#: Rows of a table of numbers, or of one with sketches beside them, above which Spark's own choice of a join is not trusted.
NARROW_ROWS, WIDE_ROWS = 200_000, 20_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has at most so many rows, else for a sort-merge join. df must be materialised and narrow."""
    return F.broadcast(df) if df.count() <= rows else df.hint("merge")


def unless_large(df: DataFrame, rows: int, most: int = NARROW_ROWS) -> DataFrame:
    """df, marked for a sort-merge join if more than so many rows stand behind it, else as it is.

    Spark sizes what is read from Parquet by its compressed bytes: sketches of near copies shrink to a hundredth in
    the file, so that hundreds of MB pass for a table under the broadcast threshold.
    """
    return df.hint("merge") if rows > most else df
