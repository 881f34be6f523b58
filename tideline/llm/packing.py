"""Best-fit packing with bound-certified repacking (operator 9).

Documents become token pieces of at most the sequence length; partitions pack their pieces by
best-fit decreasing. A dual-feasible-function lower bound certifies a partition whose
bin count meets it; partitions with a gap give up their emptiest bins and those of most pieces, which are dealt to as many partitions as
they need, mixed anew, and packed again. That ends when every partition is certified, when one is left, or when
packing the pooled pieces again takes no fewer bins than they had; of the last two ways to pack them the better stays.
No task ever packs more than about twice PACK_ROWS pieces. The result says how many sequences there are and the
bound for all pieces together. Only piece lengths are packed; no text or token leaves the tokenizing task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, materialise

LENGTH = 2048
#: Pieces that one task packs at once: fewer than twice as many, about.
PACK_ROWS = 20_000
#: Bins that an uncertified partition gives up for each bin above its bound, and at least.
GIVEN, LEAST_GIVEN = 32, 64


# --- tokens ---------------------------------------------------------------------

_ENCODERS: dict[str, tuple] = {}


def encoder(path: str):
    """A function from text to token ids (uint32 array) as the tokenizers library gives them for a byte-level BPE file.

    The file's vocabulary and merges are run by tiktoken, which is several times
    faster and gives the same ids; where it fails, the library itself encodes. Special strings
    inside texts become their special tokens, as is the library's default.
    """
    if path not in _ENCODERS:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        slow = Tokenizer.from_file(path)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in printable)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        # Fixed value: the library's own byte-level pattern.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

        def run(text: str) -> np.ndarray:
            try:
                ids = fast.encode(text, allowed_special="all")
            except (KeyboardInterrupt, SystemExit):
                raise
            except BaseException:  # noqa: BLE001  the regex engine may give up on a text, or panic
                ids = slow.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype=np.uint32)

        _ENCODERS[path] = run
    return _ENCODERS[path]


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first of several may be shorter."""
    first = n % length or length
    if n <= length:
        return [(0, n)]
    return [(0, first), *((at, length) for at in range(first, n, length))]


PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = 0) -> DataFrame:
    """A row per piece of each document: the other columns of docs than text, then PIECES.

    A document is its token ids followed by the end id; null and empty texts are the end id alone.
    """
    at = docs.columns.index("text")
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*rest, *T._parse_datatype_string(PIECES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for b in batches:
            rows, out = [], []
            for i, t in enumerate(b.column(at)):
                ids = np.append(encode(t.as_py() or ""), np.uint32(end)).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), length)):
                    rows.append(i)
                    out.append((k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            kept = pa.array(rows, pa.int32())
            columns = [b.column(k).take(kept) for k in range(b.num_columns) if k != at]
            made = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made[0], pa.int32()), *(pa.array(x, pa.int64()) for x in made[1:])], schema=_arrow(schema))

    return bounded(docs).mapInArrow(run, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


# --- packing ----------------------------------------------------------------------


def lower_bound(lengths: np.ndarray, size: int = LENGTH) -> int:
    """A bin count that no packing can go under, by dual feasible functions.

    For each k the function rounds a length up to what it takes of k equal parts
    (f_k(x) = floor((k+1)x/size)/k unless (k+1)x/size is whole), and for each
    threshold e large pieces count as whole bins and pieces under e as nothing.
    """
    return lower_bound_of(*np.unique(lengths.astype(np.int64), return_counts=True), size)


def lower_bound_of(values: np.ndarray, counts: np.ndarray, size: int = LENGTH) -> int:
    """The same for distinct lengths and how many pieces have each."""
    if not len(values):
        return 0
    best = -(-int((values * counts).sum()) // size)
    for k in range(1, 40):
        whole = (k + 1) * values
        # k * f_k as whole numbers
        f = np.where(whole % size == 0, values * k, (whole // size) * size)
        best = max(best, -(-int((f * counts).sum()) // (k * size)))
    for e in np.unique(np.concatenate((values[values <= size // 2], size - values[values > size // 2] + 1))):
        if 0 < e <= size // 2:
            f = np.where(values > size - e, size, np.where(values >= e, values, 0))
            best = max(best, -(-int((f * counts).sum()) // size))
    return best


def best_fit(lengths: np.ndarray, size: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) of each piece, and how full each bin is. Ties keep the given order."""
    order = np.argsort(-lengths, kind="stable")
    where, offset, fill = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), []
    room: dict[int, list[int]] = {}  # bins by what is left in them
    rooms: list[int] = []
    for i in order:
        n = int(lengths[i])
        at = bisect_left(rooms, n)
        if at < len(rooms):
            left = rooms[at]
            bin_ = room[left].pop()
            if not room[left]:
                del room[left], rooms[at]
        else:
            left, bin_ = size, len(fill)
            fill.append(0)
        where[i], offset[i] = bin_, fill[bin_]
        fill[bin_] += n
        left -= n
        if left:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append(bin_)
    return where, offset, np.array(fill, dtype=np.int64)


PACKED = "piece_id long, length long, part long, bin long, offset long, settled boolean"


def _pack(size: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece_id", kind="stable")
        lengths = group.length.to_numpy()
        where, offset, fill = best_fit(lengths, size)
        settled = np.ones(len(fill), dtype=bool)
        gap = len(fill) - lower_bound(lengths, size)
        if gap > 0:
            # not certified: the emptiest bins and those of most pieces go back, in proportion to the gap, so that pools stay small
            some = max(LEAST_GIVEN, GIVEN * gap) // 2
            settled[np.argsort(fill, kind="stable")[:some]] = False
            settled[np.argsort(-np.bincount(where, minlength=len(fill)), kind="stable")[:some]] = False
        return pd.DataFrame({"piece_id": group.piece_id, "length": lengths, "part": key[0], "bin": where, "offset": offset, "settled": settled[where]})

    return run


def pack(items: DataFrame, size: int = LENGTH, pack_rows: int = PACK_ROWS) -> tuple[DataFrame, int]:
    """Pack items (piece_id, length) into bins: (piece_id, sequence_id, offset), and the number of bins.

    Every piece gets a place; offsets in a bin are gapless from 0. Lengths are 1 to size.
    """
    place = lambda k: F.lit(k << 48).cast("long") + F.col("part") * (1 << 24) + F.col("bin")  # noqa: E731  rounds have ranges of their own: part and bin are below 2**24
    placed = lambda rows, k: rows.select("piece_id", place(k).alias("sequence_id"), "offset")
    full = items.where(F.col("length") == size).select("piece_id", (-1 - F.col("piece_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_ = items.where(F.col("length") < size).select("piece_id", "length")
    n, round_, done, bins, given, before = open_.count(), 0, [full], full.count(), None, None
    while n:
        parts = max(1, n // pack_rows)
        dealt = open_.withColumn("part", F.pmod(F.xxhash64(F.lit(round_), "piece_id"), F.lit(parts)))
        packed = materialise(dealt.groupBy("part").applyInPandas(_pack(size), PACKED))
        first = F.col("offset") == 0  # one piece of each bin
        used, left, n = packed.agg(F.count_if(first), F.count_if(first & ~F.col("settled")), F.count_if(~F.col("settled"))).first()
        if given is not None and used > given:
            done.append(placed(before.where("not settled"), round_ - 1))
            bins += given
            break
        if parts == 1 or given is not None and used == given:
            done.append(placed(packed, round_))
            bins += used
            break
        done.append(placed(packed.where("settled"), round_))
        bins += used - left
        open_, given, before, round_ = packed.where("not settled").select("piece_id", "length"), left, packed, round_ + 1
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out, bins


def pack_documents(docs: DataFrame, tokenizer: str, size: int = LENGTH, pack_rows: int = PACK_ROWS) -> DataFrame:
    """Pack whole documents into sequences of at most size tokens.

    Takes doc_id and text of docs. Returns a row per piece: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset, and, alike in all rows, n_sequences and least_sequences, which no packing of these pieces
    can go under. Null and empty texts are one end token. Repeated rows and null
    doc_ids are documents of their own. An empty table gives an empty result.
    """
    made = pieces(docs.select("doc_id", "text"), tokenizer, size).withColumn("piece_id", F.monotonically_increasing_id())
    made = materialise(made)
    lengths = made.groupBy("length").count().toPandas()  # at most size rows
    least = lower_bound_of(lengths["length"].to_numpy(dtype=np.int64), lengths["count"].to_numpy(dtype=np.int64), size)
    places, bins = pack(made.select("piece_id", "length"), size, pack_rows)
    certificate = [F.lit(x).cast("long").alias(c) for c, x in (("n_sequences", bins), ("least_sequences", least))]
    return made.join(places, "piece_id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *certificate)
