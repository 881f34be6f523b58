"""Line dedup by a segment-partition edit join (operator 8), in DataFrame functions only.

Equal lines meet by a 128-bit hash. Distinct lines within an edit distance meet by
pigeonhole: a line is split into threshold + 1 segments, of which a line within the
threshold holds one unchanged, at a place that its length bounds. Each line is indexed by its
segments and length, and probes the substrings that may equal a segment of a
line as long or shorter. Met pairs are verified by a banded bit-parallel edit distance: the band about the diagonal is
held as bits of a number, which a fold over the characters moves on. Only hashes are
shuffled; a line's text moves only if it has met another.

A line goes if any earlier one is near. So of a segment that many lines have, all are held against the earliest few
first; only lines that are then still without an earlier near one meet the rest, in salted parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import BROADCAST_BYTES, materialise, small

#: Lines are near within so many edits, and if edits are at most this share of the longer line's characters.
EDITS, SHARE = 2, 0.25
#: A segment key of more lines than this is hot: all its lines meet its FIRST earliest ones before others, and pairs must also agree in
#: their counts of LETTERS and in the set of their pairs of letters, hashed to 256 bits. Lines of a salted part of a hot key.
HOT_LINES, FIRST, PART, LETTERS = 16, 8, 1024, "etaoinshrdlcum0123456789"
#: Hot lines whose counts and bits are broadcast at most.
KNOWN = 100_000


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(segment, characters fewer, shift) of the substrings that a line probes, by characters fewer; the first edits + 1 are its own segments.

    In a line with d characters fewer, segment i lies at most i characters from where this
    line's split puts it, and at most edits - i from that place shifted by d.
    """
    found = [(i, d, s) for d in range(edits + 1) for i in range(edits + 1) for s in range(max(-i, d - (edits - i)), min(i, d + (edits - i)) + 1)]
    return sorted(found, key=lambda x: (x[1], x[1] != 0 or x[2] != 0, x))


def segment_keys(line: str, n: str, edits: int) -> F.Column:
    """Keys of all probes of a line, null where a substring would leave it.

    A line of m characters is split evenly into edits + 1 segments, longer ones last; the key
    of a segment is a hash of m, its number and its characters. Lines of at least edits characters.
    """
    parts, found = edits + 1, []
    for i, d, s in probes(edits):
        # a shorter line's length is split into q characters a segment and r left over, which its last r segments get
        start = f"x.q{d} * {i} + {s}" if i else f"{s}"
        start += f" + greatest(0, x.r{d} - {parts - i})" if i > 1 else ""
        size = f"x.q{d} + if(x.r{d} >= {parts - i}, 1, 0)" if i else f"x.q{d}"
        key = f"xxhash64(x.tag + {i - parts * d}L, substring({line}, {start} + 1, {size}))"
        inside = [f"{start} >= 0"] * (s < 0) + [f"{start} + {size} <= {n}"] * (s > d)
        found.append(f"if({' and '.join(inside)}, {key}, null)" if inside else key)
    # as the body of a lambda it is interpreted: generated code of so many keys is too long to be compiled to machine code
    split = [f"'q{d}', cast(({n} - {d}) div {parts} as int), 'r{d}', cast(({n} - {d}) % {parts} as int)" for d in range(edits + 1)]
    return F.expr(f"transform(array(named_struct({', '.join(split)}, 'tag', cast({n} as bigint) * {parts})), x -> array({', '.join(found)}))[0]")


def letters(line: str) -> F.Column:
    """Counts of common letters (modulo 256), eight to a number."""
    counts = [F.length(line) - F.length(F.replace(F.col(line), F.lit(c), F.lit(""))) for c in LETTERS]
    packed = []
    for at in range(0, len(counts), 7):
        total = F.lit(0).cast("long")
        for k, n in enumerate(counts[at : at + 7]):
            total = total + F.shiftleft(n.cast("long").bitwiseAND(255), 8 * k)
        packed.append(total)
    return F.array(*packed)


def letters_apart(a: str, b: str) -> F.Column:
    """Least number by which the letter counts of two lines differ; an edit changes it by at most 2."""
    total = F.lit(0)
    for k in range(len(LETTERS)):
        x, y = (F.shiftright(F.col(c)[k // 7], 8 * (k % 7)).bitwiseAND(255) for c in (a, b))
        d = F.abs(x - y)
        total = total + F.least(d, 256 - d)
    return total


def neighbours(line: str) -> F.Column:
    """The set of a line's pairs of neighbouring characters, as 256 hashed bits in four numbers."""
    word = "aggregate(sequence(0, size(x) - 2), 0L, (s, i) -> s | if((xxhash64(x[i], x[i + 1]) & 192) = {w}, shiftleft(1L, cast(xxhash64(x[i], x[i + 1]) & 63 as int)), 0L))"
    words = ", ".join(word.format(w=64 * w) for w in range(4))
    return F.expr(f"if(length({line}) < 2, array(0L, 0L, 0L, 0L), transform(array(split({line}, '')), x -> array({words}))[0])")


def neighbours_apart(a: str, b: str) -> F.Column:
    """Number of bits in which two such sets differ; an edit changes it by at most 4: two pairs go and two come."""
    return sum((F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w])) for w in range(4)), F.lit(0))


#: Characters of a pair of lines, from where they first differ, that are held against each other before the rest.
AHEAD = 40


def distance(a: str, b: str, edits: int) -> F.Column:
    """Edit distance of a line a and a line b as long or up to edits shorter, if it is at most edits, else some larger number; a has edits characters at least.

    Bit-parallel: after each character of b, bit j of vp and vn says whether the table's value grows or falls by one from
    the row above to row i + 1 - edits + j, within the band of 2 * edits + 1 rows about the diagonal. The value is followed along
    the band's lowest diagonal until that reaches the end of a, then along a's last row. What both lines begin with is left
    out, found by halving; and a pair whose whole band is beyond edits after AHEAD characters is followed no further.
    """
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    match = " | ".join(f"if(get(x, i + {d}) = c, {1 << (d + edits)}, 0)" for d in range(-edits, edits + 1))
    hp = f"((s.vn | ~(d0 | s.vp)) & {full})"
    row = f"shiftleft(1, {width - 2} - (i - (size(x) - {edits})))"
    on_row = f"if(({hp} & {row}) != 0, 1, 0) - if((d0 & s.vp & {row}) != 0, 1, 0)"
    grown = f"s.d + if(i < size(x) - {edits}, if((d0 & {top}) = 0, 1, 0), {on_row})"
    after = f"named_struct('vp', ((d0 & s.vp) | ~(shiftright(d0, 1) | {hp})) & {full}, 'vn', shiftright(d0, 1) & {hp}, 'd', {grown})"
    bind = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    d0 = f"((((m & s.vp) + s.vp) ^ s.vp) | m | s.vn) & {full}"
    step = bind("y[i]", "c", bind(match, "m", bind(d0, "d0", after)))
    start = f"named_struct('vp', {full & ~((1 << edits) - 1)}, 'vn', 0, 'd', {edits})"
    fold = lambda last, end: f"aggregate(sequence(0, {last}), {start}, (s, i) -> {step}, s -> {end})"
    # the values of a column from the lowest row of the band upwards
    values = ["s.d"]
    for j in range(width - 2, -1, -1):
        values.append(f"{values[-1]} - (shiftright(s.vp, {j}) & 1) + (shiftright(s.vn, {j}) & 1)")
    near = fold(AHEAD - 1, f"least({', '.join(values)})") + f" <= {edits}"
    whole = f"if(size(x) <= {AHEAD + edits} or size(y) <= {AHEAD} or {near}, {fold('size(y) - 1', 's.d')}, {edits + 1})"
    halves = ", ".join(str(1 << k) for k in range(24, -1, -1))
    alike = f"aggregate(array({halves}), 0, (p, h) -> if(p + h <= length({b}) and substring({a}, 1, p + h) = substring({b}, 1, p + h), p + h, p))"
    body = bind(f"split(substring({a}, q + 1), '')", "x", bind(f"split(substring({b}, q + 1), '')", "y", whole))
    return F.expr(bind(f"greatest(0, {alike} - {edits})", "q", body))


def meetings(lines: DataFrame, edits: int) -> tuple[DataFrame, DataFrame]:
    """What lines (line_id, keys) are indexed by (key, b), and what they probe (key, a, longer): a is no shorter than b, and longer says that it is not as long."""
    same = sum(1 for _, d, _ in probes(edits) if d == 0)
    index = lines.select(F.explode(F.slice("keys", 1, edits + 1)).alias("key"), F.col("line_id").alias("b"))
    probe = lines.select(F.posexplode("keys").alias("p", "key"), F.col("line_id").alias("a")).where("key is not null")
    return index, probe.select("key", "a", (F.col("p") >= same).alias("longer"))


def near_lines(lines: DataFrame, edits: int, share: float, text) -> DataFrame:
    """(line_id) of the lines that have an earlier near one; lines: line_id, keys, first. text gives (line_id, line) for a frame of line_ids."""
    firsts = lines.select("line_id", "first")
    index, probe = meetings(lines, edits)
    once = F.col("longer") | (F.col("a") > F.col("b"))  # of two as long, both probe

    def later(pairs: DataFrame) -> DataFrame:
        """The later one of each pair that is near."""
        pairs = materialise(pairs)
        said = materialise(text(pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct()))
        both = pairs.join(said.select(F.col("line_id").alias("a"), F.col("line").alias("la")), "a").join(said.select(F.col("line_id").alias("b"), F.col("line").alias("lb")), "b")
        most = F.least(F.lit(edits), F.floor(F.length("la") * share))
        near = both.where(distance("la", "lb", edits) <= most).withColumn("pair", F.monotonically_increasing_id())
        ends = materialise(near.select("pair", F.explode(F.array("a", "b")).alias("line_id")))
        return ends.join(firsts, "line_id").groupBy("pair").agg(F.max(F.struct("first", "line_id")).alias("l")).select(F.col("l.line_id").alias("line_id")).distinct()

    hot = materialise(index.groupBy("key").count().where(F.col("count") > HOT_LINES).select("key", F.ceil(F.col("count") / PART).cast("int").alias("parts")))
    if not hot.limit(1).count():
        return materialise(later(probe.join(index.hint("shuffle_hash"), "key").where(once).select("a", "b").distinct()))
    hot = small(hot)
    met = probe.join(index.join(hot, "key", "left_anti").hint("shuffle_hash"), "key").where(once).select("a", "b")
    probe, index = materialise(probe.join(hot, "key")), materialise(index.join(hot, "key"))
    some = materialise(probe.select(F.col("a").alias("line_id")).unionByName(index.select(F.col("b").alias("line_id"))).distinct())
    known = materialise(text(some).select("line_id", letters("line").alias("letters"), neighbours("line").alias("pairs")).join(firsts, "line_id"))
    few = small(known, KNOWN)
    side = lambda x: few.select(F.col("line_id").alias(x), F.col("letters").alias(f"l{x}"), F.col("pairs").alias(f"p{x}"), F.col("first").alias(f"f{x}"))
    probe, index = probe.join(side("a"), "a"), index.join(side("b"), "b")
    alike = (neighbours_apart("pa", "pb") <= 4 * edits) & (letters_apart("la", "lb") <= 2 * edits)
    earliest = lambda x, c: x.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy(c))).where(F.col("r") <= FIRST).drop("r")
    star = probe.join(earliest(index, "fb").drop("parts"), "key").where((F.col("a") != F.col("b")) & alike).select("a", "b")
    star = star.unionByName(earliest(probe, "fa").drop("parts").join(index, "key").where((F.col("a") != F.col("b")) & alike).select("a", "b"))
    found = materialise(later(met.unionByName(star).distinct()))

    # the rest of the hot keys, for lines that are still without an earlier near one
    done = lambda x: small(found).select(F.col("line_id").alias(x), F.lit(True).alias(f"d{x}"))
    probe, index = probe.join(done("a"), "a", "left"), index.join(done("b"), "b", "left")
    probe = probe.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    index = index.withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).drop("parts")
    open_ = F.when(F.col("fa") > F.col("fb"), F.col("da").isNull()).otherwise(F.col("db").isNull())
    rest = probe.join(index, ["key", "salt"]).where(once & open_ & alike).select("a", "b").distinct()
    return found.unionByName(materialise(later(rest))).distinct()


def split_lines(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(d, t, pos, line, h1, h2) of every line of min_chars or more."""
    lines = docs.where("text is not null").select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
    lines = lines.select("d", "t", "pos", F.trim("raw").alias("line")).where(F.length("line") >= min_chars)
    return lines.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit("second"), "line")})


def dedup_lines(docs: DataFrame, edits: int = EDITS, share: float = SHARE, min_chars: int = 1) -> DataFrame:
    """Remove lines that repeat an earlier line of the corpus, exactly or within an edit distance.

    Lines end at line feeds and compare without surrounding blanks. Earlier is by
    (doc_id, hash of the text, line number); nulls come first. A line of min_chars or more (blank ones never) goes if an equal
    one is earlier, or one within edits that are at most share of the longer one's characters: with two edits and a quarter, one
    edit counts from 4 characters on and two from 8 (whether or not the earlier line itself stays). share must not let
    lines of fewer than edits + 1 characters be near others: they can't be split into as many segments.

    Returns docs with the cleaned text, and n_lines, n_repeated, n_near. Null and empty
    texts stay as they are, with 0 and 1 lines. Rows alike in doc_id and text are one
    document. Other columns pass through, whatever their names; the three replace columns of their names.
    An empty table gives an empty result.
    """
    if share * (edits + 2) > 1:
        raise ValueError("share allows edits to lines that can't be split into edits + 1 segments")
    slim = docs.select("doc_id", "text")
    lines = split_lines(slim, min_chars)
    place = F.struct("d", "t", "pos")
    keyed = lines.withColumn("n", F.length("line")).withColumn("keys", F.when((F.col("n") + 1) * share >= 1, segment_keys("line", "n", edits)))
    distinct = keyed.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("keys").alias("keys"))
    distinct = distinct.select("h1", "h2", "first", (F.col("first") != F.col("last")).alias("repeats"), "keys")
    distinct = materialise(distinct.withColumn("line_id", F.monotonically_increasing_id()))

    def text(ids: DataFrame) -> DataFrame:
        """(line_id, line) of some distinct lines, read again from the documents that first hold them."""
        wanted = small(materialise(distinct.select("line_id", "h1", "h2", "first").join(ids, "line_id")))
        hold = small(materialise(wanted.select("first.d", "first.t").distinct()))
        holding = slim.join(hold, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("t")), "left_semi")
        found = split_lines(holding, min_chars).join(wanted, ["h1", "h2"]).where(F.col("first") == place)
        return found.groupBy("line_id").agg(F.first("line").alias("line"))

    later = near_lines(distinct.where("keys is not null").select("line_id", "keys", "first"), edits, share, text)
    gone = distinct.select("line_id", "h1", "h2", "first", "repeats").join(later.withColumn("near", F.lit(True)), "line_id", "left").where("repeats or near")
    gone = gone.select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    rows = lines.select("d", "t", "pos", "h1", "h2").join(gone, ["h1", "h2"])
    again = F.col("first") != F.struct("d", "t", "pos")
    dropped = rows.where(again | F.col("near")).groupBy("d", "t").agg(F.collect_set("pos").alias("dropped"), F.count_if(again).alias("rep"), F.count_if(~again).alias("nea"))
    dropped = materialise(dropped)
    # a row for each document that loses lines, of some 48 bytes and 4 a line
    size = dropped.agg(F.count("*") * 48 + F.coalesce(F.sum(F.size("dropped")), F.lit(0)) * 4).first()[0]
    if size <= BROADCAST_BYTES:
        dropped = F.broadcast(dropped)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = docs.select(row, "doc_id", "text", F.xxhash64("text").alias("hash")).join(dropped, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("t")), "left")
    out = out.withColumn("parts", F.when(F.col("dropped").isNotNull(), F.split("text", "\n", -1)))
    keep = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("dropped"))
    body = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(F.transform(keep, lambda i: F.col("parts")[i]), "\n"))
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    added = {"n_lines": F.coalesce(breaks + 1, F.lit(0)), "n_repeated": F.coalesce("rep", F.lit(0)), "n_near": F.coalesce("nea", F.lit(0))}
    kept = [body.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in added]
    return out.select(*kept, *[x.cast("long").alias(c) for c, x in added.items()])


def clean(docs: DataFrame) -> DataFrame:
    """docs with repeated lines removed, in its columns; documents of which nothing but blanks is left by that go.

    Null, empty and blank texts stay. Of rows alike in doc_id and text each keeps what the one document keeps. An empty
    table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    found = dedup_lines(docs.select("doc_id", "text", row))
    bare = (F.col("n_repeated") + F.col("n_near") > 0) & ~F.col("text").rlike("\\S")
    kept = [F.col("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns]
    return found.where(~F.coalesce(bare, F.lit(False))).select(*kept)
