"""Mixing sources to target weights (operator 5).

Documents get a hash-random key; within its source a document's place is the sum of the
sizes before it in key order, and a source is cut at its exact budget: whole epochs,
then the documents before the cut, then a part of the one document on it. The prefix sums
are distributed: sizes are summed by key range first (a map-side combined aggregate),
so only the one range of each source that holds the cut is ever sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialise

#: Words, as every mixing counts them.
WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"
CYCLE = (1.0, 2.0, 3.0)
MOST_EPOCHS = 3.0
#: About so many documents share a key range.
RANGE_ROWS = 4096
#: Tables with a row for each source are broadcast up to so many sources, else joined by shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: str = "text") -> F.Column:
    """Words of a text, 0 for null: each word with the white space around it becomes one character."""
    gap = "[\\\\x20\\\\x09-\\\\x0D]*"
    return F.expr(f"CASE WHEN {text} RLIKE '{WORD}' THEN length(regexp_replace({text}, '{gap}{WORD}{gap}', 'x')) ELSE 0 END").cast("long")


def first_words(text: F.Column, n: F.Column) -> F.Column:
    """The first n words of a text with the white space around them."""
    gap = "[\\x20\\x09-\\x0D]*"
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"{gap}[^\\x20\\x09-\\x0D]+{gap}"), F.lit(0)), F.lit(1), n.cast("int")), "")


def targets(sizes: list[tuple[str | None, int]], cycle: tuple[float, ...] = CYCLE, most: float = MOST_EPOCHS) -> dict[str | None, float]:
    """Words to take from each source: weighted shares of all words, none above most times its own.

    Sources by code point, null last, weigh as cycle repeats; what a full source can't take
    is shared again by weight among the others, until none is above.
    """
    order = sorted((s for s, _ in sizes if s is not None)) + [None] * any(s is None for s, _ in sizes)
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    own = dict(sizes)
    left, out, rest = set(order), {}, float(sum(own.values()))
    while left:
        share = rest / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * share > most * own[s]}
        if not full:
            out |= {s: weight[s] * share for s in left}
            break
        out |= {s: most * own[s] for s in full}
        rest -= sum(most * own[s] for s in full)
        left -= full
    return out


def mix(docs: DataFrame, cycle: tuple[float, ...] = CYCLE, most: float = MOST_EPOCHS, seed: int = 5, keep_text: bool = False) -> DataFrame:
    """How many words the mix takes of each document.

    Takes doc_id, text and source of docs. Returns a row per row: doc_id, size, source,
    source_size, target (its source's), taken (words, repeats counted), and with
    keep_text all columns of docs beside size, source_size, target and taken.

    A null text has size 0 and takes 0; null sources are one source, the last. Repeated
    rows are documents of their own; rows alike in key, doc_id and size may swap places,
    which leaves the result the same. An empty table gives an empty result. Sources
    are taken as configuration: one row of sums for each is sent to the driver.
    """
    spark = docs.sparkSession
    spot = F.xxhash64(F.lit(seed), "doc_id", "text")
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")] if keep_text else []
    rows = docs.select(*own, F.col("doc_id").alias("__doc"), word_count().alias("__size"), spot.alias("__key"), F.col("source").alias("__source"))
    slim = materialise(rows.drop("__row"))
    rows = rows if keep_text else slim
    by_source = slim.groupBy("__source").agg(F.sum("__size").alias("s"), F.count("*").alias("n")).collect()
    goal = targets([(r["__source"], r["s"]) for r in by_source], cycle, most)
    plan = []
    for r in by_source:
        size, budget = r["s"], int(goal[r["__source"]])
        epochs, rest = divmod(budget, size) if size else (0, 0)
        plan.append((r["__source"], size, goal[r["__source"]], epochs, rest, max(1, -(-r["n"] // RANGE_ROWS))))
    plan = spark.createDataFrame(plan, "src string, source_size long, target double, epochs long, rest long, ranges long")
    same = F.col("__source").eqNullSafe(F.col("src"))
    small = F.broadcast if len(by_source) <= BROADCAST_SOURCES else lambda x: x
    # key ranges: the top 32 bits of the key, as an unsigned number, dealt evenly over the source's ranges
    spread = F.shiftright(F.shiftrightunsigned("__key", 32) * F.col("ranges"), 32)
    put = lambda x: x.join(small(plan), same).withColumn("range", spread)
    sums = put(slim).groupBy("src", "range").agg(F.sum("__size").alias("s"), F.first("rest").alias("rest"))
    before = F.sum("s").over(W.partitionBy("src").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    cut = sums.withColumn("before", F.coalesce(before, F.lit(0))).where("before < rest and before + s >= rest").select(F.col("src").alias("cut_src"), F.col("range").alias("cut"), "before")
    cuts = spark.createDataFrame([tuple(r) for r in cut.collect()], "cut_src string, cut long, before long")
    placed = put(rows).join(small(cuts), F.col("src").eqNullSafe(F.col("cut_src")), "left")
    whole = F.when(F.col("range") < F.col("cut"), F.col("__size")).otherwise(F.lit(0))
    near = W.partitionBy("src").orderBy("__key", "__doc", "__size").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("__size").over(near), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("__size"), F.col("rest") - start))
    on_cut = F.col("cut").isNotNull() & (F.col("range") == F.col("cut"))
    out = placed.where(~F.coalesce(on_cut, F.lit(False))).withColumn("extra", whole).unionByName(placed.where(on_cut).withColumn("extra", part))
    own = [F.col("__row")] if keep_text else [F.col("__doc").alias("doc_id"), F.col("__source").alias("source")]
    return out.select(*own, F.col("__size").alias("size"), "source_size", "target", (F.col("epochs") * F.col("__size") + F.col("extra")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, cycle: tuple[float, ...] = CYCLE, most: float = MOST_EPOCHS, seed: int = 5) -> DataFrame:
    """The mixed corpus in the columns of docs: a row for each whole time that a document is taken, and the part of the one document on a source's cut.

    Null and blank texts have no words and are not taken. Null is a source of its own. Repeated rows are taken each for itself;
    columns may have any names; an empty table gives an empty result.
    """
    found = mix(docs, cycle, most, seed, keep_text=True)
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    copies = found.withColumn("__times", times).where("__times > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    left = F.col("taken") - (F.col("__i") - 1) * F.col("size")
    text = F.when(left >= F.col("size"), F.col("__row.text")).otherwise(first_words(F.col("__row.text"), left))
    return copies.select(*[(text.alias(c) if c == "text" else F.col("__row")[c].alias(c)) for c in docs.columns])
