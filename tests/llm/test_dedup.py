"""Near-duplicate documents, lines and embeddings against brute force."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import common, embed_dup, line_dedup, near_dup


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def word_set(text, k=5):
    w = (text or "").encode().lower().split()
    return set(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else ({tuple(w)} if w else set())


def test_near_duplicates_equal_brute_force(corpus):
    rows = corpus.select("doc_id", "text").collect()
    sets = {r.doc_id: word_set(r.text) for r in rows if r.doc_id is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = classes(ids, links)
    got = near_dup.near_duplicates(corpus).collect()
    assert len(got) == len(rows) and len({want[i] for i in range(100, 112)}) == 1
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept, r.n_shingles) == (want[r.doc_id], want[r.doc_id] == r.doc_id, len(sets[r.doc_id]))
    with pytest.raises(ValueError, match="75 percent"):
        near_dup.near_duplicates(corpus, percent=60)
    kept = near_dup.keep_one(corpus)
    assert kept.columns == corpus.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in got if r.kept}


def test_unsettled_buckets_are_compared_in_full(spark):
    """A chain: neighbours link, its ends do not, so stars about the smallest id do not reach all."""
    words = [f"w{i}" for i in range(500)]
    rows = [(i, " ".join(words[14 * i : 14 * i + 120])) for i in range(25)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: word_set(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a > b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert links and got == classes(list(sets), links)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert near_dup.near_duplicates(docs).count() == 0 and near_dup.keep_one(docs).count() == 0
    assert line_dedup.dedup_lines(docs).count() == 0 and line_dedup.clean(docs).columns == docs.columns
    assert embed_dup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tables_are_released(spark, tmp_path):
    import os

    df = common.materialise(spark.range(3))
    path = common._WRITTEN[-1].removeprefix("file://")
    assert df.count() == 3 and os.path.exists(path)
    common.release(spark)
    assert not os.path.exists(path)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    a, b, c = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (900, 300, 300))
    x, y, both = near_dup.registers([np.union1d(a, b), np.union1d(a, c), np.union1d(np.union1d(a, b), c)])
    assert (np.maximum(x, y) == both).all()
    n = np.array([1200.0])
    more, less = np.array([(x > y).sum()]), np.array([(x < y).sum()])
    found = near_dup.estimate(more, less, near_dup.REGISTERS - more - less, n, n)[0]
    assert abs(found - 900 / 1500) < 0.2


def test_hashes_do_not_depend_on_pieces():
    text = (" ".join(f"word{i % 977}" for i in range(30_000)) + "\tA b").encode()
    data = np.frombuffer(text, dtype=np.uint8)
    whole = common._word_hashes(data)
    common._PIECE, kept = 1000, common._PIECE
    try:
        assert (common.word_hashes(data) == whole).all()
    finally:
        common._PIECE = kept
    assert len(set(whole.tolist())) == 979 and len(whole) == 30_002
    assert common.word_hashes(np.frombuffer(b"AbC", dtype=np.uint8)) == common.word_hashes(np.frombuffer(b" aBc\n", dtype=np.uint8))


# --- lines ---


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_rules(rows, edits=2):
    """{(doc_id, line number)} to drop, for rows with distinct (doc_id, text)."""
    lines = [(d, p, line.strip(" ")) for d, t in rows if t is not None for p, line in enumerate(t.split("\n"))]
    lines = sorted((d, p, x) for d, p, x in lines if x)
    gone = set()
    for i, (d, p, x) in enumerate(lines):
        for _, _, y in lines[:i]:
            most = min(edits, max(len(x), len(y)) // 4)
            if x == y or abs(len(x) - len(y)) <= most and distance(x, y) <= most:
                gone.add((d, p))
                break
    return gone


def test_lines_equal_brute_force(spark):
    a = "This is the first long line of a document that comes again and again."
    b = "Entirely other words stand here, to be left alone by everything else."
    near = [a.replace("first", "fjrst"), a[1:], a + "!?", a.replace("long", "lung").replace("again.", "agajn."), a.replace("first long", "last short"), "  " + a, a[:20] + a[21:60] + a[61:]]
    rows = [(1, a + "\n" + b), (2, "short\nshort\n" + a), (3, "\n".join(near)), (4, None), (5, ""), (6, "\n\n"), (7, b + "\n" + b), (8, a), (9, "Überlänge: äöü äöü äöü äöü äöü äöü äöü äöü"), (10, "Überlänge: äöü äöü äöü äöü äöü äöü äöü äöu")]
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, d string, n_near int")
    gone = line_rules(rows)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    for d, t in rows:
        lines = None if t is None else t.split("\n")
        want = None if t is None else "\n".join(x for p, x in enumerate(lines) if (d, p) not in gone)
        assert got[d].text == want and got[d].n_lines == (len(lines) if lines else 0)
        assert got[d].n_repeated + got[d].n_near == sum(1 for x in gone if x[0] == d)
    clean = line_dedup.clean(df)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {1, 2, 3, 4, 5, 6, 9}


def test_lines_of_hard_texts(corpus):
    got = line_dedup.dedup_lines(corpus)
    assert got.count() == corpus.count() and got.where("doc_id is null").first().text == "no id here at all"
    assert line_dedup.dedup_lines(corpus.limit(5), min_chars=16).count() == 5
    with pytest.raises(ValueError, match="segments"):
        line_dedup.dedup_lines(corpus, edits=3)
    # alike rows are one document: neither repeats the other
    assert {r.n_repeated for r in got.where("doc_id = 300").collect()} == {0}


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance(spark, monkeypatch, edits):
    monkeypatch.setattr(line_dedup, "AHEAD", 4)
    rng = np.random.default_rng(10 + edits)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice(list("abä"), int(rng.integers(max(edits, 2), 14))))
        x = list(a)
        for _ in range(int(rng.integers(0, edits + 2))):
            i, how = int(rng.integers(0, len(x) + 1)), rng.integers(0, 3)
            x[i : i + (how < 2)] = [] if how == 0 else [str(rng.choice(list("abä")))]
        b = "".join(x)
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        if 0 < len(b) and len(a) - len(b) <= edits:
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.distance("a", "b", edits).alias("d"))
    for r in df.collect():
        want = distance(r.a, r.b)
        assert r.d == want if want <= edits else r.d > edits


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_segment_keys_are_hashes_of_what_probes_cover(spark, edits):
    parts, want, lines = edits + 1, [], ["abcdéfghijk漢lmn"[:n] for n in range(edits + 1, 16)]
    for k, line in enumerate(lines):
        for p, (i, d, s) in enumerate(line_dedup.probes(edits)):
            q, r = divmod(len(line) - d, parts)
            at, size = i * q + max(0, i - parts + r) + s, q + (parts - i <= r)
            want.append((k, p, (len(line) - d) * parts + i, line[at : at + size] if at >= 0 and at + size <= len(line) else None))
    df = spark.createDataFrame(want, "k long, p int, tag long, part string").select("k", "p", F.when(F.col("part").isNotNull(), F.xxhash64("tag", "part")).alias("key"))
    expected = {(r.k, r.p): r.key for r in df.collect()}
    rows = spark.createDataFrame(list(enumerate(lines)), "k long, line string").withColumn("n", F.length("line"))
    got = rows.select("k", F.posexplode(line_dedup.segment_keys("line", "n", edits)).alias("p", "key")).collect()
    assert {(r.k, r.p): r.key for r in got} == expected


@pytest.mark.parametrize("edits", [1, 2])
def test_probes_find_every_near_line(spark, edits):
    rng = np.random.default_rng(edits)
    base = "".join(rng.choice(list("abcde "), 50)).strip().ljust(45, "x")
    lines = [base]
    for _ in range(120):
        x = list(lines[int(rng.integers(0, len(lines)))])
        for _ in range(int(rng.integers(1, edits + 1))):
            i, how = int(rng.integers(0, len(x))), rng.integers(0, 3)
            x[i : i + (how < 2)] = [] if how == 0 else [str(rng.choice(list("abcde")))]
        lines.append("".join(x))
    lines += ["abcd", "abd", "abce", "xyz", "xy", "xyzw", "abcdefgh", "abXdefYh", "abc", "ab", "a"]
    lines = list(dict.fromkeys(x.strip() for x in lines))
    rng.shuffle(lines)
    rows = [(i, x) for i, x in enumerate(lines)]
    got = {r.doc_id for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), edits).where("n_near = 1").collect()}
    assert got == {d for d, _ in line_rules(rows, edits)} and len(got) > 60


def test_template_lines_are_not_compared_in_pairs(spark, monkeypatch):
    """Thousands of lines that share most segments: as brute force says, from a few pairs a line."""
    rng = np.random.default_rng(4)
    numbers = rng.choice(10**6, 1500, replace=False)
    lines = [f"Invoice number {n:06d} of the year" for n in numbers.tolist()] + [f"Invoice number of the {w} long year and the one after it" for w in ("first", "fjrst", "last")]
    pairs, write = [], line_dedup.materialise

    def count(df):
        out = write(df)
        if out.columns == ["a", "b"]:
            pairs.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "materialise", count)
    got = {r.doc_id for r in line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).where("n_near = 1").collect()}
    digits = np.array([[int(c) for c in f"{n:06d}"] for n in numbers])
    want, unsure = {1501}, []
    for i in range(1, 1500):
        if ((digits[:i] != digits[i]).sum(1) <= 2).any():
            want.add(i)
        else:
            unsure.append(i)
    for i in unsure:  # a digit dropped and another put in
        fewer = {f"{numbers[i]:06d}"[:k] + f"{numbers[i]:06d}"[k + 1 :] for k in range(6)}
        if any(f"{n:06d}"[:k] + f"{n:06d}"[k + 1 :] in fewer for n in numbers[:i].tolist() for k in range(6)):
            want.add(i)
    assert got == want and sum(pairs) < 1500 * 1500 / 8



# --- embeddings ---


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 16))
    rows = [(i, [float(v) for v in x[i % 60] * (1 + i // 60) + (0.12 if i % 3 else 0.0) * rng.normal(size=16) * (i >= 60)], i % 2, 9) for i in range(400)]
    rows += [(1000 + i, [float(v) for v in x[0]], 0, 9) for i in range(5)]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [1.0] * 15 + [None]), (2005, [float("inf")] * 16), (2006, [1.0] * 3), (None, [1.0] * 16)]
    short = [(3000, [1.0, 2.0]), (3001, [2.0, 4.1]), (3002, [-1.0, 2.0])]
    df = spark.createDataFrame(rows + [(*b, 0, 9) for b in bad + short], "vec_id long, embedding array<double>, label int, hash int")
    got = {r.vec_id: r for r in embed_dup.near_duplicates(df).collect()}
    ids = [r[0] for r in rows]
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= embed_dup.COSINE
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if near[i, j]]
    want = classes(ids, links)
    for k, i in enumerate(ids):
        assert got[i].n_links == near[k].sum() - 1 and got[i].component_id == want[i] and got[i].kept == (want[i] == i)
    for b, _ in bad:
        assert got[b].n_links == 0 and got[b].component_id == b and got[b].kept
    assert [(got[i].n_links, got[i].component_id) for i, _ in short] == [(1, 3000), (1, 3000), (0, 3002)]


def test_probes_and_filters_lose_nothing():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 12))
    x[300:] = x[:300] + rng.normal(size=(300, 12)) * 0.08
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index, reach = embed_dup.Index(x[:200], 5000), math.sqrt(2 - 2 * 0.95)
    at, codes, error = index.encode(x)
    row, other = index.probes(x, at, reach)
    seen = set(zip(row.tolist(), other.tolist(), strict=True)) | set(enumerate(at.tolist()))
    for i, j in zip(*np.nonzero(x @ x.T >= 0.95), strict=True):
        assert (i, at[j]) in seen
        assert index.asymmetric(x[i : i + 1], at[j], codes[j : j + 1])[0, 0] - error[j] <= reach + embed_dup.SLACK


def planted(rng, rows, rank, size):
    """Unit vectors in a random subspace, every tenth followed by one at a cosine of 0.950 to 0.955."""
    x = rng.normal(size=(rows, rank))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = rng.normal(size=(rows // 10, rank))
    base = x[: rows // 10]
    step -= (step * base).sum(1, keepdims=True) * base
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    c = rng.uniform(0.9501, 0.955, size=(rows // 10, 1))
    x[-(rows // 10) :] = c * base + np.sqrt(1 - c**2) * step
    return x @ np.linalg.qr(rng.normal(size=(size, rank)))[0].T


@pytest.mark.parametrize(("rank", "size"), [(3, 64), (8, 64), (16, 64), (64, 64), (8, 768), (16, 768)])
def test_probes_reach_every_link_whatever_the_directions(rank, size):
    rng = np.random.default_rng(6)
    x = planted(rng, 12_000, rank, size)
    index, reach = embed_dup.Index(x, len(x)), math.sqrt(2 - 2 * 0.95)
    assert len(index.centres) >= 20
    at = index.encode(x)[0]
    met = np.zeros((len(x), len(index.centres)), dtype=bool)
    met[np.arange(len(x)), at] = True
    met[index.probes(x, at, reach)] = True
    pairs = [(np.arange(1_200), np.arange(10_800, 12_000)), np.nonzero(np.triu(x[:500] @ x[:500].T >= 0.95, 1))]
    i, j = (np.concatenate(p) for p in zip(*pairs, strict=True))
    first = at[i] <= at[j]  # the one in the earlier list probes
    i, j = np.where(first, i, j), np.where(first, j, i)
    found = met[i, at[j]].mean()
    assert (at[i] != at[j]).any() and (found == 1 if rank < 64 else found > 0.995)


@pytest.mark.parametrize(("rank", "size", "kind"), [(8, 64, "float"), (16, 48, "double")])
def test_many_lists_equal_brute_force(spark, tmp_path, rank, size, kind):
    import pyarrow as pa
    import pyarrow.parquet as pq

    x = planted(np.random.default_rng(7), 11_000, rank, size).astype(np.float32 if kind == "float" else np.float64)
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)}), tmp_path / "e.parquet")
    df = spark.read.parquet(str(tmp_path / "e.parquet"))
    nodes, packed = embed_dup.distinct_vectors(embed_dup.prepared(df))
    shared, measured = embed_dup.fitted(nodes, packed, 0.95, math.sqrt(0.1))
    assert len(shared.value.of[size].centres) >= 20 and measured[size].links > 20
    got = {r.vec_id: r for r in embed_dup.near_duplicates(df).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    links = list(zip(*np.nonzero(np.tril(near, -1)), strict=True))
    want = classes(list(range(len(x))), [(int(a), int(b)) for a, b in links])
    n = near.sum(1) - 1
    assert all(got[i].n_links == n[i] and got[i].component_id == want[i] for i in range(len(x)))


def test_sketches_of_near_copies_are_not_broadcast(spark):
    # they take next to nothing in Parquet, which Spark takes for their size: at 0.6 GB of documents the driver ran out of memory
    n = 21_000
    words = [f"w{i}" for i in range(80)]
    text = lambda w: F.concat(F.lit(" ".join(w) + " "), F.col("id"))
    docs = spark.range(0, n, 1, 4).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n - 20, text(words[:60])).otherwise(text(words[15:75])).alias("text"))
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsList().last().executionId() if store.executionsCount() else -1
    found = near_dup.near_duplicates(docs).groupBy("component_id").agg(F.count("*"), F.count_if("kept")).collect()
    assert sorted(map(tuple, found)) == [(0, n - 20, 1), (n - 20, 20, 1)]
    runs = store.executionsList()
    plans = [x.physicalPlanDescription() for x in map(runs.apply, range(runs.size())) if x.executionId() > before]
    sent = [columns for plan in plans for columns in re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan)]
    assert sent and not [x for x in sent if re.search(r"\b(fine|regs|ra|rb)#", x)]


def test_tables_over_the_row_limit_are_never_broadcast(spark):
    table = common.materialise(spark.range(2_000))
    plan = lambda rows: spark.range(50).join(common.small(table, rows), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(2_000) and "Broadcast" not in plan(1_999)
