"""Quality, scoring, search, mixing, revisits, packing and token counts."""

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import common, hamming, lm_score, mixing, packing, quality, revisits, token_count

SPACES = b" \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().split()


# --- quality ---


def test_statistics_are_defined_for_all_texts():
    for text in (None, "", " \n ", "a", "x" * 100_000, "Aa BB. cc!\nAa BB. cc!"):
        s = quality.statistics(text)
        assert len(s) == len(quality.STATISTICS) and all(math.isfinite(v) for v in s)
    assert quality.statistics(None) == quality.statistics("") == [0.0] * len(quality.STATISTICS)


def test_rules_learn_and_compile(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.3) & (x[:, 5] < 0.8)).astype(float)
    model = quality.fit(x[:1500], y[:1500])
    assert 0 < len(model.rules) < 200 and np.mean((model.score(x[1500:]) >= 0.5) == y[1500:]) > 0.97
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x[:50])], "i int, s array<double>")
    got = [r.p for r in df.select("i", model.column("s").alias("p")).orderBy("i").collect()]
    np.testing.assert_allclose(got, model.score(x[:50]), atol=1e-12)
    assert quality.fit(x[:0], y[:0]).score(x[:1])[0] > 0.7
    assert quality.fit(x[:5], np.ones(5)).score(x[:1])[0] > 0.7


def test_quality_on_held_out_labels(spark):
    """Labels that the model has not seen: better than the majority by far, and ranked almost without fault."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_documents(docs.select("doc_id", "text"), labels.select("doc_id", "quality")).where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    good = got.quality == 1
    right, most = (got.predicted == got.quality).mean(), max(good.mean(), 1 - good.mean())
    ranks = got.score.rank()
    area = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert len(got) > 50 and right > max(0.9, most) and area > 0.95


def test_quality_of_hard_documents(spark, corpus):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 112)] + [(300, None, 0), (None, 1, 0), (101, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(corpus, labels).collect()
    assert len(got) == corpus.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    kept = quality.keep_good(corpus, labels.where("false"))
    assert kept.columns == corpus.columns and kept.count() == corpus.count()
    assert quality.score_documents(corpus.where("false"), labels).count() == 0


# --- language model ---


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def test_scores_of_hard_documents(corpus):
    rows = corpus.select("doc_id", "text").collect()
    tokens = {(r.doc_id, r.text): [*(r.text or "").encode().lower().split(), b"\n"] for r in rows}
    count = Counter(w for r in rows if not held(r.doc_id) for w in tokens[(r.doc_id, r.text)])
    n, v = sum(count.values()), len(count)
    got = lm_score.score_documents(corpus).collect()
    assert len(got) == len(rows) and any(r.held_out for r in got)
    by_id = {r.doc_id: r for r in rows}
    for r in got:
        t = tokens[(r.doc_id, by_id[r.doc_id].text)]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(count[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        assert r.score < 0 and r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / (sum(map(len, t)) + len(t) - 1))
    assert lm_score.score_documents(corpus.where("false")).count() == 0


def test_held_out_texts_score_above_their_base(spark):
    """The model beats smoothed frequencies on texts it has not learned from; texts that occur once more in training are foretold."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lm_score.score_documents(docs).where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_foretold").alias("n")).first()
    assert got.base < got.score < 0 and got.n > 0


def tiny(spark):
    rng = np.random.default_rng(9)
    some = [f"w{'abcd'[k % 4]}{k}" for k in range(30)]
    texts = [" ".join(rng.choice(some, int(rng.integers(0, 25)))) for _ in range(60)]
    texts += [texts[3] + " and more", texts[4], "wa0 wa0 wa0 wa0 wa0", None, "Wa0\tWB1  wa0"]
    return [(i, t) for i, t in enumerate(texts)]


def test_scores_equal_brute_force(spark, monkeypatch):
    """The whole score, from spelled words and contexts counted one occurrence at a time; and the same whatever the partitions."""
    monkeypatch.setattr(lm_score, "HEAD", 9)
    monkeypatch.setattr(lm_score, "PART", 24)
    rows = tiny(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r.doc_id: r for r in lm_score.score_documents(df.coalesce(1)).collect()}
    many = {r.doc_id: r for r in lm_score.score_documents(df.repartition(7)).collect()}
    assert all(one[i].score == pytest.approx(many[i].score, abs=1e-9) and one[i].n_foretold == many[i].n_foretold for i, _ in rows)

    cost = {bytes(r.token): r for r in lm_score.spelled(lm_score.gather(df).persist(), len({w for i, t in rows if not held(i) for w in lm_score.words((t or "").encode())})).collect()}
    top = sorted(cost.values(), key=lambda r: (-r.c, bytes(r.token)))[:9]
    hot = {bytes(r.token) for r in top if r.c > 24}
    after, seen = {}, []
    for i, t in rows:
        w = lm_score.words((t or "").encode())
        for k, word in enumerate(w):
            back = [w[k - j] if j <= k else None for j in range(1, 8)]
            size = next((m for m in range(2, 7) if any(x is not None and x not in hot for x in back[:m])), None)
            found = (word, None if size is None else tuple(back[:size]), None if size is None else tuple(back[: size + 1]), not held(i), i)
            seen.append(found)
            if found[3] and size:
                for c in found[1:3]:
                    after.setdefault((len(c) == size, c), Counter())[word] += 1
    rank = lambda w: int(hash_of(w) & np.uint64(0xFFFFFF))

    def hash_of(w):
        at = [k for k, r in enumerate(top) if bytes(r.token) == w]
        return lm_score.mix64(np.array([at[0] + 1], dtype=np.uint64))[0] if at else lm_score.word_hashes(np.frombuffer(w, dtype=np.uint8))[0]

    code, ones, total = [], Counter(), Counter()
    for word, short, long, trained, _ in seen:
        if short is None:
            code.append(0)
            continue
        a, b = (Counter(after.get((kind, c), {})) for kind, c in ((True, short), (False, long)))
        if trained:
            a[word] -= 1
            b[word] -= 1
        if sum(a.values()) == 0:
            code.append(0)
            continue
        of = b if sum(b.values()) else a
        best = min((w for w in of if of[w] > 0), key=lambda w: (-of[w], rank(w)))
        level = lambda n: int(np.searchsorted(lm_score._ENDS, n))
        n1, m1 = (b[best], sum(b.values()) - b[best])
        cell = ((level(n1) * 7 + level(m1)) * 7 + level(a[best])) * 7 + level(sum(a.values()) - a[best])
        code.append(2 * cell + (word == best))
        if trained:
            total[cell] += 1
            ones[cell] += word == best
    cells = np.array(sorted(total))
    logs = lm_score.foretold(cells, np.array([ones[c] for c in cells]), np.array([total[c] for c in cells]))
    want = Counter()
    for c, (word, _, _, _, i) in zip(code, seen, strict=True):
        want[i] += logs[c] + (0 if c % 2 else cost[word].g0)
    assert sum(c > 1 for c in code) > 200 and any(c % 2 for c in code) and hot
    for i, _ in rows:
        assert one[i].score == pytest.approx(want[i] + lm_score.GATE_COST, abs=1e-6)


def test_contexts_do_not_follow_from_the_size(spark, monkeypatch):
    """However often words occur, a context is the last two words: none is hot by default, and small parts and rows told by ranges change no score."""
    assert not (np.array([10**6 + 1, 10**12]) > lm_score.PART).any()
    df = spark.createDataFrame(tiny(spark), "doc_id long, text string")
    want = {r.doc_id: r for r in lm_score.score_documents(df).collect()}
    monkeypatch.setattr(lm_score, "OCCURRENCES", 24)
    monkeypatch.setattr(lm_score, "HELD_ROWS", 30)
    got = lm_score.score_documents(df.repartition(5)).collect()
    assert all(r.score == pytest.approx(want[r.doc_id].score, abs=1e-9) and r.n_foretold == want[r.doc_id].n_foretold for r in got) and len(got) == len(want)


@pytest.mark.parametrize("most", [1, 40, 300])
def test_large_contexts_are_told_like_small_ones(monkeypatch, most):
    """Parts over what is held at once, and single contexts over it, get the answers of all rows held together."""
    rng = np.random.default_rng(4)
    asked = []
    for _ in range(6):
        n = int(rng.integers(0, 200))
        key = np.sort(np.where(rng.random(n) < 0.6, 7, rng.integers(0, 1 << lm_score.KEY_BITS, n) >> 25 << 25))
        asked.append(np.stack((key, rng.integers(0, 4, n), rng.integers(0, 9, n), rng.integers(0, 2, n))))
    all_ = np.concatenate([lm_score._thick(lm_score._thin(x)) for x in asked], axis=1)
    want = lm_score.foretell(all_)
    monkeypatch.setattr(lm_score, "HELD_ROWS", most)
    got, seen = lm_score._answers([lm_score._thin(x) for x in asked])
    assert np.concatenate(got).tolist() == want.tolist() and (want > 0).any()
    assert seen.tolist() == np.bincount(want[all_[3] > 0], minlength=2 * lm_score.CELLS).tolist()


def test_asked_rows_travel_whole_and_small():
    """Words of the head travel as ranks and come out as hashes; rare ones as hashes. Ranks take less room than hashes."""
    rng = np.random.default_rng(5)
    n = 20_000
    rank = (rng.pareto(1.0, n) * 5).astype(np.int64) % 100_000
    hash_ = (lm_score.mix64(rank.astype(np.uint64) + np.uint64(1)) & np.uint64(0xFFFFFF)).astype(np.int64)
    rare = rng.random(n) < 0.1
    rest = [np.sort(rng.integers(0, 1 << lm_score.KEY_BITS, n)), rng.integers(0, 1 << 15, n), rng.integers(0, 2, n)]
    data = lm_score._thin(np.stack((rest[0], rest[1], np.where(rare, hash_ | 1 << 24, rank), rest[2])))
    assert lm_score._thick(data).tolist() == [rest[0].tolist(), rest[1].tolist(), hash_.tolist(), rest[2].tolist()]
    assert lm_score._keys(data).tolist() == rest[0].tolist() and len(data) < 6 * n


def test_learner_runs_once(spark, monkeypatch):
    """Weights are learned in one go over the words: as many units are learned as there are."""
    runs, learner = spark.sparkContext.accumulator(0), lm_score._learner

    def counted(shared):
        run = learner(shared)

        def through(batches):
            runs.add(1)
            yield from run(batches)

        return through

    monkeypatch.setattr(lm_score, "_learner", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lm_score.spelled(lm_score.gather(spark.createDataFrame(tiny(spark), "doc_id long, text string")).persist(), 30)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 1 <= runs.value <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_groups_of_arrow_batches_are_made_once(monkeypatch):
    """Groups that run over many batches are put together once, with the rows and the order that pandas batches give."""
    rng = np.random.default_rng(4)
    unit = np.sort(rng.integers(0, 6, 3_000))
    rows = pd.DataFrame({"unit": unit, "group": unit // 2 * 2 + (rng.random(3_000) < 0.5), "token": [b"%d" % i for i in range(3_000)]}).sort_values(["unit", "group"], kind="stable", ignore_index=True)
    cuts = [0, 0, *sorted(rng.integers(0, 3_000, 40).tolist()), 3_000]
    parts = [rows.iloc[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
    want = [(tuple(map(int, k)), r.to_numpy().tolist()) for k, r in common.in_groups(parts, ["unit", "group"])]
    monkeypatch.setattr(common.pd, "concat", None)  # none is needed
    batches = [pa.RecordBatch.from_pandas(x, preserve_index=False) for x in parts]
    got = [(tuple(map(int, k)), r.to_numpy().tolist()) for k, r in common.arrow_groups(batches, ["unit", "group"])]
    assert got == want and len(got) > 6 and list(common.arrow_groups([], ["unit"])) == []


def test_bits_of_all_words_are_a_distribution():
    """Over all bytes at one place, what the mixer spells sums to one: scores are probabilities."""
    code = lm_score.byte_code(np.arange(256.0))
    sizes = lm_score.slot_sizes(100)
    rng = np.random.default_rng(1)
    mixer = lm_score.Mixer(code, sizes, rng.integers(0, 5, (sizes[1][-1], 2)).astype(np.float32))
    mixer.weights = rng.normal(size=mixer.weights.shape) * 0.3
    every = [b"ab" + bytes([b]) for b in range(256) if b != 32] + [b"ab"]
    owner, low, keys, bit = lm_score.spell(every, np.zeros(len(every), dtype=np.int64), np.full(len(every), 1), code, sizes)
    at, found = np.unique(keys, return_inverse=True)
    p = mixer.probability(low, found.reshape(keys.shape), rng.integers(0, 5, (len(at), 2)).astype(np.float32))
    lp = np.log(np.where(bit == 1, p, 1 - p))
    # bits of the third byte alone, which for the last is the white space
    first, lengths = code[2][[97, 98]].sum(), code[2]
    total = sum(math.exp(lp[owner == k][first : first + lengths[(t + b" ")[2]]].sum()) for k, t in enumerate(every))
    assert total == pytest.approx(1, abs=1e-6)


def test_counts_of_words_so_far_are_whole(spark, monkeypatch):
    """Every bit of every word meets the counts of all training words that begin so, whatever the groups."""
    monkeypatch.setattr(lm_score, "MOST_ALIKE", 15)
    monkeypatch.setattr(lm_score, "GROUP", 50)
    monkeypatch.setattr(lm_score, "DEPTHS", (1, 2, 4))
    assert (lm_score.slot_sizes(10**8)[0] >= lm_score.slot_sizes(10**5)[0]).all()
    rng = np.random.default_rng(2)
    made = sorted({bytes(rng.choice(list(b"abcd\xc3"), rng.integers(1, 7)).astype(np.uint8)) for _ in range(500)})
    c = rng.integers(0, 100_000, (len(made), lm_score.GATES)) * (rng.random((len(made), lm_score.GATES)) < 0.4)
    rows = [(bytearray(t), *map(int, x), *[1] * lm_score.GATES) for t, x in zip(made, c, strict=True)]
    vocab = spark.createDataFrame(rows, "token binary, " + ", ".join(f"{n} long" for n in lm_score._C + lm_score._S))
    code, sizes = lm_score.byte_code(np.ones(256)), lm_score.slot_sizes(1000)
    dealt = lm_score.grouped(vocab, int((c.sum(1) > 0).sum())).toPandas()
    assert dealt.group.nunique() > 4 and len(set(dealt.depth)) > 1
    i, g = np.nonzero(c)
    owner, _, keys, bit = lm_score.spell([made[k] for k in i], g, np.ones(len(i)), code, sizes)
    want = Counter()
    for k in range(1):
        for x, b, w in zip(keys[k].tolist(), bit.tolist(), c[i, g][owner].tolist(), strict=True):
            want[k, x, b] += w
    for _, part in dealt.groupby("group"):
        group = lm_score.Group(part, code, sizes)
        r, g = np.nonzero(np.ones((len(part), lm_score.GATES)))
        _, _, keys, _ = group.spell(r, g)
        n = group.n[group.known(keys)]
        for k in range(1):
            deep = keys[k] != 0
            assert n[k][deep].tolist() == [[np.float32(want[k, x, 0]), np.float32(want[k, x, 1])] for x in keys[k][deep].tolist()] and not n[k][~deep].any()


# --- search ---


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    codes = rng.integers(-(2**63), 2**63, 300, dtype=np.int64)
    codes[100:180] = codes[0]
    codes[180:240] = codes[1] ^ (np.int64(1) << rng.integers(0, 63, 60))
    rows = [(int(i), int(c)) for i, c in enumerate(codes)] + [(500, None), (None, 5), (3, int(codes[3]))]
    base = spark.createDataFrame(rows, "id long, code long")
    got = [(r.query_id, r["rank"], r.id, r.distance) for r in hamming.top_k(base, base.where("id % 50 = 0"), 7).orderBy("query_id", "rank").collect()]
    want = []
    for q in (0, 50, 100, 150, 200, 250):
        far = sorted((bin((int(codes[q]) ^ int(c)) & (2**64 - 1)).count("1"), i) for i, c in enumerate(codes) if i != q)
        want += [(q, k + 1, i, d) for k, (d, i) in enumerate(far[:7])]
    assert got == want
    assert hamming.top_k(base.where("id < 3"), base.where("id = 0"), 7).count() == 2
    assert hamming.top_k(base.where("false"), base, 7).count() == 0 and hamming.top_k(base, base.where("false"), 7).count() == 0
    df = spark.createDataFrame([([1.0] + [0.0] * 63,), ([-1.0] * 63 + [2.0],), (None,), ([1.0],), ([float("nan")] * 64,)], "v array<double>")
    assert [r.c for r in df.select(hamming.sign_code("v").alias("c")).collect()] == [1, -(2**63), None, None, None]


@pytest.mark.parametrize("size", [5, 500, 20_000])
def test_search_stops_only_when_covered(size):
    rng = np.random.default_rng(6)
    codes = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    near = np.concatenate((codes[:20] ^ (np.uint64(1) << rng.integers(0, 60, len(codes[:20])).astype(np.uint64)), rng.integers(0, 2**63, 20).astype(np.uint64), ~codes[:2]))
    q, c, d = hamming.Block(codes).search(near, 3)
    for k, x in enumerate(near):
        far = np.bitwise_count(codes ^ x)
        last = np.sort(far)[2]
        assert set(c[q == k]) == set(np.flatnonzero(far <= last)) and (d[q == k] == far[c[q == k]]).all()


# --- mixing ---


def test_targets_fill_up():
    t = mixing.targets([("b", 100), ("a", 10), (None, 50)])
    assert t["a"] == pytest.approx(160 / 6) and t["b"] == pytest.approx(160 / 3) and t[None] == pytest.approx(80)
    t = mixing.targets([("a", 1000), ("b", 1), ("c", 1)])
    assert t["b"] == 3 and t["c"] == 3 and t["a"] == 996
    assert mixing.targets([("a", 0)]) == {"a": 0.0} and mixing.targets([]) == {}


def test_mix_of_hard_documents(corpus):
    rows = corpus.collect()
    got = mixing.mix(corpus).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r.doc_id or -1, len(words(r.text))) for r in rows)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert target == pytest.approx(mixing.targets(list(size.items())))
    for s in size:
        assert abs(taken[s] - target[s]) <= 1
    key = lambda r: (r.doc_id or -1, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(corpus.repartition(7)).collect()))
    made = mixing.apply_mix(corpus)
    assert made.columns == corpus.columns
    mine = Counter()
    for r in made.collect():
        mine[r.doc_id] += len(words(r.text))
    want = Counter()
    for r in got:
        want[r.doc_id] += r.taken
    assert +mine == +want
    assert mixing.mix(corpus.where("false")).count() == 0 and mixing.apply_mix(corpus.where("false")).count() == 0


def test_ranges_are_cut_exactly(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 8)
    df = spark.range(3000).selectExpr("id as doc_id", "array_join(transform(sequence(1, 1 + cast(id % 9 as int)), i -> 'w'), ' ') as text", "if(id % 3 = 0, 'a', 'b') as source")
    got = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("k"), F.first("target").alias("t")).collect()
    assert all(r.k == int(r.t) for r in got)


# --- revisits ---


def test_urls(spark):
    pairs = [("HTTP://User@WWW.Ex.com:80/A/b/?b=2&utm_source=x&a=1#top", "ex.com/A/b?a=1&b=2"), ("https://ex.com", "ex.com"), ("https://ex.com/?ref=1", "ex.com"), ("ex.com:8080/x?", "ex.com:8080/x"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "i int, url string")
    assert [r.c for r in df.orderBy("i").select(revisits.canonical_url().alias("c")).collect()] == [b for _, b in pairs]


@pytest.mark.parametrize("rows", [50_000, 2])
def test_revisits(spark, monkeypatch, rows):
    monkeypatch.setattr(revisits, "RANGE_POINTS", rows)
    h = {"Content-Type": "t", "Date": "1", "ETag": "e1"}
    data = [
        (1, "response", "http://a.com/x", 10, "e1", None, h, "one"), (2, "response", "https://a.com/x#f", 20, "e2", "m2", None, "two"), (3, "response", "http://a.com/x", 20, "e3", "m3", h, "three"),
        (4, "revisit", "http://www.a.com/x", 15, "W/e1", None, {"date": "9", "set-cookie": "c", "content-length": "0"}, None), (5, "revisit", "a.com/x", 21, "e2", None, None, None), (6, "revisit", "a.com/x", 30, None, "m3", None, None),
        (7, "revisit", "a.com/x", 10, "e1", None, None, None), (8, "revisit", "b.com", 99, None, None, None, None), (9, "revisit", None, 99, None, None, None, None), (10, "revisit", "a.com/x", None, None, None, None, None), (11, "revisit", "a.com/x", 99, None, None, None, None),
        (12, None, "a.com/x", 99, None, None, None, None), (13, "response", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame([(*d, 1) for d in data], "record_id long, record_type string, url string, captured_at long, etag string, last_modified string, headers map<string,string>, payload string, state int")
    got = {r.record_id: r for r in revisits.resolve(df, payload=True).collect()}
    assert len(got) == len(data)
    assert {k: (r.state, r.response_id) for k, r in got.items() if k > 3} == {
        4: ("resolved", 1), 5: ("validator_mismatch", 3), 6: ("resolved", 3), 7: ("no_earlier_response", None), 8: ("no_earlier_response", None), 9: ("no_earlier_response", None),
        10: ("no_earlier_response", None), 11: ("resolved", 3), 12: ("resolved", 3), 13: ("response", 13),
    }
    assert got[4].headers == {"content-type": "t", "etag": "e1", "date": "9"} and got[4].payload == "one" and got[5].payload is None
    assert got[4].payload_bytes == 3 and got[4].payload_crc32 == zlib.crc32(b"one") and got[1].payload == "one" and got[13].payload_bytes is None
    assert revisits.resolve(df.where("false")).count() == 0


# --- packing and tokens ---


def test_packing_of_hard_documents(corpus):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(path)
    got = packing.pack_documents(corpus, path).collect()
    want = Counter()
    for r in corpus.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        n = len(ids)
        first = n % 2048 or 2048
        cuts = [(0, min(first, n))] + [(s, 2048) for s in range(first, n, 2048)]
        for k, (s, m) in enumerate(cuts):
            want[(r.doc_id, k, s, m, zlib.crc32(ids[s : s + m].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for bins in places.values():
        at = 0
        for o, m in sorted(bins):
            assert o == at
            at += m
        assert at <= 2048
    assert len(places) == packing.lower_bound(np.array([r.length for r in got]))
    assert {(r.n_sequences, r.least_sequences) for r in got} == {(len(places), len(places))}
    assert packing.pack_documents(corpus.where("false"), path).count() == 0


@pytest.mark.parametrize("low,high", [(1, 2047), (600, 800), (1024, 1100), (500, 520)])
def test_packing_in_partitions(spark, low, high):
    rng = np.random.default_rng(low)
    items = [(i, int(n)) for i, n in enumerate(rng.integers(low, high + 1, 3000))]
    got, bins = packing.pack(spark.createDataFrame(items, "piece_id long, length long"), pack_rows=1000)
    got = got.collect()
    length = dict(items)
    assert sorted(r.piece_id for r in got) == sorted(length)
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, length[r.piece_id]))
    assert all(sorted(b)[0][0] == 0 and sum(n for _, n in b) == max(o + n for o, n in b) <= 2048 for b in fill.values())
    alone = best = len(packing.best_fit(np.array([n for _, n in items]))[2])
    bound = packing.lower_bound(np.array([n for _, n in items]))
    assert bound <= alone and bins == len(fill) <= best * 1.01 + 2


def test_no_task_packs_much_more_than_its_rows(spark, monkeypatch):
    """Half of such lengths can't be certified; rounds end, and pools are dealt to as many tasks as they need."""
    items = [(i, int(n)) for i, n in enumerate(np.random.default_rng(1).integers(500, 1101, 8000))]
    tables, write = [], packing.materialise
    monkeypatch.setattr(packing, "materialise", lambda df: tables.append(write(df)) or tables[-1])
    got, bins = packing.pack(spark.createDataFrame(items, "piece_id long, length long"), pack_rows=500)
    assert len(tables) > 1 and all(r["count"] < 1000 for t in tables for r in t.groupBy("part").count().collect())
    assert got.count() == 8000 and got.select("sequence_id").distinct().count() == bins == got.where("offset = 0").count()
    assert bins <= 1.02 * len(packing.best_fit(np.array([n for _, n in items]))[2])


def test_lower_bounds():
    assert packing.lower_bound(np.array([1025] * 7)) == 7 and packing.lower_bound(np.array([683] * 6)) == 3 and packing.lower_bound(np.array([], dtype=int)) == 0
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = rng.integers(1, 2049, 40)
        assert packing.lower_bound(n) <= len(packing.best_fit(n)[2])


TEXTS = [
    "hello world", "don't I'll 's 'st 'r 're 'rest !'s", "'", "''s", "a'", "x 'l", "'ll'll", "'v", "'vé", "12345 a1b2", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "été ÜBER Straße", "漢字かな", "🎉🎉 ok",
    "Σας ΑΣ", "İstanbul", " x y\x85z\x1cq​w", "ﬁ ½ ² Ⅷ", "é ñ", "", "   ", "\n", "a" * 5000, "!" * 3000, "ab" * 3000 + " x", "<|endoftext|", "'RE 'Ve", "１２", "…'s", "'S",
]


def test_token_counts_equal_the_library(monkeypatch):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    machine, library = token_count.Transducer(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(0)
    texts = TEXTS + ["".join(rng.choice(list("abcdefghij'!? \n12éß<|>S漢"), int(rng.integers(0, 60)))) for _ in range(1500)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert machine.count(texts) == want
    # chunk maps compose wherever texts are cut
    for size in (1, 2, 5):
        monkeypatch.setattr(token_count, "CHUNK", size)
        assert machine.count(texts[:400]) == want[:400]
    monkeypatch.setattr(token_count, "MOST_STATES", 10)
    assert machine.count(texts[:200]) == want[:200] and machine.count(texts[200:400]) == want[200:400] and len(machine.states) < 3000


def test_tables_stay_bounded(monkeypatch):
    """Many characters and states: tables don't grow with the alphabet, and are begun anew within a text."""
    import time

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    machine, library = token_count.Transducer(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(3)
    words_ = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(2, 9)))) for _ in range(9_000)]
    signs = "".join(map(chr, range(0x4E00, 0x4E00 + 3000)))
    texts = [" ".join(words_), signs, " ".join(signs[:500]) + signs[::-1]]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert machine.count(texts[:1]) == want[:1] and len(machine.states) > 10_000
    start = time.time()
    assert machine.count(texts[1:]) == want[1:] and time.time() - start < 20
    assert machine.next.nbytes + machine.emit.nbytes < 100 << 20 and machine.next.shape[1] == token_count.COLUMNS
    monkeypatch.setattr(token_count, "MOST_STATES", 500)
    monkeypatch.setattr(token_count, "MOST_RARE", 300)
    assert machine.count(texts) == want and len(machine.states) < 3_000


def test_maps_compose_associatively():
    machine = token_count.Transducer(str(public_tokenizers.path("word_bpe_49k.json")))
    text = "some text, that isn't split where   words end 12"
    symbols = np.array([machine.symbol_of(ord(c)) for c in text])
    maps = machine._maps([symbols[i : i + 3] for i in range(0, len(symbols), 3)])
    left = maps[0]
    for m in maps[1:]:
        left = machine._compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = machine._compose(m, right)
    assert machine._apply(left) == machine._apply(right) == machine._apply(machine._reduce(maps)) == machine.count([text])[0]


def test_token_counts_of_hard_documents(corpus):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(path)
    got = sorted(tuple(r) for r in token_count.count_tokens(corpus, path).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))).collect())
    want = []
    for r in corpus.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), n, n > 2048))
    assert got == sorted(want)
    assert token_count.count_tokens(corpus.where("false"), path).count() == 0
