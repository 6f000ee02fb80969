import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestry.llm import hashing, kneser_ney, quality_model, toxicity
from harvestry.llm.samples import fold


def crc(i):
    return zlib.crc32(str(i).encode())


def test_folds(spark):
    got = spark.createDataFrame([(i,) for i in (0, 5, -3, None)], "i bigint").select("i", fold(F.col("i"), 10).alias("f")).collect()
    assert [r.f for r in got] == [crc(0) % 10, crc(5) % 10, crc(-3) % 10, -1]


@pytest.fixture(scope="module")
def labelled(spark, table, prose):
    bad = ["vile", "grim", "nasty", "foul"]
    r = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 40 + i % 50).split()
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad) + r.choice(["", ",", "!"]))
        junk = i % 5 == 1
        rows.append((i, " ".join(w.upper() + "##" if junk else w for w in words)))
        if i % 11 < 7:  # a fair sample of both classes: the prior is taken from it
            labels.append((i, int(not junk), int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark, table, labelled, odd):
    rows, labels = labelled
    docs, known = table(rows), spark.createDataFrame([*labels, (None, 1, 1), (2, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, known)
    got = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in rows if crc(i) % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 6 == 0) for i in held) >= 0.97 * len(held)
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns
    kept = {r.doc_id for r in clean.select("doc_id").collect()}
    assert kept == {i for i, s in got.items() if s < 0.5}
    out = toxicity.score(table(odd), model).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.keep_clean(table(odd), model).count() == len(odd)
    assert toxicity.score(table([]), model).count() == 0


def test_labels_of_the_held_out_fold_do_not_matter(spark, table, labelled):
    rows, labels = labelled
    schema = "doc_id bigint, quality int, toxic int"
    flipped = [(i, 1 - q, 1 - t) if crc(i) % 5 == 0 else (i, q, t) for i, q, t in labels]
    a, b = (toxicity.train(table(rows), spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert a.bias == b.bias and a.weights == b.weights
    flipped = [(i, 1 - q, t) if crc(i) % 3 == 1 else (i, q, t) for i, q, t in labels]
    a, b = (quality_model.train(table(rows), spark.createDataFrame(x, schema), epochs=1) for x in (labels, flipped))
    assert np.array_equal(a.vectors, b.vectors)


def test_no_positives(spark, table, labelled):
    rows, _ = labelled
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(table(rows), none)
    assert all(r.score < 0.5 for r in toxicity.score(table(rows), model).collect())
    assert quality_model.train(table(rows), none).scorer()(b"x y") == 0.5


def test_risk_is_corrected_for_the_prior():
    r = random.Random(0)
    draw = lambda: {str(r.randrange(40)).encode() for _ in range(12)}
    pos = [draw() | {b"bad"} for _ in range(200)]
    unl = [draw() | ({b"bad"} if k < 60 else set()) for k in range(600)]
    model = toxicity.nn_pu(pos, unl, 0.1)
    score = lambda s: model.score(b" ".join(s))
    assert np.mean([score(draw() | {b"bad"}) >= 0.5 for _ in range(100)]) > 0.95
    assert np.mean([score(draw()) < 0.5 for _ in range(100)]) > 0.95


def test_quality_held_out(spark, table, labelled, odd):
    rows, labels = labelled
    docs, known = table(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality_model.train(docs, known)
    got = {r.id: r.score for r in quality_model.score(docs, model).collect()}
    held = [i for i, _ in rows if crc(i) % 3 == 1]
    assert sum((got[i] >= 0.5) == (i % 5 != 1) for i in held) >= 0.97 * len(held)
    out = quality_model.score(table(odd), model).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    assert quality_model.score(table([]), model).count() == 0


def brute_model(texts, order):
    """Interpolated modified Kneser-Ney of two or three words by dictionaries: word counts, and p(u, v, w)."""
    tokens = [[*t.lower().split(), b"\n"] for t in texts]
    uni = Counter(w for ts in tokens for w in ts)
    tri = Counter(x for ts in tokens for x in zip([None, None, *ts], [None, *ts], ts, strict=False))
    if order == 2:
        two = Counter(p for ts in tokens for p in zip([None, *ts], ts, strict=False))
    else:
        two = Counter((v, w) for _, v, w in tri)
        two.update({(v, w): c - 1 for (_, v, w), c in tri.items() if v is None})  # as often as they occur
    one = Counter(w for _, w in two)
    ds = [kneser_ney.discounts([sum(c == k for c in x.values()) for k in (1, 2, 3, 4)]) for x in (one, two, tri)]
    cut = lambda c, d: (0, *d)[min(c, 3)]
    after = [defaultdict(list), defaultdict(list)]
    for (v, _), c in two.items():
        after[0][v].append(c)
    for (u, v, _), c in tri.items():
        after[1][u, v].append(c)
    total, size = sum(one.values()), len(uni)
    rest = sum(cut(c, ds[0]) for c in one.values()) / total

    def step(count, seen, d, low):
        return max(count - cut(count, d), 0) / sum(seen) + sum(cut(c, d) for c in seen) / sum(seen) * low if seen else low

    def p(u, v, w):
        low = max(one[w] - cut(one[w], ds[0]), 0) / total + rest / (size + 1)
        low = step(two[v, w], after[0].get(v), ds[1], low)
        return step(tri[u, v, w], after[1].get((u, v)), ds[2], low) if order == 3 else low

    return uni, p


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_against_dictionaries(spark, table, prose, odd, order, monkeypatch):
    monkeypatch.setattr(kneser_ney, "HEAVY", 4)  # both ways of summing
    rows = [(i, prose(i, 60).replace("sun", "Sun").replace("moss", "É")) for i in range(60)] + odd + [(900, prose(3, 60)[:200]), (901, "a a a a a a a b a a a")]
    train = [(i, t) for n, (i, t) in enumerate(rows) if n % 4]
    # ranges of many sizes, one of them holding everything
    for range_bytes in (3000, 1 << 30):
        model = kneser_ney.train(table(train), order=order, range_bytes=range_bytes)
        uni, p = brute_model([(t or "").encode() for _, t in train], order)
        n, v = sum(uni.values()), len(uni)
        assert (model.tokens, model.size, model.order) == (n, v, order)
        want = []
        for i, t in rows:
            ts = [*(t or "").encode().lower().split(), b"\n"]
            base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)
            score = sum(math.log10(p(*x)) for x in zip([None, None, *ts], [None, *ts], ts, strict=False))
            want.append((i or -1, len(ts), sum(uni[w] > 0 for w in ts), base, score))
        got = [(r.id or -1, r.n_tokens, r.n_known, r.base_score, r.score) for r in kneser_ney.score(table(rows), model).collect()]
        for g, w in zip(sorted(got), sorted(want), strict=True):
            assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9)
    # over all words and an unknown one, probabilities after any words sum to 1
    for u, v in ((None, None), (None, b"river"), (b"a", b"a"), (b"nowhere", b"nowhere"), (b"river", b"nowhere")):
        assert sum(p(u, v, w) for w in uni) + p(u, v, b"\0new") == pytest.approx(1)


def test_key_codec():
    r = np.random.default_rng(1)
    for n in (1, 2, 1000):
        for top in (200, 1 << 40, (1 << 64) - 1):
            keys = np.sort(r.integers(0, top, n, np.uint64, endpoint=True))
            assert np.array_equal(kneser_ney.unpacked_keys(kneser_ney.packed_keys(keys)), keys)
    assert len(kneser_ney.unpacked_keys(kneser_ney.packed_keys(np.empty(0, np.uint64)))) == 0


def test_language_model_edges(spark, table):
    empty = kneser_ney.train(table([]))
    assert (empty.tokens, empty.size) == (0, 0)
    r = kneser_ney.score(table([(1, "a b"), (2, None)]), empty).orderBy("id").collect()
    assert [x.score for x in r] == [0, 0] and [x.base_score for x in r] == [0, 0] and [x.n_tokens for x in r] == [3, 1]
    assert kneser_ney.score(table([]), empty).count() == 0
    with pytest.raises(ValueError):
        kneser_ney.train(table([]), order=4)


def test_hashes_of_tokens_are_those_of_their_words():
    import pyarrow as pa

    r = random.Random(6)
    texts = [bytes(r.choice(b"aAbB \t\n\x0b\x0c\r\x1c\x00\xc3\xa9\xff") for _ in range(r.randrange(30))) for _ in range(300)] + [b"", b"x", b" ", b"ab", b"cd"]
    hasher, seen = hashing.Hasher(), {}
    column = pa.array([b"skipped", *texts], pa.binary()).slice(1)
    hashes, lengths = hasher.tokens(column)
    at = 0
    for text, n in zip(texts, lengths.tolist(), strict=True):
        words = [*text.lower().split(), b"\n"]
        assert n == len(words)
        for word, h in zip(words, hashes[at : at + n].tolist(), strict=True):
            assert seen.setdefault(word, h) == h
        at += n
    assert at == len(hashes) and len(set(seen.values())) == len(seen)
    # in small steps, and with a word longer than a step, and one text at a time
    with pytest.MonkeyPatch.context() as m:
        m.setattr(hashing, "CHUNK", 7)
        assert np.array_equal(hashing.Hasher().tokens(column)[0], hashes)
    assert np.array_equal(np.concatenate([hashing.Hasher().tokens(pa.array([t], pa.binary()))[0] for t in texts]), hashes)
    assert [len(x) for x in hasher.tokens(pa.array([], pa.binary()))] == [0, 0]


def test_features_of_a_text():
    words = toxicity.word_set("Réeux RÉEUXA réeuxb! the, the".encode())
    assert words == {w.encode() for w in ("réeux", "réeuxa", "réeuxb", "the")}
    got = toxicity.features("réeuxa réeuxb x y".encode())
    # two of four words begin alike: all shares are reached, by the one beginning they have in common
    assert got - words >= {"réeux~0".encode(), "réeux~1".encode(), "réeux~2".encode()} and not any(b"~" in w and not w.startswith("réeux".encode()) for w in got)
    assert toxicity.features(b"worda wordb " + b" ".join(b"z%d" % i for i in range(98))) >= {b"z1", b"worda"} and b"worda~0" not in toxicity.features(b"worda wordb")
    long = b"wordya wordyb " + b" ".join(b"z%d" % i for i in range(98))
    assert {w for w in toxicity.features(long) if b"~" in w} == {b"wordy~0"}
    assert toxicity.features(long, set()) == toxicity.word_set(long) and toxicity.features(None) == toxicity.features(b" ") == set()


def test_telling_features_against_plain_counts():
    r = random.Random(3)
    pos = [{b"w%d" % r.randrange(40) for _ in range(6)} | ({b"foul"} if r.random() < 0.5 else set()) for _ in range(60)]
    unl = [{b"w%d" % r.randrange(40) for _ in range(6)} | ({b"foul"} if r.random() < 0.05 else set()) for _ in range(400)]
    want = []
    for w in sorted(set().union(*pos)):
        n, share = sum(w in x for x in pos), (sum(w in x for x in unl) + 1) / 402
        if n >= 3 and n / 60 - share >= 3.5 * (share * (1 / 60 + 1 / 400)) ** 0.5:
            want.append(w)
    assert toxicity.telling(iter(pos), iter(unl)) == want and b"foul" in want
    assert toxicity.telling(iter([]), iter(unl)) == [] == toxicity.telling(iter([set()]), iter([]))


def test_toxicity_by_beginnings_of_words(spark, table):
    """Toxic texts whose words only begin alike, with endings of their own."""
    r = random.Random(8)
    rows, labels = [], []
    for i in range(700):
        toxic = i % 7 == 0
        words = [f"{r.choice(['cloud', 'stone', 'green'])}{r.randrange(10**6)}" for _ in range(60)]
        if toxic:
            words[::6] = [f"grobi{r.choice('abcdefgh')}{r.randrange(10**6)}" for _ in words[::6]]
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    model = toxicity.train(table(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert model.beginnings and all((model.score(t.encode()) >= 0.5) == (i % 7 == 0) for i, t in rows if crc(i) % 5 == 0)
