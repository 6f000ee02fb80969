"""Plain versions of what no SQL can say: risks, training steps, rules, templates, scores of shards."""

import math
import random
import zlib

import numpy as np
import pytest
import xxhash

from harvestry.llm import decontamination, quality_model, quality_rules, sharding, toxicity


def test_risk_is_near_its_least_on_a_grid():
    # one word decides; the other words are no features, as each is in one document only
    n_p, n_u, share, prior = 150, 500, 0.3, 0.2
    pos = [{b"bad", f"p{i}".encode()} for i in range(n_p)]
    unl = [({b"bad"} if i < share * n_u else set()) | {f"u{i}".encode()} for i in range(n_u)]

    def risk(w, b):
        with_word, without = np.logaddexp(0, -(w + b)), np.logaddexp(0, w + b)
        # the unlabelled: a share with the word
        negative = share * without + (1 - share) * np.logaddexp(0, b) - prior * without
        return prior * with_word + np.maximum(0, negative)

    model = toxicity.nn_pu(pos, unl, prior, steps=2000, l1=0.0)
    grid = min(risk(np.linspace(-12, 12, 481), b).min() for b in np.linspace(-12, 12, 481))
    mine = risk(model.weights[b"bad"], model.bias)
    assert mine <= grid + 0.02 and set(model.weights) == {b"bad"}
    # the plain risk, without the correction, could go below 0 for these numbers; the corrected one can't
    assert mine >= 0


def test_subword_training_step_by_step():
    texts, labels = [b"good fine words", b"\xc3\xa9t\xc3\xa9 bad", b"good bad", b""], [1, 0, 1, 0]
    buckets, dim, epochs, rate, seed = 64, 3, 2, 0.3, 5
    model = quality_model.fit(texts, labels, buckets, dim, epochs, rate, seed)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).tolist()
    weights, bias = [[0.0] * dim, [0.0] * dim], [0.0, 0.0]
    t = 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            count = {}
            for word in texts[i].split():
                for f in quality_model.word_features(word, buckets - 1):
                    count[f] = count.get(f, 0) + 1
            n = sum(count.values())
            share = {f: c / n for f, c in count.items()}
            hidden = [sum(s * vectors[f][k] for f, s in share.items()) for k in range(dim)]
            z = [sum(w * h for w, h in zip(weights[c], hidden, strict=True)) + bias[c] for c in (0, 1)]
            e = [math.exp(x - max(z)) for x in z]
            g = [x / sum(e) - (c == labels[i]) for c, x in enumerate(e)]
            step = rate * (1 - t / (epochs * len(texts)))
            t += 1
            back = [sum(g[c] * weights[c][k] for c in (0, 1)) for k in range(dim)]
            for c in (0, 1):
                weights[c] = [w - step * g[c] * h for w, h in zip(weights[c], hidden, strict=True)]
                bias[c] -= step * g[c]
            for f, s in share.items():
                vectors[f] = [v - step * s * len(share) ** 0.5 * x for v, x in zip(vectors[f], back, strict=True)]
    assert np.allclose(model.vectors, vectors) and np.allclose(model.weights, weights) and np.allclose(model.bias, bias)


def test_ngrams_are_of_code_points():
    mask = (1 << 20) - 1
    want = [zlib.crc32("<été>".encode(), 1) & mask]
    want += [zlib.crc32("<été>"[i : i + n].encode()) & mask for n in (3, 4, 5) for i in range(5 - n + 1)]
    assert quality_model.word_features("été".encode(), mask) == want
    # a Chinese word of two characters has two 3-grams with its ends, not one a byte
    assert len(quality_model.word_features("中文".encode(), mask)) == 1 + 2 + 1
    for word in (b"plain", "naïve".encode(), b"\xff\xfe"):
        assert len(quality_model.word_features(word, mask)) > 1


def test_the_first_rule_has_the_greatest_gain(spark):
    r = random.Random(9)
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks"]
    rows, labels = [], []
    for i in range(600):
        low = i % 3 == 0
        symbols = r.choice([30, 40]) if low and r.random() < 0.9 else r.choice([0, 10, 20])
        rows.append((i, 100, 500, symbols, 10, r.choice([0, 1]), 0, 50, r.choice([0, 5])))
        labels.append((i, int(not low)))
    stats = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{n} bigint" for n in names))
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    rules = quality_rules.learn_rules(stats, known)
    prune = {x.id for x in stats.selectExpr("id", "pmod(xxhash64(id), 3) = 0 as p").filter("p").collect()}
    values = {f: {x.id: x.v for x in stats.selectExpr("id", f"{sql} as v").collect()} for f, sql in quality_rules.FEATURES.items()}
    grow = [i for i, _ in labels if i not in prune]
    is_low = {i: not q for i, q in labels}
    p0, n0 = sum(is_low[i] for i in grow), sum(not is_low[i] for i in grow)

    def gain(f, op, cut):
        hit = [i for i in grow if (values[f][i] >= cut) == (op == ">=")]
        p = sum(is_low[i] for i in hit)
        n = len(hit) - p
        return p * (math.log2((p + 1e-9) / (p + n + 1e-9)) - math.log2((p0 + 1e-9) / (p0 + n0 + 1e-9))) if p >= 8 and len(hit) < len(grow) else -1.0

    best = max(((gain(f, op, cut), (f, op, cut)) for f in values for cut in sorted(set(values[f].values())) for op in (">=", "<")), key=lambda x: x[0])
    assert rules[0].tests[0] == best[1]
    # an ordered list: what a rule takes, no later one is grown on, and each holds its precision on what was left
    left = {i for i, _ in labels}
    for rule in rules:
        hit = {x.id for x in stats.filter(rule.sql()).collect()} & left
        p = sum(is_low[i] for i in hit)
        assert p >= 8 and p >= 0.6 * len(hit)
        left -= hit


def plain_template(words, i, width, head):
    """The template of a window as a tuple, from the rules; head says whether its first word opens a sentence."""
    edge = " \t\n\r.,;:!?()[]{}\"'`"

    def kind(word):
        bare = word.strip(edge)
        low = "".join(c.lower() if c.isascii() else c for c in bare)
        if low in decontamination.UNITS:
            return "unit", low, False
        digits = bare.lstrip("+-").lstrip("$")
        if digits[:1].isdigit() and digits[:1].isascii() and all(c in "0123456789.,:/%" for c in digits) and "%" not in digits[:-1] and len(bare) - len(bare.lstrip("+-")) <= 1:
            return "number", low, False
        return "", low, len(bare) > 1 and bare[0].isupper() and bare[1:].islower()

    out, plain = [], 0
    for k in range(i, i + width):
        what, low, name = kind(words[k])
        opens = head if k == i else words[k - 1].rstrip("\"')]}")[-1:] in (".", "!", "?")
        if what or (name and not opens):
            out.append(f"<{what or 'name'}>")
        else:
            out.append(low)
            plain += 1
    return tuple(out) if plain >= min(decontamination.MIN_PLAIN, width) else tuple(kind(words[k])[1] for k in range(i, i + width))


def test_windows_are_equal_where_plain_templates_are():
    r = random.Random(4)
    words = "the red hen saw 5 12.5 $3 km Anna Boris Paris end. stop! Now we 7 kg 40% of it (Tom) 'Kim' x".split()
    table = decontamination.Templates()
    seen = {}
    for _ in range(150):
        text = [r.choice(words) for _ in range(r.randrange(1, 25))]
        raw = " ".join(text).encode()
        for width in (3, 6):
            for w, places, hashes, _ in decontamination.windows(table, raw, [width], both=False):
                for at, h in zip(places.tolist(), hashes.tolist(), strict=True):
                    head = at == 0 or text[at - 1].rstrip("\"')]}")[-1:] in (".", "!", "?")
                    seen.setdefault((w, plain_template(text, at, w, head)), set()).add(h)
    assert all(len(hs) == 1 for hs in seen.values())
    assert len({next(iter(hs)) for hs in seen.values()}) == len(seen) and len(seen) > 1000


def test_slots_map_one_to_one(spark, table):
    item = "add 5 cups of flour to it then take 7 spoons of sugar for it later give 9 bowls of water with it before you add 11 pinches of salt"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")

    def found(text):
        rows = decontamination.contaminated(table([(1, text)]), items).collect()
        return rows[0].coverage if rows else 0.0

    other = item.replace("5", "50").replace("7", "70").replace("9", "90").replace("11", "110")
    assert found(item) == 1.0 and found(f"so {other} now") == 1.0
    same = item
    for n in ("11", "5", "7", "9"):
        same = same.replace(n, "8")
    # one value of the item may stand for 8, not four
    assert found(same) < 1.0


def test_rendezvous_against_plain_scores(spark):
    keys = [*range(40), 10**12, -7]
    weights = [1.0, 2.5, 1.0, 0.5]

    def plain(key):
        costs = []
        for shard, w in enumerate(weights):
            h = 42
            for value, size in ((sharding.SEED, 4), (shard, 4), (key, 8)):
                h = xxhash.xxh64(value.to_bytes(size, "little", signed=True), seed=h).intdigest()
            costs.append((-math.log(((h >> 12) + 0.5) / 2**52) / w, shard))
        return min(costs)[1]

    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", sharding.rendezvous(F.col("k"), weights).alias("s")).collect()
    assert {r.k: r.s for r in rows} == {k: plain(k) for k in keys}


@pytest.mark.parametrize("length", [3000, 5000])
def test_repeated_words_of_long_texts(table, length):
    r = random.Random(length)
    words = [r.choice("abcdefghij") + str(r.randrange(9)) for _ in range(length)]
    places = {}
    for i in range(length - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    got = quality_rules.text_statistics(table([(1, " ".join(words))])).first()
    assert got.n_repeat_words == len(covered) and got.n_words == length
