import itertools
import random
import re

import numpy as np
import pytest

from harvestry.llm import decontamination, ngram_join
from harvestry.llm.components import components
from harvestry.llm.shingles import Shingler, may_be_similar, parity_sketch, prefix_length


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((top(i), top(j)))
            up[y] = x
    return sorted((i is None, i or 0, len(s), top(i) if i is not None and s else i) for i, s in sets)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in df.collect())


def near(r, text, changes):
    words = text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = "new" + str(r.randrange(10**6))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(prose, odd):
    r = random.Random(8)
    rows = [(i, prose(i, 30 + i)) for i in range(40)]
    shared = prose(999, 40)
    rows += [(100 + i, f"{shared} {prose(2000 + i, 30)}") for i in range(30)]
    for k in range(6):
        base = prose(500 + k, 90)
        rows += [(200 + 20 * k + i, near(r, base, i % 4)) for i in range(12)]
    rows += [(400 + i, "a b c") for i in range(3)] + [(410, "A  b\tC"), (411, "a b c d e"), (412, "a b c d e e")]
    return rows + odd


def test_join_against_brute_force(table, corpus):
    assert got(ngram_join.similar_documents(table(corpus))) == brute(corpus)


def test_join_in_blocks_and_without_frequent_shingles(table, corpus, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 4)
    assert got(ngram_join.similar_documents(table(corpus))) == brute(corpus)
    monkeypatch.setattr(ngram_join, "FREQUENT_IN", 10**9)
    assert got(ngram_join.similar_documents(table(corpus))) == brute(corpus)


def test_join_of_nothing(table):
    assert ngram_join.similar_documents(table([])).count() == 0
    assert got(ngram_join.similar_documents(table([(1, None), (2, "")]))) == [(False, 1, 0, 1), (False, 2, 0, 2)]


def test_merge_skip_counts_lists():
    r = random.Random(12)
    for _ in range(400):
        lists = [sorted(r.sample(range(30), r.randrange(12))) for _ in range(r.randrange(1, 9))]
        for least in (1, 2, 3, len(lists)):
            count = {x: sum(x in part for part in lists) for x in range(30)}
            want = [(x, n) for x, n in count.items() if n >= least]
            assert list(zip(*ngram_join.merge_skip(lists, least), strict=True)) == want


def test_divide_skip_finds_all_links():
    r = random.Random(3)
    sets = []
    for k in range(40):
        base = r.sample(range(10**6), r.randrange(1, 80))
        for _ in range(5):
            some = [x for x in base if r.random() > 0.06] or base
            sets.append(np.array(sorted({*some, *(r.sample(range(200), 3) if k % 2 else [])}), np.int64))
    link = lambda a, b: 100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b))

    def classes(edges):
        up = list(range(len(sets)))
        for a, b in edges:
            up = [up[a] if x == up[b] else x for x in up]
        return {frozenset(i for i, x in enumerate(up) if x == y) for y in set(up)}

    want = classes([(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if link(sets[i].tolist(), sets[j].tolist())])
    edges = ngram_join.divide_skip(sets)
    assert classes(edges) == want and all(link(sets[a].tolist(), sets[b].tolist()) for a, b in edges)
    parts = [i % 2 for i in range(len(sets))]
    across = classes([(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if parts[i] != parts[j] and link(sets[i].tolist(), sets[j].tolist())])
    assert classes(ngram_join.divide_skip(sets, parts)) == across


def test_sketches_miss_nothing():
    r = random.Random(1)
    sets = []
    for _ in range(30):
        base = r.sample(range(1 << 40), r.randrange(5, 1500))
        sets += [np.array(sorted(x for x in base if r.random() > p), np.int64) for p in (0.0, 0.05, 0.1)]
    sizes, marks = np.array([len(s) for s in sets]), [parity_sketch(s) for s in sets]
    keep = may_be_similar(sizes, marks)
    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = set(sets[i].tolist()), set(sets[j].tolist())
        if a | b and 100 * len(a & b) >= 80 * len(a | b):
            assert keep[i] and keep[j]
            p = prefix_length(len(a)), prefix_length(len(b))
            assert set(sorted(a)[: p[0]]) & set(sorted(b)[: p[1]])


def test_equal_shingles_have_equal_tokens():
    a, b = Shingler({}), Shingler({b"a": 3})
    assert len(a.tokens(b"a b c d e f")) == 2 and a.tokens(b"A B c d e")[0] == a.tokens(b"a b C d e")[0]
    assert set(b.tokens(b"x a b c d e f").tolist()) > set(b.tokens(b"a b c d e f").tolist())
    assert a.tokens(b"a b c d")[0] != a.tokens(b"a b c d d")[0] and not len(a.tokens(b" \n")) and not len(a.tokens(None))


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    found = {x.node: x.root for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: top(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


ITEMS = [
    (1, "A train leaves the old station at 60 km per hour and after 3 hours it meets Anna near the river bridge today"),
    (2, "copper tin iron zinc lead"),
    (3, None),
    (4, ""),
    (5, "12 34 56 78 90 11 22 33 44 55"),
]


def hits(spark, table, rows):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    return {r.id: r["items"] for r in decontamination.contaminated(table(rows), items).collect()}


def test_templates(spark, table, prose, odd):
    q = ITEMS[0][1]
    rows = [
        (10, f"{prose(1, 50)}. {q} {prose(2, 50)}"),
        (11, prose(3, 50) + ". " + q.replace("60", "75").replace("3", "4.5").replace("Anna", "Boris").replace("km", "mi") + " " + prose(4, 9)),
        (12, prose(5, 200)),
        (13, "we saw copper tin iron zinc lead and more"),
        (14, "copper tin iron"),
        (15, "at 1 2 3 4 5 6 7 8 9 10 11 12 13 14"),
        (16, "list 12 34 56 78 90 11 22 33 44 55 end"),
        (17, q.upper() + " " + prose(6, 20)),
        *odd,
    ]
    found = hits(spark, table, rows)
    # the copy in capitals differs at the name only
    assert found == {10: [1], 11: [1], 13: [2], 16: [5], 17: [1]}
    assert hits(spark, table, []) == {}


def test_items_found_wherever_they_start(spark, table):
    short, long = "What is the capital of France?", "Where did the old baker hide seven silver keys?"
    items = spark.createDataFrame([(1, short), (2, long), (3, "on Monday Anna sold the boat")], "item_id bigint, text string")
    rows = [
        (1, f"Question: {short} Paris"),
        (2, f"A heading\n{short}\nParis"),
        (3, f"they asked me {short}"),
        (4, short),
        (5, "In Europe Paris is the capital of France"),
        (6, "Q: " + short.replace("France", "Italy")),
        (7, "Q: Where did the old baker hide"),
        (8, "Q: " + long),
        (9, "He left. On Monday Boris sold the boat"),
    ]
    found = {r.id: (r["items"], r.coverage) for r in decontamination.contaminated(table(rows), items, coverage=0.2).collect()}
    assert {i: x for i, (x, _) in found.items()} == {1: [1], 2: [1], 3: [1], 4: [1], 6: [1], 7: [2], 8: [2], 9: [3]}
    assert found[8][1] == 1.0


def test_slots_must_agree(spark, table):
    items = spark.createDataFrame([(1, "first add 5 red beans then take 5 more beans and give 5 beans to the cook before you add 5 cups")], "item_id bigint, text string")
    same = "first add 8 red beans then take 8 more beans and give 8 beans to the cook before you add 8 cups"
    mixed = "first add 8 red beans then take 2 more beans and give 7 beans to the cook before you add 4 cups"
    got = {r.id for r in decontamination.contaminated(table([(1, same), (2, mixed)]), items).collect()}
    assert got == {1}


def test_windows_in_conflict_take_no_others(spark, table, prose):
    a, b, c = (" ".join(w for w in prose(k, 90).split() if w.isalpha())[:90].rsplit(" ", 1)[0] for k in (41, 42, 43))
    text = "{} they picked {} apples {} which they sold for {} dollars {}"
    items = spark.createDataFrame([(1, text.format(a, 5, b, 5, c)), (2, "7 red 7 dry 7 old 7 new 7 wet 7")], "item_id bigint, text string")
    rows = [(1, text.format(a, 5, b, 7, c)), (2, text.format(a, 3, b, 7, c)), (3, text.format(a, 3, b, 3, c)), (4, text.format(a, 5, b, 5, c)), (5, "1 red 2 dry 3 old 4 new 5 wet 6")]
    found = {r.id: (r["items"], r.coverage) for r in decontamination.contaminated(table(rows), items).collect()}
    n = len(text.format(a, 5, b, 5, c).split()) - 5
    assert found.keys() == {1, 2, 3, 4} and {tuple(x) for x, _ in found.values()} == {(1,)}
    assert found[3][1] == found[4][1] == 1
    assert found[1][1] == pytest.approx((n - 6) / n) and found[2][1] == pytest.approx((n - 12) / n)


def test_numbers_in_words_and_other_digits(spark, table, prose):
    text = "Tom has {} red apples and {} green pears. He eats {} apples, buys {} pears and sells {}."
    items = spark.createDataFrame(
        [(1, text.format("five", "three", "two", "six", "one")), (2, "the bus with 12 seats took 34 days to reach the 3rd town near the lake by night"), (3, "they paid two hundred and five coins for twenty-one old maps of the northern sea")],
        "item_id bigint, text string",
    )
    rows = [
        (1, prose(60, 30) + ". " + text.format("nine", "eight", "four", "ten", "three")),
        (2, text.format(9, 8, 4, 10, 3)),
        (3, text.format("９", "８", "４", "１０", "３")),
        (4, "the bus with ١٢ seats took ٣٤ days to reach the fourth town near the lake by night"),
        (5, "they paid ninety coins for 17 old maps of the northern sea"),
        (6, "they paid 3 million coins for thirty-two old maps of the northern sea"),
        (7, prose(61, 60)),
        (8, text.format("nine", "eight", "nine", "eight", "nine")),
    ]
    found = {r.id: (r["items"], r.coverage) for r in decontamination.contaminated(table(rows), items).collect()}
    assert {i: x for i, (x, _) in found.items() if i != 8} == {1: [1], 2: [1], 3: [1], 4: [2], 5: [3], 6: [3]}
    assert all(found[i][1] == 1.0 for i in range(1, 7)) and found.get(8, (0, 0.0))[1] < 1.0


def plain_contaminated(rows, items, width=6, least=0.4):
    """All items that documents of words without capitals hold, by comparing all windows of all pairs."""
    number = re.compile(r"\d+|two|three|four")

    def read(text):
        return text.split() if text else []

    def template(words):
        kinds = ["#" if number.fullmatch(w) else w for w in words]
        return tuple(words) if sum(k != "#" for k in kinds) < min(2, len(words)) else tuple(kinds)

    out = {}
    for doc, text in rows:
        d = read(text)
        for item, body in items:
            q = read(body)
            w = min(width, len(q))
            if not w:
                continue
            n, places = len(q) - w + 1, set()
            for shift in range(-n, len(d)):
                met = {}
                for i in range(n):
                    a, b = q[i : i + w], d[i + shift : i + shift + w] if i + shift >= 0 else []
                    if template(a) == template(b):
                        exact = template(a) == tuple(a) and sum(bool(number.fullmatch(x)) for x in a) > len(a) - min(2, len(a))
                        met[i] = set() if exact else {(x, y) for x, y in zip(a, b) if number.fullmatch(x)}
                pairs = set().union(*met.values()) if met else set()
                good = pairs
                if len({x for x, _ in pairs}) < len(pairs) or len({y for _, y in pairs}) < len(pairs):
                    shows = {p: sum(p in m for m in met.values()) for p in pairs}
                    asked = {p: sum(any(x == p[0] for x, _ in m) for m in met.values()) for p in pairs}
                    good = {p for p in pairs if 2 * shows[p] > asked[p] or p[0] == p[1]}
                    rank = lambda p: (shows[p], p[0] == p[1], *p)  # noqa: B023, E731
                    good = {p for p in good if not any((p[0] == r[0] or p[1] == r[1]) and rank(r) > rank(p) for r in good)}
                places |= {i for i, m in met.items() if m <= good}
            if places and len(places) / n >= least:
                out.setdefault(doc, []).append((item, len(places) / n))
    return {doc: (sorted(i for i, _ in found), max(c for _, c in found)) for doc, found in out.items()}


def test_contaminated_against_all_pairs_of_windows(spark, table):
    r = random.Random(12)
    words = "sun river stone green walk tree bird".split()
    numbers = ["1", "2", "3", "17", "two", "three", "four"]

    def text(n):
        # a word after a number in words, so that no two make one
        return " ".join(x for _ in range(n) for x in ([r.choice(numbers), r.choice(words)] if r.random() < 0.35 else [r.choice(words)]))

    items = [(i, text(r.choice([2, 5, 9, 14]))) for i in range(25)] + [(90, None), (91, "")]
    rows = []
    for i in range(120):
        q = r.choice(items[:25])[1].split()
        swap = {x: r.choice(numbers) for x in numbers}
        how = r.random()
        q = [swap[w] if w in swap and how < 0.5 else r.choice(numbers) if w in swap and how < 0.7 and r.random() < 0.4 else w for w in q]
        a, b = sorted((r.randrange(len(q) + 1), r.randrange(len(q) + 1))) if r.random() < 0.3 else (0, len(q))
        rows.append((i, " ".join([text(4), *q[a:b], text(5)])))
    got = decontamination.contaminated(table(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = plain_contaminated(rows, items)
    assert len(want) > 40 and {x.id: (x["items"], pytest.approx(x.coverage)) for x in got} == want


def test_decontaminates_a_very_long_text(spark, table, prose):
    long = prose(70, 60_000) + " " + ITEMS[0][1] + " " + prose(71, 60_000)
    assert hits(spark, table, [(1, long), (2, prose(72, 60_000))]) == {1: [1]}


def test_decontaminate_keeps_rows(spark, table, odd):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = table([*odd, (50, ITEMS[0][1]), (None, ITEMS[0][1])])
    out = decontamination.decontaminate(docs, items)
    assert out.columns == docs.columns and out.count() == len(odd)
    assert decontamination.decontaminate(docs, items.limit(0)).count() == len(odd) + 2


def test_shingles_of_a_batch_are_those_of_each_text(odd):
    import pyarrow as pa

    texts = [t.encode() if t is not None else None for _, t in odd] + [b"a b c d", b"a b c d e", b"e f g h i j", b"x", b"A b C d"]
    make = Shingler({b"a": 2, b"e": 5})
    whole = make.batch(pa.array(texts, pa.binary()))
    for text, tokens in zip(texts, whole, strict=True):
        assert np.array_equal(Shingler({b"e": 5, b"a": 2}).tokens(text), tokens)
        assert len(tokens) == len(shingles(text.decode("utf-8", "replace") if text else None)) and (np.diff(tokens) > 0).all()
    assert np.array_equal(whole[len(odd)], whole[-1])
