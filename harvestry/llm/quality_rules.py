"""Learned decision lists over text statistics, in Spark expressions only.

Sequential covering grows one conjunction of thresholds after the other against the low-quality
class, prunes each on rows it was not grown on, and emits the list as one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.samples import agreed
from harvestry.scratch import materialise

_WORD = r"[^\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Ratios that the rules test, from the counts of text_statistics().
FEATURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "capitals_share": "n_capitals / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}


def _named(value: Column, use) -> Column:
    """use(value), with value computed once though used more than once inside."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, keys: Column) -> Column:
    """Words of an array that lie in a window of three words found at least twice.

    keys is the sorted array of one long for each window: high bits of its hash, low bits its
    place. Windows whose high bits are alone are unique. The others, few as a rule, are sorted by
    their words themselves, so that no hash decides.
    """
    shift = _place_bits(words)

    def doubtful(s: Column) -> Column:
        high = lambda i: F.call_function("shiftright", F.get(s, i), shift)
        return F.filter(s, lambda x, i: (high(i) == high(i - 1)) | (high(i) == high(i + 1)))

    def exact(c: Column) -> Column:
        place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1).cast("int")
        window = lambda p: F.struct(F.get(words, p).alias("a"), F.get(words, p + 1).alias("b"), F.get(words, p + 2).alias("c"), p.alias("p"))
        rows = F.sort_array(F.transform(c, lambda x: window(place(x))))
        same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        twice = lambda r: F.filter(r, lambda x, i: F.coalesce(same(x, F.get(r, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(r, i + 1)), F.lit(False)))
        places = F.sort_array(F.transform(_named(rows, twice), lambda x: x["p"]))
        # each window adds the words that the one before it doesn't cover
        add = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).cast("long").alias("n"), p.alias("last"))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, add, lambda acc: acc["n"])

    return F.when(F.size(keys) == 0, F.lit(0).cast("long")).otherwise(_named(_named(keys, doubtful), exact))


def _place_bits(words: Column) -> Column:
    return F.ceil(F.log2(F.size(words) + F.lit(2.0))).cast("int")


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and counts of every whole text (null or empty: all 0): n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, n_capitals (A-Z), n_marks (! and ?).

    Only id and text are read, so other columns never clash; repeated rows stay repeated.
    """
    base = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    words = base.select(
        "*",
        F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    shift = _place_bits(F.col("words"))

    def packed(i: Column) -> Column:
        h = F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
        return F.call_function("shiftleft", h, shift).bitwiseOR(i.cast("long"))

    windows = F.when(F.size("words") < 3, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))))
    keyed = words.withColumn("keys", F.sort_array(F.transform(windows, packed)))
    long = lambda c, name: c.cast("long").alias(name)
    gone = lambda chars: F.length("t") - F.length(F.translate("t", chars, ""))
    return keyed.select(
        "id",
        long(F.size("words"), "n_words"),
        long(F.length("t") - F.length(F.regexp_replace("t", _WORD, "")), "word_chars"),
        long(gone(_SYMBOLS), "n_symbols"),
        long(F.size("lines"), "n_lines"),
        long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
        long(repeated_words(F.col("words"), F.col("keys")), "n_repeat_words"),
        long(gone(_UPPER), "n_capitals"),
        long(gone("!?"), "n_marks"),
    )


@dataclass(frozen=True)
class Rule:
    """Tests (feature, ">=" or "<", threshold) that all hold: low quality."""

    tests: tuple[tuple[str, str, float], ...]

    def sql(self) -> str:
        return " AND ".join(f"({FEATURES[f]}) {op} {t!r}" for f, op, t in self.tests) or "true"


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """FOIL's gain of narrowing (p0, n0) to (p, n) covered rows of the low and the high class."""
    return p * (math.log2((p + 1e-9) / (p + n + 1e-9)) - math.log2((p0 + 1e-9) / (p0 + n0 + 1e-9)))


def learn_rules(stats: DataFrame, labels: DataFrame, bins: int = 24, max_rules: int = 8, max_tests: int = 3, min_rows: int = 8, precision: float = 0.6) -> list[Rule]:
    """An ordered list of rules for quality 0, learned from stats (id, counts) and labels (id, quality).

    Thresholds are quantiles of the labelled rows and of the low-quality ones. Each step of
    growing is one aggregation whose result has a row for each feature and bin, whatever the
    number of rows. A third of the labelled rows, chosen by a hash of the id, only prunes: tests
    are dropped from the end while (p - n) / (p + n) there doesn't fall, and a rule whose precision
    on all labelled rows stays under `precision` ends the list. Null labels, and ids with both, are left out; without
    rows of both classes there are no rules.
    """
    seen = agreed(labels, "quality").select(F.col("sid").alias("lid"), F.col("y").alias("quality"))
    named = [F.expr(sql).alias(f) for f, sql in FEATURES.items()]
    rows = materialise(
        stats.join(seen, F.col("id") == F.col("lid")).select(*named, (F.col("quality") == 0).alias("low"), (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("prune")), "labelled"
    )
    probabilities = [(i + 0.5) / bins for i in range(bins)]
    cuts: dict[str, list[float]] = {}
    quantiles = rows.agg(*[F.percentile_approx(F.when(F.col("low") | F.lit(every), F.col(f)), probabilities, 2000).alias(f"{f}{every:d}") for f in FEATURES for every in (False, True)]).first()
    for f in FEATURES:
        cuts[f] = sorted({x for e in "01" for x in quantiles[f + e] or ()})
    if not any(cuts.values()):
        return []
    totals = {r["low"]: r["n"] for r in rows.groupBy("low").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return []

    def place(f: str) -> Column:
        """How many thresholds of f the value reaches."""
        return sum((F.when(F.col(f) >= c, 1).otherwise(0) for c in cuts[f]), F.lit(0))

    binned = materialise(rows.select(*FEATURES, "low", "prune", F.array(*[F.struct(F.lit(f).alias("f"), place(f).alias("b")) for f in FEATURES if cuts[f]]).alias("places")), "binned")

    def matches(tests) -> Column:
        out = F.lit(True)
        for f, op, t in tests:
            out = out & (F.col(f) >= t if op == ">=" else F.col(f) < t)
        return out

    def count(condition: Column) -> tuple[float, float]:
        r = left.filter(condition).agg(F.count_if("low").alias("p"), F.count_if(~F.col("low")).alias("n")).first()
        return r["p"], r["n"]

    rules: list[Rule] = []
    left = binned
    while len(rules) < max_rules:
        tests: tuple = ()
        p0, n0 = count(~F.col("prune"))
        while p0 >= min_rows and n0 and len(tests) < max_tests:
            table = (
                left.filter(~F.col("prune") & matches(tests)).select("low", F.explode("places").alias("x")).groupBy("x.f", "x.b").agg(F.count_if("low").alias("p"), F.count_if(~F.col("low")).alias("n")).collect()
            )
            best = None
            for f in FEATURES:
                cells = {r["b"]: (r["p"], r["n"]) for r in table if r["f"] == f}
                below = [0, 0]
                for i, cut in enumerate(cuts[f]):
                    below = [a + b for a, b in zip(below, cells.get(i, (0, 0)), strict=True)]
                    for op, p, n in ((">=", p0 - below[0], n0 - below[1]), ("<", *below)):
                        if p >= min_rows and p + n < p0 + n0 and (best is None or _gain(p, n, p0, n0) > best[0]):
                            best = (_gain(p, n, p0, n0), (f, op, cut), p, n)
            if best is None or best[0] <= 0:
                break
            tests, p0, n0 = (*tests, best[1]), best[2], best[3]
        if not tests:
            break
        held = [F.col("prune") & matches(tests[:k]) for k in range(1, len(tests) + 1)]
        found = left.agg(*[F.count_if(c & (F.col("low") == low)).alias(f"{low:d}{k}") for k, c in enumerate(held, 1) for low in (True, False)]).first()
        worth = [(found[f"1{k}"] - found[f"0{k}"]) / max(1, found[f"1{k}"] + found[f"0{k}"]) for k in range(1, len(tests) + 1)]
        while len(tests) > 1 and worth[len(tests) - 2] >= worth[len(tests) - 1]:
            tests = tests[:-1]
        p, n = count(matches(tests))
        if p < min_rows or p < precision * (p + n):
            break
        rules.append(Rule(tests))
        left = left.filter(~matches(tests))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that holds, else null."""
    out = F
    for i, rule in enumerate(rules, 1):
        out = out.when(F.expr(rule.sql()), F.lit(i))
    return F.lit(None).cast("int") if out is F else out


def apply_rules(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Statistics, base_failed, rule (of the list, or null) and kept of every document.

    base_failed: fewer than 50 words, or over half of them repeated. kept: neither failed nor
    caught by a learned rule. The statistics are computed once and written; learning and the
    verdict read them.
    """
    stats = materialise(text_statistics(docs), "statistics")
    rules = learn_rules(stats, labels, **how)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumnRenamed("id", "doc_id").withColumn("base_failed", failed).withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
