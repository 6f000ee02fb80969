"""Fill-in-middle against plain slicing of strings."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from harvestry.llm import fill_middle, queries
from harvestry.llm.fill_middle import Recipe


def plain_draws(key, seed=1):
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def plain(key, text, units=list):
    """(n, form, prefix, middle, output) by lists of units."""
    text = text or ""
    parts, h = units(text), plain_draws(key)
    n = len(parts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (parts[:a], parts[a:b], parts[b:]))
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_select_by_halving():
    r = random.Random(3)
    for width in (1, 2, 3, 17, 64, 1000, 4097):
        bits = r.getrandbits(width)
        places = [i for i in range(width) if bits >> i & 1]
        for rank, place in enumerate(places):
            assert fill_middle.select(bits, rank, width) == place
        assert fill_middle.select(bits, len(places), width) == width
    assert fill_middle.select(0, 0, 0) == 0


def test_masks_mark_units():
    r = random.Random(4)
    alphabet = ["a", "Z", " ", "\n", "\t", "é", "中", "\U0001f372", "́", "\r"]
    for _ in range(300):
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(40)))
        body = text.encode()
        assert fill_middle.code_points(body).bit_count() == len(text)
        assert fill_middle.lines(body).bit_count() == len(re.findall(r"[^\n]*\n|[^\n]+", text))
        found = re.findall(r"^[ \t\n\r]+|[^ \t\n\r]+[ \t\n\r]*", text)
        assert fill_middle.words(body).bit_count() == len(found) and "".join(found) == text
        starts, n = fill_middle.code_points(body), len(text)
        for _ in range(5):
            a, b = sorted((r.randrange(n + 1), r.randrange(n + 1)))
            assert [p.decode() for p in fill_middle.cut(body, starts, n, a, b)] == [text[:a], text[a:b], text[b:]]


def rows_of(out):
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return out.select("row.*", F.col("n").alias("units"), F.col("form").alias("the_form"), "prefix_units", "middle_units", "output", back.alias("back")).collect()


def test_whole_table_against_slicing(spark, table, odd):
    r = random.Random(5)
    bits = ["<", "P", ">", "S", "M", "<P", "<<S>", "<M>", "é", "\U0001f372", "x y", "\n", "<S", "M>"]
    rows = odd + [(i, "".join(r.choice(bits) for _ in range(r.randrange(12)))) for i in range(100, 500)]
    got = fill_middle.transform(table([(i, t) for i, t in rows]))
    seen = set()
    for row in spark.createDataFrame(rows, "doc_id bigint, text string").collect():
        seen.add(plain(row.doc_id, row.text)[1])
    assert seen == {"plain", "psm", "spm"}
    found = sorted(((x.doc_id, x.text, x.units, x.the_form, x.prefix_units, x.middle_units, x.output, x.back) for x in rows_of(got)), key=repr)
    wanted = sorted(((i, t, *plain(i, t), t or "") for i, t in rows), key=repr)
    assert found == wanted


@pytest.mark.parametrize(("unit", "units"), [("word", lambda t: re.findall(r"^[ \t\n\r]+|[^ \t\n\r]+[ \t\n\r]*", t)), ("line", lambda t: re.findall(r"[^\n]*\n|[^\n]+", t))])
def test_other_units(spark, table, odd, unit, units):
    got = rows_of(fill_middle.transform(table(odd), Recipe(unit=unit)))
    assert sorted(((x.doc_id, x.output, x.units) for x in got), key=repr) == sorted(((i, plain(i, t, units)[4], plain(i, t, units)[0]) for i, t in odd), key=repr)


def test_shares_and_seeds(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abcdefghij").alias("text"))
    shares = {r.form: r["count"] / 4000 for r in fill_middle.transform(docs).groupBy("form").count().collect()}
    assert abs(shares["plain"] - 0.1) < 0.03 and abs(shares["spm"] - 0.18) < 0.03
    some = {r.form for r in fill_middle.transform(docs, Recipe(plain_percent=0, spm_percent=100)).select("form").distinct().collect()}
    assert some == {"spm"}
    one, two = (fill_middle.transform(docs, Recipe(seed=s)).agg(F.sum(F.xxhash64("output") % 1000)).first()[0] for s in (1, 2))
    assert one != two


def test_very_long_text_and_odd_tables(spark, table):
    long = "né中\U0001f372 " * 400_000
    x = rows_of(fill_middle.transform(table([(3, long)])))[0]
    assert (x.units, x.the_form, x.prefix_units, x.middle_units, x.output) == plain(3, long) and x.back == long
    assert fill_middle.transform(table([]).limit(0)).count() == 0
    clash = spark.createDataFrame([(1, "abc", "z", "y", 4)], "doc_id bigint, text string, form string, output string, n int")
    out = fill_middle.with_examples(clash)
    assert out.columns == [*clash.columns, "_form", "_output"] and out.first()["form"] == "z"
    with pytest.raises(ValueError):
        fill_middle.transform(clash, Recipe(unit="sentence"))


def test_query_against_slicing(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["", None, "abc", "a<P>b", "né中\U0001f372 " * 50, "one\r\ntwo"] * 30)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = []
    for i, t in rows:
        n, form, a, b, output = plain(i, t)
        wanted.append((i, n, form, a, b, sha(output), sha(t or "")))
    assert sorted(map(tuple, queries.op11_fill_middle(spark, str(tmp_path)).collect())) == sorted(wanted)
