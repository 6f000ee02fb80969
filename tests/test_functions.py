from datetime import datetime

import pytest
from pyspark.sql import functions as F

from harvestry.functions import dates, text, urls

L = F.lit


@pytest.mark.parametrize(
    ("raw", "slug"),
    [("Lemon Herb Rice!", "lemon-herb-rice"), ("  Éclairs & Cream  ", "clairs-cream"), ("", "recipe"), (None, "recipe"), ("a" * 79 + " b", "a" * 79), ("---", "recipe")],
)
def test_slugify(one, raw, slug):
    assert one(text.slugify(L(raw).cast("string"))) == slug


@pytest.mark.parametrize(
    ("raw", "canonical"),
    [
        ("https://Shop.Example/Food/x/?utm_source=a#top", "https://shop.example/Food/x"),
        ("https://e.org/a?reference=42&ref=ig", "https://e.org/a?reference=42"),
        ("https://e.org?b=2&&a=1&MC_x=3", "https://e.org/?a=1&b=2"),
        ("http://e.org/a b//", "http://e.org/a b"),
        ("", ""),
        (None, ""),
    ],
)
def test_canonical_url(one, raw, canonical):
    assert one(urls.canonical_url(L(raw).cast("string"))) == canonical
    assert one(urls.canonical_url(L(canonical))) == canonical  # applying it again changes nothing


def test_dedup_key(one):
    key = lambda s, u: one(urls.dedup_key(L(s), L(u)))
    assert key("a", "https://E.org/x/?ref=z") == key("a", "https://e.org/x")
    assert key("a", "https://e.org/x") != key("b", "https://e.org/x")
    assert len(key("a", "")) == 40


@pytest.mark.parametrize(("n", "iso", "said"), [(20, "PT20M", "20 min"), (95, "PT1H35M", "1 hr 35 min"), (60, "PT1H", "1 hr"), (0, "", ""), (None, "", "")])
def test_durations(one, n, iso, said):
    assert one(dates.iso_minutes(L(n).cast("int"))) == iso
    assert one(dates.human_duration(L(iso))) == said


def test_human_duration_passes_other_text(one):
    assert one(dates.human_duration(L("an hour"))) == "an hour"
    assert one(dates.human_duration(L(None).cast("string"))) == ""


@pytest.mark.parametrize(("raw", "n"), [("10", 10), (" 7 ", 7), ("10.5", None), ("0", None), ("-3", None), ("", None), (None, None)])
def test_minutes(one, raw, n):
    assert one(dates.minutes(L(raw).cast("string"))) == n


def test_number_minutes_are_cut(one):
    assert one(dates.number_minutes(L(10.5))) == 10


@pytest.mark.parametrize(
    ("raw", "parsed"),
    [
        ("2026-06-20", datetime(2026, 6, 20)),
        ("2026-06-21T12:00:00Z", datetime(2026, 6, 21, 12)),
        ("2026-06-21T12:00:00+02:00", datetime(2026, 6, 21, 10)),
        ("Sat, 20 Jun 2026 12:00:00 GMT", datetime(2026, 6, 20, 12)),
        ("Sat, 20 Jun 2026 12:00:00 -0500", datetime(2026, 6, 20, 17)),
        ("June 3, 2024", datetime(2024, 6, 3)),
        ("Jun 3, 2024", datetime(2024, 6, 3)),
        ("2024/06/03", datetime(2024, 6, 3)),
        ("not a date", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(one, raw, parsed):
    got = one(F.date_format(dates.parse_date(L(raw).cast("string")), "yyyy-MM-dd HH:mm:ss"))
    assert got == (parsed and parsed.strftime("%Y-%m-%d %H:%M:%S"))


def test_backoff(one):
    assert [one(dates.backoff_days(L(n))) for n in (1, 2, 3, 4, 5, 50)] == [2, 4, 8, 16, 30, 30]


def test_split_tags(one):
    assert one(text.split_tags(L("Main, Dinner"), L("dinner"), L("Quick/Easy"))) == ["Main", "Dinner", "Quick", "Easy"]
    assert one(text.split_tags(L("#Dessert"), L("a|b\nA"), L(None).cast("string"), L(" , "))) == ["Dessert", "a", "b"]


def test_ingredient_text(one):
    kind = "array<struct<purpose:string,ingredients:array<string>>>"
    groups = F.from_json(L('[{"purpose":"Dough","ingredients":["flour"," "]},{"purpose":null,"ingredients":["sugar"]}]'), kind)
    assert one(text.ingredient_text(groups, F.array(L("x")))) == "# Dough\nflour\nsugar"
    single = F.from_json(L('[{"purpose":"","ingredients":["a","b"]}]'), kind)
    assert one(text.ingredient_text(single, F.array(L("x"), L(" y ")))) == "x\ny"
    assert one(text.ingredient_text(single)) == "a\nb"
    assert one(text.ingredient_text(L(None).cast(kind))) == ""


def test_lines_and_steps(one):
    assert one(text.lines(L("a\r\nb\x0bc\u2028d\n"))) == ["a", "b", "c", "d"]
    assert one(text.lines(L(""))) == []
    assert one(text.steps(L(" one \n\n two"))) == "one\ntwo"
    assert [tuple(x) for x in one(text.ingredient_lines(L("## For it\n 2 eggs \n\n")))] == [("For it", True), ("2 eggs", False)]
    assert one(text.plain_ingredients(L("# h\na"))) == ["a"]


def test_nutrition_and_summary(one):
    facts = F.create_map(L("fatContent"), L("1 g"), L("calories"), L("9"), L("other"), L("x"), L("sugarContent"), L(""))
    assert one(text.nutrition_lines(facts)) == "Calories: 9\nFat: 1 g"
    assert one(text.summary(L("t"), L("4"), L("PT1H"), L("T"))) == "t — 4 · PT1H"
    assert one(text.summary(L(""), L(""), L(""), L("T"))) == "T"


def test_provenance_tags(one):
    tags = F.array(L("a"), L("b,c"))
    assert one(text.provenance_tags(tags, L("Saved"))) == ["Saved", "a"]
    assert one(text.provenance_tags(tags, L("a"))) == ["a"]
    assert one(text.provenance_tags(tags, L(""))) == ["a"]


def test_links_and_escapes(one):
    assert one(text.safe_link(L("javascript:x"))) == ""
    assert one(text.safe_link(L(" HTTPS://e.org "))) == "HTTPS://e.org"
    assert one(text.real_image(L(" DATA:image/gif;x"))) is False
    assert one(text.script_escape(L("</script>&"))) == "\\u003c/script\\u003e\\u0026"
    assert one(text.xml_escape(L("<a&\">"))) == "&lt;a&amp;&#34;&gt;"
    assert one(text.display_title(L("my-own_source"), L(""))) == "My Own Source"
    assert one(text.strip_emoji(L("🍲  Soup\ufe0f ✨"))) == "Soup"


@pytest.mark.parametrize(
    ("href", "full"), [("/a/b/?x#y", "https://e.org/a/b"), ("//c.org/z/", "https://c.org/z"), ("mailto:x", "mailto:x"), ("https://e.org/", "https://e.org/"), ("https://e.org/a/", "https://e.org/a")]
)
def test_absolutize(one, href, full):
    assert one(urls.absolutize(L("https://e.org/list/"), L(href))) == full


def test_shortcode_and_refs(one):
    assert one(urls.shortcode(L("https://www.instagram.com/reel/Ab_1-2/?x"))) == "Ab_1-2"
    assert one(urls.saved_ref(L("7"))) == "saved://item/7"


def test_pick_image(one):
    kind = "array<struct<kind:string,mime_type:string,url:string>>"
    media = lambda s: text.pick_image(F.from_json(L(s), kind))
    assert one(media('[{"kind":"x","mime_type":"image/png","url":"a"},{"kind":"thumbnail","url":"b"}]')) == "b"
    assert one(media('[{"kind":"thumbnail","url":""},{"mime_type":"image/png","url":"a"}]')) == "a"
    assert one(media("[]")) == ""


def test_plain_addresses_are_not_taken_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = ["https://h.org/a", "https://h.org/a//", "https://h.org//a/B", "https://h.org", "https://h.org///", "file:///a/", "https://h.org/a?", "https://h.org/a#b", "https://H.org/a", " https://h.org/a", "https://h.org/a\n", "https://h.org/é/", "ftp://h:1/~a;b=c/", "https://u@h.org/a", "", None]
    table = spark.createDataFrame([(r,) for r in rows], "u string")
    fast = urls.canonical_url(F.col("u"))
    plain = [r.u for r in table.filter(F.col("u").rlike(urls._PLAIN)).collect()]
    monkeypatch.setattr(urls, "_PLAIN", r"\z.")  # finds nothing
    assert [tuple(r) for r in table.select("u", fast).collect()] == [tuple(r) for r in table.select("u", urls.canonical_url(F.col("u"))).collect()]
    assert plain == ["https://h.org/a", "https://h.org/a//", "https://h.org//a/B", "file:///a/", "ftp://h:1/~a;b=c/"]
