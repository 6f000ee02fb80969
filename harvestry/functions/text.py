"""Column functions over free text: white space, slugs, tags, steps, summaries, escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space at the ends of a text: Unicode spaces and the four separators of ASCII.
SPACE = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same, one after the other.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: What ends a line.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"

UNTITLED = "Untitled recipe"

# Nutrition keys and their labels, in the order of the lines.
NUTRIENTS = {
    "calories": "Calories",
    "proteinContent": "Protein",
    "carbohydrateContent": "Carbs",
    "fatContent": "Fat",
    "fiberContent": "Fiber",
    "sugarContent": "Sugar",
    "sodiumContent": "Sodium",
    "servingSize": "Serving size",
}


def text_of(c: Column) -> Column:
    """c with "" for null."""
    return F.coalesce(c, F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """c without white space at its ends; only these are looked at."""
    return F.btrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def lines(c: Column) -> Column:
    """The lines of a text by any line end; one at its very end starts no line."""
    found = F.split(c, LINE_END)
    last = F.size(found) - 1
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.when(F.get(found, last) == "", F.slice(found, 1, F.greatest(last, F.lit(0)))).otherwise(found))


def tidy_lines(c: Column, mark: str = "\n") -> Column:
    """Stripped, non-blank parts of a text between marks."""
    return F.filter(F.transform(F.split(text_of(c), mark), strip), lambda x: x != "")


def slugify(c: Column, most: int = 80) -> Column:
    """Lower-case ASCII letters and digits with single dashes between, `recipe` if none is left."""
    raw = F.regexp_replace(F.lower(strip(text_of(c))), "[^a-z0-9]+", "-")
    slug = F.btrim(raw, F.lit("-"))
    return F.coalesce(blank_to_null(F.rtrim(F.substring(slug, 1, most), F.lit("-"))), F.lit("recipe"))


def page_path(source: Column, title: Column, key: Column) -> Column:
    """Where an item's page lies; eight digits of its key tell equal titles apart."""
    return F.concat(F.lit("recipes/"), source, F.lit("/"), slugify(title), F.lit("-"), F.substring(key, 1, 8), F.lit(".html"))


def split_tags(*blobs: Column) -> Column:
    """Tags between commas, slashes, bars and line feeds, without #; the first spelling of each stays."""
    joined = F.concat_ws(",", *[blank_to_null(text_of(b)) for b in blobs])
    bare = lambda x: strip(F.regexp_replace(strip(x), "^#+|#+$", ""))
    tags = F.filter(F.transform(F.split(joined, "[,/\n|]+"), bare), lambda x: x != "")
    first = lambda t: F.filter(t, lambda x, i: ~F.exists(F.slice(t, 1, i), lambda y: F.lower(y) == F.lower(x)))
    return F.get(F.transform(F.array(tags), first), F.lit(0))


def provenance_tags(tags: Column, saved_via: Column) -> Column:
    """Tags without those that hold a comma, headed by where an item was saved, unless it is among them."""
    plain = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda x: ~F.contains(x, F.lit(",")))
    return F.when((text_of(saved_via) == "") | F.array_contains(plain, text_of(saved_via)), plain).otherwise(F.array_prepend(plain, saved_via))


def steps(c: Column) -> Column:
    """A text's or an array's steps as one text, a line each."""
    return F.array_join(tidy_lines(c), "\n")


def ingredient_text(groups: Column, flat: Column | None = None) -> Column:
    """Ingredients as one text, from array<struct<purpose, ingredients array<string>>>.

    With a purpose anywhere, or several groups that have ingredients, purposes become lines that
    start with #. Otherwise flat is taken, or the only group where flat is null.
    """
    full = F.filter(F.coalesce(groups, F.array().cast("array<struct<purpose:string,ingredients:array<string>>>")), lambda g: F.size(g["ingredients"]) > 0)
    tidy = lambda a: F.filter(F.transform(a, lambda x: strip(text_of(x))), lambda x: x != "")
    purpose = lambda g: strip(text_of(g["purpose"]))
    headed = lambda g: F.concat(F.when(purpose(g) == "", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("# "), purpose(g)))), tidy(g["ingredients"]))
    nothing = F.array().cast("array<string>")
    plain = F.coalesce(flat if flat is not None else F.lit(None).cast("array<string>"), F.get(full, 0)["ingredients"], nothing)
    grouped = (F.size(full) > 1) | F.exists(full, lambda g: purpose(g) != "")
    return F.array_join(F.when(grouped, F.flatten(F.transform(full, headed))).otherwise(tidy(plain)), "\n")


def ingredient_lines(c: Column) -> Column:
    """array<struct<text, is_header>> of an ingredients text."""
    head = lambda x: F.startswith(x, F.lit("#"))
    return F.transform(tidy_lines(c), lambda x: F.struct(F.when(head(x), strip(F.regexp_replace(x, "^#+", ""))).otherwise(x).alias("text"), head(x).alias("is_header")))


def plain_ingredients(c: Column) -> Column:
    return F.transform(F.filter(ingredient_lines(c), lambda x: ~x["is_header"]), lambda x: x["text"])


def nutrition_lines(facts: Column) -> Column:
    """map<string,string> of nutrition facts as labelled lines."""
    return F.concat_ws("\n", *[F.when(text_of(F.try_element_at(facts, F.lit(k))) != "", F.concat(F.lit(f"{label}: "), F.try_element_at(facts, F.lit(k)))) for k, label in NUTRIENTS.items()])


def summary(text: Column, servings: Column, total_time: Column, title: Column) -> Column:
    """What a feed says of an item: its text, then servings and time; else the title."""
    facts = blank_to_null(F.concat_ws(" · ", blank_to_null(servings), blank_to_null(total_time)))
    return F.coalesce(blank_to_null(F.concat_ws(" — ", blank_to_null(text), facts)), title)


def display_title(name: Column, display_name: Column) -> Column:
    """The display name, or the name with spaces for - and _ and a capital at the head of each run of letters."""
    return F.coalesce(blank_to_null(display_name), F.initcap(F.translate(name, "-_", "  ")))


def real_image(url: Column) -> Column:
    """Whether url is one of an image, not of inline data."""
    return (text_of(url) != "") & ~F.startswith(F.lower(strip(text_of(url))), F.lit("data:"))


def safe_link(url: Column) -> Column:
    """url if its scheme is http or https, else ""."""
    bare = strip(text_of(url))
    return F.when(bare.rlike("(?i)^https?://"), bare).otherwise("")


def script_escape(c: Column) -> Column:
    """JSON that can't end the script element it stands in."""
    out = c
    for sign, code in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")):
        out = F.replace(out, F.lit(sign), F.lit(code))
    return out


def xml_escape(c: Column) -> Column:
    out = c
    for sign, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(sign), F.lit(code))
    return out


def strip_emoji(c: Column) -> Column:
    """c without pictographs, modifiers, surrogates and format signs, and with single spaces."""
    kept = F.regexp_replace(text_of(c), r"[\p{So}\p{Sk}\p{Cs}\p{Cf}\x{FE0F}\x{1F000}-\x{1FAFF}]", "")
    return strip(F.regexp_replace(kept, f"[{SPACE}]+", " "))


def pick_image(media: Column) -> Column:
    """The first thumbnail's url, else that of the first image, else "", of array<struct<kind, mime_type, url>>."""
    has = lambda m: text_of(m["url"]) != ""
    first = lambda keep: F.get(F.filter(media, keep), F.lit(0))["url"]
    return F.coalesce(first(lambda m: (m["kind"] == "thumbnail") & has(m)), first(lambda m: F.startswith(text_of(m["mime_type"]), F.lit("image/")) & has(m)), F.lit(""))
