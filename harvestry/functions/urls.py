"""Column functions over addresses and the keys made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestry.functions.text import strip, text_of

#: Scheme, authority, path and query of an address (RFC 3986, appendix B).
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"

#: Addresses, as most are, that are in their one form but for slashes at the end: without a query, in lower case up to the path.
_PLAIN = r"^[a-z][a-z0-9+.-]*://[a-z0-9._:-]*/[!-\"$->@-~]*[!-\"$-.0->@-~]/*\z"

# Query parameters that say where a visitor came from.
TRACKING = ("fbclid", "gclid", "igshid", "ref", "mc_cid", "mc_eid")
TRACKING_PREFIXES = ("utm_", "mc_")

#: Between the fields of a content hash.
FIELD_MARK = "␟"


def canonical_url(url: Column) -> Column:
    """One form for all spellings of an address: scheme and host in lower case, no slash at the end
    of the path, no tracking parameters or fragment, the others sorted. "" for null and "". One that
    has this form but for such slashes is found by one pattern and not taken apart.
    """
    bare = F.regexp_replace(strip(text_of(url)), "[\t\r\n]", "")
    part = lambda i: F.regexp_extract(bare, _PARTS, i)
    scheme = F.coalesce(F.nullif(F.lower(part(1)), F.lit("")), F.lit("https"))
    host = F.lower(part(2))
    path = F.coalesce(F.nullif(F.regexp_replace(part(3), "/+$", ""), F.lit("")), F.lit("/"))
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    noise = lambda p: name(p).isin(*TRACKING) | name(p).rlike(f"^({'|'.join(TRACKING_PREFIXES)})")
    query = F.array_join(F.array_sort(F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~noise(p))), "&")
    rooted = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    return F.when(text_of(url).rlike(_PLAIN), F.rtrim(url, F.lit("/"))).when(text_of(url) == "", "").otherwise(F.concat(scheme, F.lit("://"), host, rooted, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def dedup_key(source: Column, url: Column) -> Column:
    """Source and address in one form, hashed: two spellings of an address are one item of a source."""
    return F.sha1(F.concat_ws("|", text_of(source), canonical_url(url)).cast("binary"))


def content_hash(title: Column, ingredients: Column, instructions: Column, image_url: Column) -> Column:
    """Tells whether what a reader sees of an item has changed."""
    return F.sha1(F.concat_ws(FIELD_MARK, *[text_of(c) for c in (title, ingredients, instructions, image_url)]).cast("binary"))


def origin(url: Column) -> Column:
    return F.regexp_extract(url, "^(https?://[^/]+)", 1)


def absolutize(base: Column, href: Column) -> Column:
    """href as an address of its own, without query and fragment; what isn't http stays as it is."""
    bare = F.substring_index(F.substring_index(href, "#", 1), "?", 1)
    full = F.when(F.startswith(bare, F.lit("//")), F.concat(F.lit("https:"), bare)).when(F.startswith(bare, F.lit("/")), F.concat(origin(base), bare)).otherwise(bare)
    web = F.startswith(bare, F.lit("/")) | F.startswith(bare, F.lit("http"))
    slashes = F.length(full) - F.length(F.translate(full, "/", ""))
    return F.when(web & F.endswith(full, F.lit("/")) & (slashes > 3), F.regexp_replace(full, "/+$", "")).otherwise(full)


def shortcode(url: Column) -> Column:
    """The post's code in an address of a photo-sharing site."""
    return F.regexp_extract(text_of(url), r"instagram\.com/(?:p|reel|tv)/([A-Za-z0-9_-]+)", 1)


def saved_ref(item_id: Column, scheme: str = "saved") -> Column:
    """The address that stands for a saved item, made of its id alone."""
    return F.concat(F.lit(f"{scheme}://item/"), item_id)
