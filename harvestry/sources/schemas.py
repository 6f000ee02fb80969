"""Fixed schemas; nothing is ever inferred. Missing values of older data are filled on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(text: str) -> T.StructType:
    """A schema from "name type, ..", without a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(","))])


SOURCES = _schema(
    "ord int, name string, mode string, discovery string, category string, enabled boolean, display_name string, sitemap string, feed_url string, url string, "
    "index_urls array<string>, seed_file string, url_pattern string, rehost_author string, backfill_limit int, max_new_per_run int, request_delay_seconds double, user_agent string"
)
#: What was fetched: stands between the engine and the network.
DOCUMENTS = _schema("url string, kind string, body string, bytes binary, ok boolean")
#: The two halves of a store of documents.
TEXTS = _schema("url string, body string")
CONTENTS = _schema("url string, bytes binary")
REFS = _schema("source string, ord bigint, ref string, date_hint timestamp, dedup_key string")
CATALOG = _schema(
    "seq bigint, dedup_key string, source string, source_url string, page_url string, mode string, category string, saved_via string, title string, text string, author string, "
    "cuisine string, categories array<string>, ingredients string, instructions string, notes string, nutrition string, yield_ string, prep_time string, cook_time string, "
    "total_time string, prep_minutes int, cook_minutes int, total_minutes int, image_url string, local_image string, published_at timestamp, discovered_at timestamp, "
    "content_hash string, last_seen_at timestamp, in_feed boolean, backfill boolean"
)
FAILURES = _schema("dedup_key string, source string, source_url string, attempts int, last_attempt timestamp, next_retry timestamp")

#: The lists of feeds that a build keeps: whole rows of the catalog.
TOPS = T.StructType([*_schema("feed string, rank int, cut boolean"), *CATALOG])

MODES = ("link_through", "rehost")
DISCOVERIES = ("sitemap", "native_feed", "index_page", "chef_page", "seed_list", "saved_items")
CATEGORIES = ("recipe", "cocktail")
_REQUIRED = ("dedup_key", "source", "source_url", "mode")
_DEFAULTS = {"string": "", "boolean": False}


def conform(df: DataFrame, schema: T.StructType = CATALOG) -> DataFrame:
    """df in the columns of schema: missing ones and null texts and flags get their defaults.

    The four columns without which a record has no identity must be there.
    """
    missing = [c for c in _REQUIRED if c in schema.names and c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = []
    for field in schema:
        kind = field.dataType.simpleString()
        value = F.col(f"`{field.name}`").cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if kind in _DEFAULTS and field.name not in _REQUIRED:
            value = F.coalesce(value, F.lit("recipe" if field.name == "category" else _DEFAULTS[kind]))
        elif kind == "array<string>":
            value = F.coalesce(value, F.array().cast(kind))
        out.append(value.alias(field.name))
    return df.select(*out)
