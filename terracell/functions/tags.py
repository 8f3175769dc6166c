"""Tag algebra on arrays of (k, v) entries and on maps. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEMBER_KINDS = {"N": 78, "W": 87, "R": 82}  # fixed values: ASCII codes
# Escapes of the text formats, in the order in which they are made.
ESCAPES = [("\\", "\\\\"), ("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\v", "\\v")]


def blank(text: Column) -> Column:
    """Nothing but characters up to U+0020."""
    return F.regexp_replace(text, r"[\x00-\x20]+", "") == ""


def tag_map(entries: Column) -> Column:
    """Sorted map without blank keys or values; the first entry of a key wins; null when empty."""
    full = F.filter(entries, lambda e: ~blank(e["k"]) & ~blank(e["v"]))
    keys = F.transform(full, lambda e: e["k"])
    first = F.filter(full, lambda e, i: F.array_position(keys, e["k"]) == i + 1)
    return F.when(F.size(first) > 0, F.map_from_entries(F.array_sort(first)))


def utf16(text: Column) -> Column:
    """Length in UTF-16 units."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("long")


def stored_size(entries: Column) -> Column:
    """Bytes that the raw entries count for: key, separator, value."""
    return F.aggregate(entries, F.lit(0).cast("long"), lambda n, e: n + utf16(e["k"]) + 1 + utf16(e["v"]))


def has(tags: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(tags, key), F.lit(False))


def has_any_case(tags: Column, key: str) -> Column:
    return F.coalesce(F.exists(F.map_keys(tags), lambda k: F.lower(k) == key), F.lit(False))


def escaped(text: Column, quote: bool = False) -> Column:
    for plain, out in [*ESCAPES, *([('"', '\\"')] if quote else [])]:
        text = F.replace(text, F.lit(plain), F.lit(out))
    return text


def hstore(tags: Column) -> Column:
    """"k"=>"v" text of a map, \\N for null."""
    pair = F.transform(F.map_entries(tags), lambda e: F.concat(F.lit('"'), escaped(e["key"], True), F.lit('"=>"'), escaped(e["value"], True), F.lit('"')))
    return F.coalesce(F.array_join(pair, ","), F.lit("\\N"))


def plain_text(text: Column) -> Column:
    """What ``escaped`` text stands for; a backslash before any other character goes."""
    kept = "\u0000"  # no text in a table has it
    text = F.replace(text, F.lit("\\\\"), F.lit(kept))
    for plain, out in ESCAPES[1:]:
        text = F.replace(text, F.lit(out), F.lit(plain))
    return F.replace(F.replace(text, F.lit("\\"), F.lit("")), F.lit(kept), F.lit("\\"))


def parse_hstore(text: Column) -> Column:
    """Map of an hstore text with escapes; the first of a repeated key counts; NULL values are null, \\N is null."""
    pattern = F.lit(r'(?s)"((?:[^"\\]|\\.)*)"\s*=>\s*(?:"((?:[^"\\]|\\.)*)"|(NULL))')
    keys, values, nulls = (F.regexp_extract_all(text, pattern, F.lit(i)) for i in (1, 2, 3))
    pairs = F.transform(F.arrays_zip(keys.alias("k"), values.alias("v"), nulls.alias("n")), lambda e: F.struct(plain_text(e["k"]).alias("k"), F.when(e["n"] == "", plain_text(e["v"])).alias("v")))
    all_keys = F.transform(pairs, lambda e: e["k"])
    first = F.filter(pairs, lambda e, i: F.array_position(all_keys, e["k"]) == i + 1)
    return F.when(text != "\\N", F.map_from_entries(first))


def marked(tags: Column, key: str, value: str, when: Column) -> Column:
    """The map with one more entry where the condition holds; a key that is there keeps its value."""
    more = F.create_map(F.lit(key), F.lit(value))
    return F.when(when & ~has(tags, key), F.coalesce(F.map_concat(tags, more), more)).otherwise(tags)


def int_array(values: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(values.cast("array<string>"), ","), F.lit("}"))


def kind_code(kind: Column) -> Column:
    return F.ascii(kind).cast("tinyint")
