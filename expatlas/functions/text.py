"""Scalar helpers: text, dates, bins, arrays."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(col: Column, literals: list[tuple[str, str]] = ()) -> Column:
    """Lower case, literal replacements in order, trimmed."""
    out = F.lower(col)
    for old, new in literals:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def replace_phrases(col: Column, phrases: list[tuple[str, str]]) -> Column:
    """Replace phrases one after another in the given order."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in phrases])
    return F.reduce(pairs, col, lambda text, e: F.replace(text, e["k"], e["v"]))


def replace_once(col: Column, mapping: dict[str, str]) -> Column:
    """Replace all keys in one pass: what a replacement puts in is not looked at again.

    The text is split before and after every key and each piece is looked up.
    """
    keys = "|".join(re.escape(k) for k in sorted(mapping, key=len, reverse=True))
    pieces = F.regexp_extract_all(col, F.lit(f"(?s)({keys}|(?:(?!{keys}).)+)"), F.lit(1))
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(lookup, p), p)), "")


def tokens(col: Column, pattern: str = r"[\w-]+", stop: list[str] = ()) -> Column:
    """Tokens without numbers, single characters and stop words; repeats stay."""
    found = F.regexp_extract_all(col, F.lit(f"({pattern})"), F.lit(1))
    words = F.array(*[F.lit(w) for w in stop]) if stop else F.array().cast("array<string>")
    return F.filter(found, lambda w: (F.length(w) > 1) & ~w.rlike(r"^[\d.-]+$") & ~F.array_contains(words, w))


def split_bars(col: Column) -> Column:
    return F.split(col, r"\|")


def person(first: Column, last: Column, mail: Column) -> Column:
    """``First Last <mail>`` of what is known; null if nothing is."""
    address = F.when(F.nullif(mail, F.lit("")).isNotNull(), F.concat(F.lit("<"), mail, F.lit(">")))
    return F.nullif(F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")), address), F.lit(""))


def scrub_title(col: Column) -> Column:
    return F.when(F.lower(col).contains("currently private"), "not provided").otherwise(col)


def cut_left_open(col: Column, edges: list[float], labels: list[str]) -> Column:
    """Bins (a, b]; null outside."""
    out = F.lit(None).cast("string")
    for a, b, name in zip(edges[:-1], edges[1:], labels, strict=True):
        out = F.when((col > a) & (col <= b), name).otherwise(out)
    return out


def equal_bins(col: Column, low: float, high: float, n: int) -> Column:
    """Bin 1 .. n of equal width; the highest value is in the last one."""
    return F.least(F.width_bucket(col, F.lit(low), F.lit(high), F.lit(n)), F.lit(n))


def attribute_lines(attributes: Column) -> Column:
    return F.array_join(F.transform(attributes, lambda a: F.concat_ws(": ", a["name"], a["value"])), "\n")


def on_flag(col: Column) -> Column:
    return F.coalesce((col == "on").cast("int"), F.lit(0))


def resource_tier(size: Column) -> Column:
    """Memory class by order of magnitude."""
    digits = F.log10(size)
    return F.when(digits <= 3, "small").when(digits <= 6, "medium").when(digits <= 7, "large").otherwise("huge")
