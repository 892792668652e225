"""String expressions on paths, file names and HTML."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and file-name replacements.
YEAR_PATTERN = r"(20\d{2})"
NAME_REPLACEMENTS = (("2021and2023", "2023"), (".xlsx", ".csv"), (".xls", ".csv"))

# What a page is made of, in the order a parser tries it: comments, other declarations, elements whose content
# is no markup, tags, and a tag that the page ends in. Each takes its quoted values and content whole, so what looks
# like an anchor within them is none.
ATTRIBUTE = r"""[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'>])[^\s>]++)?+)?+"""
REST_OF_TAG = rf"""(?:[\s/]++|{ATTRIBUTE}|=)*+>"""
COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
DECLARATION = r"<[!?](?!--)[^>]*+(?:>|\z)|</[^a-z][^>]*+(?:>|\z)"
UNMARKED = rf"<(script|style)(?=[\s/>]){REST_OF_TAG}.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\z)|\z)"
TAG = rf"</?[a-z][^\s/>]*+{REST_OF_TAG}"
TOKEN = rf"(?is){COMMENT}|{DECLARATION}|{UNMARKED}|{TAG}|</?[a-z].*\z"
# Of a value: references by number and by name, and what lies between.
REFERENCE = r"&#[xX][0-9a-fA-F]++;?|&#[0-9]++;?|&[A-Za-z][A-Za-z0-9]*+;|&[A-Za-z][A-Za-z0-9]*+=?|[^&]++|&"


def _as_map(entries: dict[str, str]) -> Column:
    """A constant map; as text, so that a plan holds one literal and not one for each entry."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


# Names of characters as the standard library knows them, with their semicolon and, where it may lack, without.
NAMED = {f"&{name}": text for name, text in html5.items()}
# Numbers that pages mean as Windows letters; the five that have none stay.
WINDOWS = {str(n): text for n in range(128, 160) if (text := bytes([n]).decode("cp1252", "ignore"))}


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def absolute_url(base: str, href: Column) -> Column:
    """Plain concatenation; the href is not resolved against the base."""
    return F.concat(F.lit(base), href)


def first_year(text: Column) -> Column:
    """First ``20dd`` in the text, missing when there is none."""
    return F.regexp_extract(text, YEAR_PATTERN, 1).try_cast("int")


def output_name(name: Column, prefix: str = "") -> Column:
    for old, new in NAME_REPLACEMENTS:
        name = F.replace(name, F.lit(old), F.lit(new))
    return F.concat(F.lit(prefix), name) if prefix else name


def tokens(html: Column) -> Column:
    """Comments, declarations, unmarked elements and tags of a page, in order."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def anchor_tags(html: Column) -> Column:
    return F.filter(tokens(html), lambda token: token.rlike(r"(?i)^<a[\s/>]") & token.endswith(">"))


def _numbered(reference: Column) -> Column:
    """The character a number stands for."""
    digits = F.regexp_extract(reference, "[0-9a-fA-F]+", 0)
    base = F.when(F.lower(reference).startswith("&#x"), 16).otherwise(10)
    number = F.when(F.length(F.ltrim(digits, F.lit("0"))) > 10, F.lit(1 << 40)).otherwise(
        F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    )
    unknown = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(unknown, "\ufffd").otherwise(F.coalesce(_as_map(WINDOWS)[number.cast("string")], letter))


def unescaped(value: Column) -> Column:
    """An attribute value with its references decoded; a name without a semicolon counts unless an equals sign follows."""
    decoded = F.transform(
        F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0)),
        lambda part: F.when(part.rlike("^&#[xX]?[0-9a-fA-F]"), _numbered(part)).when(part.startswith("&"), F.coalesce(_as_map(NAMED)[part], part)).otherwise(part),
    )
    return F.when(value.contains("&"), F.array_join(decoded, "")).otherwise(value)


def href_of(tag: Column) -> Column:
    """Decoded href of an anchor tag, missing when the tag has none; of several the last, and empty without a value."""
    attributes = F.regexp_extract_all(F.regexp_replace(tag, r"(?i)^<a", ""), F.lit(ATTRIBUTE), F.lit(0))
    last = F.get(F.reverse(F.filter(attributes, lambda a: a.rlike(r"(?is)^href(?:\s*=|\z)"))), F.lit(0))
    value = F.regexp_replace(last, r"(?is)^href\s*=?\s*", "")
    bare = F.when(value.rlike("^[\"']"), F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return unescaped(bare)
