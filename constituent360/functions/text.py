"""Normalisation of contact fields. Every function takes and returns a Column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Role mailboxes that never identify one person (matching rule).
GENERIC_EMAIL_PREFIXES = (
    "info@", "admin@", "support@", "contact@", "hello@",
    "noreply@", "no-reply@", "webmaster@", "postmaster@",
)

# The shorter list used when a canonical e-mail is chosen.
SURVIVOR_GENERIC_PREFIXES = ("info@", "admin@", "support@")

# Address abbreviations, applied in this order to whole words.
ADDRESS_WORDS = (
    ("street", "st"),
    ("str", "st"),
    ("avenue", "ave"),
    ("av", "ave"),
    ("road", "rd"),
    ("drive", "dr"),
    ("boulevard", "blvd"),
    ("lane", "ln"),
    ("court", "ct"),
    ("apartment", "apt"),
    ("unit", "apt"),
    ("suite", "ste"),
    ("north", "n"),
    ("south", "s"),
    ("east", "e"),
    ("west", "w"),
)

_WHITESPACE = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, tabs and line breaks included."""
    return F.btrim(c, F.lit(_WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """An empty string counts as missing everywhere in the matcher."""
    return F.nullif(c, F.lit(""))


def norm_email(c: Column) -> Column:
    return blank_to_null(strip(F.lower(c)))


def norm_name(c: Column) -> Column:
    return blank_to_null(strip(c))


def norm_phone(c: Column) -> Column:
    """Ten national digits, or the text as given when it does not hold ten."""
    national = F.regexp_extract(F.regexp_replace(c, r"[^0-9]", ""), r"^1?([0-9]{10})$", 1)
    return blank_to_null(F.coalesce(F.nullif(national, F.lit("")), c))


def norm_zip(c: Column) -> Column:
    return blank_to_null(F.substring(c, 1, 5))


def starts_with_any(c: Column, prefixes) -> Column:
    return c.rlike("^(?:" + "|".join(re.escape(p) for p in prefixes) + ")")


def is_generic_email(c: Column, prefixes=GENERIC_EMAIL_PREFIXES) -> Column:
    """True for a missing address or a role mailbox."""
    return F.coalesce(starts_with_any(F.lower(F.nullif(c, F.lit(""))), prefixes), F.lit(True))


def name_tokens(full: Column) -> Column:
    return F.split(strip(full), r"\s+")


def name_parts(first: Column, last: Column, full: Column) -> Column:
    """struct(first, last) in lower case; a full name stands in when either part is missing."""
    both = (F.coalesce(first, F.lit("")) != "") & (F.coalesce(last, F.lit("")) != "")
    tokens = name_tokens(full)
    has_full = F.coalesce(strip(full), F.lit("")) != ""
    first_part = (
        F.when(both, F.lower(first)).when(has_full, F.lower(tokens[0])).otherwise("")
    )
    last_part = (
        F.when(both, F.lower(last))
        .when(has_full & (F.size(tokens) >= 2), F.lower(F.element_at(tokens, -1)))
        .otherwise("")
    )
    return F.struct(first_part.alias("first"), last_part.alias("last"))


def norm_address(c: Column) -> Column:
    """Lower-case street line with standard abbreviations and no punctuation; '' when missing."""
    # no short form is a word of the list, so one pass over the words replaces them all
    shorter = F.create_map(*[F.lit(x) for pair in ADDRESS_WORDS for x in pair])
    words = F.split(strip(F.lower(F.coalesce(c, F.lit("")))), r"\b")
    out = F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(shorter, w), w)), "")
    out = F.regexp_replace(out, r"[,.]", "")
    return strip(F.regexp_replace(out, r"\s+", " "))


def email_domain(c: Column) -> Column:
    return F.when(c.contains("@"), F.substring_index(c, "@", -1)).otherwise("")


def record_key(source_system: Column, source_id: Column) -> Column:
    return F.concat(source_system, F.lit(":"), source_id)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(
        F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))
    )


def phone_block(phone: Column) -> Column:
    """Numbers can only agree when this key agrees: the last seven digits, or a short number whole."""
    return F.when(F.length(phone) >= 7, F.substring(phone, -7, 7)).otherwise(phone)


def phonetic_match(a: Column, b: Column) -> Column:
    return F.soundex(a) == F.soundex(b)


def parse_attributes(c: Column) -> Column:
    """Free-form event attributes held as JSON text, as a string map."""
    return F.from_json(c, "map<string,string>")


def attributes(c: Column) -> Column:
    """The same as a variant of any depth; null where the text is missing or is not JSON."""
    return F.try_parse_json(c)


def attribute(attrs: Column, path: str, kind: str = "string") -> Column:
    """A value inside a variant; null where the path leads nowhere, at a JSON null, and where the value is not of the kind."""
    return F.try_variant_get(attrs, path, kind)


def with_attributes(df: DataFrame, text: str, paths: dict[str, tuple[str, str]], well_formed: str = "well_formed") -> DataFrame:
    """Every row with one column per (path, kind), read from one parse of the text, and whether the text is JSON: false where
    it is malformed, null where it is missing. Rows are kept whatever their text holds; columns of the same names are replaced."""
    parsed = df.withColumn("_attrs", attributes(F.col(text)))
    found = {name: attribute(F.col("_attrs"), path, kind) for name, (path, kind) in paths.items()}
    return parsed.withColumns({**found, well_formed: F.when(F.col(text).isNotNull(), F.col("_attrs").isNotNull())}).drop("_attrs")
