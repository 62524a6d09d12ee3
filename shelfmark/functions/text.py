"""Text expressions. All run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates search terms, as a pattern and as characters.
SPACE = "[\\t\\n\\x0b\\f\\r \\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"
BLANKS = "".join(chr(code) for code in range(0x10000) if re.fullmatch(SPACE, chr(code)))
# Characters that can stand for a name on its cover, and the stand-in without one.
GLYPH = "[一-龥A-Za-z0-9]"
NO_GLYPH = "？"
# Multiplier and modulus of the name hash, distance of the second hue.
HUE_STEP, HUES, SECOND_HUE = 31, 360, 40


def split_terms(query: str) -> list[str]:
    """Lowered terms of a query known to the driver."""
    return [term for term in re.split(f"{SPACE}+", query.lower()) if term]


def terms(query: Column) -> Column:
    """Lowered terms of a query column."""
    return F.filter(F.split(F.lower(query), f"{SPACE}+"), lambda term: term != "")


def contains_any(text: Column, keywords: Column) -> Column:
    """Whether the text holds any of the keywords of an array column, ignoring case. Never NULL."""
    low = F.lower(text)
    return F.coalesce(
        F.exists(keywords, lambda word: F.coalesce(F.contains(low, F.lower(word)), F.lit(False))),
        F.lit(False),
    )


def contains_all(text: Column, words: Column) -> Column:
    """Whether the text holds every word of an array column as it is. Never NULL."""
    return F.coalesce(
        F.forall(words, lambda word: F.coalesce(F.contains(text, word), F.lit(False))), F.lit(False)
    )


def first_glyph(name: Column) -> Column:
    found = F.regexp_extract(name, GLYPH, 0)
    return F.when(F.length(found) > 0, found).otherwise(F.lit(NO_GLYPH))


def name_hue(name: Column) -> Column:
    """Stable hash of a name over its UTF-16 units, in 0..359."""

    def step(hue: Column, unit: Column) -> Column:
        return F.pmod(hue * HUE_STEP + unit, F.lit(HUES))

    def fold(hue: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        above = code - 0x10000
        high = F.lit(0xD800) + F.shiftright(above, 10)
        low = F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))
        return F.when(code < 0x10000, step(hue, code)).otherwise(step(step(hue, high), low))

    chars = F.filter(F.split(name, ""), lambda char: char != "")
    return F.aggregate(chars, F.lit(0).cast("bigint"), fold)


def second_hue(hue: Column) -> Column:
    return F.pmod(hue + SECOND_HUE, F.lit(HUES))


def trimmed(text: Column | str) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    clean = trimmed(text)
    return F.when(clean != "", clean)


def custom_barcode(millis: Column) -> Column:
    """Barcode given to a product entered without one."""
    return F.concat(F.lit("custom-"), F.lower(F.conv(millis.cast("string"), 10, 36)))


def minute_text(iso: Column, zone: str = "UTC") -> Column:
    """ISO text as 'yyyy-MM-dd HH:mm' on the clock of a zone, whatever zone the session has.

    A text that is no time is shown as it is.
    """
    local = F.convert_timezone(
        F.current_timezone(), F.lit(zone), F.try_to_timestamp(iso).cast("timestamp_ntz")
    )
    return F.coalesce(F.date_format(local, "yyyy-MM-dd HH:mm"), iso)


def iso_text(ts: Column) -> Column:
    """Timestamp as ISO text with milliseconds and a trailing Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
