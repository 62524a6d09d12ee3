"""Transliterated search keys of names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control characters, which no reading holds: between the entries of a table, and for a missing entry.
BETWEEN, NO_ENTRY = "\x1e", "\x1f"
#: Entries that are replaced one after the other; of more than one letter, by way of characters for private use.
FEW = 16
CHAIN = 32
STAND_INS = 0xE000


def load_dictionary(entries: DataFrame) -> dict[str, str]:
    """``(char, reading)`` rows as a dictionary; of several readings the smallest is taken.

    Entries are for single characters, so there are never more than characters in Unicode; others are refused.
    """
    read = entries.where(F.col("reading").isNotNull())
    longer = read.where(F.coalesce(F.length("char") != 1, F.lit(True))).first()
    if longer is not None:
        raise ValueError(f"a reading belongs to one character, not to {longer['char']!r}")
    rows = read.groupBy("char").agg(F.min("reading").alias("reading")).collect()
    return {row["char"]: row["reading"] for row in rows}


def add_readings(
    df: DataFrame, dictionary: Mapping[str, str] | None, name: str = "name"
) -> DataFrame:
    """Adds ``reading`` (all characters read out) and ``initials`` (first letter of every reading).

    Characters without a reading stand for themselves. Without a dictionary both are empty.
    """
    if not dictionary:
        return df.withColumns({"reading": F.lit(""), "initials": F.lit("")})
    text = F.col(name)
    first = {char: reading[:1] for char, reading in dictionary.items()}
    return df.withColumns({"reading": F.lower(_read_out(text, dictionary)), "initials": F.lower(_read_out(text, first))})


def _read_out(text: Column, table: Mapping[str, str]) -> Column:
    """Every character replaced by its entry.

    A few are replaced one after the other, if no entry holds a character that has one. Else entries of one letter
    are translated at once, and characters with longer ones into stand-ins, which no entry holds; these are
    then replaced one after the other. A text that holds stand-ins itself, or a table of many long entries, is read
    character by character.
    """
    if len(table) <= FEW and set("".join(table.values())).isdisjoint(table):
        for char, reading in table.items():
            text = F.replace(text, F.lit(char), F.lit(reading))
        return text
    long = [char for char, reading in table.items() if len(reading) > 1]
    stand_ins = [chr(STAND_INS + i) for i in range(len(long))]
    used = set("".join(table) + "".join(table.values()))
    if len(long) > CHAIN or not used.isdisjoint(stand_ins):
        return _by_character(text, table)
    # What has no counterpart, at the end, is deleted.
    to = dict(zip(long, stand_ins, strict=True)) | {char: r for char, r in table.items() if len(r) == 1}
    gone = [char for char, reading in table.items() if not reading]
    read = F.translate(text, "".join([*to, *gone]), "".join(to.values()))
    for char, stand_in in zip(long, stand_ins, strict=True):
        read = F.replace(read, F.lit(stand_in), F.lit(table[char]))
    if not long:
        return read
    return F.when(text.rlike(f"[{stand_ins[0]}-{stand_ins[-1]}]"), _by_character(text, table)).otherwise(read)


def _by_character(text: Column, table: Mapping[str, str]) -> Column:
    """The same, character by character. The table is one constant: entries by code point."""
    codes = {ord(char): reading for char, reading in table.items()}
    low = min(codes)
    entries = [codes.get(code, NO_ENTRY) for code in range(low, max(codes) + 1)]
    by_code = F.split(F.lit(BETWEEN.join(entries)), BETWEEN)

    def read(char: Column) -> Column:
        entry = F.get(by_code, F.ascii(char) - low)
        return F.when(entry.isNull() | (entry == NO_ENTRY), char).otherwise(entry)

    chars = F.filter(F.split(text, ""), lambda char: char != "")
    return F.array_join(F.transform(chars, read), "")
