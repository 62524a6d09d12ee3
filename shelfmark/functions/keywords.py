"""Which keyword groups a text matches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Groups = Sequence[Sequence[str]]
#: Up to so many words are looked for one by one. Longer words than that many characters always are.
FEW = 8
LONGEST = 100
END = ""


def any_of(low: Column, words: Sequence[str]) -> Column:
    """Whether a lowered text holds one of the words. Never NULL."""
    tests = [low.contains(word) for word in words]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False)) if tests else F.lit(False)


def all_of(low: Column, words: Sequence[str]) -> Column:
    """Whether a lowered text holds every word; true without words. Never NULL."""
    tests = [low.contains(word) for word in words]
    return F.coalesce(reduce(Column.__and__, tests), F.lit(False)) if tests else F.lit(True)


def word_tree(words: Sequence[str]) -> dict:
    """The words as a prefix tree: a character leads to what may follow it, END is where a word ends.

    A word that holds another one adds nothing, as the other is found wherever it is.
    """
    known = set(words)
    root: dict = {}
    for word in known:
        parts = (word[i:j] for i in range(len(word) + 1) for j in range(i, len(word) + 1) if j - i < len(word))
        if any(part in known for part in parts):
            continue
        node = root
        for char in word:
            node = node.setdefault(char, {})
        node[END] = {}
    return root


def _pattern(node: dict) -> str:
    """The tree as a pattern: what words have in common at their start is tried once."""
    if END in node:
        return ""
    followed = {char: _pattern(rest) for char, rest in sorted(node.items())}
    last = "".join(_escaped(char) for char, rest in followed.items() if not rest)
    ways = [_escaped(char) + rest for char, rest in followed.items() if rest]
    if last:
        ways.append(f"[{last}]")
    return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"


def _escaped(char: str) -> str:
    return char if char.isalnum() else f"\\x{{{ord(char):x}}}"


def matches(low: Column, words: Sequence[str]) -> Column:
    """As :func:`any_of`, for any number of words: many are looked for at once, by their prefix tree."""
    tree = [word for word in words if len(word) <= LONGEST]
    if len(set(tree)) <= FEW:
        return any_of(low, words)
    found = low.rlike(_pattern(word_tree(tree)))
    return F.coalesce(reduce(Column.__or__, [low.contains(w) for w in words if len(w) > LONGEST], found), F.lit(False))


def _hits(low: Column, groups: Groups, every: bool) -> Column:
    """Positions of the groups that a lowered text matches."""
    test = all_of if every else matches
    none = F.array().cast("array<int>")
    return F.concat(*[F.when(test(low, words), F.array(F.lit(i))).otherwise(none) for i, words in enumerate(groups)])


def where_once(df: DataFrame, condition: Column) -> DataFrame:
    """Filter by a condition that uses a costly column several times.

    The optimizer would move a plain filter below that column, and there compute it anew for every use.
    It does not do so with the outcome of an explode.
    """
    kept = df.withColumn("_kept", F.explode_outer(F.when(condition, F.array(F.lit(True)))))
    return kept.where(F.col("_kept").isNotNull()).drop("_kept")


def explode_hits(df: DataFrame, hits: Column | str, out: str) -> DataFrame:
    """One row per hit.

    A plain explode would make the optimizer filter empty arrays before it, and so match every text twice.
    """
    return df.withColumn(out, F.explode_outer(hits)).where(F.col(out).isNotNull())


def with_hits(
    df: DataFrame, text: Column, groups: Groups, out: str, every: bool = False, lowered: bool = False
) -> DataFrame:
    """Adds the positions of the groups that a text matches, ignoring case, in ascending order.

    A group matches by one of its words, or with ``every`` only by all of them. An empty word is in
    every text, but nothing is in a NULL text. ``lowered`` takes the text as it is. A few words are looked for
    one by one, many at once by one pattern a group.
    """
    groups = [tuple(word.lower() for word in group) for group in groups]
    low = "_low"
    df = df.withColumn(low, text if lowered else F.lower(text))
    if not groups:
        return df.withColumn(out, F.array().cast("array<int>")).drop(low)
    return df.withColumn(out, _hits(F.col(low), groups, every)).drop(low)
