"""Token ids of whole texts by the tokenizers library, each pre-token encoded once per worker.

A byte-level BPE never merges across pre-tokens, so the ids of a text are those of its pre-tokens in a row. Texts
of Latin letters, digits and marks (up to U+024F) are split here by the pattern that the library uses, and their
distinct pre-tokens are encoded by the library's model in one call. Texts with other characters, or with
the string of a special token, go to the library whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache
from itertools import chain

import numpy as np

from shelfmark.llm.common import worker_memory

#: Distinct pre-tokens that a worker remembers: about 160 MB.
KNOWN = 1 << 20
_LATIN = 0x250
#: The contractions and the white space of the byte-level pre-tokenizer's pattern.
_CONTRACTIONS = "'(?:s|t|re|ve|m|ll|d)"
_SPACES = "\t-\r \x85\xa0"


def _of_kind(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_LATIN) if unicodedata.category(chr(c))[0] == kind)


@cache
def _byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary, for bytes given as Latin-1.

    Visible characters stand for themselves, the other bytes in order for the characters from U+0100 on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) if b in visible else chr(0x100 + others.index(b)) for b in range(256)}


def _in_bytes(text: str) -> str:
    return text.encode().decode("latin-1").translate(_byte_alphabet())


#: Between pre-tokens; none of theirs, as it lies beyond U+024F.
_BETWEEN = "\u0300"


@cache
def _pattern() -> re.Pattern:
    letters, numbers, spaces = _of_kind("L"), _of_kind("N"), _SPACES
    return re.compile(
        f"{_CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


class _Numbers(dict):
    """Numbers pre-tokens as they come; ``new`` are those without ids yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, token: str) -> int:
        number = len(self)
        self[token] = number
        self.new.append(token)
        return number


class Encoder:
    """Ids as little-endian bytes: 2 a token if the vocabulary allows, else 4."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self._forget()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split = parts.get("pre_tokenizer") or {}
        added = [re.escape(token["content"]) for token in parts.get("added_tokens", [])]
        self.splits = (
            split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and parts.get("normalizer") is None
            and parts["model"]["type"] == "BPE"
            and not parts["model"].get("dropout")
        )
        # Pre-tokens come once each, so the model's own cache would only cost time.
        self.model = Tokenizer(self.library.model)
        if hasattr(self.library.model, "_resize_cache"):
            self.library.model._resize_cache(0)
        self.latin = re.compile(f"[\x00-{chr(_LATIN - 1)}]*")
        self.added = re.compile("|".join(added)) if added else None

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        # The ids of all numbered pre-tokens in a row, and where those of each begin.
        self.ids = np.empty(0, self.dtype)
        self.starts = np.zeros(1, np.int64)

    def _learn(self) -> None:
        tokens = self.numbers.new
        written = _in_bytes(_BETWEEN.join(tokens)).split(_in_bytes(_BETWEEN))
        found = self.model.encode(written, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(tokens))
        self.ids = np.concatenate([self.ids, np.array(found.ids, self.dtype)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        tokens.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        pattern = _pattern()
        fast = [
            self.splits and self.latin.fullmatch(t) is not None and not (self.added and self.added.search(t))
            for t in texts
        ]
        split = [pattern.findall(t) if f else [] for t, f in zip(texts, fast, strict=True)]
        if len(self.numbers) > KNOWN:
            self._forget()
        sizes = np.array([len(tokens) for tokens in split], np.int64)
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if self.numbers.new:
            self._learn()
        counts = self.starts[number + 1] - self.starts[number]
        before = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.starts[number] - before[:-1], counts) + np.arange(before[-1])
        raw = self.ids[at].tobytes()
        ends = before[np.concatenate([[0], np.cumsum(sizes)])] * self.dtype.itemsize
        return [
            raw[i:j] if f else self._whole(t)
            for t, f, i, j in zip(texts, fast, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        ]


def encoder(path: str) -> Encoder:
    """One per worker and file, as long as the worker's tasks encode."""
    held = worker_memory("bpe")
    if path not in held:
        held[path] = Encoder(path)
    return held[path]
