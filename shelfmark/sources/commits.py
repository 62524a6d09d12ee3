"""Numbered commits: small JSON documents of which only one writer can make each.

A writer reads all commits, does its work, and asks for the next number. If someone else was faster, it gets nothing, and
has to look at what the other one did before it tries again.

A commit is a folder that is written whole under another name and then moved to its number. Where that number is taken,
moving puts the folder into the other one, where nobody looks. So a commit is there whole or not at all, and a writer
that dies at any moment neither leaves half a commit nor holds up others.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import Any

from pyspark.sql import SparkSession

from shelfmark.sources.files import drop, exists, listing, move, read_text, write_text

_CONTENT = "commit.json"


def _folder(path: str, number: int) -> str:
    return f"{path}/{number:012d}"


def _held(spark: SparkSession, path: str, number: int) -> dict[str, Any]:
    return json.loads(read_text(spark, f"{_folder(path, number)}/{_CONTENT}"))


def numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name, _, _ in listing(spark, path) if re.fullmatch(r"\d+", name))


def read(spark: SparkSession, path: str, number: int) -> Any:
    """The content of a commit."""
    return _held(spark, path, number)["content"]


def latest(spark: SparkSession, path: str) -> tuple[int, Any]:
    """The last commit's number and content; 0 and None before the first."""
    found = numbers(spark, path)
    return (found[-1], read(spark, path, found[-1])) if found else (0, None)


def commit(spark: SparkSession, path: str, number: int, content: Any) -> bool:
    """Write a commit, unless its number is taken. Tells whether it was written."""
    folder = _folder(path, number)
    if exists(spark, folder):
        return False
    writer = uuid.uuid4().hex
    name = f".by-{writer}"
    write_text(spark, f"{path}/{name}/{_CONTENT}", json.dumps({"writer": writer, "content": content}))
    move(spark, f"{path}/{name}", folder)
    if _held(spark, path, number)["writer"] == writer:
        return True
    drop(spark, f"{path}/{name}")
    drop(spark, f"{folder}/{name}")
    return False
