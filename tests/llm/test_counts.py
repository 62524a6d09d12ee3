"""Token counts and token files against the libraries on whole texts."""

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest_llm import in_order, sorted_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import bpe, token_counts, token_files
from shelfmark.session import fresh_dir

os.environ["TOKENIZERS_PARALLELISM"] = "false"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
LIBRARY = Tokenizer.from_file(BPE)

TEXTS = st.lists(
    st.sampled_from([" ", "  ", "a", "The", "▁", "\n", "\t", "　", "é", "漢", "😀", "</s>", "<0x0A>", "\x00", "ﬁ", "²", "'s", "'ll"])
    | st.characters(max_codepoint=0x24F)
    | st.characters(exclude_categories=["Cs"]),
    max_size=12,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_pieces_of_pre_tokens_add_up(text):
    tokens = [t.decode() for t in token_counts.pre_tokens(text.encode())]
    assert sum(token_counts.n_pieces(MODEL, [t], True)[0] for t in tokens) == len(PIECES.encode(text))


def test_the_model_can_be_split():
    assert token_counts.can_split(MODEL)


@pytest.mark.parametrize("head", [1 << 19, 5, 0])
def test_counts_match_the_library(unusual, head):
    found = token_counts.count_tokens(unusual, MODEL, limit=100, head=head)
    want = []
    for row in unusual.collect():
        text = row["text"] or ""
        n = len(PIECES.encode(text))
        want.append((row["doc_id"], len(text.encode()), n, n > 100))
    assert sorted_rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == in_order(want)


def test_whole_texts_give_the_same(unusual, monkeypatch):
    monkeypatch.setattr(token_counts, "can_split", lambda path: False)
    found = token_counts.count_tokens(unusual, MODEL)
    want = [(r["doc_id"], len(PIECES.encode(r["text"] or ""))) for r in unusual.collect()]
    assert sorted_rows(found, "doc_id", "n_tokens") == in_order(want)


def test_counts_of_nothing(nothing):
    assert token_counts.count_tokens(nothing, MODEL).count() == 0


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_match_the_library(text):
    raw = bpe.encoder(BPE).encode([text])[0]
    assert np.frombuffer(raw, "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_ids_of_all_pairs_of_latin_characters():
    rng = random.Random(0)
    kept = [chr(c) for c in range(0x250)]
    texts = ["".join(rng.choice(kept) for _ in range(400)) for _ in range(200)]
    for text, raw in zip(texts, bpe.encoder(BPE).encode(texts), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def whole_ids(rows):
    """Ids with the end, in the files' order."""
    found = {}
    for row in rows:
        found.setdefault((row["doc_id"] is None, row["doc_id"] or 0), []).append(
            LIBRARY.encode(row["text"] or "", add_special_tokens=False).ids + [0]
        )
    return found


def check_files(spark, docs):
    folder = fresh_dir(spark, "files")
    token_files.write_tokens(docs, folder, BPE)
    got = token_files.read_tokens(spark, folder).collect()
    want = whole_ids(docs.collect())
    by_id = {}
    start = 0
    for row in sorted(got, key=lambda r: r["start"]):
        assert row["start"] == start and row["n_tokens"] == len(row["ids"])
        start += row["n_tokens"]
        by_id.setdefault((row["doc_id"] is None, row["doc_id"] or 0), []).append(row["ids"])
    assert list(by_id) == sorted(by_id)
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in want.items()}
    crcs = sorted_rows(token_files.read_tokens(spark, folder, "crc32"), "doc_id", "crc32")
    assert crcs == in_order(
        (r["doc_id"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got
    )
    return folder, want


def test_files_come_back(spark, unusual, sample):
    check_files(spark, unusual)
    folder, want = check_files(spark, sample)
    some = token_files.read_documents(spark, folder, [7, 150, 10**9]).collect()
    assert {r["doc_id"]: r["ids"] for r in some} == {i: want[(False, i)][0] for i in (7, 150)}
    assert token_files.read_documents(spark, folder, []).count() == 0


def test_files_of_nothing(spark, nothing):
    check_files(spark, nothing)


def test_a_damaged_dictionary_is_noticed(spark, sample):
    folder = fresh_dir(spark, "files")
    token_files.write_tokens(sample.limit(20), folder, BPE)
    row = spark.read.parquet(f"{folder}/dictionary").first()
    spark.createDataFrame([(row["dict_hash"], bytearray(b"x"), 2)], "dict_hash string, bytes binary, width int").write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError, match="damaged"):
        token_files.read_tokens(spark, folder)
