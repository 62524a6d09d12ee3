"""Token counts without token ids: pieces per distinct pre-token, joined to the documents' pre-tokens.

The model's pieces hold the mark for a blank only at their start, so no piece reaches from one run of blanks and
text after it into the next: a text has as many tokens as its pre-tokens have pieces together. Every distinct
pre-token of the corpus is encoded once. A document's pre-tokens are counted in a pass over the texts that sums the
common ones at once and leaves (document, pre-token, frequency) rows of the others to a join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import chunks, in_small_batches, read_table, stage
from shelfmark.llm.vocabulary import HEAD, head_from, in_head, token_counts

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: The model's mark for a blank; a text that holds it is read as if it held blanks.
_MARK = "▁"
_PRE_TOKEN = re.compile(b" +[^ ]*")


@cache
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def can_split(path: str) -> bool:
    """Whether texts may be split at blanks: no piece has a blank after its start, and blanks and letters stay as they are."""
    model = _processor(path)
    inner = any(re.search(f"[^{_MARK}]{_MARK}", model.id_to_piece(i)) for i in range(model.get_piece_size()))
    probes = {"  a  b": f"{_MARK * 3}a{_MARK * 2}b", "ﬁ": f"{_MARK}ﬁ", "A": f"{_MARK}A", "a ": f"{_MARK}a{_MARK}"}
    return not inner and all("".join(model.encode(t, out_type=str)) == pieces for t, pieces in probes.items())


def pre_tokens(text: bytes) -> list[bytes]:
    """The text's runs of blanks and what follows each, without the first blank; the library adds one in front."""
    if not text:
        return []
    return [run[1:] for run in _PRE_TOKEN.findall(b" " + text.replace(_MARK.encode(), b" "))]


def _whole(text: bytes) -> list[bytes]:
    return [text] if text else []


def n_pieces(path: str, tokens: list[str], split: bool) -> list[int]:
    """Pieces of each pre-token; the empty one is a blank that ends a text."""
    model = _processor(path)
    # The ids of a few short strings at a time; none are kept.
    found = [len(ids) for start in range(0, len(tokens), 4096) for ids in model.encode(tokens[start : start + 4096], num_threads=1)]
    if split and "" in tokens:
        found[tokens.index("")] = len(model.encode("a ")) - len(model.encode("a"))
    return found


def count_tokens(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    head: int = HEAD,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``.

    The tokens are those of the sentencepiece model at ``path``, without begin and end. NULL is read as the empty
    text, which has none. Repeated rows and NULL ids are counted like others; other columns are not looked at.
    A model whose pieces don't respect blanks is applied to whole texts, each distinct one once. ``head`` bounds the
    pre-tokens that are broadcast; it changes the plan, not the result.
    """
    in_small_batches(docs.sparkSession)
    split = can_split(path)
    cut = pre_tokens if split else _whole
    texts = docs.select(F.col(text).cast("binary").alias("t"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = n_pieces(path, batch.column("token").to_pylist(), split)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], names=["token", "n", "pieces"])

    pieces = stage(token_counts(texts, cut).mapInArrow(encode, "token string, n long, pieces long"), "pre-tokens")
    start = head_from(pieces, head)
    common = pieces.filter(in_head(start)).select("token", "pieces").toArrow()
    known = dict(zip((t.encode() for t in common.column(0).to_pylist()), common.column(1).to_pylist(), strict=True))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def sum_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows, sizes, sums, ends, tokens, times = [], [], [], [0], [], []
            for part in chunks(batch.column("t").to_pylist()):
                for content in part:
                    total = 0
                    for token, n in Counter(cut(content)).items():
                        found = known.get(token)
                        if found is None:
                            tokens.append(token)
                            times.append(n)
                        else:
                            total += n * found
                    rows.append(row)
                    row += 1
                    sizes.append(len(content))
                    sums.append(total)
                    ends.append(len(tokens))
            others = pa.StructArray.from_arrays(
                [pa.array(tokens, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], names=["token", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(rows, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), others),
                ],
                names=["doc_id", "row", "n_bytes", "known", "others"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = stage(
        rows.mapInArrow(
            sum_known,
            f"doc_id {kind}, row long, n_bytes long, known long, others array<struct<token:string,times:long>>",
        ),
        "document-pre-tokens",
    )
    rare = counted.select("row", F.explode("others").alias("o")).select("row", "o.token", "o.times")
    summed = (
        rare.join(pieces.filter(~in_head(start)).select("token", "pieces"), "token")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("pieces")).alias("rare"))
    )
    total = F.col("known") + F.coalesce("rare", F.lit(0))
    return (
        counted.select("doc_id", "row", "n_bytes", "known")
        .join(summed, "row", "left")
        .select("doc_id", "n_bytes", total.cast("long").alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
