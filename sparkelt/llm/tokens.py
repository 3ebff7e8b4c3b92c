"""Token counts: batches of about equal bytes go through the tokenizer, only lengths come back."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Bytes of text handed to the tokenizer at once, and the length from which a text is split.
BATCH_BYTES = 1 << 20
SPLIT_CHARS = 1 << 15
#: A space between two plain characters; the tokenizer's words begin at it.
BOUNDARY = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
MARK = "▁"


@functools.lru_cache(maxsize=4)
def _processor(name: str):
    """The tokenizer, and what a cut at a space drops (None: cuts are not safe).

    Cuts are safe if no piece continues past a word's mark, so that no merge spans a cut. A model
    that puts a mark before every text supplies the one of the dropped space.
    """
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    spans = re.compile(f"[^{MARK}]{MARK}")
    if any(spans.search(model.id_to_piece(i)) for i in range(model.get_piece_size())):
        return model, None
    return model, int(model.encode("a", out_type=str)[0].startswith(MARK))


def pieces_of(text: str, dropped: int | None, size: int = SPLIT_CHARS) -> list[str]:
    """The text in pieces whose token counts add up to its own."""
    if dropped is None or len(text) <= size:
        return [text]
    out, begin = [], 0
    while len(text) - begin > size:
        cut = BOUNDARY.search(text, begin + size)
        if cut is None:
            break
        out.append(text[begin : cut.start()])
        begin = cut.start() + dropped
    return [*out, text[begin:]]


def lengths(texts: list[str | None], name: str) -> list[int]:
    """Tokens of each text (null: none)."""
    model, dropped = _processor(name)
    counts = [0] * len(texts)
    owners: list[int] = []
    batch: list[str] = []
    held = 0

    def flush() -> None:
        for owner, ids in zip(owners, model.encode(batch, num_threads=1)):
            counts[owner] += len(ids)
        owners.clear()
        batch.clear()

    for n, text in enumerate(texts):
        for piece in pieces_of(text or "", dropped):
            owners.append(n)
            batch.append(piece)
            held += len(piece)
            if held >= BATCH_BYTES:
                flush()
                held = 0
    flush()
    return counts


def count(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text).

    No shuffle. Defined results: a null text counts as empty; a null doc_id stays; repeated rows
    get a row each; an empty table gives an empty table; other columns are ignored. A long text
    without any safe place to cut is encoded whole.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = lengths(b.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(found, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    importable(docs.sparkSession)
    given = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    counted = given.mapInArrow(encode, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
