"""Token counts of whole texts as a tokenizer library gives them.

Every task encodes batches of pieces and keeps nothing but their lengths. A text is
cut at white space, which the tokenizer's own pattern never lets a token cross, so
a text of any length is handed over in small pieces; a piece that occurs again is
counted from what was found before. Batches of pieces are balanced by bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from recordlens.llm.batches import id_and_text, slices

# Texts looked at together, pieces encoded together, and pieces remembered, by task.
SLICE_BYTES = 4 << 20
BATCH_BYTES = 256 << 10
REMEMBERED = 400_000

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def balanced(pieces: list[bytes], limit: int) -> Iterator[list[bytes]]:
    """The pieces in batches of about ``limit`` bytes."""
    batch, held = [], 0
    for piece in pieces:
        if batch and held + len(piece) > limit:
            yield batch
            batch, held = [], 0
        batch.append(piece)
        held += len(piece)
    if batch:
        yield batch


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    *,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Bytes and tokens of each text, and whether it has more than ``limit`` tokens.

    Without begin, end or added special tokens, truncation or padding; special
    strings within a text are what the library makes of them. A null or empty text
    has no tokens, a null id stays null, repeated rows are counted each for itself,
    and columns beyond id and text are ignored. ``tokenizer_file`` has to be
    readable on every executor and to belong to a tokenizer whose tokens never
    cross ASCII white space and which drops it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_file)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        known: dict[bytes, int] = {}
        for part in slices(batches, SLICE_BYTES):
            bodies = part.column("body").to_pylist()
            totals = []
            for body in bodies:
                # bytes.split() knows ASCII white space alone, unlike str.split().
                words = body.split()
                missing = [w for w in set(words) if w not in known]
                if len(known) + len(missing) > REMEMBERED:
                    known.clear()
                    missing = list(set(words))
                for batch in balanced(missing, BATCH_BYTES):
                    found = tokenizer.encode_batch_fast(
                        [w.decode("utf-8", "replace") for w in batch], add_special_tokens=False
                    )
                    known.update(zip(batch, map(len, found)))
                totals.append(sum(map(known.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(map(len, bodies), pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array((n > limit for n in totals), pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(count, SCHEMA)
