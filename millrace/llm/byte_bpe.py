"""Byte-level BPE: texts to ids by a rank file, and ids back to bytes, with the tiktoken library.

The pattern splits a text into pieces and each piece is merged by itself.  A long text is
first cut where no piece can span the cut: between a printable ASCII character and a space or
line feed.  No alternative of the pattern matches a non-space followed by white space, and
nothing in it looks back, so the pieces left and right of such a place are the same as in the
whole text.  A stretch without such a place stays whole.

Long white space is taken out before the pattern sees it, because the pattern walks back through it step by step
and gives up: all of it but the last character is one piece, or all of it at the end of a text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, shape, worker_cache

SAFE = re.compile(r"[!-~](?=[ \n])")
# Characters that the pattern's \s stands for (the property White_Space).
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space of so many characters goes past the pattern.
LONG_WHITE = 10_000


def encoding(rank_file: str, pattern: str):
    """The encoder of a rank file; built once per Python worker."""

    def make():
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return worker_cache(f"tiktoken {rank_file} {pattern}", make)


def pieces(text: str, most: int) -> Iterator[str]:
    """The text in parts of about ``most`` characters, cut at safe places only."""
    start = 0
    while len(text) - start > most:
        cut = SAFE.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:] if start else text


def encode_text(encoder, text: str, most: int, white: int = LONG_WHITE) -> np.ndarray:
    parts, start = [], 0
    for run in re.finditer(f"(?<![{WHITE}])[{WHITE}]{{{white},}}", text) if len(text) >= white else ():
        before, stop = text[start : run.start()], run.end() - (run.end() < len(text))
        parts += [encoder.encode_to_numpy(part, disallowed_special=()) for part in pieces(before, most)]
        # The library's own call for a text that the pattern would leave whole.
        parts.append(np.array(encoder._encode_single_piece(text[run.start() : stop]), np.int64))
        start = stop
    parts += [encoder.encode_to_numpy(part, disallowed_special=()) for part in pieces(text[start:], most)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    id: str = "doc_id",
    text: str = "text",
    piece_chars: int = 100_000,
) -> DataFrame:
    """``id`` and ``ids array<int>`` of every row; a NULL or empty text has no ids.

    Rows are handled one by one, so repeated rows give repeated results and NULL ids stay.
    Strings that look like special tokens are ordinary text.  ``rank_file`` must be readable at
    the same path on every executor.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(rank_file, pattern)
        for batch in batches:
            found = [encode_text(encoder, t.as_py() or "", piece_chars) for t in batch.column(1)]
            ends = np.cumsum([0] + [len(x) for x in found], dtype=np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *found]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[id, "ids"])

    rows = bounded_batches(docs).select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(task, shape({id: rows.schema["id"].dataType, "ids": "array<int>"}))


def decode(encoded: DataFrame, rank_file: str, pattern: str, id: str = "doc_id") -> DataFrame:
    """``id``, ``ids`` and ``bytes``: the raw bytes that the ids stand for, valid UTF-8 or not.

    NULL ids count as none.  An id that the rank file lacks ends the job.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(rank_file, pattern)
        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            out = [
                encoder.decode_bytes(flat[a:b].tolist()) if ok else b""
                for a, b, ok in zip(ends[:-1], ends[1:], valid)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(out, pa.binary())], names=[id, "ids", "bytes"])

    rows = encoded.select(F.col(id).alias("id"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(task, shape({id: rows.schema["id"].dataType, "ids": "array<int>", "bytes": "binary"}))
