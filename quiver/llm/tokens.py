"""Token counts of whole texts, huge documents by overlap resynchronisation.

A text above ``chunk_bytes`` UTF-8 bytes is encoded in overlapping chunks with byte offsets. Two neighbouring
chunks are spliced at a stable common boundary: a space after another character, at which both chunks
start a token. It is proven stable because no piece of the vocabulary holds a word mark after any other
character (checked when the model is loaded), so no merge crosses it. Where the overlap holds no such
boundary, the overlap is widened until it does or reaches the end of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import prepare

MARK = "▁"
_MARK = MARK.encode()
_MODELS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def load_model(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model of this worker, loaded once; refuses a vocabulary in which merges may cross word starts."""
    if path not in _MODELS:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size())):
            raise ValueError("a piece holds a word mark after another character: boundaries are not stable")
        _MODELS[path] = model
    return _MODELS[path]


def stable(text: bytes, lo: int, hi: int) -> Iterator[int]:
    """Positions in [lo, hi) of a space that follows a character which is no space."""
    p = text.find(b" ", max(lo, 1), hi)
    while p >= 0:
        if text[p - 1:p] != b" " and not text.endswith(_MARK, 0, p):
            yield p
        p = text.find(b" ", p + 1, hi)


def _whole(text: bytes, p: int) -> int:
    """``p``, or the start of the character that it falls into."""
    while 0 < p < len(text) and text[p] & 0xC0 == 0x80:
        p -= 1
    return p


def count_long(text: bytes, starts: Callable[[bytes], np.ndarray], chunk: int, overlap: int) -> int:
    """Tokens of the UTF-8 ``text``, encoded chunk by chunk; ``starts`` gives the byte offsets at which a
    text's tokens begin."""
    total = at = begin = 0  # the chunk's tokens count from the proven boundary ``at`` on
    size = max(chunk, 4)
    end = _whole(text, min(len(text), size))
    own = starts(text[:end])
    while end < len(text):
        wide = overlap
        while True:
            left = max(begin, _whole(text, max(0, end - wide)))
            reach = _whole(text, min(len(text), end + (size if left > begin else max(size, end - begin))))
            following = starts(text[left:reach]) + left
            mine, theirs = set(own.tolist()), set(following.tolist())
            common = next((p for p in stable(text, max(left, at) + 1, end) if p in mine and p in theirs), None)
            if common is not None or left == begin:
                break
            wide *= 2  # no alignment in this overlap
        if common is not None:
            total += int(np.count_nonzero((own >= at) & (own < common)))
            begin, at = left, common
        own, end = following, reach  # without a common boundary the chunk itself has grown
    return total + int(np.count_nonzero(own >= at))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None,
                 limit: int = 4096, chunk_bytes: int = 64_000, overlap_bytes: int = 1_000) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the sentencepiece model at ``model_path`` (default: the public 32k piece model) for
    the whole text, without begin, end or added tokens; marker strings inside a text are ordinary text, as
    the library has it. A null text counts as empty: 0 bytes, 0 tokens. Null and repeated ids keep their
    rows; other columns are not read, whatever their names; an empty table gives an empty result. No shuffle;
    a task holds one Arrow batch and, of a huge text, one chunk's tokens.
    """
    prepare(docs.sparkSession)
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(path)

        def starts(text: bytes) -> np.ndarray:
            return np.fromiter((p.begin for p in model.encode(text, return_type="proto").pieces), np.int64)

        for b in batches:
            texts = b.column(1).fill_null("").to_pylist()
            size = b.column(2).to_numpy()
            n = np.zeros(len(texts), np.int64)
            short = np.flatnonzero(size <= chunk_bytes)
            for k in range(0, len(short), 256):
                part = short[k:k + 256]
                n[part] = [len(x) for x in model.encode([texts[i] for i in part], num_threads=1)]
            for i in np.flatnonzero(size > chunk_bytes):
                n[i] = count_long(texts[i].encode(), starts, chunk_bytes, overlap_bytes)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
