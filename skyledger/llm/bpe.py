r"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts are split by the pattern of the rank file and each match is merged on its own, without special tokens.
Long texts go to the library in chunks that end at safe boundaries, places that no match of the pattern
crosses: before white space that follows something else, and before the last character of a run of white
space that something else follows. So a chunk's ids are those of the whole text. A run of white space too
long for the pattern engine is one match by the same reasoning and is merged as one piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Characters that a chunk holds before it is cut at the next safe boundary.
CHUNK = 100_000
#: A run of white space of at least so many characters is encoded as one piece.
LONG_SPACE = 10_000


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The encoding, read once in each Python worker."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_BOUNDARY = re.compile(r"(?<=\S)(?=\s)")
_SPACES = re.compile(r"\s{%d,}" % LONG_SPACE)


def chunks(text: str, size: int = CHUNK) -> Iterator[tuple[str, bool]]:
    """(piece, whole): consecutive pieces of text, ``whole`` for a run of white space that is one match."""
    at = 0
    for m in _SPACES.finditer(text):
        # Followed by something, the run's match stops before its last character; at the end it takes all.
        end = m.end() if m.end() == len(text) else m.end() - 1
        yield from ((x, False) for x in _cut(text[at : m.start()], size))
        yield text[m.start() : end], True
        at = end
    yield from ((x, False) for x in _cut(text[at:], size))


def _cut(text: str, size: int) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        m = _BOUNDARY.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    if at < len(text):
        yield text[at:]


def encode(enc, text: str) -> np.ndarray:
    """ids of the text as unsigned 32-bit integers."""
    if len(text) <= LONG_SPACE:
        return np.asarray(enc.encode_ordinary(text), dtype="<u4")
    parts = [enc._core_bpe.encode_single_piece(x.encode()) if whole else enc.encode_ordinary(x) for x, whole in chunks(text)]
    return np.concatenate([np.asarray(p, dtype="<u4") for p in parts]) if parts else np.zeros(0, "<u4")


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) for each row of docs.

    ids are the tokens of the whole text, null with keep_ids=False; ids_sha256 is the digest of the ids as
    little-endian unsigned 32-bit integers and decoded_sha256 that of the bytes the ids decode to. A null text
    is encoded as the empty text: no ids. A null doc_id stays null; repeated rows give repeated results; an empty table
    gives an empty one; other columns of docs are not read, whatever their names. A very long text is encoded whole, in
    chunks that change no id. No shuffle: every row is encoded where it is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n, ids, sha, back = [], [], [], []
                for text in part.column(1):
                    x = encode(enc, text.as_py() or "")
                    n.append(len(x))
                    ids.append(x.astype("i4") if keep_ids else None)
                    sha.append(hashlib.sha256(x.tobytes()).hexdigest())
                    back.append(hashlib.sha256(enc.decode_bytes(x.tolist())).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(sha, pa.string()), pa.array(back, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
