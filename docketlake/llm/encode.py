"""Corpus encoding with a public byte-level BPE (problem 8).

Method: content-defined chunk reuse.  A gear hash rolls over the bytes and marks
chunk ends by content alone, so equal passages of different documents fall into
equal chunks; a chunk is encoded once per worker and its ids are reused.  A chunk
end is kept only where the encoding of the two sides provably joins to the
encoding of the whole; at any other mark the join is repaired by fusing both
sides and encoding the fused piece, so that the result agrees exactly with an
encoding of the whole text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Folder of the public vocabulary files.
TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-token pattern of this vocabulary.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A mark every 2**MASK_BITS eligible positions on average.
MASK_BITS = 2
#: Bytes the rolling hash sees.
HASH_WINDOW = 8
#: Bytes of known chunks a worker keeps, all told; the table is dropped and refilled beyond it.
CACHE_BYTES = 128 << 20
#: Bytes of a table entry beside its text and ids: two object heads and the slot.
ENTRY_BYTES = 2 * 33 + 104

_GEAR = np.random.default_rng(20240607).integers(1, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_WORKER: dict = {}


def load_encoder(directory: str = TOKENIZER_DIR, vocabulary: str = VOCABULARY):
    """The tokenizer without special tokens, and the byte length of each id."""
    import tiktoken

    with open(os.path.join(directory, vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("corpus", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}), lengths


def content_cuts(data: np.ndarray, mask_bits: int = MASK_BITS) -> np.ndarray:
    """Positions of ``data`` (bytes) where a chunk may end, chosen by content.

    A mark is set where the gear hash of the preceding bytes ends in zeros.  Its
    join is exact if the mark lies before a space that follows printable ASCII
    and precedes an ASCII letter: each alternative of the pre-token pattern
    starts a new pre-token at that space, whatever stands around.  Marks with
    any other surroundings are given up, which fuses the chunks beside them.
    """
    spaces = np.flatnonzero(data == 32)
    spaces = spaces[(spaces >= HASH_WINDOW) & (spaces < data.size - 1)]
    before, after = data[spaces - 1], data[spaces + 1] | 32
    spaces = spaces[(before > 32) & (before < 127) & (after >= 97) & (after <= 122)]
    rolled = np.zeros(spaces.size, np.uint32)
    for back in range(HASH_WINDOW, 0, -1):
        rolled = (rolled << np.uint32(1)) + _GEAR[data[spaces - back]]
    return spaces[(rolled >> np.uint32(12)) & np.uint32((1 << mask_bits) - 1) == 0]


class ChunkEncoder:
    """Encodes batches of texts, keeping the ids of chunks seen before."""

    def __init__(self, directory: str = TOKENIZER_DIR, mask_bits: int = MASK_BITS, cache_bytes: int = CACHE_BYTES):
        self.encoding, self.lengths = load_encoder(directory)
        self.mask_bits, self.cache_bytes = mask_bits, cache_bytes
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        #: bytes of all texts, and those that had to be encoded
        self.met = self.learnt = 0

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode new chunks.  Those that start at a proven join are encoded in
        one call and the ids are dealt out by byte length; others go one by one."""
        inner = [c for c in chunks if c[:1] == b" " and 97 <= (c[1] | 32 if len(c) > 1 else 0) <= 122 and 32 < c[-1] < 127]
        rest = set(chunks).difference(inner)
        if inner:
            ids = np.array(self.encoding.encode_ordinary(b"".join(inner).decode("utf-8")), np.int32)
            ends = np.cumsum([len(c) for c in inner])
            upto = np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="left") + 1
            start = 0
            for chunk, end in zip(inner, upto.tolist()):
                self.known[chunk] = ids[start:end].tobytes()
                start = end
        for chunk in rest:
            self.known[chunk] = np.array(self.encoding.encode_ordinary(chunk.decode("utf-8")), np.int32).tobytes()
        self.held += sum(len(c) + len(self.known[c]) + ENTRY_BYTES for c in chunks)

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i + 1]]``: row offsets and flat ids."""
        if self.held > self.cache_bytes:
            self.known.clear()
            self.held = 0
        ends = np.concatenate([content_cuts(data, self.mask_bits), offsets])
        ends.sort(kind="stable")
        ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])]
        raw = data.tobytes()
        at = ends.tolist()
        chunks = [raw[a:b] for a, b in zip(at, at[1:])]
        if fresh := [c for c in dict.fromkeys(chunks) if c not in self.known]:
            self._learn(fresh)
        self.met, self.learnt = self.met + len(raw), self.learnt + sum(map(len, fresh))
        parts = [self.known[c] for c in chunks]
        sizes = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4, out=sizes[1:])
        return sizes[np.searchsorted(ends, offsets)], np.frombuffer(b"".join(parts), np.int32)


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", directory: str = TOKENIZER_DIR) -> DataFrame:
    """Rows ``(id_col, ids)``: the ids of every text, in one pass without a shuffle.

    Null and empty texts get an empty list; a null id stays null; repeated rows
    stay repeated; other columns are dropped; an empty table gives an empty one.
    A text of any length is encoded whole.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _WORKER.get(directory)
        if encoder is None:
            encoder = _WORKER[directory] = ChunkEncoder(directory)
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.large_binary())
            if len(texts) == 0:
                continue
            _, offsets, data = texts.buffers()
            starts = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
            raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None and starts[-1] > starts[0] else np.zeros(0, np.uint8)
            rows, ids = encoder.encode(starts - starts[0], raw)
            lists = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")
