"""Encoding by byte-level BPE, cut at forced boundaries.

Two neighbouring bytes that no vocabulary token holds side by side can't end up in one token, for
every merge makes a token. Such places are certain cuts: the parts are encoded independently and
the ids put one after another. As corpora repeat their parts (mostly words), each different part
of a batch is encoded once, and ids are gathered by array operations.

The vocabulary's pre-splitting pattern looks at more than two bytes, so a certain cut is only used
where the pattern can't tell the difference: not after white space (``\\s+(?!\\S)`` looks ahead), not
before an apostrophe (``'s`` would be tried first) and not within a character. Then both sides keep
their pre-splits: before white space every pre-split ends, and elsewhere a run of letters, digits
or other characters is continued by a run of the same kind.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that splits text before the merges of the vocabulary. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text whose parts are looked up at once, and parts that a worker remembers.
CHUNK_BYTES = 8 << 20
REMEMBERED = 500_000

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        side_by_side = np.zeros((256, 256), bool)
        for token in ranks:
            bytes_of = np.frombuffer(token, np.uint8)
            side_by_side[bytes_of[:-1], bytes_of[1:]] = True
        cut = ~side_by_side
        cut[list(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")] = False
        cut[:, 0x80:0xC0] = False
        cut[:, ord("'")] = False
        self._cut = cut.ravel()
        self._known: dict[bytes, np.ndarray] = {}

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """True at each place (0 to the length) where the bytes may be cut."""
        out = np.zeros(len(data) + 1, bool)
        if len(data) < 2:
            return out
        pairs = data[:-1].astype(np.uint16)
        pairs <<= 8
        pairs |= data[1:]
        out[1:-1] = self._cut[pairs]
        after = np.flatnonzero(out[1:-1] & (data[:-1] >= 0x80)) + 1
        if len(after):  # not after white space of two or three bytes
            a, b, c = data[np.maximum(after - 3, 0)], data[np.maximum(after - 2, 0)], data[after - 1]
            space = (b == 0xC2) & ((c == 0x85) | (c == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80)
            space |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
            space |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
            out[after[space]] = False
        return out

    def _ids(self, part: bytes) -> np.ndarray:
        ids = self._known.get(part)
        if ids is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            ids = np.array(self._bpe.encode_ordinary(part.decode("utf-8", "replace")), np.int32)
            if len(part) <= 64:
                self._known[part] = ids
        return ids

    def _parts(self, data: np.ndarray, offsets: np.ndarray):
        """The different parts' ids, which part each one is, and the parts before each text."""
        at = self.cuts(data)
        at[offsets] = True
        at[0] = at[-1] = True
        places = np.flatnonzero(at).astype(np.int32)
        if len(data) == 0:
            return [], np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        parts = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        return [self._ids(p) for p in coded.dictionary.to_pylist()], which, np.searchsorted(places, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts (bytes between offsets) -> all ids, and the offsets of each text's ids."""
        ids, which, first = self._parts(data, offsets)
        if not len(which):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        sizes = np.array([len(x) for x in ids], np.int64)
        flat, starts = np.concatenate(ids), np.cumsum(sizes) - sizes
        own = sizes[which]
        ends = np.cumsum(own)
        gathered = flat[np.repeat(starts[which] - (ends - own), own) + np.arange(ends[-1])]
        return gathered, np.concatenate([[0], ends])[first]

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of ids of each text."""
        ids, which, first = self._parts(data, offsets)
        if not len(which):
            return np.zeros(len(offsets) - 1, np.int64)
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.diff(np.concatenate([[0], np.cumsum(sizes[which])])[first])


def chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A text column as (bytes, offsets) of consecutive rows, about CHUNK_BYTES each; NULL as empty."""
    texts = texts.cast(pa.large_binary()) if texts.type != pa.large_binary() else texts
    texts = texts.fill_null(b"") if texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, "right")) - 1)
        stop = min(stop, len(texts))
        yield data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            row = 0
            for data, offsets in chunks(batch["text"]):
                ids, ends = own.encode(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch["key"].slice(row, n), lists], names=["key", "ids"])
                row += n

    return run


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            sizes = [own.count(data, offsets) for data, offsets in chunks(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(np.concatenate([np.zeros(0, np.int64), *sizes]))], names=["key", "n_tokens"])

    return run


def encode(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """key and ids, the token ids of each row's whole text, without special tokens.

    NULL and empty texts give an empty list; a blank text is encoded like any other, and the
    strings of special tokens are ordinary text. Rows keep their number, repeated ones too.
    ``path`` is a rank file that every executor has.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_encode(path), "key long, ids array<int>").withColumnRenamed("key", key)


def count_tokens(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """key and n_tokens: the length of what ``encode`` gives, without making it."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_count(path), "key long, n_tokens long").withColumnRenamed("key", key)
