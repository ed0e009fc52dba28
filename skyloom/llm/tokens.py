"""Token ids of whole texts by a public byte-level BPE vocabulary, with forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary forces a token boundary between its bytes. Where the
splitting of text before the merges surely cuts at the same place, whatever stands around it, the text can be cut
there, its fragments be encoded one by one, and their ids be put together. Such cuts lie before most words and marks,
so a task meets few different fragments and encodes each of them once.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

TOKENIZERS = os.environ.get("SKYLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMO = 200_000  # fragments that a worker remembers

# The last two UTF-8 bytes of white space beyond ASCII.
_WIDE_BLANKS = [(0xC2, 0x85), (0xC2, 0xA0), (0x9A, 0x80), (0x80, 0xA8), (0x80, 0xA9), (0x80, 0xAF), (0x81, 0x9F), (0x80, 0x80)] + [(0x80, b) for b in range(0x80, 0x8B)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


def forced_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """[a, b] is true where no token holds byte a followed by byte b."""
    inside = np.zeros((256, 256), bool)
    for token in ranks:
        if len(token) > 1:
            t = np.frombuffer(token, np.uint8)
            inside[t[:-1], t[1:]] = True
    return ~inside


def certain_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """Forced pairs at which the splitting pattern cuts in every context.

    It ends a run of letters, digits or marks where another kind follows, and white space begins a piece after
    anything else. Only after an apostrophe may letters belong to the piece before; after white space, and next to
    control characters that some engines take for white space, nothing is sure.
    """
    kind = np.zeros(256, np.uint8)  # 0: not sure, 1: letter, 2: digit, 3: mark, 4: blank, 5: end of a longer character
    for b in range(128):
        c = chr(b)
        kind[b] = 1 if c.isalpha() else 2 if c.isdigit() else 4 if c in " \t\n\r\x0b\x0c" else 0 if 0x1C <= b <= 0x1F else 3
    kind[128:] = 5
    a, b = kind[:, None], kind[None, :]
    before_blank = (a != 0) & (a != 4) & (b == 4)
    changes = (a >= 1) & (a <= 3) & (b >= 1) & (b <= 3) & (a != b)
    changes[ord("'"), :] &= kind != 1
    return forced_pairs(ranks) & (before_blank | changes)


class Encoder:
    """The vocabulary, its certain cuts, and the ids of fragments met before."""

    def __init__(self, folder: str, vocabulary: str = VOCABULARY):
        ranks = read_ranks(os.path.join(folder, vocabulary))
        self.cuts = certain_pairs(ranks)
        self.blank = np.zeros((256, 256), bool)
        for pair in _WIDE_BLANKS:
            self.blank[pair] = True
        self.bpe = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        # ids of the fragments met so far one after the other, grown in place; where each begins, and how many it has
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.first, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, fragment: bytes) -> int:
        ids = self.bpe.encode_ordinary(fragment.decode())
        at, n = len(self.known), len(ids)
        if at == len(self.first):
            self.first, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.length))
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + n] = ids
        self.first[at], self.length[at] = self.used, n
        self.used += n
        self.known[fragment] = at
        return at

    def fragment_starts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sorted places in the joined texts where a fragment begins; every text's beginning is one."""
        mark = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            mark[1:-1] = self.cuts[data[:-1], data[1:]]
            after_blank = self.blank[data[:-2], data[1:-1]]
            mark[2:-1] &= ~after_blank
        mark[starts] = True
        return np.flatnonzero(mark[: len(data)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the places where each text's ids begin; null and empty texts have none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low, high = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
        blob = b"" if data is None else bytes(memoryview(data)[low:high])
        offsets = offsets - low
        if not blob:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        if len(self.known) > MEMO:
            self.forget()
        begin = self.fragment_starts(np.frombuffer(blob, np.uint8), offsets[:-1][np.diff(offsets) > 0])
        bounds = [*begin.tolist(), len(blob)]
        known = self.known
        which = np.fromiter((at if (at := known.get(x)) is not None else self._learn(x) for x in map(blob.__getitem__, map(slice, bounds[:-1], bounds[1:]))), np.int64, len(begin))
        n = self.length[which]
        ends = np.cumsum(n)
        out = self.flat[np.repeat(self.first[which] - (ends - n), n) + np.arange(ends[-1])]
        per_fragment = np.append(0, ends)
        return out, per_fragment[np.searchsorted(begin, offsets)]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(folder: str, vocabulary: str = VOCABULARY) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if (folder, vocabulary) not in _ENCODERS:
        _ENCODERS[folder, vocabulary] = Encoder(folder, vocabulary)
    return _ENCODERS[folder, vocabulary]


def _mapper(folder: str, vocabulary: str, sizes_only: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = encoder(folder, vocabulary).encode(batch.column("text"))
            if sizes_only:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(at), pa.int64())})
            else:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))})

    return run


def encode_documents(docs: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids`` of every row; a null or empty text has the empty list.

    Ids are those of the whole text, without special tokens; their names in a text are ordinary text. Repeated rows
    each give a row, null doc_ids are kept, other columns are ignored, an empty table gives none.
    """
    return docs.select("doc_id", "text").mapInArrow(_mapper(folder, vocabulary, False), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def token_counts(docs: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens`` of every row, as encode_documents() would have it."""
    return docs.select("doc_id", "text").mapInArrow(_mapper(folder, vocabulary, True), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint")
