"""Best-fit packing: tokenize documents and pack them, online, into sequences of bounded length.

Bounded-space best fit: a fixed number of sequences stays open, kept in a bitset by free space. A piece goes where the least space
is left over; if it fits nowhere a new sequence opens, for which, at the limit, the fullest open one closes. Every task packs what
it reads, so packing needs no shuffle, and a task that is run again gives the same sequences. Pieces of a chunk are placed longest
first.

Cases: null or empty text is the end id alone; documents longer than a sequence are cut into full pieces, the first one taking the
remainder; repeated rows and null ids are packed like any other; columns beyond id and text are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import mix64, table

#: Tokens of a sequence, sequences open in a task, id that ends a document, characters tokenized at a time.
CAPACITY, OPEN, END_ID, CHUNK_CHARS = 2048, 1024, 0, 2_000_000
#: Fixed: the split before merges, of the byte-level vocabulary, written with possessive repeats.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_OTHER, _LETTER, _NUMBER, _BLANK, _NEWLINE, _WHITE = range(6)


class Tokenizer:
    """Ids of whole texts. Words that repeat within a chunk or across chunks are merged once.

    A text with an apostrophe, a run of white space, unusual white space or an astral character goes to the tokenizer as a
    whole, as its split is not local there; the split of any other text follows from each character's class and its neighbours.
    """

    def __init__(self, vocabulary: str = "byte_bpe_50k", cached_words: int = 1_000_000):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self._merge = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
        self._json, self._full = public_tokenizers.path(f"{vocabulary}.json"), None
        self._cache: dict[str, bytes] = {}
        self._cached_words = cached_words
        kind = np.zeros(1 << 16, np.uint8)
        for i in range(1 << 16):
            c = chr(i)
            major = unicodedata.category(c)[0]
            kind[i] = _LETTER if major == "L" else _NUMBER if major == "N" else _BLANK if c == " " else _NEWLINE if c == "\n" else _WHITE if c.isspace() else _OTHER
        kind[ord("'")] = _WHITE  # sends the text to the tokenizer as a whole
        self._kind = kind

    def _whole(self, text: str) -> list[int]:
        if "<|endoftext|>" in text:  # the one added token of the vocabulary
            if self._full is None:
                from tokenizers import Tokenizer as Full

                self._full = Full.from_file(self._json)
            return self._full.encode(text, add_special_tokens=False).ids
        return self._merge(text)

    def _word(self, word: str) -> bytes:
        got = self._cache.get(word)
        if got is None:
            if len(self._cache) >= self._cached_words:
                self._cache.clear()
            got = self._cache[word] = array("I", self._merge(word)).tobytes()
        return got

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each ended by END_ID; number of ids of each text, END_ID included)."""
        joined = "\n".join(texts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        end = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1  # of each text, where the added newline is
        kind = self._kind[np.minimum(code, 0xFFFF)]
        blank = (kind == _BLANK) | (kind == _NEWLINE)
        own = np.ones(len(code), bool)
        own[end] = False
        odd = (kind == _WHITE) | (code > 0xFFFF)
        odd[1:] |= blank[1:] & blank[:-1] & own[1:] & own[:-1]
        complex_ = np.zeros(len(texts), bool)
        complex_[np.searchsorted(end, np.flatnonzero(odd))] = True
        complex_ |= np.fromiter(("<|endoftext|>" in t for t in texts), bool, len(texts))

        start = np.ones(len(code), bool)
        start[1:] = ((kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK)) | blank[1:]
        at = np.flatnonzero(start)
        size = np.diff(np.append(at, len(code)))
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
            place = np.arange(len(code)) - np.repeat(at, size)
            key = mix64(np.add.reduceat((code.astype(np.uint64) + np.uint64(1)) * powers[place], at))
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        like = np.repeat(at[first][which], size) + place  # words of one key are compared with the first; texts with an unlike one are read apart
        unlike = np.add.reduceat(code[np.minimum(like, len(code) - 1)] != code, at) > 0
        unlike |= size != size[first][which]
        complex_[np.searchsorted(end, at[unlike])] = True
        words = [self._word(joined[s : s + n]) for s, n in zip(at[first].tolist(), size[first].tolist(), strict=True)]
        flat = np.frombuffer(b"".join(words), "<u4")
        n_ids = np.fromiter(map(len, words), np.int64, len(words)) // 4
        begin = np.cumsum(n_ids) - n_ids
        count = n_ids[which]
        after = np.cumsum(count)
        ids = flat[np.repeat(begin[which] - (after - count), count) + np.arange(int(after[-1]))].copy()
        last = after[np.searchsorted(at, end)]  # past the id of the added newline
        ids[last - 1] = END_ID
        length = np.diff(np.concatenate([[0], last]))
        if complex_.any():
            parts = np.split(ids, last[:-1])
            for i in np.flatnonzero(complex_).tolist():
                parts[i] = np.array([*self._whole(texts[i]), END_ID], "<u4")
            ids, length = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, length


class OpenBins:
    """Best fit into a bounded number of open bins, found by free space in a bitset."""

    def __init__(self, capacity: int, most_open: int, first_id: int = 0):
        self.capacity, self.most_open, self.next_id = capacity, most_open, first_id
        self.bits, self.count, self.at = 0, 0, [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bin_id = self.at[free].pop()
        if not self.at[free]:
            self.bits ^= 1 << free
        self.count -= 1
        return bin_id

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset in it) of a piece of 1 to capacity tokens."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.capacity, self.next_id
            self.next_id += 1
        left = free - size
        if left:
            if self.count >= self.most_open:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.at[left].append(bin_id)
            self.bits |= 1 << left
            self.count += 1
        return bin_id, self.capacity - free


def cut(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, size) of each piece of documents of these lengths (1 at least)."""
    n = -(-length // capacity)
    doc = np.repeat(np.arange(len(length)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    head = length - (n - 1) * capacity
    start = np.where(piece > 0, head[doc] + (piece - 1) * capacity, 0)
    return doc, piece, start, np.where(piece > 0, capacity, head[doc])


def _chunks(texts: list[str]) -> Iterator[slice]:
    begin = chars = 0
    for i, t in enumerate(texts):
        chars += len(t) + 1
        if chars >= CHUNK_CHARS:
            yield slice(begin, i + 1)
            begin, chars = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _pack(capacity: int, most_open: int, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        bins = OpenBins(capacity, most_open, (context.partitionId() if context else 0) << 40)
        tokenizer = Tokenizer(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in _chunks(texts):
                ids, length = tokenizer.encode(texts[part])
                doc, piece, start, size = cut(length, capacity)
                placed = np.empty((len(size), 2), np.int64)
                for i in np.argsort(-size, kind="stable").tolist():
                    placed[i] = bins.place(int(size[i]))
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64) * 4
                blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, part.stop - part.start).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), blob.cast(pa.binary()), pa.array(placed[:, 0]), pa.array(placed[:, 1])],
                    names=["id", "piece", "start", "length", "ids", "sequence_id", "offset"],
                )

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, most_open: int = OPEN, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """(id, piece, start, length, ids, sequence_id, offset) of each piece; ids are little-endian unsigned 32-bit."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pack(capacity, most_open, vocabulary), f"id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")


def packed_rows(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pack(docs).select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    return packed_rows(table(spark, sf_dir, "documents"))
