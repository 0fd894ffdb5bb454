"""Byte-level BPE encoding and decoding by a two-tier lookup.

A minimal perfect hash over the vocabulary resolves pre-tokens that are tokens themselves.  All others
are merged: their bytes form a linked list, and a heap gives the pair of lowest rank next.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexitab.llm.memory import Memory, release
from lexitab.plans.fixtures import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Bytes of words and their ids that a worker remembers.
REMEMBERED = 192 * 1024 ** 2
# Documents whose ids and digests are held at a time.
BLOCK = 512
# Keys of a bucket of the perfect hash, on average; seeds that are tried at a time.
BUCKET, SEEDS = 4, 256
# Fixed value: an odd number whose product spreads a hash over its upper bits.
SPREAD = 0x9E3779B97F4A7C15


class PerfectHash:
    """A minimal perfect hash of distinct byte strings by hash and displace.

    Keys fall into buckets by one hash.  The largest buckets go first, and each gets the first seed
    that sends all its keys to free places of a table with exactly one place per key.
    """

    def __init__(self, keys: list[bytes]):
        self.size = max(1, len(keys))
        buckets = max(1, len(keys) // BUCKET)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        bucket = hashes % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        key_at, free, seeds = np.full(self.size, -1), np.ones(self.size, dtype=bool), [0] * buckets
        for b in sorted(range(buckets), key=lambda b: starts[b] - starts[b + 1]):
            members = order[starts[b]:starts[b + 1]]
            if not len(members):
                break
            found, first = np.empty(0, dtype=int), 1
            while not len(found):
                tried = np.arange(first, first + SEEDS, dtype=np.uint64)
                places = self._spread(hashes[members][:, None], tried[None, :]) % np.uint64(self.size)
                sorted_places = np.sort(places, axis=0)
                found = np.flatnonzero(free[places].all(axis=0) & (sorted_places[1:] != sorted_places[:-1]).all(axis=0))
                first += SEEDS
            seeds[b] = int(tried[found[0]])
            chosen = places[:, found[0]]
            key_at[chosen], free[chosen] = members, False
        self.seeds, self.key_at = seeds, key_at.tolist()

    @staticmethod
    def _spread(h: np.ndarray, seed: np.ndarray) -> np.ndarray:
        x = h * (seed * np.uint64(2) + np.uint64(1))
        return ((x ^ (x >> np.uint64(32))) * np.uint64(SPREAD)) >> np.uint64(33)

    def candidate(self, key: bytes) -> int:
        """The position of the only key that can equal ``key``, -1 if there is none."""
        h = xxhash.xxh64_intdigest(key)
        x = h * (2 * self.seeds[h % len(self.seeds)] + 1) & 0xFFFFFFFFFFFFFFFF
        return self.key_at[(((x ^ (x >> 32)) * SPREAD & 0xFFFFFFFFFFFFFFFF) >> 33) % self.size]


@dataclass
class Vocabulary:
    """Tokens in rank order, with the rank of each as its id."""

    pieces: list[bytes]
    ids: list[int]
    hash: PerfectHash

    def __post_init__(self):
        self.by_id = dict(zip(self.ids, self.pieces))
        self.ranks = dict(zip(self.pieces, self.ids))
        # Ranks of all pairs of bytes, -1 for none, by the number that the pair is.
        self.pairs = [self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: its own if it is a token, else those of its merged bytes."""
        i = self.hash.candidate(piece)
        return [self.ids[i]] if i >= 0 and self.pieces[i] == piece else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Join neighbours, lowest rank first and leftmost among equals, until no pair is a token.

        ``end[i]`` is where the part that starts at byte ``i`` ends, so the list links forward through
        it; ``before`` links back.  ``pair[i]`` is the rank of that part with the next one.  The heap holds
        rank and start as one number; an entry is out of date if the rank is no longer that of the pair.
        """
        n, rank_of, pairs = len(piece), self.ranks.get, self.pairs
        end, before = list(range(1, n + 1)), list(range(-1, n))
        pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        shift = n.bit_length()
        heap = [rank << shift | i for i, rank in enumerate(pair) if rank >= 0]
        heapq.heapify(heap)
        low, pop, push = (1 << shift) - 1, heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i = entry & low
            if pair[i] != entry >> shift:
                continue
            j = end[i]
            k = end[i] = end[j]
            pair[j] = pair[i] = -1
            if k < n:
                before[k] = i
                rank = rank_of(piece[i:end[k]])
                if rank is not None:
                    pair[i] = rank
                    push(heap, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(piece[h:k])
                pair[h] = -1 if rank is None else rank
                if rank is not None:
                    push(heap, rank << shift | h)
        ids, i = [], 0
        while i < n:
            rank = rank_of(piece[i:end[i]])
            if rank is None:
                raise ValueError(f"the vocabulary has no byte {piece[i:end[i]]!r}")
            ids.append(rank)
            i = end[i]
        return ids


def read_vocabulary(lines: list[bytes]) -> Vocabulary:
    """From the lines of a rank file: a token in base 64 and its rank."""
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, lines)))
    pieces = [p for _, p in pairs]
    return Vocabulary(pieces, [r for r, _ in pairs], PerfectHash(pieces))


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary at a path that every executor has, built once in a Python worker."""
    with open(path, "rb") as file:
        return read_vocabulary(file.read().splitlines())


class Encoder:
    """Encodes texts and remembers the ids of words it has met.

    Under ``public_tokenizers.PATTERN`` no match reaches over a single blank between other characters: it
    ends before the blank, and what follows begins with it.  So a text is parted there, and a word with
    the blank before it is looked up as a whole.  Blanks beside other white space part nothing.  Any other
    pattern is matched over the whole text.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, remembered: int = REMEMBERED):
        self.vocabulary = vocabulary
        self.pretokens = regex.compile(pattern).findall
        self.by_words = pattern == public_tokenizers.PATTERN
        # Ids are held in 16 bits where all of them fit.
        self.kind = "H" if max(vocabulary.ids, default=0) < 1 << 16 else "I"
        self.pieces = Memory(self._piece, remembered // 4)
        self.known = Memory(self._word, remembered - remembered // 4)

    def _piece(self, pretoken: str) -> bytes:
        return array(self.kind, self.vocabulary.encode_piece(pretoken.encode("utf-8"))).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pretokens(text)))

    def _word(self, word: str) -> bytes | None:
        """The ids of a blank and a word; ``None`` if white space is at either end or nothing is there."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        first, *others = self.pretokens(" " + word)
        if not others:
            return self._piece(first)
        return b"".join([self.known[first[1:]] or self.pieces[first], *map(self.pieces.__getitem__, others)])

    def _units(self, parts: list[str]) -> Iterator[bytes]:
        """The ids of parts between blanks, those beside other white space put together again."""
        unit, open_end = [parts[0]], parts[0][-1:].isspace()
        for part in parts[1:]:
            if open_end or not part or part[0].isspace():
                unit.append(part)
            else:
                yield self._plain(" ".join(unit))
                unit = ["", part]
            open_end = not part or part[-1].isspace()
        yield self._plain(" ".join(unit))

    def packed(self, text: str) -> bytes:
        if not self.by_words:
            return self._plain(text)
        first, *parts = text.split(" ")
        words = [*map(self.known.__getitem__, parts)]
        if first[-1:].isspace() or None in words:
            return b"".join(self._units([first, *parts]))
        return b"".join([self._plain(first), *words])

    def encode(self, text: str) -> list[int]:
        return array(self.kind, self.packed(text)).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.by_id.__getitem__, ids))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str, remembered: int = REMEMBERED) -> Encoder:
    return Encoder(load(path), pattern, remembered)


def _encoded(path: str, pattern: str, with_ids: bool, remembered: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern, remembered)
        decimal = {i: str(i) for i in coder.vocabulary.ids}
        for batch in (b.slice(i, BLOCK) for b in batches for i in range(0, b.num_rows, BLOCK)):
            counts, id_sums, text_sums, lists = [], [], [], []
            for text in batch.column("text"):
                ids = coder.encode(text.as_py() or "")
                counts.append(len(ids))
                id_sums.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sums.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(np.array(ids, dtype=np.int32))
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                       "ids_sha256": pa.array(id_sums, pa.string()), "decoded_sha256": pa.array(text_sums, pa.string())}
            if with_ids:
                columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
        release()
    return work


def encode_documents(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN,
                     with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row, and ``ids`` if asked for.

    The text is split by ``pattern`` and each match encoded by itself, without special tokens.
    ``decoded_sha256`` is the digest of the bytes that the ids give back.  Null texts count as empty,
    and an empty text has no ids: both digests are those of nothing.  ``path`` names a rank file that
    every executor has.  Rows are independent, so nothing is shuffled.  A Python worker remembers words in
    ``remembered`` bytes.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(
        _encoded(path, pattern, with_ids, remembered), schema + (", ids array<int>" if with_ids else ""))


def _decoded(path: str, pattern: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            texts = [None if ids.as_py() is None else coder.decode(ids.as_py()) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "bytes": pa.array(texts, pa.binary())})
    return work


def decode_documents(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``(doc_id, bytes)`` of rows with ``ids``; null ids give null bytes."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path, pattern), f"doc_id {kind}, bytes binary")


def documents_bytes(docs: DataFrame) -> DataFrame:
    """``(doc_id, bytes)``: what decoding has to give back."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))


def op7_byte_bpe(spark, sf_dir):
    """All documents."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
