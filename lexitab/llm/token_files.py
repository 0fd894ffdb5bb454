"""Token ids in ORC files.

Ids are integers in runs and packed bits, in stripes that are read in parallel.  Row indexes and Bloom
filters on the document id let a reader skip stripes and row groups that lack the documents it wants.
Files hold the documents in ascending order, each file one range of them.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexitab.llm.memory import Memory
from lexitab.operators.ordering import bases, number_rows, range_sort
from lexitab.plans.fixtures import table
from lexitab.session import materialise, scratch_path

VOCABULARY, END_ID = "word_bpe_49k.json", 2
ORC = {"orc.create.index": "true", "orc.row.index.stride": "2000", "orc.stripe.size": str(32 * 1024 ** 2),
       "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd"}
# Bytes of chunks and their ids that a worker remembers.
REMEMBERED = 224 * 1024 ** 2
# Marks that end a chunk and make up one word, if a letter or number is before them.
ENDS = ".,;:!?"
PRINTABLE = regex.compile(r"[!-~]+")


class ChunkEncoder:
    """Encodes texts with the tokenizer, each distinct chunk between blanks once.

    The tokenizer drops white space and lets no word, normalisation or special token reach across it,
    so a text's ids are those of its chunks in turn.  Chunks are parted at blanks and line feeds only;
    any other white space is left to the tokenizer.  A chunk that its normaliser does not change is
    parted into words where the tokenizer does it, and each word goes to its model.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # Printable bytes stand for themselves, the others for characters from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.shown = [chr(b) if b in plain else chr(next(others)) for b in range(256)]
        with open(path, encoding="utf-8") as file:
            splitter = json.load(file)["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(splitter["pattern"]["Regex"]).findall
        # Ids are held in 16 bits where all of them fit.
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.known = Memory(self._ids, REMEMBERED)

    @staticmethod
    def _folded(text: str) -> str:
        """The text in lower case where the tokenizer, which folds it in any case, gives the same ids.

        It composes characters before it folds them and finds special tokens before either; it also
        knows no final sigma.  Where one of these could matter the text stays as it is.
        """
        if text.isascii():
            return text if "<|" in text else text.lower()
        if "<|" in text or "Σ" in text or not is_normalized("NFC", text):
            return text
        lower = text.lower()
        return lower if is_normalized("NFC", lower) else text

    def _word(self, word: str) -> bytes:
        """The ids of a word as the tokenizer's model gets it: the characters that stand for its bytes."""
        if not word.isascii():
            word = "".join(map(self.shown.__getitem__, word.encode("utf-8")))
        return array(self.kind, [token.id for token in self.tokenizer.model.tokenize(word)]).tobytes()

    def _ids(self, chunk: str) -> bytes:
        """The ids of one chunk."""
        plain = chunk.isascii()
        if chunk.isalpha() and chunk.islower() and (plain or chunk == chunk.lower() and is_normalized("NFC", chunk)):
            return self._word(chunk)
        body = chunk.rstrip(ENDS)
        if chunk == chunk.lower() and (plain or is_normalized("NFC", chunk)):
            if body != chunk and body and body[-1].isalnum():
                return self.known[body] + self.known[chunk[len(body):]]
            if plain and "<|" not in chunk and PRINTABLE.fullmatch(chunk):
                words = self.words(chunk)
                return self._word(chunk) if len(words) == 1 else b"".join(map(self.known.__getitem__, words))
        return array(self.kind, self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        chunks = self._folded(text).replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.known.__getitem__, chunks)), self.kind)


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    """The encoder for a file that every executor has, built once in a Python worker."""
    return ChunkEncoder(path)


def id_lists(rows: list[np.ndarray]) -> pa.ListArray:
    """Arrays of ids as one Arrow column of lists."""
    offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    values = np.concatenate(rows).astype(np.int32) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _encoded(path: str, end_id: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            rows = [np.append(coder.encode(text.as_py() or "").astype(np.int32), np.int32(end_id)) for text in batch.column("text")]
            others = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), id_lists(rows)], [*others, "ids"])
    return work


def encode_texts(docs: DataFrame, tokenizer: str, end_id: int, *kept: str) -> DataFrame:
    """``(*kept, ids)`` of every row: the ids of its text, then ``end_id``.  Null texts count as empty."""
    slim = docs.select(*kept, "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    return slim.mapInArrow(_encoded(tokenizer, end_id), ", ".join([*fields, "ids array<int>"]))


def _packed(path: str, end_id: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        kind = "<u2" if coder.kind == "H" and end_id < 1 << 16 else "<u4"
        for batch in batches:
            rows = [np.append(coder.encode(text.as_py() or ""), end_id).astype(kind) for text in batch.column("text")]
            others = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in others), pa.array([len(r) for r in rows], pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())],
                [*others, "n_tokens", "ids"])
    return work


def encode_packed(docs: DataFrame, tokenizer: str, end_id: int, *kept: str) -> DataFrame:
    """``(*kept, n_tokens, ids)`` as ``encode_texts`` has them, the ids as bytes: little-endian numbers of 16
    bits where all ids fit, else of 32.  Spark moves them as they are, not number by number."""
    slim = docs.select(*kept, "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    return slim.mapInArrow(_packed(tokenizer, end_id), ", ".join([*fields, "n_tokens bigint, ids binary"]))


def unpacked(ids: bytes, n_tokens: int) -> np.ndarray:
    """The numbers of packed ids."""
    return np.frombuffer(ids, f"<u{len(ids) // n_tokens}")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every text, append ``end_id`` and write ``(doc_id, pid, row, ids)`` in doc_id order.

    ``pid`` is the file's place and ``row`` the row's place in it.  Null doc_ids come first; rows of one
    doc_id go by the hash of their text and may be cut anywhere.  Null texts count as empty.  The text
    crosses one range exchange and is encoded behind it, so sampling the range never encodes.
    """
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_row"))
    ordered = range_sort(slim, ["doc_id", "_h", "_row"])
    encoded = encode_texts(ordered, tokenizer, end_id, "doc_id")
    number_rows(encoded).write.mode("errorifexists").options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def tokens_of(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """``(doc_id, ids)`` of a few documents; the filter reaches the files' indexes and Bloom filters."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "ids")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        ends = lists.offsets.to_numpy()
        sums = [zlib.crc32(ids[a:b].data) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_pydict({
            **{n: batch.column(n) for n in ("doc_id", "pid", "row")},
            "n_tokens": pa.array(np.diff(ends).astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64())})


def token_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files.

    ``start`` counts the ids of all documents before it: a running sum in each file, and one over the
    files' totals, which has one row per file.
    """
    files = read_tokens(spark, path)
    kind = files.schema["doc_id"].dataType.simpleString()
    sums = materialise(files.mapInArrow(
        _sums, f"doc_id {kind}, pid int, row bigint, n_tokens bigint, ids_crc32 bigint"), "token_sums")
    totals = bases(sums.groupBy("pid").agg(F.sum("n_tokens").alias("n")), ["pid"], "n")
    before = Window.partitionBy("pid").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    return (sums.withColumn("_in", inside).join(totals, "pid")
            .select("doc_id", (F.col("base") + F.col("_in")).alias("start"), "n_tokens", "ids_crc32"))


def op4_token_files(spark, sf_dir):
    """All documents, written and read back."""
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    return token_offsets(spark, path)
