"""Quality classification by votes of the nearest labelled texts in a latent semantic space.

A text's terms are its words and the shapes of its words.  Shapes stand alone and in pairs: case, length,
punctuation, and whether the word before was the same; they hold in any language.  Labelled texts give TF-IDF rows, their leading
singular vectors span the space, and the labelled vectors in it are broadcast.  Every document is compared
with all of them by exact cosine products, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexitab.llm.memory import Memory, release
from lexitab.llm.samples import bounded_sample, fold_of
from lexitab.plans.fixtures import table

# Places of hashed shapes, of hashed words, and both.
SHAPES, WORDS = 1_024, 1_024
TERMS = SHAPES + WORDS
DIMENSIONS, NEIGHBOURS = 32, 15
# Bound of the training sample: texts of each label.
SAMPLE = 1_500
# Documents that are compared at a time, and bytes of word hashes a worker remembers.
BLOCK, REMEMBERED = 128, 24 << 20
FOLDS, HELD_OUT = 3, 1
GOOD = 0.5


def shape(word: str) -> str:
    """Case, rough length and first kinds of punctuation of a word."""
    core, marks = word, ""
    if not word.isalnum():
        core = "".join(c for c in word if c.isalnum())
        marks = "".join(sorted({c for c in word if not c.isalnum()}))[:3]
    if core.islower():
        case = "l"
    elif core.isupper():
        case = "U"
    elif core[:1].isupper() and core[1:].islower():
        case = "T"
    else:
        case = "m" if core.lower() != core.upper() else "n"
    return f"{case}{min(len(core).bit_length(), 5)}{marks}"


def _code(word: str) -> int:
    """The hash of a word's shape above the hash of the word in lower case."""
    return xxhash.xxh32_intdigest(shape(word)) << 32 | xxhash.xxh32_intdigest(word.lower().encode("utf-8", "surrogatepass"))


_codes = Memory(_code, REMEMBERED)


def terms(text: str | None) -> np.ndarray:
    """Counts of the hashed terms of a whole text, shapes before words; all zero for a text without words."""
    words = (text or "").split()
    if not words:
        return np.zeros(TERMS, dtype=np.int64)
    both = np.fromiter(map(_codes.__getitem__, words), dtype=np.uint64, count=len(words))
    codes = both >> np.uint64(32) << np.uint64(1)
    codes[1:] |= np.fromiter(map(str.__eq__, words, words[1:]), dtype=np.uint64, count=len(words) - 1)
    pairs = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:]
    mixed = np.concatenate([codes, pairs]) * np.uint64(0xBF58476D1CE4E5B9)
    shapes = (mixed >> np.uint64(40)) % np.uint64(SHAPES)
    return np.bincount(np.concatenate([shapes, both % np.uint64(WORDS) + np.uint64(SHAPES)]).astype(np.int64), minlength=TERMS)


def _forget() -> None:
    """Gives back what a task's words and batches took, as the worker goes on to other stages."""
    _codes.clear()
    _codes.old, _codes.size = {}, 0
    release()


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one."""
    rows = np.log1p(counts, dtype=np.float64)
    rows *= idf
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    return rows


@dataclass
class Model:
    """The space, the labelled vectors in it, their labels and what each of their votes counts."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of rows of term counts; zero rows stay zero."""
        return _unit(_weighted(counts, self.idf) @ self.basis)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest labelled texts.

        All texts as near as the last of the NEIGHBOURS, to nine digits, vote.  A text without words
        scores 0, one unlike all labelled texts, or with none to compare, 0.5.
        """
        empty = counts.sum(axis=1) == 0
        result = np.full(len(counts), 0.5)
        if len(self.labels):
            near = np.maximum(self.embed(counts) @ self.vectors.T, 0).round(9)
            k = min(NEIGHBOURS, near.shape[1])
            last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            votes = np.where(near >= last[:, None], near, 0) * self.weights
            total = votes.sum(axis=1)
            np.divide(votes @ self.labels, total, out=result, where=total > 0)
        result[empty] = 0.0
        return np.clip(result, 0.0, 1.0)


def leading(rows: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` leading right singular vectors of rows, as columns; zero columns beyond their rank.

    They come from the eigenvectors of the products of the rows or of the columns, whichever are fewer.
    """
    if len(rows) > rows.shape[1]:
        return np.linalg.eigh(rows.T @ rows)[1][:, ::-1][:, :k]
    left = np.linalg.eigh(rows @ rows.T)[1][:, ::-1][:, :k]
    right = rows.T @ left
    length = np.linalg.norm(right, axis=0)
    return right / np.where(length > 1e-6, length, np.inf)


def fit_rows(counts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Model:
    """A model from labelled rows of term counts; none, or rows without a word, are fine."""
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
    rows = _weighted(counts, idf)
    basis = leading(rows, DIMENSIONS)
    return Model(idf, basis, _unit(rows @ basis), labels, weights)


def _packed(counts: np.ndarray) -> bytes:
    """The places that are not zero, and their counts."""
    at = np.flatnonzero(counts)
    return np.concatenate([at, counts[at]]).astype("<i4").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    at, n = np.frombuffer(packed, dtype="<i4").reshape(2, -1)
    counts = np.zeros(TERMS, dtype=np.int32)
    counts[at] = n
    return counts


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [_packed(terms(text.as_py())) for text in batch.column("text")]
        yield pa.RecordBatch.from_pydict({
            "quality": batch.column("quality").cast(pa.int32()),
            "counts": pa.array(counts, pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` documents of each quality.

    Documents and labels meet by their ids alone.  Only term counts, at most 16 KB each, reach the driver.
    A vote counts as many documents as its text stands for, so the bound does not shift the labels' shares.
    Where rows of ``labels`` disagree on a document the lower quality holds.
    """
    marks = labels.filter("quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    ids = docs.select("doc_id").join(marks, F.col("doc_id") == F.col("_id")).select("doc_id", "quality")
    rows, totals = bounded_sample(docs, ids, "quality", sample)
    found = rows.select("quality", "text").mapInArrow(
        _term_rows, "quality int, counts binary").toPandas().sort_values(["quality", "counts"])
    counts = np.array([_unpacked(c) for c in found["counts"]], dtype=np.int32).reshape(-1, TERMS)
    quality = found["quality"].to_numpy(dtype=np.int64)
    stands_for = [totals[q] / (quality == q).sum() for q in quality]
    return fit_rows(counts, (quality > 0).astype(np.float64), np.array(stands_for, dtype=np.float64))


def _scores(model: Model, texts) -> np.ndarray:
    """Scores of a column of texts, in blocks."""
    blocks = (np.stack([terms(t.as_py()) for t in texts[i:i + BLOCK]]) for i in range(0, len(texts), BLOCK))
    return np.concatenate([np.empty(0), *(model.scores(b) for b in blocks)])


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold_of("doc_id", FOLDS) != HELD_OUT)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row, learnt from the labels not held out.

    Every whole text is read once where it lies; the broadcast model is at most ``2 * sample`` vectors of
    32 numbers and the space.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs), labels, sample))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(score),
                "predicted": pa.array((score >= GOOD).astype(np.int32))})
        _forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text").mapInArrow(
        work, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows, with all their columns, that are predicted to be of quality 1."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs), labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column("text")) >= GOOD))
        _forget()

    return docs.mapInArrow(work, docs.schema)


def op10_quality(spark, sf_dir):
    """All documents."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
