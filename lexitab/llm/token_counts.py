"""Token counts by a Viterbi search that keeps scores and counts only.

A text is parted as the tokenizer does it: blanks become the mark, and a new segment starts at every
mark.  An Aho-Corasick automaton over the vocabulary gives all pieces that end at each character, and
each character keeps the best score of a path to it and the number of pieces on that path.  No path is
kept and nothing is traced back.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from lexitab.llm.memory import Memory
from lexitab.plans.fixtures import table

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
# Fixed value: what an unknown character costs below the worst piece.
UNKNOWN_PENALTY = 10.0
# Bytes of segments and their counts that a worker remembers.
REMEMBERED = 128 * 1024 ** 2


class UnigramCounter:
    """Counts the pieces of the best path under ``(piece, score)`` pairs, the unknown piece first.

    Ties go as in the tokenizer: a path must be better, not equal, to replace one that was found from
    an earlier start, so of equal paths to a character the one with the longer last piece stays.  A
    character that is no piece may stand alone at the worst score less the penalty.  Unknown characters
    beside each other are one unknown piece; with ``byte_pieces`` they count as their UTF-8 bytes.  The
    unknown piece written out in a text (``<unk>``) is one piece by itself and unknown characters beside
    others; all other special pieces written out (``<s>``, ``<0x0A>``) count as any piece.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], byte_pieces: bool):
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i == 0))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        # What the unknown piece counts as among unknown characters.
        self.spelt = len(vocabulary[0][0].encode("utf-8"))
        self.known = Memory(lambda part: self.segment(MARK + part), REMEMBERED)

    def _unknown(self, count: int, run: int, size: int, written: bool) -> tuple[int, int]:
        """``(pieces, run)`` after unknown characters of ``size`` bytes; ``run`` tells what was before:
        0 a known piece, 1 unknown characters, 2 the unknown piece, written out, alone."""
        if written and run == 0:
            return count + 1, 2
        if self.byte_pieces:
            return count + size + (self.spelt - 1 if run == 2 else 0), 1
        return count + (run == 0), 1

    def segment(self, text: str) -> tuple[int, float]:
        """``(pieces, score)`` of the best path over one segment."""
        n = len(text)
        score: list[float] = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        run = [0] * (n + 1)
        matches = self.automaton.iter(text)
        match = next(matches, None)
        for end in range(1, n + 1):
            best = float("-inf")
            # Matches of one end come with the longest first, which is the earliest start.
            while match is not None and match[0] < end:
                length, worth, written = match[1]
                start = end - length
                reached = score[start] + worth
                if reached > best:
                    best = reached
                    if written:
                        count[end], run[end] = self._unknown(count[start], run[start], self.spelt, True)
                    else:
                        count[end], run[end] = count[start] + 1, 0
                match = next(matches, None)
            char = text[end - 1]
            if char not in self.single:
                reached = score[end - 1] + self.unknown
                if reached > best:
                    best = reached
                    count[end], run[end] = self._unknown(count[end - 1], run[end - 1], len(char.encode("utf-8")), False)
            score[end] = best
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        """``(pieces, score)`` of a whole text."""
        parts = text.replace(MARK, " ").split(" ")
        # A mark is put before the text unless it starts with one; an empty text has no segment.
        if not parts[0]:
            del parts[0]
        pairs = [*map(self.known.__getitem__, parts)]
        return sum(n for n, _ in pairs), float(sum(worth for _, worth in pairs))


def vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Pieces with their scores, and whether all 256 byte pieces are there."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids], sum(map(model.is_byte, ids)) == 256


@lru_cache(maxsize=4)
def counter(path: str) -> UnigramCounter:
    """The counter for a vocabulary file that every executor has, built once in a Python worker."""
    return UnigramCounter(*vocabulary(path))


def _counted(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = counter(path)
        for batch in batches:
            pairs = [counting.count(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array([n for n, _ in pairs], pa.int64()),
                "score": pa.array([s for _, s in pairs], pa.float64())})
    return work


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, score)`` of every row; null and empty texts have 0 tokens and score 0.

    Rows are independent, so nothing is shuffled; a segment is searched once per worker.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_counted(path), f"doc_id {kind}, n_tokens bigint, score double")


def op5_token_counts(spark, sf_dir):
    """All documents, with the pieces and scores of the vocabulary file as unigrams."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
