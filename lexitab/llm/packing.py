"""Packing documents into sequences of tokens by cutting-stock column generation.

A document is cut into full sequences and a tail shorter than one.  Tails are packed by patterns: how many
tails of which lengths make up one sequence.  A linear program over the histogram of tail lengths chooses
patterns; its columns come from a knapsack dynamic program over the lengths' current prices.  A tail may
also be cut, as a part of one long stream, at a price a little above its length.  So the program always
has a solution, uses no pattern with more padding than that price, and can be stopped at any time.

Long tails of almost the same length are one class of the histogram, with the length of the longest.
Patterns are rounded down and given to the documents by their rank in their class; what rounding leaves
over goes to the stream.  Histogram, patterns and places have a size that the capacity bounds, whatever
the number of documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexitab.llm.token_files import VOCABULARY, encode_packed, id_lists, unpacked
from lexitab.operators.ordering import bases, number_rows, range_sort, with_positions
from lexitab.plans.fixtures import table
from lexitab.session import materialise

CAPACITY, END_ID = 2_048, 1
# What a token of a cut tail costs beside itself: the share of padding below which a tail stays whole.
CUT_COST = 1 / 256
# Tails of up to so many tokens are classes by themselves; longer ones differ by their length's share of it.
CLASS = 256
# The program ends at this share of the possible saving from its optimum, or after so many pivots.
GAP, PIVOTS = 0.02, 1_000
EPSILON = 1e-9


@dataclass
class Pattern:
    """``copies`` tails of each of ``lengths``, in so many sequences."""

    lengths: np.ndarray
    copies: np.ndarray
    sequences: int


def first_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> Iterator[tuple]:
    """Patterns ``(exhausted, items, copies, amount)`` to start from, each of which uses up one length.

    The longest tail that is left is filled up by two that fit exactly, else by the longest that fits, and
    so on.  With more padding than cutting would cost, ``items`` is none: the longest tail is cut.
    Patterns only use what is left, so in the order of what they use up their matrix is triangular.
    """
    left = demand.astype(np.float64)
    at = np.full(capacity + 1, -1)
    at[lengths] = np.arange(len(lengths))
    while (left > 0).any():
        longest = int(np.flatnonzero(left > 0)[-1])
        items, room = [longest], capacity - int(lengths[longest])
        while room:
            fitting = np.flatnonzero((left > 0) & (lengths <= room))
            if not len(fitting):
                break
            rest = room - lengths[fitting]
            exact = fitting[(rest == 0) | (at[rest] >= 0) & (left[at[rest]] > 0)]
            best = int(exact[-1] if len(exact) else fitting[-1])
            items.append(best)
            room -= int(lengths[best])
        kinds, copies = np.unique(items, return_counts=True)
        if room > CUT_COST * (capacity - room):
            yield longest, None, None, left[longest]
            left[longest] = 0
            continue
        amounts = left[kinds] / copies
        out = int(np.argmin(amounts))
        yield int(kinds[out]), kinds, copies, amounts[out]
        left[kinds] = np.maximum(0.0, left[kinds] - amounts[out] * copies)
        left[kinds[out]] = 0


class _Program:
    """The master program: a basis of patterns and cut tails that covers the demand of every length.

    It starts with the patterns of ``first_patterns`` and keeps the inverse of the basis.
    """

    def __init__(self, lengths: np.ndarray, demand: np.ndarray, capacity: int):
        self.lengths, self.capacity, m = lengths, capacity, len(lengths)
        basis, self.amount = np.eye(m), np.zeros(m)
        self.cost = lengths * (1 + CUT_COST)
        self.columns: list[tuple[np.ndarray, np.ndarray] | None] = [None] * m
        for exhausted, items, copies, amount in first_patterns(lengths, demand, capacity):
            self.amount[exhausted] = amount
            if items is not None:
                basis[:, exhausted] = 0
                basis[items, exhausted] = copies
                self.columns[exhausted], self.cost[exhausted] = (items, copies), float(capacity)
        self.inverse = np.linalg.inv(basis)
        self.price = self.cost @ self.inverse

    def knapsack(self) -> tuple[np.ndarray, np.ndarray]:
        """The best worth of tails with exactly ``c`` tokens, for every ``c``, and the last tail of it."""
        worth = np.full(self.capacity + 1, -np.inf)
        last = np.zeros(self.capacity + 1, dtype=np.int64)
        worth[0] = 0.0
        fitting = np.searchsorted(self.lengths, np.arange(self.capacity + 1), side="right").tolist()
        for c in range(int(self.lengths[0]), self.capacity + 1):
            k = fitting[c]
            reached = worth[c - self.lengths[:k]] + self.price[:k]
            last[c] = best = reached.argmax()
            worth[c] = reached[best]
        return worth, last

    def priced(self) -> tuple[list[tuple[np.ndarray, np.ndarray, float]], float]:
        """Columns that save something, for every length the best pattern that holds it and a cut tail; and
        the greatest ratio of worth to cost among all columns."""
        worth, last = self.knapsack()
        best = np.zeros(self.capacity + 1, dtype=np.int64)
        for c in range(1, self.capacity + 1):
            best[c] = c if worth[c] > worth[best[c - 1]] else best[c - 1]
        rests = best[self.capacity - self.lengths]
        values = self.price + worth[rests]
        found = set()
        for i in np.flatnonzero(values > self.capacity * (1 + EPSILON)).tolist():
            items, rest = [i], int(rests[i])
            while rest:
                items.append(int(last[rest]))
                rest -= int(self.lengths[last[rest]])
            found.add(tuple(sorted(items)))
        columns = [(*np.unique(items, return_counts=True), float(self.capacity)) for items in sorted(found)]
        cut = self.lengths * (1 + CUT_COST)
        columns += [(np.array([i]), np.array([1]), float(cut[i])) for i in np.flatnonzero(self.price > cut * (1 + EPSILON))]
        return columns, max(1.0, float(values.max()) / self.capacity, float((self.price / cut).max()))

    def pivot(self, items: np.ndarray, copies: np.ndarray, cost: float) -> None:
        """Take a column into the basis for the one that runs out first."""
        change = self.inverse[:, items] @ copies
        falling = np.flatnonzero(change > EPSILON)
        ratios = self.amount[falling] / change[falling]
        out = falling[np.argmin(ratios)]
        step = self.amount[out] / change[out]
        saved = cost - self.price[items] @ copies
        row = self.inverse[out] / change[out]
        moved = np.flatnonzero(np.abs(change) > EPSILON)
        moved = moved[moved != out]
        self.amount[moved] = np.maximum(0.0, self.amount[moved] - step * change[moved])
        self.inverse[moved] -= change[moved, None] * row
        self.inverse[out], self.amount[out] = row, step
        self.price = self.price + saved * row
        self.cost[out], self.columns[out] = cost, (items, copies) if cost == self.capacity else None

    def solve(self, demand: np.ndarray) -> None:
        pivots = 0
        while pivots < PIVOTS:
            columns, ratio = self.priced()
            # Prices divided by the ratio are feasible, so they bound the optimum from below.
            if not columns or self.price @ demand * (1 - 1 / ratio) <= GAP * CUT_COST * (self.lengths @ demand):
                return
            sizes = np.array([len(items) for items, _, _ in columns])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            items, copies = (np.concatenate([c[k] for c in columns]) for k in (0, 1))
            costs = np.array([c[2] for c in columns])
            for _ in range(len(columns)):
                saving = np.add.reduceat(self.price[items] * copies, starts) - costs
                chosen = int(np.argmax(saving))
                if saving[chosen] <= EPSILON * costs[chosen] or pivots >= PIVOTS:
                    break
                self.pivot(*columns[chosen])
                pivots += 1


def classes(histogram: np.ndarray) -> np.ndarray:
    """The class of every tail length: the longest length that is there and differs by less than the
    length's share ``1 / CLASS``."""
    out = np.arange(len(histogram))
    there = np.flatnonzero(histogram)
    start = 1
    while start < len(histogram):
        end = min(start + start // CLASS, len(histogram) - 1)
        inside = there[(there >= start) & (there <= end)]
        out[start:end + 1] = inside[-1] if len(inside) else end
        start = end + 1
    return out


def patterns(histogram: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns for ``histogram[n]`` tails of ``n`` tokens; no length is used more often than it is there.

    The basis is rounded down, then each of its patterns is taken once more where enough tails are left,
    the largest remainders first.
    """
    lengths = np.flatnonzero(histogram[:capacity])
    lengths = lengths[lengths > 0]
    demand = histogram[lengths].astype(np.int64)
    if not len(lengths):
        return []
    program = _Program(lengths, demand, capacity)
    program.solve(demand)
    left, used = demand.copy(), {}
    some = [i for i, column in enumerate(program.columns) if column is not None]

    def take(i: int, most: int) -> None:
        items, copies = program.columns[i]
        n = min(most, int((left[items] // copies).min()))
        left[items] -= n * copies
        used[i] = used.get(i, 0) + n

    for i in some:
        take(i, int(program.amount[i] + 1e-6))
    for i in sorted(some, key=lambda i: (program.amount[i] % 1, i), reverse=True):
        take(i, 1)
    return [Pattern(lengths[program.columns[i][0]], program.columns[i][1], n) for i, n in used.items() if n]


class Places:
    """Where the tail at a position goes, if tails are ranked by length.

    Runs of positions: ``copies`` tails a sequence from ``sequence`` on, the first at ``slot``, one every
    ``size``; or, with no copies, tails of the stream from token ``slot`` of it.  The stream is cut at the
    capacity and its end into powers of two, so that it needs no padding.
    """

    def __init__(self, histogram: np.ndarray, capacity: int = CAPACITY):
        self.capacity = capacity
        kinds = classes(histogram)
        by_class = np.zeros_like(histogram)
        np.add.at(by_class, kinds, histogram)
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for pattern in patterns(by_class, capacity):
            slot = 0
            for size, copies in sorted(zip(pattern.lengths.tolist(), pattern.copies.tolist()), reverse=True):
                runs.setdefault(size, []).append((pattern.sequences * copies, sequence, copies, slot))
                slot += size * copies
            sequence += pattern.sequences
        self.stream_sequence = sequence
        rows, stream = [(0, 0, 0, 0, 0)], 0
        # Where the tails of each length begin, and the position up to which patterns take them.
        starts = np.concatenate([[0], np.cumsum(histogram)]).tolist()
        taken = starts[1] if len(starts) > 1 else 0
        for length in range(1, len(histogram)):
            if kinds[length] != kinds[length - 1]:
                taken = starts[length]
                for n, first, copies, slot in runs.get(int(kinds[length]), []):
                    rows.append((taken, first, copies, slot, int(kinds[length])))
                    taken += n
            begin = max(taken, starts[length])
            if begin < starts[length + 1]:
                rows.append((begin, 0, 0, stream, length))
                stream += (starts[length + 1] - begin) * length
        self.start, self.sequence, self.copies, self.slot, self.size = (np.array(c, dtype=np.int64) for c in zip(*rows))
        self.full_end = stream // capacity * capacity
        ends, rest = [], stream - self.full_end
        for i in reversed(range(capacity.bit_length())):
            if rest >> i & 1:
                ends.append((ends[-1] if ends else self.full_end) + (1 << i))
        self.ends = ends
        self.sequences = sequence + stream // capacity + len(ends)

    def _stream(self, token: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        done = 0
        while done < length:
            at = token + done
            if at < self.full_end:
                number, start = at // self.capacity, at // self.capacity * self.capacity
                end = start + self.capacity
            else:
                i = bisect_right(self.ends, at)
                number, start, end = self.full_end // self.capacity + i, self.ends[i - 1] if i else self.full_end, self.ends[i]
            size = min(end - at, length - done)
            yield done, size, self.stream_sequence + number, at - start
            done += size

    def pieces(self, positions: np.ndarray, lengths: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """``(start in the tail, length, sequence, slot)`` of the pieces of every tail; slots give the order
        in a sequence."""
        run = np.searchsorted(self.start, positions, side="right") - 1
        nth, copies = positions - self.start[run], self.copies[run]
        each = np.maximum(copies, 1)
        sequence = self.sequence[run] + nth // each
        slot = self.slot[run] + np.where(copies > 0, nth % each, nth) * self.size[run]
        return [([(0, n, s, o)] if c else list(self._stream(o, n))) if n else []
                for n, c, s, o in zip(lengths.tolist(), copies.tolist(), sequence.tolist(), slot.tolist())]


PIECE = ("start", "length", "sequence_id", "slot")


def _placed(places: Places):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, tail = (batch.column(n).to_numpy() for n in ("pos", "tail"))
            found = places.pieces(position, tail)
            doc = np.repeat(batch.column("doc").to_numpy(), [len(f) for f in found])
            columns = list(zip(*(piece for f in found for piece in f))) or [()] * len(PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(doc), *(pa.array(c, pa.int64()) for c in columns)], ["doc", *PIECE])
    return work


def place(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(doc, pieces)`` for unique ``doc`` of ``n_tokens`` each: every token in exactly one piece.

    The histogram of tail lengths, one number per length, is all that reaches the driver.  Tails are
    ranked by one range sort of slim rows, whose bounds cut through the documents of one length.  Offsets
    are running sums inside a sequence.
    """
    tail = F.col("n_tokens") % capacity
    slim = sizes.select("doc", tail.cast("long").alias("tail"), F.floor(F.col("n_tokens") / capacity).cast("long").alias("n_full"))
    ranked = materialise(number_rows(range_sort(slim, ["tail", "doc"])), "tails")
    histogram = np.zeros(capacity, dtype=np.int64)
    for r in ranked.groupBy("tail").agg(F.count(F.lit(1)).alias("n")).collect():
        histogram[r.tail] = r.n
    places = Places(histogram, capacity)
    placed = with_positions(ranked.select("doc", "tail", "pid", "row")).select("doc", "tail", "pos").mapInArrow(
        _placed(places), "doc bigint, start bigint, length bigint, sequence_id bigint, slot bigint")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    full_tokens = F.col("n_full") * capacity

    def piece(start, length, sequence, offset):
        values = zip(("start", "length", "sequence_id", "offset"), (start, length, sequence, offset))
        return F.struct(*(value.cast("long").alias(name) for name, value in values))

    tails = placed.groupBy("doc").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("tails"))
    inside = Window.partitionBy("pid").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    totals = bases(ranked.groupBy("pid").agg(F.sum("n_full").alias("n")), ["pid"], "n")
    first = F.coalesce(F.sum("n_full").over(inside), F.lit(0)) + F.col("base") + places.sequences
    numbered = ranked.join(F.broadcast(totals), "pid").withColumn("first", first)
    whole = F.transform(F.sequence(F.lit(1).cast("long"), "n_full"), lambda i: piece(
        (i - 1) * capacity, F.lit(capacity), F.col("first") + i - 1, F.lit(0)))
    cut = F.transform("tails", lambda t: piece(full_tokens + t["start"], t["length"], t["sequence_id"], t["offset"]))
    none = F.array().cast("array<struct<start: bigint, length: bigint, sequence_id: bigint, offset: bigint>>")
    return numbered.join(tails, "doc", "left").select("doc", F.concat(
        F.when(F.col("n_full") > 0, whole).otherwise(none), F.coalesce(cut, none)).alias("pieces"))


def pack_bytes(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``: the pieces of all documents, their ids
    as the bytes of ``encode_packed``.

    Every text is encoded once, followed by ``end_id`` and written; null texts count as empty and give one
    token.  A document's full sequences stand alone, its tail is one piece unless it is cut.  Sequences are
    numbered from 0: those of patterns, the stream, then full ones; pieces fill a sequence from offset 0
    without a gap.  Each row is a document, also where doc_ids are null or repeated.
    """
    tokens = materialise(encode_packed(docs, tokenizer, end_id, "doc_id").withColumn("doc", F.monotonically_increasing_id()), "tokens")
    places = place(tokens.select("doc", "n_tokens"), capacity)
    width = (F.octet_length("ids") / F.col("n_tokens")).cast("int")
    cut = F.transform("pieces", lambda p: F.struct(
        p["start"].alias("start"), p["length"].alias("length"), p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset"),
        F.substring("ids", (p["start"] * width + 1).cast("int"), (p["length"] * width).cast("int")).alias("ids")))
    # Places grow with the documents as the tokens do: never a broadcast, whatever a small table would allow.
    return tokens.join(places.hint("merge"), "doc").select("doc_id", F.col("n_tokens").alias("doc_tokens"), F.inline(cut)).select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = id_lists([unpacked(i.as_py(), n.as_py()) for i, n in zip(batch.column("ids"), batch.column("length"))])
        others = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), ids], [*others, "ids"])


def _mapped(pieces: DataFrame, work, column: str) -> DataFrame:
    """Pieces with what ``work`` makes of their ids in place of these."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name != "ids"]
    return pieces.mapInArrow(work, ", ".join([*fields, column]))


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``pack_bytes`` with their ids as numbers."""
    return _mapped(pack_bytes(docs, tokenizer, end_id, capacity), _lists, "ids array<int>")


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences, not padded.  A sequence has at most its capacity of pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = pa.array([zlib.crc32(unpacked(i.as_py(), n.as_py()).astype("<u4").data)
                         for i, n in zip(batch.column("ids"), batch.column("length"))], pa.int64())
        others = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), sums], [*others, "ids_crc32"])


def op12_packing(spark, sf_dir):
    """All documents in sequences of 2,048."""
    return _mapped(pack_bytes(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)), _sums, "ids_crc32 bigint")
