"""Language identification by n-gram filters with a bitmask of languages.

A Bloom filter is kept for every language, all of them bit-sliced into one array: bit ``l`` of a slot
says whether the filter of language ``l`` has it set.  One lookup ANDs the slots of an n-gram and gives
all languages that contain it.  A text's hits per language are counted, corrected for the filters' false
positives, and the language with most of them is predicted.  The part of a text's n-grams that this
language contains is the evidence that the text is in a learnt language at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexitab.llm.memory import release
from lexitab.llm.samples import bounded_sample, fold_of
from lexitab.plans.fixtures import table
from lexitab.session import materialise

N = 4
HASHES, SLOTS = 3, 1 << 20
# Bound of the training sample: texts of each language.
SAMPLE = 1_000
# An n-gram belongs to a language if it was seen so often there, and so often against all languages.
LEAST, SHARE = 3, 0.05
# Languages in one word of a slot.
WORD = 63
FOLDS, HELD_OUT = 4, 2
UNDECIDED = "und"
# A prediction below this score is rejected in the pipeline.
CERTAIN = 0.35
# So is one with less than this part of the evidence that half of the language's own unseen texts reach.
EVIDENCE = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code points by themselves if they are letters, else 0."""
    return np.array([i if chr(i).isalpha() else 0 for i in range(0x110000)], dtype=np.uint32)


def ngrams(text: str | None) -> tuple[np.ndarray, bool]:
    """Hashes of the n-grams of a text, repeats included, and whether it has a letter.

    Letters are lower-cased; all else counts as one gap, which may start or end an n-gram but not stand
    inside it.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = np.zeros(len(points) + 2, dtype=np.uint64)
    letters[1:-1] = _letters()[points]
    inside = letters != 0
    starts = len(letters) - N + 1
    if starts < 1:
        return np.empty(0, dtype=np.uint64), bool(inside.any())
    good = np.ones(starts, dtype=bool)
    for j in range(1, N - 1):
        good &= inside[j:j + starts]
    at = np.flatnonzero(good)
    value = letters[at]
    for j in range(1, N):
        value = (value * np.uint64(0x9E3779B97F4A7C15)) ^ letters[at + j]
    return _mixed(value), bool(inside.any())


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


def slots(grams: np.ndarray) -> list[np.ndarray]:
    """The slots of n-grams, one array for each hash: three cuts of 20 bits of the mixed hash."""
    return [((grams >> np.uint64(20 * i + 1)) % np.uint64(SLOTS)).astype(np.int64) for i in range(HASHES)]


@dataclass
class Model:
    """Languages in order, their training shares, and the filter: ``words[w][slot]`` holds their bits."""

    languages: list[str]
    shares: list[float]
    words: np.ndarray

    def false_rates(self) -> np.ndarray:
        """How likely each language's filter says yes to an n-gram it lacks."""
        fill = [((self.words[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1)).mean() for i in range(len(self.languages))]
        return np.array(fill, dtype=np.float64) ** HASHES

    def predict(self, text: str | None, false_rates: np.ndarray) -> tuple[str, float]:
        """The language and its share of all corrected hits.

        N-grams that all languages contain decide nothing and are left out.  Without a hit the language
        most frequent in training is taken, with its share there; ties go to the first language.
        """
        return self.judge(text, false_rates)[:2]

    def judge(self, text: str | None, false_rates: np.ndarray) -> tuple[str, float, float]:
        """The language, its share and the evidence: its corrected hits against all n-grams of the text.

        For the evidence, n-grams that all languages contain count too.  It is 0 where the hits decide
        nothing, so that the language is that of ``shares`` or none.
        """
        grams, letters = ngrams(text)
        if not letters or not self.languages:
            return UNDECIDED, 0.0, 0.0
        at = slots(grams)
        masks = self.words[:, at[0]]
        for more in at[1:]:
            masks = masks & self.words[:, more]
        bits = np.stack([(masks[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1) for i in range(len(self.languages))])
        some = bits[:, bits.sum(axis=0) < len(self.languages)] if len(self.languages) > 1 else bits
        hits = np.maximum(0.0, (some.sum(axis=1) - some.shape[1] * false_rates) / (1 - false_rates))
        if not hits.sum() > 0:
            best = int(np.argmax(self.shares))
            return self.languages[best], self.shares[best], 0.0
        best = int(np.argmax(hits))
        rate = false_rates[best]
        evidence = max(0.0, float((bits[best].mean() - rate) / (1 - rate)))
        return self.languages[best], float(hits[best] / hits.sum()), evidence


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, gram, n)`` of a batch: texts are counted before anything leaves the task."""
    for batch in batches:
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            by_lang.setdefault(lang, []).append(ngrams(text.as_py())[0])
        for lang, grams in by_lang.items():
            gram, n = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(gram), pa.string()), "gram": pa.array(gram.view(np.int64)),
                "n": pa.array(n.astype(np.int64))})


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the non-null ``lang`` of at most ``sample`` texts of each language.

    The filter is put together by Spark, one row per used slot, so at most SLOTS rows per 63 languages
    reach the driver.
    """
    return _fit_rows(*bounded_sample(docs, docs.select("doc_id", "lang"), "lang", sample))


def _fit_rows(rows: DataFrame, totals: dict) -> Model:
    languages = sorted(totals)
    shares = [totals[lang] / sum(totals.values()) for lang in languages]
    words = np.zeros((max(1, -(-len(languages) // WORD)), SLOTS), dtype=np.uint64)
    if not languages:
        return Model([], [], words)
    counts = rows.select("lang", "text").mapInArrow(_gram_counts, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rate = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    kept = (counts.withColumn("rate", rate)
            .withColumn("share", F.col("rate") / F.sum("rate").over(Window.partitionBy("gram")))
            .filter((F.col("n") >= LEAST) & (F.col("share") >= SHARE)))
    number = F.create_map(*(F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)))[F.col("lang")]
    each = kept.withColumn("i", number).select(
        F.floor(F.col("i") / WORD).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(i % {WORD} as int))").alias("bit"),
        F.explode(F.array(*(F.pmod(F.shiftrightunsigned("gram", 20 * k + 1), F.lit(SLOTS)) for k in range(HASHES)))).alias("slot"))
    filled = each.groupBy("word", "slot").agg(F.bit_or("bit").alias("mask")).toPandas()
    words[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy().astype(np.uint64)
    return Model(languages, shares, words)


def fit_with_bounds(docs: DataFrame, sample: int = SAMPLE) -> tuple[Model, dict[str, float]]:
    """What ``fit`` learns, and the least evidence that a text of each language has to show.

    The bounds come from texts that a filter has not seen: one half of the sample is judged by a model of
    the other, and a language's bound is EVIDENCE times the median of its texts.  A language whose sample
    is too small to tell has the bound 0.
    """
    rows, totals = bounded_sample(docs, docs.select("doc_id", "lang"), "lang", sample)
    rows = materialise(rows, "language_sample")
    model = _fit_rows(rows, totals)
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id", "text"), F.lit(2))
    shared = docs.sparkSession.sparkContext.broadcast(_fit_rows(rows.filter(half == 0), totals))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rates = shared.value.false_rates()
        for batch in batches:
            made = [shared.value.judge(text.as_py(), rates)[2] for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "evidence": pa.array(made, pa.float64())})

    unseen = rows.filter(half == 1).select("lang", "text").mapInArrow(work, "lang string, evidence double")
    medians = {r.lang: r.median for r in unseen.groupBy("lang").agg(F.median("evidence").alias("median")).collect()}
    return model, {lang: EVIDENCE * medians.get(lang, 0.0) for lang in model.languages}


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` needed and given: ``(doc_id, text) -> (doc_id, lang_pred, score)``.

    Every whole text is read once, in the order of the input; the filter, 8 MB for 63 languages, is
    broadcast.  Texts that are null, empty or free of letters are ``und`` with score 0.  Columns that are
    named ``lang_pred`` or ``score`` are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rates = shared.value.false_rates()
        for batch in batches:
            made = [shared.value.predict(text.as_py(), rates) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                **{n: batch.column(n) for n in batch.schema.names if n != "text"},
                "lang_pred": pa.array([x for x, _ in made], pa.string()),
                "score": pa.array([x for _, x in made], pa.float64())})

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(work, ", ".join([*fields, "lang_pred string", "score double"]))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold_of("doc_id", FOLDS) != HELD_OUT)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row, learnt from the rows not held out."""
    model = fit(training_rows(docs), sample)
    return predict(docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text"), model)


def keep_certain(docs: DataFrame, least: float = CERTAIN) -> DataFrame:
    """Rows, with all their columns, whose language is decided with a score of at least ``least``.

    The score says how far the language stands out among the learnt ones.  Rows also have to show evidence
    of it, at least the language's bound: texts in scripts or languages that were not learnt, gibberish and
    texts without an n-gram that decides are left out, whatever the mix of the corpus.
    """
    model, bounds = fit_with_bounds(training_rows(docs))
    shared = docs.sparkSession.sparkContext.broadcast((model, bounds))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bounds = shared.value
        rates = model.false_rates()
        for batch in batches:
            made = [model.judge(text.as_py(), rates) for text in batch.column(batch.schema.get_field_index("text"))]
            yield batch.filter(pa.array([evidence > 0 and score >= least and evidence >= bounds[lang]
                                         for lang, score, evidence in made], pa.bool_()))
        release()

    return docs.mapInArrow(work, docs.schema)


def op8_language(spark, sf_dir):
    """All documents."""
    return identify(table(spark, sf_dir, "documents"))
