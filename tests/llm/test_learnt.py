import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lexitab.llm import decontamination, language, quality, samples, simhash
from lexitab.plans.fixtures import table

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, score string"


def remainder(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


# --- samples ----------------------------------------------------------------------------------

def test_samples_are_bounded_for_hot_ids_and_labels(spark):
    rows = [(i, f"t{i}", "a") for i in range(500)] + [(7000, f"u{i}", "b") for i in range(600)]
    rows += [(8000, "same", "d")] * 300 + [(None, "n", "c"), (9, "x", None)]
    schema = "doc_id bigint, text string, lang string"

    def sample(docs):
        return samples.bounded_sample(docs, docs.select("doc_id", "lang"), "lang", 10)
    found, totals = sample(spark.createDataFrame(rows, schema))
    counts = {r.lang: r["count"] for r in found.groupBy("lang").count().collect()}
    assert counts == {"a": 10, "b": 10, "c": 1, "d": 1}
    assert totals == {"a": 500, "b": 1, "c": 1, "d": 1}
    again, _ = sample(spark.createDataFrame(rows, schema).repartition(7))
    assert sorted(map(str, found.collect())) == sorted(map(str, again.collect()))


# --- language ---------------------------------------------------------------------------------

def test_held_out_languages_are_told(spark):
    want = {r.doc_id: r.lang for r in table(spark, SF, "documents").select("doc_id", "lang").collect()}
    found = language.op8_language(spark, SF).collect()
    assert len(found) == len(want)
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.98 * len(held)


def test_grams_and_filter_by_brute_force(spark):
    """Every n-gram of the training texts that belongs to a language is in its filter, and the score is
    what counting the filter's answers one by one gives."""
    docs = language.training_rows(table(spark, SF, "documents"))
    model = language.fit(docs, 30)
    rates = model.false_rates()
    for text in ("", "...", "De.", "The anhely eran. Was erlytion 12 that", "Èonai aiaiai, retion en ouéaieux"):
        grams, letters = language.ngrams(text)
        shown = "".join(c if c.isalpha() else "." for c in f".{text.lower()}.")
        windows = [shown[i:i + 4] for i in range(len(shown) - 3)]
        assert len(grams) == sum("." not in w[1:3] for w in windows)
        hits = np.zeros(len(model.languages))
        n = 0
        for gram in grams.tolist():
            mask = (1 << len(model.languages)) - 1
            for at in language.slots(np.array([gram], dtype=np.uint64)):
                mask &= int(model.words[0, at[0]])
            if mask != (1 << len(model.languages)) - 1:
                n += 1
                hits += [mask >> i & 1 for i in range(len(hits))]
        hits = np.maximum(0, (hits - n * rates) / (1 - rates))
        got = model.predict(text, rates)
        if not letters:
            assert got == ("und", 0.0)
        elif hits.sum() > 0:
            assert got[0] == model.languages[int(np.argmax(hits))] and abs(got[1] - hits.max() / hits.sum()) < 1e-12
        else:
            assert got == (model.languages[int(np.argmax(model.shares))], max(model.shares))


def test_odd_language_rows(spark):
    rows = [(i, "the quick brown fox and the other foxes", "en", "s", "x") for i in range(20)]
    rows += [(100 + i, "der schnelle braune fuchs und die anderen", "de", "s", "x") for i in range(20)]
    rows += [(200, None, "en", "s", "x"), (201, "", None, None, None), (202, "12 !?", "en", "s", "x"), (None, "the fox", None, "s", "x"),
             (203, "ж", "en", "s", "x"), (204, "fuchs und " * 30_000, None, "s", "x"), (205, "the fox", None, "s", "x"), (205, "the fox", None, "s", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    found = language.identify(docs).collect()
    got = {r.doc_id: r.lang_pred for r in found}
    assert len(found) == len(rows)
    assert (got[200], got[201], got[202]) == ("und",) * 3
    assert got[205] == "en" and got[204] == "de" and got[None] == "en" and got[203] in ("en", "de")
    kept = language.keep_certain(docs)
    assert kept.schema == docs.schema
    assert {200, 201, 202}.isdisjoint({r.doc_id for r in kept.collect()})
    none = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language.identify(spark.createDataFrame([], DOCS)).count() == 0
    assert language.keep_certain(spark.createDataFrame([], DOCS)).count() == 0


def test_more_languages_than_a_word_has_bits(spark):
    draw = random.Random(2)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(70)]
    rows = [(100 * i + j, f"{w} {w} {w}", f"l{i:02}", "s", "x") for i, w in enumerate(words) for j in range(4)]
    found = language.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert sum(r.lang_pred == f"l{r.doc_id // 100:02}" for r in found) >= 0.95 * len(found)


STRANGE = [(900, "Это русский текст о погоде, о людях и о городе"), (901, "这是一个关于天气和人们的中文句子"), (902, "xqzt wvkj qqpl zzxk brfg vvtq"),
           (903, "Kissa nukkuu tuolilla ikkunan vieressä ja näkee unta hiiristä"), (904, "ж"), (905, "a")]


@pytest.mark.parametrize("mix", [(40, 40, 40, 40), (400, 40, 40, 40)])
def test_texts_in_no_learnt_language_are_left_out(spark, mix):
    """Whatever the mix: with equal shares no language has 0.35 of the training ids, with the other one has."""
    draw = random.Random(5)
    words = {"en": "the quick brown fox and other foxes were walking through green woods with their friends",
             "de": "der schnelle braune fuchs und die anderen gingen durch den dunklen wald mit ihren freunden",
             "fr": "le renard brun et les autres marchaient dans la grande forêt avec leurs amis pendant une semaine",
             "es": "el zorro rápido y los otros caminaban por el bosque verde con sus amigos durante muchos días"}
    rows = [(1000 * k + i, " ".join(draw.choices(words[lang].split(), k=12)), lang, "s", "x")
            for k, lang in enumerate(words, 1) for i in range(mix[k - 1])]
    rows += [(i, text, None, "s", "x") for i, text in STRANGE]
    rows += [(950, "the fox", None, "s", "x"), (951, "der fuchs und die freunde", None, "s", "x"), (952, "12 !?", None, "s", "x")]
    kept = {r.doc_id for r in language.keep_certain(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == {r[0] for r in rows} - {i for i, _ in STRANGE} - {952}


@pytest.mark.parametrize("out", ["de", "es"])
def test_a_language_left_out_of_training_is_left_out(spark, out):
    docs = table(spark, SF, "documents")
    lang = F.when(F.col("lang") != out, F.col("lang"))
    want = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    kept = [want[r.doc_id] for r in language.keep_certain(docs.withColumn("lang", lang)).collect()]
    assert kept.count(out) <= 0.05 * list(want.values()).count(out)
    assert len(kept) - kept.count(out) >= 0.99 * sum(x != out for x in want.values())


# --- quality ----------------------------------------------------------------------------------

def test_held_out_quality_is_told(spark):
    want = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    found = quality.op10_quality(spark, SF).collect()
    assert len(found) == table(spark, SF, "documents").count()
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in want]
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.97 * len(held)


def plain_terms(text):
    """Counts of the terms of a text, one word after the other, by whole numbers of Python."""
    counts, before, last = [0] * quality.TERMS, None, None
    for word in (text or "").split():
        code = xxhash.xxh32_intdigest(quality.shape(word)) * 2 + (word == before)
        for term in [code] if last is None else [code, (last * 0x9E3779B97F4A7C15) % 2 ** 64 ^ code]:
            counts[((term * 0xBF58476D1CE4E5B9) % 2 ** 64 >> 40) % quality.SHAPES] += 1
        counts[quality.SHAPES + xxhash.xxh32_intdigest(word.lower().encode()) % quality.WORDS] += 1
        before, last = word, code
    return counts


def test_scores_from_texts_by_brute_force(spark):
    """From texts to scores: terms by a loop, the space by a full singular value decomposition, votes one by one."""
    rows = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.001", "labels").collect() if r.quality is not None}
    learnt = [r for r in rows if remainder(r.doc_id, 3) != 1 and r.doc_id in labels]
    assert all(sum(labels[r.doc_id] == q for r in learnt) < quality.SAMPLE for q in (0, 1))
    counts = np.array([plain_terms(r.text) for r in learnt], dtype=float)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
    table_rows = np.log1p(counts) * idf
    table_rows /= np.linalg.norm(table_rows, axis=1)[:, None]
    space = np.linalg.svd(table_rows, full_matrices=False)[2][:quality.DIMENSIONS].T
    found = {r.doc_id: r.score for r in quality.op10_quality(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(rows)

    def vector(one):
        one = one / np.linalg.norm(one) @ space
        return one / np.linalg.norm(one)
    known = [vector(r) for r in table_rows]
    for r in rows[::7]:
        one = vector(np.log1p(np.array(plain_terms(r.text))) * idf)
        near = [max(0.0, float(one @ v)) for v in known]
        last = sorted(near, reverse=True)[quality.NEIGHBOURS - 1]
        votes = [(s, labels[x.doc_id]) for s, x in zip(near, learnt) if s >= last - 1e-9]
        assert abs(sum(s * (q > 0) for s, q in votes) / sum(s for s, _ in votes) - found[r.doc_id]) < 1e-6


def test_words_tell_what_shapes_do_not(spark):
    """Two kinds of texts with the same shapes of words and other words."""
    draw = random.Random(8)
    kinds = [["lorem", "dolor", "ipsum", "amets"], ["river", "stone", "cloud", "grass"]]
    rows = [(100 * k + i, " ".join(draw.choices(kinds[k], k=30)), "en", "s", "x") for k in (0, 1) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(r[0], r[0] // 100) for r in rows], "doc_id bigint, quality int")
    found = quality.classify(docs, labels).collect()
    assert sum(r.predicted == r.doc_id // 100 for r in found if r.held_out) >= 0.95 * sum(r.held_out for r in found)


def test_votes_by_brute_force():
    draw = np.random.default_rng(6)
    counts = draw.poisson(0.05, (80, quality.TERMS))
    labels, weights = draw.integers(0, 2, 80).astype(float), draw.uniform(1, 3, 80)
    model = quality.fit_rows(counts, labels, weights)
    asked = np.concatenate([draw.poisson(0.05, (20, quality.TERMS)), counts[:3], np.zeros((1, quality.TERMS), dtype=int)])
    got = model.scores(asked)
    vectors = model.embed(asked)
    for row, score in zip(vectors[:-1], got):
        near = [round(max(0.0, float(row @ v)), 9) for v in model.vectors]
        last = sorted(near, reverse=True)[quality.NEIGHBOURS - 1]
        votes = [(s * w, y) for s, w, y in zip(near, weights, labels) if s >= last]
        assert abs(sum(v * y for v, y in votes) / sum(v for v, _ in votes) - score) < 1e-6
    assert got[-1] == 0.0
    assert np.allclose(np.linalg.norm(model.vectors, axis=1), 1)


def test_odd_quality_rows(spark):
    rows = [(i, "Some plain words of a good text. And more of it.", "en", "s", "x") for i in range(30)]
    rows += [(100 + i, "BAD!! BAD!! BAD!! $$$ ### ### $$$", "en", "s", "x") for i in range(30)]
    rows += [(300, None, None, None, None), (301, "", "en", "s", "x"), (None, "Some plain words.", "en", "s", "x"),
             (302, "Other plain words of a text " * 20_000, "en", "s", "x"), (303, "BAD!! BAD!!", "en", "s", "x"), (303, "BAD!! BAD!!", "en", "s", "x")]
    marks = [(i, 1, 0, "x") for i in range(30)] + [(100 + i, 0, 0, "x") for i in range(30)] + [(5, 1, 0, "x"), (None, 1, 0, "x"), (6, None, 0, "x"), (999, 1, 0, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int, text string")
    found = quality.classify(docs, labels).collect()
    got = {r.doc_id: r.predicted for r in found}
    assert len(found) == len(rows)
    assert got[300] == got[301] == got[303] == 0 and got[302] == got[None] == 1
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, p in got.items() if p}
    assert quality.classify(spark.createDataFrame([], DOCS), labels).count() == 0
    unlabelled = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.0, 0.5}


# --- pipeline ---------------------------------------------------------------------------------

def test_the_pipeline_by_its_stages(spark):
    """Each stage against a plain version of its rule over what the stage before kept."""
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality.classify(docs, table(spark, SF, "labels")).collect() if r.predicted}
    kept = corpus_pipeline.good_quality(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == good
    kept = corpus_pipeline.known_language(spark, kept, SF)
    known = {r.doc_id for r in kept.collect()}
    assert known <= good and len(known) >= 0.99 * len(good)

    one = corpus_pipeline.one_of_near_copies(spark, kept, SF)
    prints = {d: simhash.fingerprint(rows[d].text) & (1 << 64) - 1 for d in known}
    left = {d: d for d in sorted(known)}
    changed = True
    while changed:
        changed = False
        for a in left:
            for b in left:
                if left[b] < left[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    left[a], changed = left[b], True
    first = {d for d in left if left[d] == d}
    assert {r.doc_id for r in one.collect()} == first

    clean = corpus_pipeline.no_benchmark(spark, one, SF)
    assert clean.columns == docs.columns
    hit = {r.doc_id for r in decontamination.contained(one, table(spark, SF, "benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == first - hit
    result = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in result} == first - hit and len(result) == len(first - hit)


def test_the_last_stage_keeps_the_ids(spark):
    docs = spark.createDataFrame([(1, "Some words here.", "en", "s", "x"), (2, None, None, None, None)], DOCS)
    made = {r.doc_id: r for r in corpus_pipeline.tokens(spark, docs, SF).collect()}
    assert len(made[1].ids) == made[1].n_tokens > 0 and made[2].ids == []
    assert hashlib.sha256(",".join(map(str, made[1].ids)).encode()).hexdigest() == made[1].ids_sha256


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "s", "x"), (2, "", None, None, None), (None, "Some words here.", "en", "s", "x"),
                                       (3, "Some other words.", "en", "s", "x"), (3, "Some other words.", "en", "s", "x")]])
def test_stages_take_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        assert name == "byte-level BPE" or made.columns == docs.columns
        assert made.count() <= len(rows)
        docs = made if name != "byte-level BPE" else docs


def test_predictions_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat", "en", 5.0, "x") for i in range(8)],
                                 "doc_id int, text string, lang string, score double, lang_pred string")
    made = language.predict(docs.select("doc_id", "text", "score", "lang_pred"), language.fit(docs, 10))
    assert made.columns == ["doc_id", "lang_pred", "score"] and {r.lang_pred for r in made.collect()} == {"en"}


def test_too_many_labels_are_refused(spark):
    docs = spark.range(1_500).selectExpr("id as doc_id", "'a b' as text", "cast(id as string) as lang")
    with pytest.raises(ValueError, match="different values of lang"):
        language.fit(docs, 10)
