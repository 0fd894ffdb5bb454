import csv
import glob
import io

import pytest
from pyspark.sql import functions as F

from lexitab.plans import build
from lexitab.sources import synthetic


def collected(df):
    return [(r.title, r.value, r.ord) for r in df.collect()]


def test_rows_are_unique_long_enough_and_on_one_line(spark):
    df = synthetic.generate(spark, num_rows=60, seed=5)
    got = df.withColumn("target", synthetic.target_bytes(F.col("ord"), 5)).collect()
    assert len(got) == len({r.title for r in got}) == 60
    for r in got:
        size = len(r.value.encode())
        assert 5000 <= r.target <= 12000 and r.target <= size < r.target + 1500
        assert " ".join(r.value.split()) == r.value
    assert [r.title.lower() for r in got] == sorted(r.title.lower() for r in got)


def test_a_seed_repeats_under_any_partitioning(spark):
    want = collected(synthetic.generate(spark, num_rows=30, seed=1))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert collected(synthetic.generate(spark, num_rows=30, seed=1)) == want
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert collected(synthetic.generate(spark, num_rows=30, seed=2)) != want


def test_shortfall_warns(spark):
    with pytest.warns(UserWarning, match="unique titles of 400 requested"):
        df = synthetic.generate(spark, num_rows=400, templates=["{first}"])
    titles = [r.title for r in df.select("title").collect()]
    assert len(titles) == len(set(titles)) <= len(synthetic.FIRST.split())


def test_limit_keeps_the_first_attempts(spark):
    attempts = spark.range(200).select(F.col("id").alias("attempt"))
    title = {r.attempt: r.t for r in attempts.select(
        "attempt", synthetic.title(F.col("attempt"), 3, ["{first}"]).alias("t")).collect()}
    seen, want = set(), []
    for attempt in range(200):
        if title[attempt] not in seen and len(want) < 12:
            seen.add(title[attempt])
            want.append(attempt)
    asked = []

    def block(i):
        asked.append(i)
        return spark.range(i * 20, (i + 1) * 20).select(F.col("id").alias("attempt"))
    got = synthetic.from_attempts(block, 12, 3, ["{first}"])
    assert sorted(r.ord for r in got.select("ord").collect()) == want
    assert asked == list(range(want[-1] // 20 + 1))


def test_all_templates_are_drawn_evenly(spark):
    n = len(synthetic.FULL_TEMPLATES)
    assert len(set(synthetic.FULL_TEMPLATES)) == n
    draws = spark.range(20_000).select(synthetic._Draw.of(0, F.col("id")).number(100, 1, n).alias("n"))
    counts = [r["count"] for r in draws.groupBy("n").count().collect()]
    assert len(counts) == n and min(counts) > 0.7 * 20_000 / n and max(counts) < 1.35 * 20_000 / n


def test_short_words_still_fill_a_value(spark):
    ids = spark.range(20).select(synthetic.value(F.col("id"), 1, F.lit(900), "a b c").alias("v"))
    assert all(900 <= len(r.v) < 2500 for r in ids.collect())


def test_values_stop_at_the_first_sentence_end_behind_the_target(spark):
    """By arithmetic in Python: draws, the stop rule, capitals and marks."""
    words, seed, p = "ab cde fghi é".split(), 9, synthetic.PRIME

    def key(attempt, use):
        x = (attempt % p + (seed * 7_368_787 + use * 15_485_863) % p) % p
        x = (x * x + 99_991) % p
        return (x * x + attempt + use) % p

    def made(attempt, target):
        k, out, sentence, total, n = key(attempt, 1), [], [], 0, 0
        while True:
            n += 1
            x = (k + n * 104_729) % p
            x = (x * x + k) % p
            x = (x * x + 104_729) % p
            rest, word = divmod(x, len(words))
            sentence.append(words[word])
            total += len(words[word].encode()) + 1
            if rest % synthetic.SENTENCE == 0 or n % synthetic.LONGEST == 0:
                mark = synthetic.MARKS[rest // synthetic.SENTENCE % len(synthetic.MARKS)]
                out.append(" ".join([sentence[0].capitalize(), *sentence[1:]]) + mark)
                sentence = []
                if total >= target:
                    return " ".join(out)

    ids = spark.createDataFrame([(i,) for i in [0, 1, 5, 2_147_483_646, 2_147_483_647, 10 ** 12]], "id bigint")
    got = ids.select("id", synthetic.value(F.col("id"), seed, F.lit(700), " ".join(words)).alias("v"),
                     synthetic.target_bytes(F.col("id"), seed).alias("t")).collect()
    assert {r.id: (r.v, r.t) for r in got} == {r.id: (made(r.id, 700), key(r.id, 2) % 7_001 + 5_000) for r in got}


def test_values_are_made_in_batches_and_letters_keep_their_number(spark, capsys):
    ids = spark.createDataFrame([(1,), (None,), (2,), (-5,)], "id bigint")
    made = ids.select("id", synthetic.value(F.col("id"), 3, F.lit(300), "ßheit éa").alias("v"))
    made.explain()
    assert "ArrowEvalPython" in capsys.readouterr().out
    got = {r.id: r.v for r in made.collect()}
    assert got[None] is None
    for value in (got[1], got[2], got[-5]):
        assert value[0] in "ẞÉ" and value[-1] in ".?!" and len(value.encode()) >= 300 and "SS" not in value


def test_frequent_words(spark):
    texts = spark.createDataFrame([("The the cat, the É",), ("cat dogs at été",), (None,)], "text string")
    assert synthetic.frequent_words(texts, 3) == "the cat dogs"
    assert synthetic.frequent_words(texts.filter("text is null")) == synthetic.WORDS


def test_no_template_leaves_a_token(spark):
    titles = spark.range(3000).select(synthetic.title(F.col("id"), 1).alias("t"))
    assert titles.filter("t rlike '[{}|]' or t = ''").count() == 0


def test_size_or_rows(spark):
    assert synthetic.rows_for_size(5.0) == 668_581
    for wrong in ({}, {"num_rows": 1, "target_gb": 1.0}):
        with pytest.raises(ValueError):
            synthetic.generate(spark, **wrong)
    rows = synthetic.generate(spark, target_gb=30 * 8030 / 1024 ** 3, sort=False)
    assert rows.count() == 30 and "k" not in rows.columns


@pytest.mark.parametrize("sort", [True, False])
def test_generated_csv(spark, tmp_path, sort):
    made = build.generate_csv(spark, str(tmp_path), num_rows=25, seed=4, sort=sort, part_rows=10)
    parts = sorted(glob.glob(f"{tmp_path}/data.csv/part_file=*/*.txt"))
    data = b"".join(open(f, "rb").read() for f in [f"{tmp_path}/header.csv", *parts])
    assert made == {"rows": 25, "bytes": len(data)}
    got = list(csv.DictReader(io.StringIO(data.decode(), newline="")))
    drawn = {r.title: r.ord for r in synthetic.generate(spark, num_rows=25, seed=4, sort=False).collect()}
    key = (lambda t: t.lower()) if sort else drawn.get
    titles = [r["title"] for r in got]
    assert titles == sorted(drawn, key=key)


def test_full_build_defaults_to_synthetic_rows(spark, tmp_path):
    made = build.full_build(spark, str(tmp_path), target_gb=20 * 8030 / 1024 ** 3, seed=2)
    assert made.rows == made.index_entries == 20 and made.data_bytes > 20 * 5000
