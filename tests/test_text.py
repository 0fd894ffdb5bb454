import csv
import datetime
import io
import itertools

from pyspark.sql import functions as F

from lexitab.functions import text

FIELDS = ["", "a", "a,b", 'a"b', '""', " a ", "x\ny", "x\r\ny", "é", "日本", "😀", "'", "a;b", ',"\r\n']


def test_csv_line_and_row_bytes_equal_the_csv_module(spark):
    pairs = list(itertools.product(FIELDS, FIELDS))
    df = spark.createDataFrame(pairs, "title string, value string")
    got = df.select("title", "value", text.csv_line().alias("line"), text.row_bytes().alias("n"),
                    text.csv_decode(text.csv_line()).alias("back")).collect()
    assert len(got) == len(pairs)
    for row in got:
        out = io.StringIO(newline="")
        csv.writer(out).writerow((row.title, row.value))
        assert row.line + "\r\n" == out.getvalue()
        assert row.n == len(out.getvalue().encode())
        assert (row.back.title, row.back.value) == (row.title, row.value)


def test_normalize_equals_split_join(spark):
    texts = ["", "  a  b ", "a\n\nb\r\nc", "\x1ca\x1f b\x85c", "a b c　", "a​b", "\t"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.normalize("t").alias("n")).collect()
    assert all(r.n == " ".join(r.t.split()) for r in got)


def test_fold_and_capitalize_equal_python(spark):
    words = ["Apple", "ÉCOLE", "straße", "ΟΔΟΣ", "new YORK city", "", "x"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", text.fold("w").alias("low"), text.capitalize("w").alias("cap")).collect()
    assert all(r.low == r.w.lower() and r.cap == r.w.capitalize() for r in got)


def test_stamps_equal_python(spark):
    moments = [datetime.datetime(2024, 2, 29, 23, 59, 59, 12), datetime.datetime(2025, 1, 1)]
    got = spark.createDataFrame([(m,) for m in moments], "t timestamp").select(
        "t", text.date_stamp("t").alias("day"), text.iso_stamp("t").alias("iso")).collect()
    assert all(r.day == r.t.strftime("%Y%m%d") and r.iso == r.t.isoformat() for r in got)


def test_utf8_bytes(spark):
    assert spark.range(1).select(text.utf8_bytes(F.lit("é😀a"))).first()[0] == 7


def test_capitals_fold_to_the_same_key(spark):
    titles = ["Straße 5", "ßheit", "ŉ ﬁn ǰ", "éÑ 日本 😀", "", None]
    got = spark.createDataFrame([(t,) for t in titles], "t string").select(
        text.capitals("t").alias("up"), (text.fold(text.capitals("t")) == text.fold("t")).alias("same"), text.capitalize("t").alias("cap")).collect()
    assert [r.up for r in got] == ["STRAẞE 5", "ẞHEIT", "ŉ ﬁN ǰ", "ÉÑ 日本 😀", "", None]
    assert all(r.same for r in got[:-1]) and got[1].cap == "ẞheit"
