"""Edge cases of the row-wise functions; expected values follow FIXTURES.md part C."""

import datetime

from pyspark.sql import functions as F

from tamarack.functions import dates, parsing, text
from tamarack.functions.constants import KEYWORDS


def values(df):
    return [tuple(r) for r in df.collect()]


def test_durations(spark):
    df = spark.createDataFrame(
        [(0, "2h 30min"), (1, "2h"), (2, "45min"), (3, ""), (4, None), (5, "2h 30m"), (6, "1h"), (7, "45m")], "i int, d string"
    )
    got = dict((r[0], r[1:]) for r in values(df.select("i", parsing.duration_strict("d"), parsing.duration_lenient("d"))))
    assert [got[i][0] for i in range(5)] == [150, 0, 0, 0, 0]
    assert [got[i][1] for i in (4, 5, 6, 7)] == [None, 150, 60, 45]


def test_dates_and_bins(spark):
    df = spark.createDataFrame([(0, "10 February 2006"), (1, "1994"), (2, "nope"), (3, None)], "i int, d string")
    got = [r[1] for r in sorted(values(df.select("i", dates.parse_date("d"))))]
    assert got == [datetime.date(2006, 2, 10), datetime.date(1994, 1, 1), None, None]
    days = spark.createDataFrame([(i, d) for i, d in enumerate([-1, 0, 7, 8, 30, 366, None])], "i int, d int")
    got = [r[1] for r in sorted(values(days.select("i", dates.lag_bin("d"))))]
    assert got == [None, "First Week", "First Week", "First Month", "First Month", "Over a Year", None]


def test_list_literals(spark):
    df = spark.createDataFrame([("['Action', \"Children's\"]",)], "l string")
    assert df.select(parsing.parse_list("l")).first()[0] == ["Action", "Children's"]


def test_tokens_in_any_script(spark):
    df = spark.createDataFrame([("élan Vital ouè a b1",)], "t string")
    assert df.select(text.vector_words("t")).first()[0] == ["élan", "vital", "ouè", "b1"]
    grams = df.select(text.ngrams(text.vector_words("t"), (1, 2, 3))).first()[0]
    assert grams == ["élan", "vital", "ouè", "b1", "élan vital", "vital ouè", "ouè b1", "élan vital ouè", "vital ouè b1"]


def test_bad_text_gives_zeros(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Hi, you. Go!")], "i int, t string")
    out = text.with_readability(text.with_keyword_flags(text.with_token_stats(df, "t"), "t"), "t").orderBy("i").collect()
    for row in out[:2]:
        assert all(v == 0 for k, v in row.asDict().items() if k not in ("i", "t"))
    assert (out[2]["word_count"], out[2]["num_sentences"]) == (6, 2)
    assert abs(out[2]["avg_word_length"] - 10 / 6) < 1e-12


def test_keyword_flags_are_substrings(spark):
    df = spark.createDataFrame([("The ENDINGS: a Plot Twist",)], "t string")
    row = text.with_keyword_flags(df, "t").first().asDict()
    assert len([k for k in row if k.startswith("has_")]) == len(KEYWORDS) == 33
    assert {k for k, v in row.items() if k.startswith("has_") and v} == {"has_ending", "has_plot twist", "has_twist"}


def test_readability_formulas(spark):
    df = spark.createDataFrame([("One two three. Beautiful banana bread here. We like it.",)], "t string")
    row = text.with_readability(df, "t").first()
    syllables = [1, 1, 1, 3, 3, 1, 1, 1, 1, 1]
    words, total, poly = 10, sum(syllables), 2
    assert abs(row["flesch_reading_ease"] - (206.835 - 1.015 * words / 3 - 84.6 * total / words)) < 1e-9
    assert abs(row["flesch_kincaid_grade"] - (0.39 * words / 3 + 11.8 * total / words - 15.59)) < 1e-9
    assert abs(row["smog_index"] - (1.043 * (30 * poly / 3) ** 0.5 + 3.1291)) < 1e-9


def test_row_functions_run_on_streams(spark, tmp_path):
    from tamarack.functions.text import with_keyword_flags, with_token_stats

    spark.createDataFrame([(1, "a secret"), (2, "none here")], "i int, t string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("i int, t string").parquet(str(tmp_path / "in"))
    query = (
        with_keyword_flags(with_token_stats(stream, "t"), "t").writeStream.format("memory").queryName("rows_out").start()
    )
    query.processAllAvailable()
    query.stop()
    got = spark.table("rows_out").select("i", "word_count", "has_secret").orderBy("i")
    assert values(got) == [(1, 2, 1), (2, 2, 0)]


def test_no_python_in_row_functions(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("t"))
    plan = text.with_readability(text.with_keyword_flags(text.with_token_stats(df, "t"), "t"), "t")
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
