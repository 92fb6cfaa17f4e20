import decimal

from pyspark.sql import functions as F

from cadenza.functions.aggregates import avg2, collated_names, distinct_names
from cadenza.functions.text import like_pattern, search_match, whole_word_match
from table_rows import rows

NAMES = [(1, "High"), (2, "a_b"), (3, "a%b"), (4, "a\\b"), (5, None)]


def _matches(spark, term):
    df = spark.createDataFrame(NAMES, "id int, name string")
    return sorted(r[0] for r in rows(df.filter(search_match("name", term)).select("id")))


def test_like_pattern_keeps_wildcards_and_drops_lone_backslash():
    assert like_pattern("") == "%%"
    assert like_pattern("a_b") == "%a_b%"
    assert like_pattern("\\a") == "%a%"
    assert like_pattern("\\%") == "%\\%%"
    assert like_pattern("a\\") == "%a\\%"


def test_empty_term_matches_every_row_including_null(spark):
    assert _matches(spark, "") == [1, 2, 3, 4, 5]


def test_case_folded_substring(spark):
    assert _matches(spark, "HIGH") == [1]
    assert _matches(spark, "igh") == [1]


def test_user_wildcards_stay_live(spark):
    # '_' is any one character: every non-empty name; NULL counts as ''.
    assert _matches(spark, "_") == [1, 2, 3, 4]
    assert _matches(spark, "%") == [1, 2, 3, 4, 5]


def test_backslash_escapes(spark):
    # '\a' is a literal 'a' (PostgreSQL); a trailing '\' escapes the closing '%'.
    assert _matches(spark, "\\a") == [2, 3, 4]
    assert _matches(spark, "\\") == []
    assert _matches(spark, "\\%") == [3]
    assert _matches(spark, "\\_") == [2]


def test_whole_word(spark):
    df = spark.createDataFrame([(1, "Congratulations"), (2, "the rat ran"), (3, None)], "id int, t string")
    assert [r[0] for r in rows(df.filter(whole_word_match("t", "rat")).select("id"))] == [2]


def test_distinct_names_sorted_binary_and_null_rules(spark):
    df = spark.createDataFrame(
        [(1, "Alena"), (1, "Alex"), (1, "Aleš"), (1, "Alex"), (1, None), (2, None)], "k int, n string"
    )
    got = dict(rows(df.groupBy("k").agg(distinct_names("n").alias("s"))))
    assert got == {1: "Alena, Alex, Aleš", 2: None}


def test_collated_names_linguistic_order(spark):
    df = spark.createDataFrame([(1, "Alena"), (1, "Alex"), (1, "Aleš")], "k int, n string")
    got = rows(df.groupBy("k").agg(collated_names("n").alias("s")))
    assert got == [(1, "Alena, Aleš, Alex")]


def test_avg2_half_away_from_zero(spark):
    df = spark.createDataFrame([(469, 200), (-469, 200), (7, 1), (0, 0), (10, 3)], "s long, n long")
    got = [r[0] for r in rows(df.select(avg2("s", "n")))]
    D = decimal.Decimal
    assert got == [D("2.35"), D("-2.35"), D("7.00"), None, D("3.33")]
    assert df.select(avg2("s", "n").alias("a")).schema["a"].dataType.simpleString() == "decimal(10,2)"


def test_search_match_plans_as_contains(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string").filter(search_match("name", "abc"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" in plan or "contains" in plan
    assert F  # keep import used


def test_whole_word_of_any_script_and_with_signs(spark):
    from cadenza.functions.text import whole_word_match

    df = spark.createDataFrame([("learn C++ now",), ("\u00c9T\u00c9 indien",), ("C++x",), ("\u00e9t\u00e9s",), ("red",), ("Redder",)], "t string")
    assert [r.t for r in df.where(whole_word_match("t", "C++")).collect()] == ["learn C++ now"]
    assert [r.t for r in df.where(whole_word_match("t", "\u00e9t\u00e9")).collect()] == ["\u00c9T\u00c9 indien"]
    assert [r.t for r in df.where(whole_word_match("t", "red")).collect()] == ["red"]
