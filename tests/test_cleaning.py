import datetime as dt

from pyspark.sql import functions as F

from fraudspark.functions.parsing import named, parse_boolean, parse_timestamp
from fraudspark.operators import clean as c


def test_clean_leaves_no_duplicates_and_no_gaps(raw, cleaned):
    assert raw.count() > raw.distinct().count()
    assert cleaned.count() == cleaned.distinct().count()
    for column in ("transaction_country", "merchant_category", "is_international"):
        assert cleaned.where(F.col(column).isNull()).count() == 0


def test_clean_types(cleaned):
    types = dict(cleaned.dtypes)
    assert types["transaction_datetime"] == "timestamp"
    for flag in ("is_fraud", "is_online", "is_international", "is_online_fraud", "is_international_fraud"):
        assert types[flag] == "boolean"


def test_fill_word_never_reaches_typed_columns(cleaned):
    text = [name for name, kind in cleaned.dtypes if kind == "string"]
    assert cleaned.where(F.col("transaction_datetime").isNull()).count() > 0
    assert "transaction_datetime" not in text


def test_timestamps(spark):
    cases = {
        "2024-01-01T01:02:03Z": dt.datetime(2024, 1, 1, 1, 2, 3),
        "2024-01-01T01:02:03": dt.datetime(2024, 1, 1, 1, 2, 3),
        "2024-01-01 01:02:03": dt.datetime(2024, 1, 1, 1, 2, 3),
        "2024-01-01T01:02:03.250Z": dt.datetime(2024, 1, 1, 1, 2, 3, 250_000),
        "2024-01-01T01:02:03+05:30": dt.datetime(2023, 12, 31, 19, 32, 3),
        "2024-01-01": dt.datetime(2024, 1, 1),
        "2024-01-01T01:02": dt.datetime(2024, 1, 1, 1, 2),
        "20240101T010203": dt.datetime(2024, 1, 1, 1, 2, 3),
        "NA": None,
        "n/a": None,
        "2024-13-01T00:00:00": None,
        "junk": None,
        "": None,
        None: None,
    }
    table = spark.createDataFrame([(s,) for s in cases], "s string")
    found = {r.s: r.t for r in table.select("s", parse_timestamp(named("s")).cast("timestamp_ntz").alias("t")).collect()}
    assert found == cases
    seconds = table.select("s", parse_timestamp(named("s")).cast("long").alias("t"))
    before = {r.s: r.t for r in seconds.collect()}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert {r.s: r.t for r in table.select("s", parse_timestamp(named("s")).cast("long").alias("t")).collect()} == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_booleans(spark):
    cases = {
        "TRUE": True, "false": False, "True": True, "1": True, "0": False, "yes": True, "n": False,
        "maybe": None, "1.0": None, "": None, None: None,
    }
    table = spark.createDataFrame([(s,) for s in cases], "s string")
    assert {r.s: r.b for r in table.select("s", parse_boolean(named("s")).alias("b")).collect()} == cases


def test_booleans_from_other_types(spark):
    table = spark.createDataFrame([(True, 1), (False, 0), (None, None)], "b boolean, i int")
    rows = table.select(parse_boolean(named("b")).alias("b"), parse_boolean(named("i")).alias("i")).collect()
    assert [tuple(r) for r in rows] == [(True, True), (False, False), (None, None)]


def _fill(spark, rows, **options):
    table = spark.createDataFrame(rows, "id int, kind string, cat string")
    filled = c.fill_default(table, "cat", F.col("kind") == "withdrawal", **options)
    return {r.id: r.cat for r in filled.collect()}


ROWS = [(3, "withdrawal", "b"), (2, "withdrawal", "a"), (1, "purchase", "z"), (4, "withdrawal", None), (5, "purchase", None)]


def test_default_fills_matching_rows_with_the_first_value(spark):
    assert _fill(spark, ROWS, order_column="id") == {3: "b", 2: "a", 1: "z", 4: "a", 5: None}


def test_default_scope_all(spark):
    assert _fill(spark, ROWS, order_column="id", scope="all") == {3: "b", 2: "a", 1: "z", 4: "a", 5: "a"}


def test_default_without_order_takes_the_least_value(spark):
    assert _fill(spark, ROWS)[4] == "a"


def test_default_is_a_no_op_without_a_candidate(spark):
    assert _fill(spark, [(1, "withdrawal", None), (2, "purchase", "x")], order_column="id") == {1: None, 2: "x"}


def test_and_flags_use_three_valued_logic(spark):
    table = spark.createDataFrame([(None, False), (None, True), (True, True)], "a boolean, b boolean")
    assert [r.f for r in c.add_and_flags(table, {"f": ("a", "b")}).collect()] == [False, None, True]


def test_missing_columns_skip_their_steps(spark):
    table = spark.createDataFrame([(1, None), (1, None)], "x int, note string")
    assert [tuple(r) for r in c.clean(table).collect()] == [(1, "NA")]


def test_empty_input(raw):
    assert c.clean(raw.limit(0)).count() == 0


def test_filters_reach_the_scan_side_of_the_duplicate_removal(raw):
    plan = c.clean(raw)._jdf.queryExecution().optimizedPlan().toString()
    aggregate = plan.index("Aggregate")
    assert "atleastnnonnulls" in plan[aggregate:]
    assert "Filter" not in plan[:aggregate]


def test_the_text_of_a_timestamp_is_made_once(spark):
    """Its pattern stands once in the plan, not once for each place where the text is looked at."""
    df = spark.createDataFrame([("2020-01-02T03:04",), ("2020-01-02 03:04:05Z",), ("N/A",), (None,)], "t string")
    parsed = c.parse_timestamps(df, ["t"])
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("(?i)([T ]") == 1
    assert parsed.columns == ["t"]
    assert [r.t for r in parsed.collect()] == [r.t for r in df.select(parse_timestamp(F.col("t")).alias("t")).collect()]
