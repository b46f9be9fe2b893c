import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from registrar.operators import joins
from registrar.operators.reshape import non_empty_columns
from registrar.operators.running import _with_ranges, carried_forward, running_total


def test_name_clash_is_refused(spark):
    left = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="project before joining"):
        joins.left_join(left, left, ["k"])


@pytest.mark.parametrize("seed", range(3))
def test_many_join_equals_plain_left_join(spark, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, "", "a", "b", "c"])
    number = lambda: rng.choice([None, 0, 1])
    left = spark.createDataFrame([(key(), number(), i) for i in range(40)], "k string, n int, v int")
    right = spark.createDataFrame(
        [(rng.choice([None, "", "a", "d"]), number(), i) for i in range(30)], "k string, n int, w int"
    )
    rows = lambda df: sorted(map(repr, df.select("k", "n", "v", "w").collect()))
    plain = joins.left_join(left, right, ["k", "n"])
    assert rows(joins.left_join_many(left, right, ["k", "n"])) == rows(plain)
    matched = joins.inner_join(left, right, ["k", "n"])
    lonely = joins.anti_join(left, right, ["k", "n"]).withColumn("w", F.lit(None).cast("int"))
    assert rows(matched.unionByName(lonely)) == rows(plain)


def test_full_join_keeps_both_sides(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("b", 3), (None, 4)], "k string, w int")
    got = sorted(map(tuple, joins.full_join(left, right, "k").select("v", "w", "k").collect()), key=repr)
    assert got == [(1, None, "a"), (2, 4, None), (None, 3, "b")]


@pytest.mark.parametrize("rows_per_part", [1, 4, 1000])
def test_running_total_against_brute_force(spark, rows_per_part):
    rng = random.Random(rows_per_part)
    keys = {(g, d, u) for g in ("x", None, "y") for d in range(20) for u in ("p", None, "q")}
    rows = [(*k, rng.randint(1, 9)) for k in keys if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "g string, d int, u string, n int")
    got = {
        (r.g, r.d, r.u): r.total
        for r in running_total(df, ["g"], ["d", "u"], "n", "total", rows_per_part).collect()
    }
    expected, sums = {}, defaultdict(int)
    for g, d, u, n in sorted(rows, key=lambda r: (r[1], r[2] is None, r[2] or "")):
        sums[g] += n
        expected[(g, d, u)] = sums[g]
    assert got == expected


def test_running_total_splits_one_huge_group(spark):
    """A group with every row is spread over many window partitions."""
    df = spark.range(2000).select(
        F.lit("g").alias("g"), F.col("id").alias("d"), F.lit(1).alias("n")
    )
    got = running_total(df, ["g"], ["d"], "n", "total", rows_per_part=100)
    assert got.filter("total <> d + 1").count() == 0
    sizes = [r["count"] for r in _with_ranges(df, ["g"], "d", 100).groupBy("__range").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 101


def test_running_total_of_a_hot_day_at_many_partitions(spark):
    """One year group and one day hold nearly all rows; no sample, no array of cuts, whatever the number of partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    try:
        df = spark.range(60_000).selectExpr(
            "IF(id % 50 = 0, CAST(id % 4 AS STRING), '9') AS g", "IF(id % 20 = 0, DATE'2024-01-01' + CAST(id % 300 AS INT), DATE'2024-03-05') AS d",
            "concat('A8012', lpad(CAST(id AS STRING), 8, '0')) AS u", "1 + id % 3 AS n")
        total = running_total(df, ["g"], ["d", "u"], "n", "total", rows_per_part=1000)
        assert "Subquery" not in total._jdf.queryExecution().toString()
        expected = df.selectExpr("g", "d", "u", "SUM(n) OVER (PARTITION BY g ORDER BY d, u) AS total")
        assert total.select("g", "d", "u", "total").exceptAll(expected).isEmpty() and total.count() == 60_000
        ranges = _with_ranges(df, ["g", "d"], "u", 1000).groupBy("g", "d", "__range").count()
        assert ranges.agg(F.max("count")).first()[0] <= 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


KEYS = {"d": "date", "c": "string", "r": "int", "room": "string"}


@pytest.mark.parametrize("rows_per_part", [1, 3, 1000])
def test_carried_forward_equals_the_window(spark, rows_per_part):
    """Random tables with ties, repeated rows, missing keys and groups without any value."""
    draw = random.Random(rows_per_part)
    rows = [
        (draw.choice(["u1", "u2", None]), draw.choice([1, 2, 3, None]), draw.choice(["c1", "c2", "cé", "", None]), draw.choice([0, 1, None]),
         draw.choice([None, None, "R1", "R2"]))
        for _ in range(200)
    ] + [("empty", 1, "c", 0, None), ("empty", 2, "c", 0, None)]
    df = spark.createDataFrame(rows, "u string, d int, c string, r int, room string")
    order = list(KEYS)
    got = carried_forward(df, ["u"], order, "room", "carried", rows_per_part).select(*df.columns, "carried")
    window = Window.partitionBy("u").orderBy(*[F.col(c).asc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("carried", F.last("room", ignorenulls=True).over(window))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_carried_forward_splits_the_group_of_missing_keys(spark):
    """All places of a missing key on one day are many parts, and the carry crosses their ends."""
    df = spark.range(100_000).selectExpr(
        "CAST(NULL AS STRING) AS u", "DATE'2024-01-01' AS d", "concat('class', lpad(CAST(id AS STRING), 7, '0')) AS c",
        "IF(id % 30000 = 7, concat('R', id), NULL) AS room")
    got = carried_forward(df, ["u"], ["d", "c"], "room", "carried", rows_per_part=1000)
    wrong = got.filter("NOT carried <=> IF(substr(c, 6) < 7, NULL, concat('R', CAST(floor((CAST(substr(c, 6) AS INT) - 7) / 30000) * 30000 + 7 AS INT)))")
    assert wrong.isEmpty() and got.count() == 100_000
    sizes = _with_ranges(df, ["u", "d"], "c", 1000).groupBy("__range").count()
    assert sizes.count() >= 50 and sizes.agg(F.max("count")).first()[0] <= 5000


def test_non_empty_columns(spark):
    df = spark.createDataFrame(
        [(None, "", "a", ""), (None, "", None, None)], "a string, b string, c string, d string"
    )
    # All null or all empty is dropped; a mix of the two is not.
    assert non_empty_columns(df, ["a", "b", "c", "d"]) == ["c", "d"]


def test_two_dates_of_a_lesson_stand_for_all(spark):
    """The timetable's shortened dates against all dates of the calendar, some of which it lists twice."""
    import datetime as dt

    from registrar.plans.timetable import _slot_dates, _slots

    draw = random.Random(11)
    first = dt.date(2024, 1, 1)
    days = [(first + dt.timedelta(days=i), 1 + i // 7 % 2, str(i % 7)) for i in range(42)]
    open_days = spark.createDataFrame(days + draw.sample(days, 12), "date date, week int, day string")
    periods = [(f"p{i}", f"l{min(i, 4)}", "l", str(i % 3), 1 + i % 2) for i in range(7)]
    periods = spark.createDataFrame(periods, "period_id string, lesson_id string, period string, day string, week int")
    of = {r.period_id: r.lesson_id for r in periods.collect()}
    rows = [
        (draw.choice(["u1", "u2", None]), of[p := f"p{draw.randrange(7)}"], p, f"c{draw.randrange(3)}", draw.choice([0, 1, None]),
         draw.choice([None, None, "R1", "R2"]), draw.random() < 0.8, draw.choice([None, first, first + dt.timedelta(days=9)]))
        for _ in range(60)
    ]
    rows = spark.createDataFrame(
        rows, "upn string, lesson_id string, period_id string, class_id string, room_number int, room string, live boolean, student_start date"
    )
    every = periods.join(open_days, ["week", "day"]).select("period_id", "lesson_id", "date")
    found = [sorted(map(repr, set(_slots(rows, dates).collect()))) for dates in (_slot_dates(open_days, periods), every)]
    assert found[0] == found[1] and len(found[0]) > 20
