"""What the plans must and must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registrar.operators.joins import left_join, left_join_many
from registrar.plans import checked
from registrar.sources.derived import DerivedSchool

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
             "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "Scan ExistingRDD"]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(checked.PRODUCTS))
def test_plan_is_native_and_has_no_product_join(spark, sf_dir, name):
    plan = physical(checked.PRODUCTS[name](DerivedSchool(spark, sf_dir)))
    assert [word for word in FORBIDDEN if word in plan] == []


def test_code_has_no_hints_or_local_checkpoints():
    package = Path(checked.__file__).resolve().parents[1]
    school = [p for p in package.rglob("*.py") if p.relative_to(package).parts[0] != "llm"]
    code = "\n".join(p.read_text() for p in school)
    for word in ("broadcast(", "localCheckpoint", "toPandas", ".collect()", "crossJoin", ".limit("):
        assert word not in code, word


def test_staff_filter_reaches_the_teachers(spark, sf_dir):
    plan = physical(checked.PRODUCTS["class_list_teacher_staff"](DerivedSchool(spark, sf_dir)))
    assert re.search(r"Filter .*s_suppkey.* IN \(T3,T7\)", plan)


def test_qualification_filter_is_under_the_joins(spark, sf_dir):
    df = checked.PRODUCTS["exam_results_typed"](DerivedSchool(spark, sf_dir))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above = plan.splitlines()[: next(i for i, l in enumerate(plan.splitlines()) if "Join" in l)]
    assert not any("RLIKE" in line for line in above)


def test_impossible_pattern_prunes_nameless_branch(spark, sf_dir):
    from registrar.plans.classlists import class_list_student

    cat = DerivedSchool(spark, sf_dir)

    def joins(pattern):
        plan = class_list_student(cat, 2023, pattern)._jdf.queryExecution().optimizedPlan().toString()
        return len(re.findall(r"Join (Inner|LeftOuter|FullOuter)", plan))

    assert joins("nation_1") < joins("na na")
    assert "NestedLoop" not in physical(class_list_student(cat, 2023, "na na"))


@pytest.fixture
def skew_settings(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "6",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot(spark, name, rows):
    """A third of the rows on one key, written by many map tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    filler = F.sha2(F.col("id").cast("string"), 512)
    return spark.range(0, rows, 1, 12).select(key.alias("k"), filler.alias(name))


def test_hot_key_on_the_left_is_split(spark, skew_settings):
    left = hot(spark, "v", 20000)
    right = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("w"))
    df = left_join(left, right, ["k"])
    assert df.count() == 20000
    rows = df.select("k", "v", "w")
    rows.write.format("noop").mode("overwrite").save()
    collected = rows.collect()
    assert len(collected) == 20000
    assert "skew=true" in physical(rows)


def test_hot_key_on_the_right_is_split(spark, skew_settings):
    left = spark.range(100).select(F.concat(F.lit("x"), "id").alias("k"), F.lit(1).alias("v"))
    left = left.unionByName(left.limit(1).withColumn("k", F.lit("hot")))
    right = hot(spark, "w", 20000)
    rows = left_join_many(left, right, ["k"])
    collected = rows.collect()
    assert len(collected) == 100 + 6667
    assert "skew=true" in physical(rows)
    plain = left_join(left, right, ["k"])
    assert plain.count() == len(collected)


def test_detention_series_reads_no_attributes(spark, sf_dir):
    plan = physical(checked.PRODUCTS["detentions_cumulative"](DerivedSchool(spark, sf_dir)))
    assert "Ethnicity" not in plan and "HML Band" not in plan
    assert "Ethnicity" in physical(checked.PRODUCTS["detentions"](DerivedSchool(spark, sf_dir)))


def test_behaviour_events_are_read_once(spark, sf_dir):
    """Facts and action lists share one aggregate of the events; the test tables hold the events as a union of two scans."""
    for name, reads in (("behaviour_events", 1), ("detentions", 2)):
        df = checked.PRODUCTS[name](DerivedSchool(spark, sf_dir))
        df.collect()
        final = physical(df).split("== Initial Plan ==")[0]
        assert len(re.findall(r"FileScan parquet \[event_id", final)) == 2 * reads, name
