"""The queries that cut every city with a limit of 200 rows, over a table with many rows for that limit."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skygrain.operators.ordered import cut_large_groups, ordered

ROWS = 24_000
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """Events of three cities, one with half of the rows; more rows of a city share a time than the limit."""
    folder = str(tmp_path_factory.mktemp("many"))
    i = F.col("id")
    spark.range(ROWS).select(
        i.alias("event_id"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + (i * 7919 % 20) * 60_000_000).cast("timestamp_ntz").alias("ts"),
        F.when(i % 2 == 0, 0).otherwise(i % 8).cast("long").alias("user_id"), F.when(i % 10 == 0, "error").otherwise("view").alias("event_type"),
        ((i * 31 % 4001) / 16.0).alias("value"), F.concat(F.lit('{"k": '), (i * 17 % 100).cast("string"), F.lit("}")).alias("props"),
    ).repartition(4).write.parquet(f"{folder}/events.parquet")
    return folder


def _same_rows(a, b):
    hashed = [f.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(f.columns)).cast("decimal(38,0)"))).first() for f in (a, b)]
    return hashed[0] == hashed[1] and hashed[0][0] > 0


@pytest.mark.parametrize("name", ["rolling_std", "targets_multi", "lag_features", "chrono_split"])
def test_cut_takes_few_tasks_and_equals_the_plain_query(spark, many, name):
    cut = QUERIES[f"{name}_cut"](spark, many)
    assert cut.rdd.getNumPartitions() <= 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _same_rows(cut, QUERIES[name](spark, many))


def test_rolling_sends_only_its_columns_through_python(spark, many):
    plan = QUERIES["rolling_std_cut"](spark, many)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "wind_chill" not in plan and "uv_index" not in plan


def test_slots_grow_with_the_table(spark):
    rows = spark.range(220_000).select(F.lit("hot").alias("city"), F.timestamp_micros("id").alias("timestamp"), "id")
    slots = cut_large_groups(rows, ["city"], ["timestamp", "id"], 10)
    assert slots.table.count() <= 200_000 and slots.table.agg(F.sum("_rows")).first()[0] == 220_000
    o = ordered(rows, ["city"], ["timestamp", "id"], back=5, ahead=7, limit=10)
    wrong = o.finish(o.frame.select(
        "*", F.lag("id", 5).over(o.window).alias("lag5"), F.lead("id", 7).over(o.window).alias("lead7"), o.position.alias("pos"), o.size.alias("n"))).select(
        F.count(F.lit(1)).alias("rows"), F.count("lag5").alias("lags"), F.count("lead7").alias("leads"),
        F.count_if((F.col("lag5") != F.col("id") - 5) | (F.col("lead7") != F.col("id") + 7) | (F.col("pos") != F.col("id")) | (F.col("n") != 220_000)).alias("wrong"))
    assert tuple(wrong.first()) == (220_000, 219_995, 219_993, 0)


def test_no_group_is_large(spark):
    rows = spark.range(300).select((F.col("id") % 10).cast("string").alias("city"), F.timestamp_micros("id").alias("timestamp"), "id")
    assert cut_large_groups(rows, ["city"], ["timestamp", "id"], 50) is None
