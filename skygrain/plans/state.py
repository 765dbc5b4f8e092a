"""What checks and views need to know of each city, kept beside the feature table.

One row per city: its newest index value and the one before, and its newest complete feature row, from which forecasts are
made. An update merges the feature rows that it has computed, so a check reads a row per city and never the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.functions.index import category
from skygrain.operators import alerts as AL
from skygrain.plans.store import Store
from skygrain.session import durable, small_side
from skygrain.sources import versioned
from skygrain.sources.feature_table import read_table

COMPLETE = "is_complete"
INPUTS = "inputs"
KEYS = list(S.KEYS)


def _two_newest(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``at, aqi, before, previous`` from ``_at`` (a struct that orders rows) and ``_aqi``, each row once."""
    two = F.slice(F.sort_array(F.collect_list(F.struct("_at", "_aqi")), asc=False), 1, 2)
    return values.groupBy(*keys).agg(two.alias("_two")).select(
        *keys, F.get("_two", F.lit(0)).getField("_at").alias("at"), F.get("_two", F.lit(0)).getField("_aqi").alias("aqi"),
        F.get("_two", F.lit(1)).getField("_at").alias("before"), F.get("_two", F.lit(1)).getField("_aqi").alias("previous"))


def summarise(rows: DataFrame, keys: Sequence[str] = S.KEYS, order: Sequence[str] = (S.TIME,)) -> DataFrame:
    """The state of each key from feature rows, each key and time once.

    ``at, aqi, before, previous``: place and value of the newest row with an index and of the one before. ``inputs_at, inputs``: the newest
    complete row, NULL if none is. Places are structs of ``order``. Partial sums leave at most two values
    and a row for each key and task before anything is moved.
    """
    place = F.struct(*order)
    inputs = F.struct(*[c for c in rows.columns if c not in (*keys, COMPLETE)])
    known = F.col("aqi").isNotNull()
    # the newest, then the newest of the others: max_by twice instead of a list of all rows
    best = rows.groupBy(*keys).agg(
        F.max(F.when(known, F.struct(place.alias("_at"), F.col("aqi").alias("_aqi")))).alias("_new"),
        F.max_by(F.struct(place.alias("_at"), inputs.alias("_in")), F.when(F.col(COMPLETE), place)).alias("_complete"))
    newest = best.select(*keys, F.col("_new._at").alias("_newest"))
    others = rows.filter(known).select(*keys, place.alias("_at"), F.col("aqi").alias("_aqi")).join(small_side(newest), list(keys)).filter(
        F.col("_newest").isNull() | (F.col("_at") < F.col("_newest")))
    second = others.groupBy(*keys).agg(F.max(F.struct("_at", "_aqi")).alias("_old"))
    return best.join(second, list(keys), "left").select(
        *keys, F.col("_new._at").alias("at"), F.col("_new._aqi").alias("aqi"), F.col("_old._at").alias("before"), F.col("_old._aqi").alias("previous"),
        F.col("_complete._at").alias("inputs_at"), F.col("_complete._in").alias(INPUTS))


def merge_states(old: DataFrame, rows: DataFrame, keys: Sequence[str] = S.KEYS, order: Sequence[str] = (S.TIME,)) -> tuple[DataFrame, DataFrame]:
    """The state after feature rows were computed, and the keys whose newest complete row has to be looked up.

    A computed row replaces what the state knows of its place. If it takes away the newest complete row and none of
    the computed ones is newer, only the stored rows tell which one is it now; such keys are rare and
    returned apart, with ``inputs`` NULL in the state.
    """
    keys = list(keys)
    fresh = durable(summarise(rows, keys, order), "fresh")
    place = F.struct(*order)
    seen = rows.select(*keys, place.alias("_p"), F.col(COMPLETE).alias("_ok"), F.col("aqi").alias("_a"))
    # what the state knows, and what the computed rows say of the same places
    places = old.select(*keys, F.explode(F.array("at", "before", "inputs_at")).alias("_p")).filter("_p is not null").distinct()
    again = durable(seen.join(small_side(places), [*keys, "_p"]).select(*keys, "_p", F.lit(True).alias("_seen"), F.coalesce("_ok", F.lit(False)).alias("_ok")), "again")

    def kept(at: str, value: str) -> DataFrame:
        mine = old.select(*keys, F.col(at).alias("_p"), F.col(value).alias("_v")).filter("_p is not null")
        return mine.join(small_side(again), [*keys, "_p"], "left").filter("_seen is null").select(*keys, F.col("_p").alias("_at"), F.col("_v").alias("_aqi"))

    now = fresh.select(*keys, F.col("at").alias("_at"), F.col("aqi").alias("_aqi")).filter("_at is not null")
    then = fresh.select(*keys, F.col("before").alias("_at"), F.col("previous").alias("_aqi")).filter("_at is not null")
    values = _two_newest(now.union(then).union(kept("at", "aqi")).union(kept("before", "previous")), keys)  # four rows a key at most

    stored = old.select(*keys, F.col("inputs_at").alias("_p"), F.col(INPUTS).alias("_in")).filter("_p is not null").join(
        small_side(again), [*keys, "_p"], "left")
    valid = stored.filter("_seen is null").select(*keys, F.struct(F.col("_p").alias("_at"), F.col("_in").alias("_in")).alias("_c"))
    computed = fresh.filter("inputs_at is not null").select(*keys, F.struct(F.col("inputs_at").alias("_at"), F.col(INPUTS).alias("_in")).alias("_c"))
    complete = valid.union(computed).groupBy(*keys).agg(F.max_by("_c", "_c._at").alias("_c"))
    gone = stored.filter("_seen and not _ok").select(*keys, "_p").join(computed, keys, "left").filter("_c is null or _c._at < _p").select(*keys)
    gone = durable(gone, "gone")
    every = old.select(*keys).union(fresh.select(*keys)).distinct()
    merged = every.join(values, keys, "left").join(complete, keys, "left").join(gone.withColumn("_gone", F.lit(True)), keys, "left")
    c = F.when(F.col("_gone").isNull(), F.col("_c"))
    return merged.select(*keys, "at", "aqi", "before", "previous", c["_at"].alias("inputs_at"), c["_in"].alias(INPUTS)), gone


def looked_up(merged: DataFrame, history: DataFrame, keys: Sequence[str] = S.KEYS, order: Sequence[str] = (S.TIME,)) -> DataFrame:
    """``merged`` with the newest complete row of the keys that ``history``, their feature rows, is of."""
    keys = list(keys)
    found = summarise(history.filter(COMPLETE), keys, order).select(*keys, F.col("inputs_at").alias("_at"), F.col(INPUTS).alias("_in"))
    return merged.join(found, keys, "left").select(
        *keys, "at", "aqi", "before", "previous", F.coalesce("inputs_at", "_at").alias("inputs_at"), F.coalesce(INPUTS, "_in").alias(INPUTS))


def merge(spark: SparkSession, store: Store, rows: DataFrame) -> None:
    """Bring the stored state up to date with feature rows just computed and stored."""
    if not versioned.exists(spark, store.state):
        versioned.append(spark, store.state, summarise(rows), KEYS)
        return
    known = read(spark, store)
    columns = [*KEYS, *known.schema[INPUTS].dataType.names, COMPLETE]
    rows = rows.select(*columns)
    old = durable(known.join(small_side(rows.select(*KEYS).distinct()), KEYS, "left_semi"), "state")
    merged, gone = merge_states(old, rows)
    if not gone.isEmpty():
        # the history of these cities alone
        history = read_table(spark, store.features).select(*columns).join(small_side(gone), KEYS, "left_semi")
        merged = looked_up(merged, history)
    versioned.append(spark, store.state, durable(merged, "merged"), KEYS)


def read(spark: SparkSession, store: Store) -> DataFrame:
    return versioned.read(spark, store.state, KEYS).drop(versioned.MONTH)


def model_inputs(state: DataFrame, keys: Sequence[str] = S.KEYS) -> DataFrame:
    """The newest feature rows of cities whose newest row is complete; the others have nothing to forecast from."""
    return state.filter("inputs_at is not null and inputs_at >= at").select(*keys, f"{INPUTS}.*")


def check_values(
    state: DataFrame, predictions: DataFrame | None, models: Sequence[tuple[int, str]], as_of, keys: Sequence[str] = S.KEYS
) -> DataFrame:
    """The values an alert check looks at: the current one of each city and one for every model and horizon.

    A city whose newest row lacks a sensor has no forecast: its current value stands for each of them.
    ``models``: (horizon, name); ``predictions``: keys, horizon, model, prediction.
    """
    current = state.filter("aqi is not null").select(*keys, as_of.alias("as_of"), F.col("aqi").alias("current"))
    if predictions is not None:
        predictions = predictions.select(*keys, as_of.alias("as_of"), "horizon", "model", "prediction")
    return AL.candidates(current, predictions, keys, models)


def snapshot_rows(state: DataFrame, predictions: DataFrame | None, models: Sequence[tuple[int, str]], counts: DataFrame, keys: Sequence[str] = S.KEYS) -> DataFrame:
    """Current value, its time, its change, number of readings and category of each city, with one row per model and horizon.

    A missing forecast is NULL with the status "missing"; without any model there is one row with "no model".
    """
    keys = list(keys)
    now = state.filter("aqi is not null").select(
        *keys, F.col(f"at.{S.TIME}").alias("as_of"), F.col("aqi").alias("current"), (F.col("aqi") - F.col("previous")).alias("change"),
        category(F.col("aqi")).category.alias("category")).join(counts, keys, "left")
    if not models:
        none = F.lit(None)
        return now.select("*", none.cast("int").alias("horizon"), none.cast("string").alias("model"), none.cast("double").alias("prediction"), F.lit("no model").alias("status"))
    wanted = now.withColumn("_m", AL.each_model(models)).select("*", "_m.*").drop("_m")
    if predictions is None:
        joined = wanted.withColumn("prediction", F.lit(None).cast("double"))
    else:
        joined = wanted.join(predictions.select(*keys, "horizon", "model", "prediction"), [*keys, "horizon", "model"], "left")
    return joined.withColumn("status", F.when(F.col("prediction").isNull(), "missing").otherwise("ok"))
