"""Versioned tables, bounded updates and the state of each city."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.operators import alerts as AL
from skygrain.operators.touched import POSITION, pieces, rows_of, touched_ranges
from skygrain.operators import touched as U
from skygrain.plans import ingest, state
from skygrain.plans.store import Store
from skygrain.sources import versioned

KEYS = ["city", "timestamp"]
START = datetime(2025, 1, 1)


def _batch(spark, rows, more=""):
    """rows: (city, day, value, ...)."""
    return spark.createDataFrame([(c, None if d is None else START + timedelta(days=d), *v) for c, d, *v in rows], f"city string, timestamp timestamp, v double{more}")


def _rows(df):
    return sorted([(r.city, None if r.timestamp is None else (r.timestamp - START).days, r.v) for r in df.collect()], key=str)


def test_versions_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not versioned.exists(spark, path)
    versioned.append(spark, path, _batch(spark, [("a", 0, 1.0), ("a", 40, 2.0), ("b", None, 3.0), (None, 1, 4.0)]), KEYS, "timestamp", buckets=2)
    versioned.append(spark, path, _batch(spark, [("a", 40, 5.0), ("b", None, 6.0), (None, 1, None), ("c", 90, 7.0)]), KEYS, "timestamp")
    expected = [("a", 0, 1.0), ("a", 40, 5.0), ("b", None, 6.0), (None, 1, None), ("c", 90, 7.0)]
    assert _rows(versioned.read(spark, path, KEYS)) == sorted(expected, key=str)
    assert versioned.months(spark, path) == ["2025-01", "2025-02", "2025-04", "none"]
    versioned.append(spark, path, _batch(spark, []), KEYS, "timestamp")
    versioned.append(spark, path, _batch(spark, [("c", 90, 8.0, "new")], ", note string"), KEYS, "timestamp")
    found = versioned.read(spark, path, KEYS)
    assert {r.note for r in found.collect()} == {None, "new"} and found.filter("note = 'new'").first().v == 8.0
    april = versioned.read(spark, path, KEYS, ["2025-04"])
    assert _rows(april) == [("c", 90, 8.0)] and all("event_month=2025-04" in f for f in april.inputFiles())
    assert versioned.read(spark, path, KEYS, ["2031-01"]).count() == 0


def test_empty_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.append(spark, path, _batch(spark, []), KEYS, "timestamp")
    assert versioned.exists(spark, path) and versioned.read(spark, path, KEYS).columns[:3] == ["city", "timestamp", "v"]
    assert versioned.read(spark, path, KEYS).count() == 0 and versioned.compact(spark, path, KEYS) == 0
    versioned.append(spark, path, _batch(spark, [("a", 0, 1.0)]), KEYS, "timestamp")
    assert _rows(versioned.read(spark, path, KEYS)) == [("a", 0, 1.0)]


def test_a_version_without_manifest_rows_is_not_there(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.append(spark, path, _batch(spark, [("a", 0, 1.0)]), KEYS, "timestamp", buckets=1)
    stray = _batch(spark, [("a", 0, 9.0)]).withColumns({"event_month": F.lit("2025-01"), "_bucket": F.lit(0)})
    stray.write.partitionBy("event_month", "_bucket").parquet(f"{path}/data/_version=v000000000009-failed")
    assert _rows(versioned.read(spark, path, KEYS)) == [("a", 0, 1.0)]


def test_compaction_hides_nothing_written_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = [("a", d, float(d)) for d in range(60)]
    versioned.append(spark, path, _batch(spark, first), KEYS, "timestamp", buckets=2)
    versioned.append(spark, path, _batch(spark, [("a", d, -1.0) for d in range(28)]), KEYS, "timestamp")
    merged = versioned._merged

    def with_a_writer(*args):
        monkeypatch.setattr(versioned, "_merged", merged)
        out = merged(*args)
        versioned.append(spark, path, _batch(spark, [("a", 3, 99.0), ("a", 50, 98.0)]), KEYS, "timestamp")
        return out

    monkeypatch.setattr(versioned, "_merged", with_a_writer)
    done = versioned.compact(spark, path, KEYS, 0.2)
    expected = sorted([("a", d, 99.0 if d == 3 else 98.0 if d == 50 else -1.0 if d < 28 else float(d)) for d in range(60)], key=str)
    assert done == 2 and _rows(versioned.read(spark, path, KEYS)) == expected
    assert versioned.vacuum(spark, path) == 4  # two buckets of January, in two versions
    assert _rows(versioned.read(spark, path, KEYS)) == expected
    assert versioned.compact(spark, path, KEYS, 0.9) == 0
    assert versioned.compact(spark, path, KEYS, 0.0) >= 1 and _rows(versioned.read(spark, path, KEYS)) == expected
    assert versioned.stale(spark, path, KEYS).count() == 0


def test_compacted_buckets_are_read_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1.0, 2.0):
        versioned.append(spark, path, _batch(spark, [("a", d, v) for d in range(40)]), KEYS, "timestamp", buckets=2)
    plan = lambda: versioned.read(spark, path, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan()
    versioned.compact(spark, path, KEYS)
    assert "Exchange" not in plan()


@pytest.mark.parametrize("block", [4096, 16])
def test_ranges_are_disjoint_and_complete(spark, monkeypatch, block):
    monkeypatch.setattr(U, "BLOCK", block)
    changed = {"a": [0, 3, 60, 61, 200, 254, 255, 400], "b": [7], "c": list(range(0, 500, 9))}
    df = spark.createDataFrame([(k, p) for k, ps in changed.items() for p in ps * 2], f"city string, {POSITION} long")
    got = touched_ranges(df, ["city"], 6, 47).collect()
    for city, positions in changed.items():
        mine = sorted((r.low, r.high) for r in got if r.city == city)
        wanted = {q for p in positions for q in range(max(0, p - 6), p + 48)}
        assert {q for low, high in mine for q in range(low, high + 1)} == wanted
        assert all(b > a + 1 for (_, a), (b, _) in zip(mine, mine[1:]))


def test_pieces_hold_what_each_row_needs(spark, monkeypatch):
    monkeypatch.setattr(U, "PIECE", 100)
    ranges = spark.createDataFrame([("a", 0, 249), ("a", 500, 520), ("b", 10, 63)], "city string, low long, high long")
    numbered = spark.range(600).select(F.lit("a").alias("city"), F.col("id").alias(POSITION), F.col("id").alias("v")).union(
        spark.range(64).select(F.lit("b"), F.col("id"), F.col("id")))
    got = rows_of(numbered, pieces(ranges, ["city"], 47, 6), ["city"]).collect()
    own = sorted((r.city, r.v) for r in got if r._emit)
    assert own == sorted([("a", v) for v in [*range(250), *range(500, 521)]] + [("b", v) for v in range(10, 64)])
    for r in (x for x in got if x._emit):
        mine = {x.v for x in got if x.city == r.city and x._piece == r._piece}
        assert {v for v in range(max(0, r.v - 47), min(r.v + 6, 599 if r.city == "a" else 63) + 1)} <= mine


def _observations(spark, city, first, hours, offset=0.0):
    return spark.range(hours).select(
        *[((F.col("id") * (i + 3)) % 97 + 1.0 + offset).alias(c) for i, c in enumerate(S.POLLUTANTS)],
        F.timestamp_seconds(F.lit(int((START - datetime(1970, 1, 1)).total_seconds())) + (F.col("id") + first) * 3600).alias(S.TIME),
        *[((F.col("id") * (i + 5)) % 89 + 0.5).alias(c) for i, c in enumerate(S.WEATHER)],
        F.lit(city).alias("city"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))


def test_which_months_an_update_reads(spark, tmp_path):
    """A late row reads its month, and the next or the one before if its reach crosses the border; a new city only its own."""
    store = Store(str(tmp_path))
    ingest.write_observations(spark, store, _observations(spark, "Rome", 0, 24 * 180), START)

    def months(changed):
        t = ingest.touched(spark, store, changed)
        return sorted((r.city, r.event_month) for r in t.months.collect()), sorted((r.city, r.low, r.high) for r in t.ranges.collect())

    late = _observations(spark, "Rome", 24 * 75 + 0.5, 1)  # 17 March
    ingest.write_observations(spark, store, late, START)
    assert months(late) == ([("Rome", "2025-03")], [("Rome", 24 * 75 + 1 - 6, 24 * 75 + 1 + 47)])
    border = _observations(spark, "Rome", 24 * 59 + 0.5, 1)  # 1 March, half past midnight
    ingest.write_observations(spark, store, border, START)
    assert months(border)[0] == [("Rome", "2025-02"), ("Rome", "2025-03")]
    oslo = _observations(spark, "Oslo", 24 * 100, 30)  # April
    ingest.write_observations(spark, store, oslo, START)
    assert months(oslo) == ([("Oslo", "2025-04")], [("Oslo", 0, 29 + 47)])
    both = late.union(oslo)
    assert months(both)[0] == [("Oslo", "2025-04"), ("Rome", "2025-03")]
    index = {(r.city, r.event_month): (r.rows, r.start) for r in ingest.row_index(spark, store).collect()}
    assert index["Rome", "2025-01"] == (744, 0) and index["Rome", "2025-03"] == (746, 744 + 672) and index["Oslo", "2025-04"] == (30, 0)


def _features(spark, rows):
    """rows: (city, hour, aqi, complete)."""
    return spark.createDataFrame([(c, START + timedelta(hours=h), a, float(h), ok) for c, h, a, ok in rows],
                                 f"city string, timestamp timestamp, aqi int, x double, {state.COMPLETE} boolean")


def _state(df):
    hour = lambda t: None if t is None else int((t.timestamp - START).total_seconds() // 3600)
    return {r.city: (hour(r.at), r.aqi, hour(r.before), r.previous, hour(r.inputs_at), r.inputs and r.inputs.x) for r in df.collect()}


def test_states_merge_like_one_pass(spark):
    old = [("a", h, 10 + h, True) for h in range(5)] + [("b", 0, 50, True), ("b", 1, 51, False)] + [("c", 3, None, False)] + [("d", 0, 1, True), ("d", 1, 2, True)]
    new = [("a", 7, 90, False), ("a", 6, 80, True), ("b", 1, 55, False), ("c", 2, 33, True), ("d", 1, 2, False), ("e", 0, 7, False), ("b", -4, 1, True)]
    merged, gone = state.merge_states(state.summarise(_features(spark, old)), _features(spark, new))
    assert _state(merged) == {"a": (7, 90, 6, 80, 6, 6.0), "b": (1, 55, 0, 50, 0, 0.0), "c": (2, 33, None, None, 2, 2.0),
                              "d": (1, 2, 0, 1, None, None), "e": (0, 7, None, None, None, None)}
    assert [r.city for r in gone.collect()] == ["d"]
    whole = {(c, h): (c, h, a, ok) for c, h, a, ok in old + new}
    found = state.looked_up(merged, _features(spark, list(whole.values())).join(gone, "city", "left_semi"))
    assert _state(found) == _state(state.summarise(_features(spark, list(whole.values()))))


def test_fallback_for_a_dead_sensor(spark):
    """The newest row of "b" is incomplete: its current value stands for every forecast, and the snapshot says so."""
    current = state.summarise(_features(spark, [("a", 1, 120, True), ("b", 1, 130, True), ("b", 2, 160, False)]))
    assert [r.city for r in state.model_inputs(current).collect()] == ["a"]
    predictions = spark.createDataFrame([("a", 1, "m", 70.0), ("a", 6, "m", None)], "city string, horizon int, model string, prediction double")
    models = [(1, "m"), (6, "m")]
    moment = F.lit(datetime(2025, 1, 2)).cast("timestamp")
    checked = {(r.city, r.source): r.aqi for r in state.check_values(current, predictions, models, moment).collect()}
    assert checked == {("a", "current"): 120, ("b", "current"): 160, ("a", "1h_m"): 70, ("a", "6h_m"): 120, ("b", "1h_m"): 160, ("b", "6h_m"): 160}
    alerts = AL.build_alerts(state.check_values(current, None, models, moment))
    assert alerts.count() == 6
    counts = spark.createDataFrame([("a", 1), ("b", 2)], "city string, data_points long")
    snap = {(r.city, r.horizon): (r.current, r.change, r.prediction, r.status) for r in state.snapshot_rows(current, predictions, models, counts).collect()}
    assert snap == {("a", 1): (120, None, 70.0, "ok"), ("a", 6): (120, None, None, "missing"), ("b", 1): (160, 30, None, "missing"), ("b", 6): (160, 30, None, "missing")}
    assert {r.status for r in state.snapshot_rows(current, None, [], counts).collect()} == {"no model"}
