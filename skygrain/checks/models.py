"""Checked queries: metrics, roll-ups, forecasts and attributions."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from skygrain import schema as S
from skygrain.checks import views as V
from skygrain.checks.features import OBS, W
from skygrain.operators import attribution as X
from skygrain.operators import features as FE
from skygrain.operators import forecast as FC
from skygrain.operators import metrics as M
from skygrain.operators import series as T
from skygrain.operators.gram import gram
from skygrain.operators.ordered import ordered
from skygrain.plans import model_report as MR
from skygrain.session import durable, scratch_root
from skygrain.sources import feature_table

NAIVE = {"persistence": 0, "lag_1": 1, "lag_6": 6}


def _round(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _naive(spark, sf):
    """Forecasts that repeat an earlier reading, with what came true, per horizon."""
    o = ordered(V.obs_aqi(spark, sf), ["city"], V.ORDER, back=6, ahead=max(S.HORIZONS))
    guesses = {a: (F.lag("aqi", k).over(o.window) if k else F.col("aqi")) for a, k in NAIVE.items()}
    wide = o.finish(o.frame.select(
        "*", *[g.alias(a) for a, g in guesses.items()],
        *[t.alias(n) for n, t in FE.target_columns(o.window).items()]))
    entries = [F.struct(F.lit(a).alias("algorithm"), F.lit(h).alias("horizon"),
                        F.col(a).alias("prediction"), F.col(S.horizon_name(h)).alias("actual"))
               for a in NAIVE for h in S.HORIZONS]
    return wide.select("city", F.explode(F.array(*entries)).alias("e")).select("city", "e.*")


def naive_forecast_metrics(spark, sf):
    return _round(M.regression_metrics(_naive(spark, sf), ["algorithm", "horizon"]), "mse", "mae", "r2")


def _split_metrics(spark, sf):
    """The naive forecasts scored apart before and after a city's chronological cut."""
    split = T.chronological_split(V.obs_aqi(spark, sf), ["city"], V.ORDER)
    o = ordered(split, ["city"], V.ORDER, back=6, ahead=max(S.HORIZONS))
    wide = o.finish(o.frame.select(
        "*", F.lag("aqi", 6).over(o.window).alias("lag_6"),
        *[t.alias(n) for n, t in FE.target_columns(o.window).items()]))
    entries = [F.struct(F.lit(a).alias("algorithm"), F.lit(h).alias("horizon"),
                        (F.col(c) * w).alias("prediction"), F.col(S.horizon_name(h)).alias("actual"))
               # the last two overshoot 500 and are bounded before scoring
               for a, c, w, hs in (("persistence", "aqi", 1, S.HORIZONS), ("lag_6", "lag_6", 1, (12, 24)),
                                   ("triple", "aqi", 3, (1, 6)))
               for h in hs]
    long = wide.select("split", F.explode(F.array(*entries)).alias("e")).select("split", "e.*")
    return M.regression_metrics(long, ["algorithm", "horizon", "split"])


def summary_by_model(spark, sf):
    names = [f"{s}_{m}" for s in ("train", "test") for m in ("mse", "mae", "r2")]
    return _round(M.summary_by_model(_split_metrics(spark, sf)), *names)


def representative_metrics(spark, sf):
    test = _split_metrics(spark, sf).filter("split = 'test'")
    return _round(M.representative(test), "mse", "mae", "r2")


def _records(spark, sf):
    """One metric record per algorithm, horizon and city, trained when the city's data ends."""
    metrics = M.regression_metrics(_naive(spark, sf), ["algorithm", "horizon", "city"])
    ends = V.obs(spark, sf).groupBy("city").agg(F.max("timestamp").alias("trained"))
    named = metrics.join(ends, "city").withColumn("algorithm", F.concat_ws("_", "algorithm", "city"))
    rounded = _round(named, "mse", "mae", "r2")
    return M.flat_records(M.metric_records(
        rounded, F.date_format("trained", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("none"))).withColumn(
        "model_name", F.concat("model_name", F.lit("_h"), "horizon"))


def best_model(spark, sf):
    return M.best_models(_records(spark, sf))


def model_ranking(spark, sf):
    return M.model_ranking(_records(spark, sf))


def comparison_table(spark, sf):
    return M.comparison_table(M.model_ranking(_records(spark, sf))).select(
        "Model", "Algorithm", "Horizon", "MAE", F.col("R² Score").alias("R2"),
        F.col("Last Trained").alias("Trained"))


def horizon_rollup(spark, sf):
    df = M.horizon_rollup(_records(spark, sf))
    return df.withColumns({
        "avg_mae": F.round("avg_mae", 9), "avg_r2": F.round("avg_r2", 9)}).withColumn(
        "models", F.array_join(F.transform("models", lambda m: m.model_name), ","))


def latest_per_algorithm(spark, sf):
    return M.latest_per_algorithm(_records(spark, sf)).select(
        "algorithm", "model_name", "horizon", "training_timestamp", "mae", "r2")


LINEAR = [("ridge", h, c, w * h) for h in (1, 6) for c, w in (
    ("pm2_5", 0.5), ("ozone", -0.5), ("temperature_2m", 1.5), ("uv_index", 3.0),
    ("cloud_cover", -0.125), ("pm10", 0.75), ("dust", 0.0625))]
LINEAR_FEATURES = list(dict.fromkeys(c for _, _, c, _ in LINEAR))


def _linear(spark, sf):
    """Contributions to fixed linear models, means taken from the training rows."""
    split = T.chronological_split(V.obs(spark, sf), ["city"], V.ORDER)
    long = split.unpivot(["event_id", "split"], LINEAR_FEATURES, "feature", "value")
    coefficients = spark.createDataFrame(
        LINEAR, "model string, horizon int, feature string, coefficient double")
    means = X.feature_means(long.filter("split = 'train'"))
    return X.linear_contributions(
        long.filter("split = 'test'"), coefficients, means, ["event_id"])


def linear_attribution(spark, sf):
    return _round(_linear(spark, sf), "contribution")


def importance_topk(spark, sf):
    return _round(X.top_features(X.importance(_linear(spark, sf)), 5), "importance")


def row_explanation(spark, sf):
    """Contributions and values as maps, for the rows of one reading per city and model."""
    newest = V.obs(spark, sf).groupBy("city").agg(F.max("event_id").alias("event_id")).select("event_id")
    picked = _linear(spark, sf).join(newest, "event_id", "left_semi")
    scores = picked.groupBy("event_id", "model", "horizon").agg(
        F.sum("contribution").alias("prediction"))
    e = X.explanation(_round(picked, "contribution"), scores, ["event_id"])
    text = lambda m: F.array_join(
        F.transform(F.map_entries(m), lambda kv: F.concat(kv.key, F.lit("="), kv.value.cast("string"))), ",")
    return e.select("event_id", "model", "horizon", F.round("prediction", 6).alias("prediction"),
                    text(F.col("feature_values")).alias("feature_values"))


def row_explanation_parts(spark, sf):
    """The same rows with contribution and value of every feature."""
    newest = V.obs(spark, sf).groupBy("city").agg(F.max("event_id").alias("event_id")).select("event_id")
    picked = _linear(spark, sf).join(newest, "event_id", "left_semi")
    scores = picked.groupBy("event_id", "model", "horizon").agg(F.sum("contribution").alias("prediction"))
    e = X.explanation(picked, scores, ["event_id"])
    rows = e.select("event_id", "model", "horizon", "feature_values", F.explode("feature_contributions").alias("feature", "contribution"))
    return _round(rows.select("event_id", "model", "horizon", "feature", "contribution", F.col("feature_values")[F.col("feature")].alias("value")), "contribution")


TREE_FEATURES = ("pm2_5", "ozone", "wind_direction_10m")
# Hand-made trees of a root and one inner node: root feature and threshold, inner feature and threshold, then value and
# training rows of the root's left leaf and of the inner node's two.
TREES = [("pm2_5", 40.0, "ozone", 90.0, (10.0, 30.0), (60.0, 50.0), (150.0, 20.0)),
         ("ozone", 120.0, "wind_direction_10m", 180.0, (25.0, 64.0), (80.0, 8.0), (220.0, 8.0))]


def _forest(horizon: int) -> pd.DataFrame:
    """The nodes of the trees as a saved forest has them; a later horizon has larger values."""
    rows = []
    for tree, (f, t, g, u, a, b, c) in enumerate(TREES):
        leaf = lambda i, v: (tree, i, v[0] * horizon, v[1], -1, -1, -1, float("nan"))
        inner = (b[0] * b[1] + c[0] * c[1]) / (b[1] + c[1]) * horizon
        rows += [(tree, 0, 0.0, a[1] + b[1] + c[1], 1, 2, TREE_FEATURES.index(f), t), leaf(1, a),
                 (tree, 2, inner, b[1] + c[1], 3, 4, TREE_FEATURES.index(g), u), leaf(3, b), leaf(4, c)]
    return pd.DataFrame(rows, columns=["tree", "id", "value", "cover", "left", "right", "feature", "threshold"])


def tree_contributions_fixed(spark, sf):
    """Shapley values of every row under a hand-made forest for each of the six horizons."""
    rows = FC.assemble(V.obs(spark, sf), TREE_FEATURES)
    boxes = {h: X.leaf_boxes(_forest(h)) for h in S.HORIZONS}
    parts = X.tree_contributions(rows, boxes, TREE_FEATURES, ["event_id"])
    return _round(parts.select("event_id", "horizon", "feature", "value", "contribution", "base"), "contribution", "base")


def single_horizon_ridge(spark, sf):
    """The single-horizon ridge on three readings, on an exact random split."""
    rows = FE.engineer(V.obs(spark, sf), ["city"], V.ORDER).select("city", "timestamp", "event_id", *GRAM_FEATURES, S.TARGET).na.drop("any")
    split = feature_table.random_split(rows, ["city", "timestamp", "event_id"])
    _, metrics = FC.fit_single(rows, split, GRAM_FEATURES, ["ridge_regression"])
    return _round(metrics, "mse", "mae", "r2")


def metric_report(spark, sf):
    """The best models by the newest of two runs' records; the first run was better and is history."""
    records = _stored(spark, sf)
    return MR.metric_sections(records)["best_model"]


def _stored(spark, sf):
    metrics = M.regression_metrics(_naive(spark, sf), ["algorithm", "horizon"])
    rounded = _round(metrics, "mse", "mae", "r2")
    first = M.metric_records(rounded.withColumn("mae", F.lit(0.0)), F.lit("2024-01-01T00:00:00"), F.lit("none"))
    return first.unionByName(M.metric_records(rounded, F.lit("2024-01-02T00:00:00"), F.lit("none"))).withColumn(
        "model_name", F.concat("model_name", F.lit("_h"), "horizon"))


# --- fitted models: no SQL twin ------------------------------------------------------

def _training(spark, sf):
    names = [S.horizon_name(h) for h in S.HORIZONS]
    features = FE.engineer(V.obs(spark, sf).drop("event_type"), ["city"], V.ORDER, horizons=S.HORIZONS)
    return FC.prepare(FE.complete_rows(features, [S.TARGET, *names]), ["city"], V.ORDER)


def _forecast(spark, sf, algorithm):
    training = _training(spark, sf)
    fitted = FC.fit(training, [algorithm])
    return FC.evaluate(fitted, training)


def ridge_forecast(spark, sf):
    return _forecast(spark, sf, "ridge_regression")


GRAM_FEATURES = ("pm2_5", "ozone", "wind_direction_10m")


def ridge_gram(spark, sf):
    """Ridge coefficients of all six horizons on three readings, from one pass over all rows with every target."""
    df = FE.with_targets(V.obs_aqi(spark, sf), ["city"], V.ORDER)
    targets = {h: S.horizon_name(h) for h in S.HORIZONS}
    g = gram(df, [*GRAM_FEATURES, *targets.values()])
    rows = []
    for h, target in targets.items():
        w, intercept = g.ridge(GRAM_FEATURES, target, FC.RIDGE_ALPHA)
        rows += [(h, g.n, c, float(x), intercept) for c, x in zip(GRAM_FEATURES, w)]
    return _round(spark.createDataFrame(rows, "horizon int, n long, feature string, coefficient double, intercept double"), "coefficient", "intercept")


def ridge_predictions(spark, sf):
    """Test predictions of ridge models on three readings, all horizons, from the stored coefficients."""
    df = T.chronological_split(V.obs_aqi(spark, sf), ["city"], V.ORDER)
    df = FE.with_targets(df, ["city"], V.ORDER)
    rows = FC.assemble(df, GRAM_FEATURES)
    training = FC.TrainingSet(durable(rows, "few"), GRAM_FEATURES, {h: S.horizon_name(h) for h in S.HORIZONS})
    return _round(FC.evaluate(FC.fit_ridge(training), training), "mse", "mae", "r2")


def forest_forecast(spark, sf):
    return _forecast(spark, sf, "random_forest")


def single_horizon_forecast(spark, sf):
    keys = ["city", "timestamp", "event_id"]
    features = FE.complete_rows(FE.engineer(V.obs(spark, sf).drop("event_type"), ["city"], V.ORDER))
    rows, columns = feature_table.training_frame(features)
    columns = [c for c in columns if c != "event_id"]
    split = feature_table.random_split(FC.vectors(rows, keys, columns), keys)
    _, metrics = FC.fit_single(features, split, columns, ["ridge_regression"])
    return M.summary_by_model(metrics)


def forest_importance(spark, sf):
    training = _training(spark, sf)
    one = FC.TrainingSet(training.rows, training.features, {6: training.targets[6]})
    return FC.forest_importance(spark, FC.fit(one, ["random_forest"])[0], 20)


def tree_attribution(spark, sf):
    """Mean absolute tree contributions over all test rows, ten strongest features."""
    training = _training(spark, sf)
    one = FC.TrainingSet(training.rows, training.features, {6: training.targets[6]})
    fitted = FC.fit(one, ["random_forest"])[0]
    path = f"{scratch_root(spark)}/forest-{uuid.uuid4().hex}"
    fitted.model.write().overwrite().save(path)
    boxes = {6: X.leaf_boxes(X.tree_nodes(spark, path))}
    test = training.rows.filter("split = 'test'")
    return X.top_features(X.importance(X.tree_contributions(
        test, boxes, training.features, ["city", "timestamp", "event_id"])))


QUERIES = {f.__name__: f for f in (
    naive_forecast_metrics, summary_by_model, representative_metrics, best_model, model_ranking, comparison_table, horizon_rollup,
    latest_per_algorithm, linear_attribution, importance_topk, row_explanation, row_explanation_parts, tree_contributions_fixed, single_horizon_ridge, metric_report, ridge_gram, ridge_predictions, ridge_forecast,
    forest_forecast, single_horizon_forecast, forest_importance, tree_attribution)}


# --- SQL twins -------------------------------------------------------------------

PAIRS = " union all ".join(
    f"select city, '{a}' as algorithm, {h} as horizon, {'p_' + a} as p, h{h} as y from n"
    for a in NAIVE for h in S.HORIZONS)
NAIVE_SQL = f"""{OBS}, n as (select city, aqi as p_persistence, """ + ", ".join(
    f"lag(aqi, {k}) over ({W}) as p_{a}" for a, k in NAIVE.items() if k) + ", " + ", ".join(
    f"lead(aqi, {h}) over ({W}) as h{h}" for h in S.HORIZONS) + f""" from o), f as ({PAIRS})"""


def _metrics(by: str) -> str:
    return f"""select {by}, count(*) as n, round(avg((p - y) * (p - y)), 6) as mse,
        round(avg(abs(p - y)), 6) as mae, round(case when min(y) = max(y) then -1 else
          1 - avg((p - y) * (p - y)) / var_pop(y) end, 6) as r2
        from f where p is not null and y is not null group by {by}"""


SPLIT_SQL = f"""{OBS}, s as (select *, row_number() over ({W}) - 1 as pos,
      floor(cast(count(*) over (partition by city) as double) * 0.8::double) as cut from o),
    n as (select case when pos < cut then 'train' else 'test' end as split, aqi,
      lag(aqi, 6) over ({W}) as lag_6, """ + ", ".join(
    f"lead(aqi, {h}) over ({W}) as h{h}" for h in S.HORIZONS) + """ from s),
    f as (""" + " union all ".join(
    [f"select split, 'persistence' as algorithm, {h} as horizon, aqi as p, h{h} as y from n" for h in S.HORIZONS]
    + [f"select split, 'lag_6', {h}, lag_6, h{h} from n" for h in (12, 24)]
    + [f"select split, 'triple', {h}, least(aqi * 3, 500), h{h} from n" for h in (1, 6)]) + """),
    v as (select *, case when p is not null then y end as t from f),
    g as (select algorithm, horizon, split, count(t) as n, round(avg((p - t) * (p - t)), 6) as mse,
      round(avg(abs(p - t)), 6) as mae, round(coalesce(case when min(t) < max(t) then
        1 - avg((p - t) * (p - t)) / var_pop(t) end, -1), 6) as r2 from v group by 1, 2, 3)"""
RECORDS = f"""{NAIVE_SQL}, m as ({_metrics('algorithm, horizon, city')}),
    ends as (select city, strftime(max(timestamp), '%Y-%m-%dT%H:%M:%S') as training_timestamp,
      strftime(max(timestamp), '%Y-%m-%d %H:%M') as trained from obs group by city),
    r as (select concat('multi_output_', algorithm, '_', city, '_h', horizon) as model_name,
      concat(algorithm, '_', city) as algorithm, horizon, mse, mae, r2, training_timestamp, trained,
      '1.0' as version from m join ends using (city))"""
LINEAR_SQL = f"""with {V.OBS_SQL}, s as (select *, row_number() over ({W}) - 1 as pos,
      floor(cast(count(*) over (partition by city) as double) * 0.8::double) as cut from obs),
    u as (""" + " union all ".join(
    f"select event_id, city, pos < cut as train, '{c}' as feature, {c} as value from s"
    for c in LINEAR_FEATURES) + """),
    mu as (select feature, avg(value) as mean from u where train group by 1),
    co (model, horizon, feature, coefficient) as (values """ + ", ".join(
    f"('{m}', {h}, '{c}', {w}::double)" for m, h, c, w in LINEAR) + """),
    c as (select event_id, model, horizon, feature, value, coefficient * (value - mean) as contribution
      from u join mu using (feature) join co using (feature) where not train)"""

def _ridge_sql(rows: str) -> str:
    """CTE ``w``: coefficients ``wa, wb, wc`` and intercept ``i`` per horizon, by Cramer's rule on the penalised normal equations.

    ``rows`` has ``horizon, a, b, c, y``.
    """
    pairs = ("aa", "ab", "ac", "bb", "bc", "cc", "ay", "by", "cy")
    sums = ", ".join(f"covar_pop({p[0]}, {p[1]}) * count(*) + {FC.RIDGE_ALPHA if p[0] == p[1] else 0.0}::double as s{p}" for p in pairs)
    det = lambda a, b, c: (f"({a[0]} * ({b[1]} * {c[2]} - {c[1]} * {b[2]}) - {b[0]} * ({a[1]} * {c[2]} - {c[1]} * {a[2]})"  # noqa: E731
                           f" + {c[0]} * ({a[1]} * {b[2]} - {b[1]} * {a[2]}))")
    a, b, c, y = ("saa", "sab", "sac"), ("sab", "sbb", "sbc"), ("sac", "sbc", "scc"), ("say", "sby", "scy")
    return f"""g as (select horizon, count(*) as n, avg(a) as ma, avg(b) as mb, avg(c) as mc, avg(y) as my, {sums} from ({rows}) group by horizon),
      d as (select *, {det(y, b, c)} / {det(a, b, c)} as wa, {det(a, y, c)} / {det(a, b, c)} as wb, {det(a, b, y)} / {det(a, b, c)} as wc from g),
      w as (select *, my - wa * ma - wb * mb - wc * mc as i from d)"""


_LEADS = ", ".join(f"lead(aqi, {h}) over ({W}) as h{h}" for h in S.HORIZONS)
_ALL_LEADS = " and ".join(f"h{h} is not null" for h in S.HORIZONS)
_ABC = ", ".join(f"{c} as {n}" for c, n in zip(GRAM_FEATURES, "abc"))


def _by_horizon(source: str, more: str = "") -> str:
    return " union all ".join(f"select {h} as horizon, a, b, c, h{h}::double as y{more} from {source}" for h in S.HORIZONS)


def _tree_sql() -> str:
    """Path-dependent Shapley values of each tree by its two features' four sets, averaged over the trees."""
    parts = []
    for f, t, g, u, a, b, c in TREES:
        total, inner = a[1] + b[1] + c[1], b[1] + c[1]
        mean = (b[0] * b[1] + c[0] * c[1]) / inner
        lower, none = f"case when {g} <= {u} then {b[0]} else {c[0]} end::double", (a[0] * a[1] + inner * mean) / total
        vf = f"case when {f} <= {t} then {a[0]} else {mean!r} end::double"
        vg = f"(({a[0]} * {a[1]} + {inner} * ({lower})) / {total})"
        both = f"case when {f} <= {t} then {a[0]} else {lower} end::double"
        parts += [f"select event_id, '{f}' as feature, (({vf} - {none!r}) + ({both} - {vg})) / 2 as phi, {none!r}::double as base from obs",
                  f"select event_id, '{g}', (({vg} - {none!r}) + ({both} - {vf})) / 2, 0::double from obs"]
    zero = [f"select event_id, '{c}', 0::double, 0::double from obs" for c in TREE_FEATURES]
    value = "case feature " + " ".join(f"when '{c}' then {c}" for c in TREE_FEATURES) + " end"
    return f"""with {V.OBS_SQL}, p as ({' union all '.join([*parts, *zero])}),
      s as (select event_id, feature, sum(phi) / {len(TREES)} as phi from p group by 1, 2),
      b as (select event_id, sum(base) / {len(TREES)} as base from p group by 1),
      h (horizon) as (values {', '.join(f'({h})' for h in S.HORIZONS)})
      select s.event_id, cast(horizon as int) as horizon, feature, {value} as value, round(phi * horizon, 6) as contribution, round(base * horizon, 6) as base
      from s join b using (event_id) join obs using (event_id), h"""


ORACLES = {
    "tree_contributions_fixed": _tree_sql(),
    "single_horizon_ridge": f"""{OBS}, t as (select *, h6::double as y, case when row_number() over (order by
          md5(concat_ws('|', city, cast(epoch_us(timestamp) as varchar), cast(event_id as varchar), '42'))) <= floor(count(*) over () * 0.8::double) then 'train' else 'test' end as split
          from (select *, {_ABC}, lead(aqi, 6) over ({W}) as h6 from o) where h6 is not null),
        {_ridge_sql("select 6 as horizon, a, b, c, y from t where split = 'train'")},
        f as (select 'ridge_regression' as algorithm, cast(6 as int) as horizon, split, y, least(500, greatest(0, w.i + w.wa * a + w.wb * b + w.wc * c)) as p from t, w)
        {_metrics('algorithm, horizon, split')}""",
    "metric_report": f"""{NAIVE_SQL}, m as ({_metrics('algorithm, horizon')}),
        r as (select concat('multi_output_', algorithm, '_h', horizon) as model_name, mae, r2 from m)
        select count(*) as total_models, arg_min(model_name, (mae, model_name)) as best_mae_model, min(mae) as best_mae,
          arg_min(model_name, (-r2, model_name)) as best_r2_model, max(r2) as best_r2 from r""",
    "row_explanation_parts": f"""{LINEAR_SQL}, k as (select max(event_id) as event_id from obs group by city)
        select event_id, model, horizon, feature, round(contribution, 6) as contribution, value from c join k using (event_id)""",
    "ridge_gram": f"""{OBS}, t as (select * from (select {_ABC}, {_LEADS} from o) where {_ALL_LEADS}),
        {_ridge_sql(_by_horizon('t'))}
        select horizon, n, feature, round(coefficient, 6) as coefficient, round(i, 6) as intercept from (
          select horizon, n, i, unnest([{', '.join(f"'{c}'" for c in GRAM_FEATURES)}]) as feature, unnest([wa, wb, wc]) as coefficient from w)""",
    "ridge_predictions": f"""{OBS}, s as (select *, row_number() over ({W}) - 1 as pos, {_ABC}, {_LEADS},
          floor(cast(count(*) over (partition by city) as double) * 0.8::double) as cut from o),
        t as (select *, case when pos < cut then 'train' else 'test' end as split from s where {_ALL_LEADS}),
        {_ridge_sql(_by_horizon("(select * from t where split = 'train')"))},
        f as (select 'ridge_regression' as algorithm, horizon, split, y,
          least(500, greatest(0, w.i + w.wa * l.a + w.wb * l.b + w.wc * l.c)) as p from ({_by_horizon('t', ', split')}) l join w using (horizon))
        {_metrics('algorithm, horizon, split')}""",
    "naive_forecast_metrics": f"{NAIVE_SQL} {_metrics('algorithm, horizon')}",
    "summary_by_model": f"{SPLIT_SQL} select algorithm, horizon, " + ", ".join(
        f"max({m}) filter (split = '{s}') as {s}_{m}" for s in ("train", "test") for m in ("n", "mse", "mae", "r2"))
        + " from g group by 1, 2",
    "representative_metrics": f"""{SPLIT_SQL} select algorithm, horizon, mse, mae, r2 from (
        select *, row_number() over (partition by algorithm order by horizon <> 6, horizon) as rn
        from g where split = 'test') where rn = 1""",
    "best_model": f"""{RECORDS} select count(*) as total_models,
        arg_min(model_name, (mae, model_name)) as best_mae_model, min(mae) as best_mae,
        arg_min(model_name, (-r2, model_name)) as best_r2_model, max(r2) as best_r2 from r""",
    "model_ranking": f"""{RECORDS} select model_name, algorithm, horizon, round_even(r2, 4) as r2,
        round_even(mae, 4) as mae, training_timestamp, version from r""",
    "comparison_table": f"""{RECORDS} select model_name as "Model", algorithm as "Algorithm",
        horizon as "Horizon", round_even(mae, 4) as "MAE", round_even(r2, 4) as "R2",
        trained as "Trained" from r""",
    "horizon_rollup": f"""{RECORDS} select horizon, min(mae) as best_mae, max(r2) as best_r2,
        round(avg(mae), 9) as avg_mae, round(avg(r2), 9) as avg_r2, count(*) as model_count,
        string_agg(model_name, ',' order by model_name) as models from r group by horizon""",
    "latest_per_algorithm": f"""{RECORDS} select algorithm, model_name, horizon, training_timestamp, mae, r2
        from (select *, row_number() over (partition by algorithm
          order by training_timestamp desc, model_name, horizon) as rn from r) where rn = 1""",
    "linear_attribution": f"""{LINEAR_SQL} select event_id, model, horizon, feature, value,
        round(contribution, 6) as contribution from c""",
    "importance_topk": f"""{LINEAR_SQL}, i as (select model, horizon, feature,
          avg(abs(contribution)) as importance from c group by 1, 2, 3)
        select model, horizon, feature, round(importance, 6) as importance, cast(rank as int) as rank from (
          select *, row_number() over (partition by model, horizon order by importance desc, feature) as rank
          from i) where rank <= 5""",
    "row_explanation": f"""{LINEAR_SQL}, k as (select max(event_id) as event_id from obs group by city)
        select event_id, model, horizon, round(sum(contribution), 6) as prediction,
          string_agg(concat(feature, '=', cast(value as varchar)), ',' order by feature) as feature_values
        from c join k using (event_id) group by 1, 2, 3""",
}
