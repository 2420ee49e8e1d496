"""Queries over forecasts, calibration, scoring and the track record, on the daily order panel.

Next to the naive models a *band* model stands in for a learned one: the mean of both naive
forecasts with bounds 20 % away. It is a plain expression, so SQL can follow every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.operators import calibrate as cal
from zonecast.operators import features as ft
from zonecast.operators import score as sc
from zonecast.operators.models import naive_day, naive_week, predict_long
from zonecast.plans import panels
from zonecast.plans.shape import big, six
from zonecast.plans.sqltext import DAILY_PANEL, LOCAL, R6, with_ctes
from zonecast.session import materialise
from zonecast.sources.tables import driver_table

MIN_DAYS = 30


def order_rows(panel: DataFrame) -> DataFrame:
    """Daily targets with the inputs of the naive models, and one unlabelled day per zone."""
    ahead = panel.select("zone").distinct().select(
        "zone", F.date_add(ft.last_day(panel), 1).alias("delivery_date")
    ).select(
        "zone",
        "delivery_date",
        F.col("delivery_date").cast("timestamp_ntz").alias("hour_start"),
        F.lit(0).alias("hour_local"),
        F.lit(None).cast("double").alias("price_sek_kwh"),
    )
    previous = ft.trailing(ft.daily_profile(panel)).select(
        "zone",
        F.date_add("delivery_date", 1).alias("delivery_date"),
        F.col("day_mean").alias("prev_day_mean"),
        F.col("week_mean").alias("prev_week_mean"),
    )
    return (
        panel.unionByName(ahead)
        .withColumnRenamed("price_sek_kwh", "target_price")
        .join(ft.seasonal_lags(panel), ["zone", "delivery_date", "hour_local"], "left")
        .join(previous, ["zone", "delivery_date"], "left")
    )


def band() -> tuple:
    middle = (naive_day()[1] + naive_week()[1]) / 2
    return middle * 0.8, middle, middle * 1.2


MODELS = {"naive_day": naive_day, "naive_week": naive_week, "band": band}


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled day with every model, stored as a backtest stores them.

    The first days have no earlier price, so a model has no median there; such a row drops out of its own errors only.
    """
    rows = ft.labelled(order_rows(panels.stored_days(spark, sf_dir)))
    return materialise(predict_long(rows, MODELS), "predictions")


# One slot per day: the day's only price is also its mean, the fallback of the naive day.
_FORECASTS = f"""panel_days as (
    select zone, delivery_date, price_sek_kwh as target_price from hourly
    union all select distinct zone, (select max(delivery_date) + 1 from hourly), null from hourly),
weeks as (
    select zone, delivery_date, price_sek_kwh,
           avg(price_sek_kwh) over (partition by zone order by delivery_date
               range between interval 6 days preceding and current row) as week_mean from hourly),
inputs as (
    select t.*, l1.price_sek_kwh as day_value,
           coalesce(l7.price_sek_kwh, l1.week_mean) as week_value
    from panel_days as t
    left join weeks as l1 on l1.zone = t.zone and l1.delivery_date = t.delivery_date - 1
    left join weeks as l7 on l7.zone = t.zone and l7.delivery_date = t.delivery_date - 7),
preds as (
    select zone, delivery_date, target_price, cast(date_trunc('month', delivery_date) as date) as fold, model,
           case model when 'naive_day' then day_value when 'naive_week' then week_value
                      else (day_value + week_value) / 2 * 0.8 end as q10,
           case model when 'naive_day' then day_value when 'naive_week' then week_value
                      else (day_value + week_value) / 2 end as q50,
           case model when 'naive_day' then day_value when 'naive_week' then week_value
                      else (day_value + week_value) / 2 * 1.2 end as q90
    from inputs, (values ('naive_day'), ('naive_week'), ('band')) as m(model)
    where target_price is not null)"""

_MARGINS = f"""history as (
    select p.model, p.zone, f.fold, greatest(q10 - target_price, target_price - q90) as score
    from preds as p join (select distinct model, zone, fold from preds) as f
      on f.model = p.model and f.zone = p.zone
     and p.delivery_date < f.fold and p.delivery_date >= f.fold - 90
    where p.model = 'band' and p.q50 is not null),
ranked as (
    select *, count(*) over (partition by model, zone, fold) as n,
           row_number() over (partition by model, zone, fold order by score) - 1 as place from history),
margins as (
    select model, zone, fold, n, score as margin from ranked
    where n >= {MIN_DAYS} and place = ceil((n - 1) * least(1.0::double, ceil((n + 1) * 0.8::double) / n))),
calibrated as (
    select p.*, q10 as q10_raw, q90 as q90_raw, coalesce(margin, 0) as interval_margin,
           least(q10 - coalesce(margin, 0), q50) as low, greatest(q90 + coalesce(margin, 0), q50) as high
    from preds as p left join margins as m using (model, zone, fold))"""


def naive_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both naive models for every day, the coming one included."""
    rows = order_rows(panels.stored_days(spark, sf_dir))
    long = predict_long(rows, {"naive_day": naive_day, "naive_week": naive_week})
    return long.select("zone", "delivery_date", "model", *six("target_price", "q10", "q50", "q90"))


NAIVE_FORECASTS = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    select=f"""
    select zone, delivery_date, model, {R6('target_price')} as target_price,
           {R6('v')} as q10, {R6('v')} as q50, {R6('v')} as q90
    from (select *, 'naive_day' as model, day_value as v from inputs
          union all select *, 'naive_week', week_value from inputs)""",
)


def conformal_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margins of the folds that were predicted."""
    preds = predictions(spark, sf_dir)
    found = cal.fold_margins(preds, ("band",), min_points=MIN_DAYS)
    folds = preds.select("model", "zone", "fold").distinct()
    return found.join(folds, ["model", "zone", "fold"], "left_semi").select(
        "model", "zone", "fold", *big("n_scores"), *six("interval_margin")
    )


CONFORMAL_MARGINS = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    _MARGINS,
    select=f"select model, zone, fold, n as n_scores, {R6('margin')} as interval_margin from margins",
)


def calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calibrate(predictions(spark, sf_dir), ("band",), min_points=MIN_DAYS)


def calibrated_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrated(spark, sf_dir).select(
        "model", "zone", "fold", "delivery_date",
        *six("q10", "q50", "q90", "q10_raw", "q90_raw", "interval_margin"),
    )


CALIBRATED_INTERVALS = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    _MARGINS,
    select=f"""
    select model, zone, fold, delivery_date, {R6('low')} as q10, {R6('q50')} as q50, {R6('high')} as q90,
           {R6('q10_raw')} as q10_raw, {R6('q90_raw')} as q90_raw, {R6('interval_margin')} as interval_margin
    from calibrated""",
)


def live_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = calibrated(spark, sf_dir)
    return cal.recent_margins(preds, "band", min_points=MIN_DAYS).select(
        "zone", *big("n_scores"), *six("interval_margin")
    )


LIVE_MARGINS = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    f"""recent as (
        select zone, greatest(q10 - target_price, target_price - q90) as score from preds
        where model = 'band' and q50 is not null
          and delivery_date > (select max(delivery_date) - 90 from preds where model = 'band')),
    ranked as (
        select *, count(*) over (partition by zone) as n,
               row_number() over (partition by zone order by score) - 1 as place from recent)""",
    select=f"""
    select zone, n as n_scores, {R6('score')} as interval_margin from ranked
    where n >= {MIN_DAYS} and place = ceil((n - 1) * least(1.0::double, ceil((n + 1) * 0.8::double) / n))""",
)

METRICS = ("mae", "rmse", "bias", "pinball", "coverage_80")


def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics overall, by zone and by year for every model, with skill against the naive day."""
    scores = sc.score(calibrated(spark, sf_dir), raw_models=("band",))
    return scores.select(
        "scope", "part", "model", "n", *six(*METRICS, "skill_vs_naive_day", "coverage_80_uncalibrated")
    )


def _pinball(q: float, column: str) -> str:
    return f"avg(greatest({q} * (target_price - {column}), ({q} - 1) * (target_price - {column})))"


_METRICS_SQL = f"""keyed as (
    select *, cast(year(delivery_date) as varchar) as yr from calibrated),
sets as (
    select scope, part, model, count(*) as n, avg(abs(q50 - target_price)) as mae,
           sqrt(avg((q50 - target_price) * (q50 - target_price))) as rmse, avg(q50 - target_price) as bias,
           ({_pinball(0.1, 'low')} + {_pinball(0.5, 'q50')} + {_pinball(0.9, 'high')}) / 3 as pinball,
           avg(cast(target_price between low and high as int)) as coverage_80,
           avg(cast(target_price between q10_raw and q90_raw as int)) as raw_coverage
    from (select 'overall' as scope, 'all' as part, * from keyed
          union all select 'zone', zone, * from keyed
          union all select 'year', yr, * from keyed)
    group by scope, part, model)"""

FORECAST_METRICS = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    _MARGINS,
    _METRICS_SQL,
    select=f"""
    select s.scope, s.part, s.model, s.n, {", ".join(f"{R6(f's.{m}')} as {m}" for m in METRICS)},
           {R6('1 - s.mae / nullif(b.mae, 0)')} as skill_vs_naive_day,
           {R6("case when s.scope = 'overall' and s.model = 'band' then s.raw_coverage end")} as coverage_80_uncalibrated
    from sets as s left join sets as b on b.scope = s.scope and b.part = s.part and b.model = 'naive_day'""",
)


def skill_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models ranked by error within each view and part."""
    scores = sc.score(predictions(spark, sf_dir))
    place = F.rank().over(Window.partitionBy("scope", "part").orderBy(F.round("mae", 9)))
    return scores.select(
        "scope", "part", "model", *six("mae", "skill_vs_naive_day"), place.cast("bigint").alias("place")
    )


SKILL_BY_GROUP = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    """sets as (
        select scope, part, model, avg(abs(q50 - target_price)) as mae
        from (select 'overall' as scope, 'all' as part, * from preds
              union all select 'zone', zone, * from preds
              union all select 'year', cast(year(delivery_date) as varchar), * from preds)
        group by scope, part, model)""",
    select=f"""
    select s.scope, s.part, s.model, {R6('s.mae')} as mae, {R6('1 - s.mae / nullif(b.mae, 0)')} as skill_vs_naive_day,
           rank() over (partition by s.scope, s.part order by round(s.mae, 9)) as place
    from sets as s left join sets as b on b.scope = s.scope and b.part = s.part and b.model = 'naive_day'""",
)


def monthly_error_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pivot = sc.monthly_errors(predictions(spark, sf_dir), tuple(MODELS))
    return pivot.select("month", *six(*MODELS))


MONTHLY_ERROR_PIVOT = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    select="select strftime(fold, '%Y-%m') as month, "
    + ", ".join(
        f"{R6(f'''avg(abs(q50 - target_price)) filter (where model = '{m}')''')} as {m}" for m in MODELS
    )
    + " from preds group by month",
)


def evaluation_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.evaluation_period(predictions(spark, sf_dir))


EVALUATION_PERIOD = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    select="""
    select min(delivery_date) as first_day, max(delivery_date) as last_day,
           count(distinct delivery_date) as days from preds""",
)


def issued_forecasts(spark: SparkSession, sf_dir: str, panel: DataFrame) -> DataFrame:
    """The band forecast of every day, the coming one included, as an issued log.

    A day's forecast is issued the day before, at 08:00 UTC and half an hour later for every
    order that came in on the day before. A day without lags is issued too, with empty quantiles.
    """
    rows = order_rows(panel)
    arrivals = (
        driver_table(spark, sf_dir, "orders")
        .groupBy(F.date_add(F.col("o_orderdate").cast("date"), 1).alias("delivery_date"))
        .agg(F.count("*").alias("orders"))
    )
    start = F.date_sub("delivery_date", 1).cast("timestamp_ntz")
    forecast = predict_long(rows, {"band": band, "naive_day": naive_day})
    wide = forecast.groupBy("zone", "delivery_date", "hour_start").agg(
        *[F.max(F.when(F.col("model") == "band", F.col(q))).alias(q) for q in ("q10", "q50", "q90")],
        F.max(F.when(F.col("model") == "naive_day", F.col("q50"))).alias("naive_day"),
    )
    minutes = F.lit(480) + F.lit(30) * F.coalesce("orders", F.lit(0))
    return wide.join(arrivals, "delivery_date", "left").select(
        *wide.columns,
        F.timestamp_add("MINUTE", minutes, start).alias("issued_at"),
        F.lit("band-v1").alias("model_version"),
    )


_ISSUED = f"""arrivals as (
    select cast(o_orderdate as date) + 1 as delivery_date, count(*) as orders from orders group by all),
issued as (
    select zone, i.delivery_date, (day_value + week_value) / 2 * 0.8 as q10, (day_value + week_value) / 2 as q50,
           (day_value + week_value) / 2 * 1.2 as q90, day_value as naive_day, target_price as actual,
           cast(i.delivery_date - 1 as timestamp) + to_minutes(480 + 30 * coalesce(orders, 0)) as issued_at
    from inputs as i left join arrivals as a on a.delivery_date = i.delivery_date),
record as (
    select delivery_date, zone, avg(abs(q50 - actual)) as mae_model, avg(abs(naive_day - actual)) as mae_naive,
           avg(cast(actual between q10 and q90 as int)) as coverage, count(*) as hours
    from issued where actual is not null group by all)"""


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    panel = panels.stored_days(spark, sf_dir)
    issued = materialise(issued_forecasts(spark, sf_dir, panel), "issued")
    return issued, sc.with_actuals(issued, panel)


def track_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = _scored(spark, sf_dir)
    return sc.track_record_days(scored).select(
        "delivery_date", "zone", *six("mae_model", "mae_naive", "coverage")
    )


TRACK_RECORD = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    _ISSUED,
    select=f"""
    select delivery_date, zone, {R6('mae_model')} as mae_model, {R6('mae_naive')} as mae_naive,
           {R6('coverage')} as coverage from record""",
)


def track_record_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = _scored(spark, sf_dir)
    return sc.track_record_summary(scored).select(
        *big("days", "days_beating_naive"), *six("mae_model", "mae_naive", "coverage_80")
    )


TRACK_RECORD_SUMMARY = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    _ISSUED,
    select=f"""
    select (select count(*) from (select delivery_date from record group by all)) as days,
           (select count(*) from (select delivery_date from record group by delivery_date
                                  having avg(mae_model) < avg(mae_naive))) as days_beating_naive,
           {R6('avg(abs(q50 - actual))')} as mae_model, {R6('avg(abs(naive_day - actual))')} as mae_naive,
           {R6('avg(cast(actual between q10 and q90 as int))')} as coverage_80
    from issued where actual is not null""",
)


def issue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    issued, scored = _scored(spark, sf_dir)
    return sc.issue_log(issued, scored).select(
        "position", "delivery_date", "issued_at", "model_version", "timing", "status",
        *six("mae_model", "mae_naive", "coverage"),
    )


ISSUE_LOG = with_ctes(
    DAILY_PANEL,
    _FORECASTS,
    _ISSUED,
    select=f"""
    select row_number() over (order by i.delivery_date desc) as position,
           i.delivery_date, issued_at, 'band-v1' as model_version,
           case when {LOCAL('issued_at')} < cast(i.delivery_date - 1 as timestamp) + interval 12 hours
                then 'before' else 'after' end as timing,
           case when hours is null then 'waiting' else 'scored' end as status,
           {R6('mae_model')} as mae_model, {R6('mae_naive')} as mae_naive, {R6('coverage')} as coverage
    from (select delivery_date, min(issued_at) as issued_at from issued group by all) as i
    left join (select delivery_date, avg(mae_model) as mae_model, avg(mae_naive) as mae_naive,
                      avg(coverage) as coverage, sum(hours) as hours from record group by all) as r using (delivery_date)""",
)

QUERIES = {
    "naive_forecasts": (naive_forecasts, NAIVE_FORECASTS),
    "conformal_margins": (conformal_margins, CONFORMAL_MARGINS),
    "calibrated_intervals": (calibrated_intervals, CALIBRATED_INTERVALS),
    "live_margins": (live_margins, LIVE_MARGINS),
    "forecast_metrics": (forecast_metrics, FORECAST_METRICS),
    "skill_by_group": (skill_by_group, SKILL_BY_GROUP),
    "monthly_error_pivot": (monthly_error_pivot, MONTHLY_ERROR_PIVOT),
    "evaluation_period": (evaluation_period, EVALUATION_PERIOD),
    "track_record": (track_record, TRACK_RECORD),
    "track_record_summary": (track_record_summary, TRACK_RECORD_SUMMARY),
    "issue_log": (issue_log, ISSUE_LOG),
}
