"""H: volume, revenue, freshness and trend rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import anomaly, scores
from plumbline.plans.suites import consolidated
from plumbline.sources.events import daily_load, load_log
from plumbline.sources.star import sales

NOW = "2024-01-20 07:30:00"


def on_load(build):
    return lambda spark, sf_dir: build(daily_load(spark, sf_dir))


def on_sales(build):
    return lambda spark, sf_dir: build(sales(spark, sf_dir))


def on_log(build):
    return lambda spark, sf_dir: build(load_log(spark, sf_dir))


def daily_quality(spark, sf_dir):
    """Mean score of the fact per day."""
    runs = scores.daily_runs(sales(spark, sf_dir), consolidated()["fact_sales"].subset(kinds=["between",
                                                                                              "revenue_identity"]))
    return runs.groupBy("load_date").agg(scores.mean_score().alias("score"))


def trends(spark, sf_dir):
    return anomaly.score_trends(daily_quality(spark, sf_dir))


def trends_per_series(spark, sf_dir):
    """The same rules for several series at once: one window partition per feed."""
    volume = anomaly.daily_volume(daily_load(spark, sf_dir), series=["event_type"])
    scored = volume.select("event_type", "load_date",
                           F.least(F.round(F.col("row_count") / F.lit(60.0), 6), F.lit(1.0)).alias("score"))
    return anomaly.score_trends(scored, series=["event_type"])


QUERIES = {
    "H1_volume_bands": on_load(anomaly.volume_bands),
    "H1_volume_bands_sales": on_sales(anomaly.volume_bands),
    "H1_volume_bands_per_feed": on_load(lambda t: anomaly.volume_bands(t, series=["event_type"])),
    "H2_volume_flags": on_load(anomaly.volume_flags),
    "H2_volume_flag_today": on_load(lambda t: anomaly.volume_flags(t, as_of="2024-01-24")),
    "H3_revenue_flags": on_sales(anomaly.revenue_flags),
    "H3_revenue_flags_all_days": on_sales(lambda t: anomaly.revenue_flags(t, last=None)),
    "H4_revenue_spikes": on_sales(anomaly.revenue_spikes),
    "H5_freshness_sla": on_log(lambda t: anomaly.freshness_sla(t, "fact_sales", NOW)),
    "H5_freshness_sla_nothing_loaded": on_log(lambda t: anomaly.freshness_sla(t, "fact_sales", "2024-03-01 07:30:00")),
    "H6_freshness_age": on_log(lambda t: anomaly.freshness_age(t, "2024-02-02 12:00:00")),
    "H6_freshness_never_loaded": on_log(lambda t: anomaly.freshness_age(t.where("table_name <> 'dim_store'"),
                                                                        "2024-02-02 12:00:00")),
    "H7_timeliness": on_log(lambda t: anomaly.timeliness(t, "2024-01-20 05:30:00")),
    "H7_timeliness_stale": on_log(lambda t: anomaly.timeliness(t.where("table_name <> 'dim_date'"), "2024-03-05 07:30:00")),
    "H8_daily_limits": on_load(lambda t: anomaly.daily_limits(t, 100, 600)),
    "H8_daily_limits_sales": on_sales(anomaly.daily_limits),
    "H9_score_trends": trends,
    "H9_score_trends_per_feed": trends_per_series,
}
