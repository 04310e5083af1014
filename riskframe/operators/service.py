"""Service monitoring over request logs: hourly summaries, sliding windows, percentiles, alerts.

Sliding windows first collapse the log into panes of one slide each, so that only pane totals, not
requests, are copied into the windows they belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.ordered import quantiles_by
from riskframe.schemas import ALERT_HOLD_SECONDS, ALERT_LIFETIMES, ALERT_LIMITS

WINDOW_SECONDS = 300
SLIDE_SECONDS = 60
SKETCH_K = 1_000

# Upper bounds in seconds of the usual latency histogram.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def hourly_logs(logs: DataFrame, ts: str = "predicted_at") -> DataFrame:
    """Tumbling hour: predictions, mean class and probability, share of each risk level.

    Works on a batch and, with its watermark, on a stream.
    """
    if logs.isStreaming:
        logs = logs.withWatermark(ts, "10 minutes")
    n = F.count("*")
    return (
        logs.groupBy(F.window(ts, "1 hour").alias("w"))
        .agg(
            n.alias("predictions"),
            F.avg("prediction").alias("mean_prediction"),
            F.avg("probability_default").alias("mean_probability"),
            *[
                (F.count_if(F.col("risk_level") == level) / n).alias(f"share_{level}")
                for level in ("low", "medium", "high")
            ],
        )
        .select(F.col("w.start").alias("hour"), "predictions", "mean_prediction", "mean_probability",
                "share_low", "share_medium", "share_high")
    )


def pane(ts: Column, slide: int) -> Column:
    """Start of the pane of ``slide`` seconds, as epoch seconds."""
    return F.floor(F.unix_micros(ts) / (slide * 1_000_000)).cast("bigint") * slide


def _windows(panes: DataFrame, window: int, slide: int) -> DataFrame:
    """Every pane once per window that covers it; ``window_start`` replaces ``pane``."""
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    starts = F.sequence(F.col("pane") - (window - slide), F.col("pane"), F.lit(slide).cast("bigint"))
    return panes.withColumn("window_start", F.explode(starts)).drop("pane")


def request_windows(log: DataFrame, window: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS) -> DataFrame:
    """``(window_start, requests, errors, request_rate, error_ratio)`` per sliding window of a batch."""
    panes = log.groupBy(pane(F.col("ts"), slide).alias("pane")).agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") >= 500).alias("errors")
    )
    totals = (
        _windows(panes, window, slide)
        .groupBy("window_start")
        .agg(F.sum("requests").alias("requests"), F.sum("errors").alias("errors"))
    )
    return totals.select(
        "window_start",
        "requests",
        "errors",
        (F.col("requests") / float(window)).alias("request_rate"),
        (F.col("errors") / F.col("requests")).alias("error_ratio"),
    )


def request_panes(log: DataFrame, slide: int = SLIDE_SECONDS, k: int = SKETCH_K) -> DataFrame:
    """``(pane, requests, errors, timed, sketch)`` per pane of one slide, of a batch or a stream.

    A request falls into one pane, so a stream keeps one state row per pane: three counters and a quantile sketch of the
    latencies, which has a few kilobytes however many requests the pane holds. Late rows of a stream count for ten minutes.
    """
    if log.isStreaming:
        log = log.withWatermark("ts", "10 minutes")
    grouped = log.groupBy(F.window("ts", f"{slide} seconds").alias("w"))
    totals = grouped.agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("status") >= 500).alias("errors"),
        F.count("latency_s").alias("timed"),
        F.kll_sketch_agg_double(F.col("latency_s"), F.lit(k)).alias("sketch"),
    )
    return totals.select(F.unix_timestamp("w.start").alias("pane"), "requests", "errors", "timed", "sketch")


def windows_of_panes(
    panes: DataFrame, p: float = 0.95, window: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS
) -> DataFrame:
    """Request windows with ``p95`` from panes: counters are added, sketches merged.

    Only panes are copied into the windows that cover them. The quantile is a latency that occurred; its rank is off by
    1.7 / k^0.9 of the window's requests with high probability, and exact while a window holds no more than ``k``.
    """
    sketch = F.when(F.col("timed") > 0, F.col("sketch"))
    totals = (
        _windows(panes.withColumn("sketch", sketch), window, slide)
        .groupBy("window_start")
        .agg(
            F.sum("requests").alias("requests"),
            F.sum("errors").alias("errors"),
            F.sum("timed").alias("timed"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )
    )
    quantile = F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(p))
    return totals.select(
        "window_start",
        "requests",
        "errors",
        (F.col("requests") / float(window)).alias("request_rate"),
        (F.col("errors") / F.col("requests")).alias("error_ratio"),
        F.when(F.col("timed") > 0, quantile).alias("p95"),
    )


def latency_quantile(
    log: DataFrame, p: float = 0.95, window: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS
) -> DataFrame:
    """``(window_start, requests, latency)``: exact interpolated percentile per sliding window."""
    panes = (
        log.filter(F.col("latency_s").isNotNull())
        .groupBy(pane(F.col("ts"), slide).alias("pane"), "latency_s")
        .agg(F.count("*").alias("n"))
    )
    counts = _windows(panes, window, slide).groupBy("window_start", "latency_s").agg(F.sum("n").alias("n"))
    return quantiles_by(counts, ["window_start"], "latency_s", {"latency": p}).withColumnRenamed("n", "requests")


def bucket_quantile(
    log: DataFrame,
    p: float = 0.95,
    bounds: list[float] = LATENCY_BOUNDS,
    window: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
) -> DataFrame:
    """``(window_start, requests, latency)`` from cumulative histogram buckets.

    Linear within the bucket that holds the rank; beyond the last bound the last bound is returned.
    """
    value = F.col("latency_s")
    counters = [F.count_if(value <= b).alias(f"le{i}") for i, b in enumerate(bounds)]
    names = ["n", *[f"le{i}" for i in range(len(bounds))]]
    panes = log.groupBy(pane(F.col("ts"), slide).alias("pane")).agg(F.count(value).alias("n"), *counters)
    totals = _windows(panes, window, slide).groupBy("window_start").agg(*[F.sum(c).alias(c) for c in names])
    rank = F.col("n") * p
    result = F.when(F.col("n") == 0, F.lit(None).cast("double"))
    for i, b in enumerate(bounds):
        below, low = (F.col(f"le{i - 1}"), bounds[i - 1]) if i else (F.lit(0), 0.0)
        inside = F.col(f"le{i}") - below
        spot = F.lit(low) + (b - low) * F.coalesce(F.try_divide(rank - below, inside), F.lit(1.0))
        result = result.when(F.col(f"le{i}") >= rank, spot)
    return totals.select(
        "window_start", F.col("n").alias("requests"), result.otherwise(F.lit(bounds[-1])).alias("latency")
    )


def metric_series(windows: DataFrame, metrics: dict[str, str], window: int = WINDOW_SECONDS) -> DataFrame:
    """``(metric, at, value)`` from windowed columns; a value belongs to the end of its window."""
    at = F.col("window_start") + window
    entries = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in metrics.items()]
    )
    return windows.select(at.alias("at"), F.explode(entries).alias("e")).select("e.metric", "at", "e.value")


def alerts(
    series: DataFrame,
    limits: dict[str, float] = ALERT_LIMITS,
    hold: int = ALERT_HOLD_SECONDS,
    step: int = SLIDE_SECONDS,
) -> DataFrame:
    """``(metric, at, value, state)`` where a metric is above its limit.

    An alert fires once every evaluation of the last ``hold`` seconds exceeded the limit, before that
    it is pending. A breach is copied to the evaluations it can confirm and the copies are counted, so
    a long series needs no ordered pass.
    """
    bound = F.when(F.lit(False), F.lit(None).cast("double"))
    for metric, limit in limits.items():
        bound = bound.when(F.col("metric") == metric, F.lit(float(limit)))
    needed = hold // step + 1
    confirms = F.sequence(F.col("at"), F.col("at") + hold, F.lit(step).cast("bigint"))
    return (
        series.filter(F.col("value") > bound)
        .withColumn("point", F.explode(confirms))
        .groupBy("metric", "point")
        .agg(F.count("*").alias("breaches"), F.max(F.when(F.col("point") == F.col("at"), F.col("value"))).alias("value"))
        .filter(F.col("value").isNotNull())
        .select(
            "metric",
            F.col("point").alias("at"),
            "value",
            F.when(F.col("breaches") >= needed, "firing").otherwise("pending").alias("state"),
        )
    )


def _of_metric(values: dict[str, float], kind: str) -> Column:
    """The value of the row's metric."""
    out = F.when(F.lit(False), F.lit(None).cast(kind))
    for metric, value in values.items():
        out = out.when(F.col("metric") == metric, F.lit(value).cast(kind))
    return out


EPISODE = ["metric", "started", "last_at", "points", "peak"]


def alert_episodes(
    series: DataFrame,
    limits: dict[str, float] = ALERT_LIMITS,
    lifetimes: dict[str, int] = ALERT_LIFETIMES,
    hold: int = ALERT_HOLD_SECONDS,
    open_episodes: DataFrame | None = None,
) -> DataFrame:
    """Unbroken breaches of ``(metric, at, value)``: ``metric, started, last_at, points, peak, ended, fires_at``.

    A value stands until the next one of its metric, at most for the metric's lifetime; metrics may come at different
    times and intervals. A breach ends where a value within the limit comes or the last value runs out; it fires at
    ``started + hold`` if it still stands then. ``ended`` is null as long as the newest value of the metric is part
    of the breach. Episodes left open by an earlier call go on (``open_episodes``: ``metric, started, last_at, points, peak``).
    Metrics without a limit are left out. The series hold a point a minute or fewer, so a metric is one window.
    """
    points = series.select("metric", F.col("at").cast("long").alias("at"), F.col("value").cast("double").alias("value"))
    points = points.filter(F.col("metric").isin(list(limits)) & F.col("value").isNotNull())
    entries = points.select(
        "metric", "at", F.col("at").alias("started"), F.lit(1).cast("long").alias("points"), F.col("value").alias("peak"),
        (F.col("value") > _of_metric(limits, "double")).alias("breach"),
    )
    if open_episodes is not None:
        known = open_episodes.select("metric", F.col("last_at").alias("at"), "started", "points", "peak", F.lit(True).alias("breach"))
        entries = entries.unionByName(known)
    in_order = Window.partitionBy("metric").orderBy("at", F.desc("points"))
    lifetime = _of_metric(lifetimes, "long")
    goes_on = F.lag("breach").over(in_order) & (F.col("at") - F.lag("at").over(in_order) <= lifetime)
    entries = entries.withColumns({"next_at": F.lead("at").over(in_order), "new": (~F.coalesce(goes_on, F.lit(False))).cast("int")})
    entries = entries.filter("breach").withColumn("island", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    episodes = entries.groupBy("metric", "island").agg(
        F.min("started").alias("started"),
        F.max("at").alias("last_at"),
        F.sum("points").alias("points"),
        F.max("peak").alias("peak"),
        F.max_by("next_at", "at").alias("next_at"),
    )
    runs_out = F.col("last_at") + lifetime
    stands_until = F.coalesce(F.least("next_at", runs_out), runs_out)
    fires = F.col("started") + hold
    return episodes.select(
        *EPISODE,
        F.when(F.col("next_at").isNotNull(), stands_until).alias("ended"),
        F.when(stands_until > fires, fires).alias("fires_at"),
    )
