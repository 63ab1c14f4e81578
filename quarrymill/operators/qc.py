"""Quality checks of rendered items from their metrics: frame arrays to summary numbers, rules to reasons, status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import col
from quarrymill.sources.store import materialise

METRICS = ["video_bytes", "fps", "frame_count", "duration_s", "luma_mean", "luma_mean_std_over_time", "frame_luma_std_mean", "sample_diff_mean", "sample_diff_max", "laplacian_var_mean"]


@dataclass(frozen=True)
class QcRules:
    """Thresholds of the rules. The defaults, and the names of the reasons below, are fixed values."""

    width: int = 832
    height: int = 480
    num_frames: int = 81
    fps: float = 16.0
    frame_tolerance: int = 1
    fps_tolerance: float = 0.05
    duration_tolerance: float = 0.35
    min_bytes: int = 1024
    warn_min_bytes: int = 150_000
    hard_min_luma: float = 3.0
    hard_max_luma: float = 252.0
    warn_min_luma: float = 15.0
    warn_max_luma: float = 240.0
    hard_min_std: float = 2.0
    warn_min_std: float = 10.0
    low_motion_mean: float = 1.5
    low_motion_max: float = 4.0
    flicker_std: float = 35.0


def array_mean(values: Column | str) -> Column:
    """Null for null or empty arrays."""
    values = col(values)
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def array_stdev(values: Column | str) -> Column:
    """Population deviation; null under two values."""
    values = col(values)
    mean = array_mean(values)
    return F.when(F.size(values) >= 2, F.sqrt(F.aggregate(F.transform(values, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x) / F.size(values)))


def rounded(value: Column, digits: int = 4) -> Column:
    """NaN becomes null."""
    return F.when(~F.isnan(value), F.round(value, digits))


def consecutive_diffs(values: Column | str) -> Column:
    """Absolute differences of neighbours; empty under two values."""
    values = col(values)
    return F.zip_with(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.slice(values, 1, F.greatest(F.size(values) - 1, F.lit(0))), lambda b, a: F.abs(b - a))


def sample_positions(frames: Column | str, samples: int) -> Column:
    """Evenly spaced frame numbers, rounded half to even, without repeats; none without frames."""
    frames = col(frames)
    if samples <= 1:
        return F.when(frames > 0, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>"))
    spaced = F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: F.bround(i * (frames - 1) / (samples - 1)).cast("long"))
    return F.when(frames > 0, F.array_sort(F.array_distinct(spaced))).otherwise(F.array().cast("array<long>"))


def with_metrics(df: DataFrame) -> DataFrame:
    """df (luma_means, luma_stds, lap_vars, diffs: arrays; frame_count, fps) with the rounded summary numbers."""
    return df.withColumns({"luma_mean": rounded(array_mean("luma_means")), "luma_mean_std_over_time": rounded(array_stdev("luma_means")), "frame_luma_std_mean": rounded(array_mean("luma_stds")), "laplacian_var_mean": rounded(array_mean("lap_vars")), "sample_diff_mean": rounded(array_mean("diffs")), "sample_diff_max": rounded(F.array_max("diffs")), "duration_s": rounded(F.when(F.col("fps") > 0, F.col("frame_count") / F.col("fps"))), "decoded_sample_frames": F.size("luma_means")})


def with_status(df: DataFrame, rules: QcRules = QcRules(), samples: int = 9) -> DataFrame:
    """df with reject_reasons, warning_reasons (both sorted) and status.

    Early exits come as boolean columns where a source has them: decoder_missing, sidecar_error, video_missing and
    open_failed; each is then the only reason, but for the size rules before open_failed.
    """
    c, r = F.col, rules
    none = F.array().cast("array<string>")
    flag = lambda name: F.coalesce(c(name), F.lit(False)) if name in df.columns else F.lit(False)
    small = [F.when(c("video_bytes") < r.min_bytes, "video_too_small")]
    duration = F.when(c("fps") > 0, c("frame_count") / c("fps"))
    seen = F.least(F.lit(3), F.size(sample_positions("frame_count", samples)))
    rejects = small + [
        F.when((c("width") != r.width) | (c("height") != r.height), "dimension_mismatch"),
        F.when((c("fps") <= 0) | (F.abs(c("fps") - r.fps) > r.fps_tolerance), "fps_mismatch"),
        F.when((c("frame_count") <= 0) | (F.abs(c("frame_count") - r.num_frames) > r.frame_tolerance), "frame_count_mismatch"),
        F.when(duration.isNull() | (F.abs(duration - r.num_frames / r.fps) > r.duration_tolerance), "duration_mismatch"),
        F.when(c("decoded_sample_frames") < F.greatest(F.lit(1), seen), "too_few_decodable_frames"),
        F.when((c("luma_mean") < r.hard_min_luma) | (c("luma_mean") > r.hard_max_luma), "black_or_white_video"),
        F.when(c("frame_luma_std_mean") < r.hard_min_std, "blank_low_detail_video"),
    ]
    size_warning = F.when((c("video_bytes") >= r.min_bytes) & (c("video_bytes") < r.warn_min_bytes), "small_video_file")
    within = c("luma_mean").between(r.hard_min_luma, r.hard_max_luma)
    warnings = [
        size_warning,
        F.when(within & (c("luma_mean") < r.warn_min_luma), "very_dark_video"),
        F.when(within & (c("luma_mean") > r.warn_max_luma), "very_bright_video"),
        F.when((c("frame_luma_std_mean") >= r.hard_min_std) & (c("frame_luma_std_mean") < r.warn_min_std), "low_detail_video"),
        F.when((c("sample_diff_mean") < r.low_motion_mean) & (c("sample_diff_max") < r.low_motion_max), "low_motion_or_freeze"),
        F.when(c("luma_mean_std_over_time") > r.flicker_std, "high_global_flicker"),
    ]
    gathered = lambda whens: F.array_sort(F.array_compact(F.array(*whens)))
    only = lambda name: F.array(F.lit(name))
    reject = F.when(flag("decoder_missing"), only("missing_video_decode_dependency")).when(flag("sidecar_error"), only("sidecar_json_error")).when(flag("video_missing"), only("missing_video")).when(flag("open_failed"), F.array_sort(F.array_compact(F.array(*small, F.lit("open_failed"))))).otherwise(gathered(rejects))
    early = flag("decoder_missing") | flag("sidecar_error") | flag("video_missing")
    warn = F.when(early, none).when(flag("open_failed"), gathered([size_warning])).otherwise(gathered(warnings))
    out = df.withColumns({"reject_reasons": reject, "warning_reasons": warn})
    return out.withColumn("status", F.when(F.size("reject_reasons") > 0, "reject").when(F.size("warning_reasons") > 0, "review").otherwise("pass"))


def reason_counts(df: DataFrame) -> DataFrame:
    """kind (status, reject or warning), value and count."""
    pairs = F.concat(F.array(F.struct(F.lit("status").alias("kind"), F.col("status").alias("value"))), F.transform("reject_reasons", lambda x: F.struct(F.lit("reject").alias("kind"), x.alias("value"))), F.transform("warning_reasons", lambda x: F.struct(F.lit("warning").alias("kind"), x.alias("value"))))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.kind", "p.value").agg(F.count("*").alias("n"))


def metric_summary(df: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, min, mean, median (the upper one) and max, each rounded to four places; metrics without values are left out.

    The upper median of n values is the one of rank n div 2 + 1. Values are counted, so equal ones are one row; the
    different values of all metrics are numbered by ranges (`sampling.numbered`), whose bounds follow their distribution,
    so that no metric's values meet in one task, however close they lie.
    """
    long = df.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))).alias("m")).select("m.metric", "m.value").where("value IS NOT NULL")
    counts = materialise(long.groupBy("metric", "value").agg(F.count("*").alias("c")), "metric-counts")
    base = counts.groupBy("metric").agg(F.round(F.min("value"), 4).alias("min"), F.round(F.sum(F.col("value") * F.col("c")) / F.sum("c"), 4).alias("mean"), F.round(F.max("value"), 4).alias("max"), F.sum("c").alias("n"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(counts.repartitionByRange(ranges, "metric", "value").withColumn("part", F.spark_partition_id()), "metric-ranges")
    sums = placed.groupBy("metric", "part").agg(F.sum("c").alias("c"))
    sums = sums.withColumn("upto", F.sum("c").over(Window.partitionBy("metric").orderBy("part")))
    nth = F.floor(F.col("n") / 2) + 1
    middle = sums.join(base.select("metric", "n"), "metric").where((F.col("upto") - F.col("c") < nth) & (F.col("upto") >= nth)).select("metric", "part", (nth - F.col("upto") + F.col("c")).alias("nth"))
    fine = placed.join(F.broadcast(middle), ["metric", "part"])  # a row per metric
    fine = fine.withColumn("upto", F.sum("c").over(Window.partitionBy("metric").orderBy("value")))
    median = fine.where((F.col("upto") - F.col("c") < F.col("nth")) & (F.col("upto") >= F.col("nth"))).select("metric", F.round("value", 4).alias("median"))
    return base.join(median, "metric").select("metric", "min", "mean", "median", "max")
