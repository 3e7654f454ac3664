"""Summary and error reports: joins and unions over small tables of a row a slide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MISSING = -1.0  # "not reached" in times


def derived(summary: DataFrame, compat: bool = False) -> DataFrame:
    """summary with the two shares and two totals. compat: counts of -1 give a share of 100, and the user total takes the coordinates' cpu time."""
    share = F.try_divide("tiles_passing_tissue_thresh", "total_tiles") * 100
    if not compat:
        share = F.when(F.col("total_tiles") >= 0, share)
    times = lambda kind, middle: F.col(f"time_patching_tiles_{kind}") + F.col(f"time_masking_{kind}") + F.col(f"time_obtaining_valid_coordinates_{middle}")
    return summary.withColumns(
        {
            "%_tissue": share,
            "%_tiles_passing_QC": F.try_divide("non_blurry_tiles", "tiles_passing_tissue_thresh") * 100,
            "total_time_cpu": times("cpu", "cpu"),
            "total_time_user": times("user", "cpu" if compat else "user"),
        }
    )


def merged(old: DataFrame, new: DataFrame, compat: bool = False, key: str = "sample_id") -> DataFrame:
    """old rows and those of new whose sample isn't Processed already. A sample that failed before is replaced by its new row (compat: both stay)."""
    done = old.where("status = 'Processed'").select(key).distinct()
    fresh = new.join(done, key, "left_anti")
    kept = old if compat else old.join(fresh.select(key).distinct().withColumn("__again", F.lit(True)), key, "left").where("status = 'Processed' OR __again IS NULL").drop("__again")
    return kept.unionByName(fresh, allowMissingColumns=True)


def with_encoding(summary: DataFrame, encoding: DataFrame, compat: bool = False, key: str = "sample_id") -> DataFrame:
    """summary with encoding_cpu_time and encoding_user_time; -1 and absent leave what was there (compat: absent overwrites)."""
    columns = ("encoding_cpu_time", "encoding_user_time")
    new = encoding.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    out = summary.join(new, key, "left")
    for c in columns:
        if c not in summary.columns:
            out = out.withColumn(c, F.col(f"__{c}"))
        elif compat:
            out = out.withColumn(c, F.when(F.col(f"__{c}") == _MISSING, F.col(c)).otherwise(F.col(f"__{c}")))
        else:
            out = out.withColumn(c, F.coalesce(F.when(F.col(f"__{c}") != _MISSING, F.col(f"__{c}")), F.col(c)))
    return out.drop(*(f"__{c}" for c in columns))


def errors_merged(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).dropDuplicates()


def passing(manifest: DataFrame, summary: DataFrame, min_tiles: int, metric: str = "non_blurry_tiles", key: str = "sample_id", manifest_key: str = "Patient ID") -> DataFrame:
    """manifest without the slides whose metric is under min_tiles; an unknown metric never fails."""
    failing = summary.where(F.col(f"`{metric}`") < min_tiles).select(F.col(f"`{key}`").alias("__k")).distinct()
    return manifest.join(failing, manifest[f"`{manifest_key}`"] == F.col("__k"), "left_anti")


def unfinished(manifest: DataFrame, finished: DataFrame, key: str) -> DataFrame:
    """What is left to do: manifest without finished keys."""
    return manifest.join(finished.select(key).distinct(), key, "left_anti")


def error_rows(checked: DataFrame) -> DataFrame:
    """Rows of the error report from slides with error and step."""
    return checked.where("error IS NOT NULL").select(F.col("slide_id").alias("Sample ID"), F.col("path").alias("Path"), F.col("error").alias("Error"), F.col("step").alias("Step in Pipeline"))


def step_errors(slides: DataFrame, failed: DataFrame, step: str) -> DataFrame:
    """Rows of the error report for failed (slide_id, error) of slides (slide_id, path) in one step; of several errors of a slide the first in order."""
    one = failed.where("error IS NOT NULL").groupBy("slide_id").agg(F.min("error").alias("error"))
    return slides.select("slide_id", "path").join(one, "slide_id").select(F.col("slide_id").alias("Sample ID"), F.col("path").alias("Path"), F.col("error").alias("Error"), F.lit(step).alias("Step in Pipeline"))


def without_mask(slides: DataFrame, masks: DataFrame, opened_not: DataFrame) -> DataFrame:
    """(slide_id, error) of slides that could be opened but have no mask."""
    return slides.select("slide_id").join(masks.select("slide_id").distinct(), "slide_id", "left_anti").join(opened_not.select("slide_id"), "slide_id", "left_anti").withColumn("error", F.lit("no tissue mask"))


def as_text(report: DataFrame) -> DataFrame:
    """report with every column as text and N/A for null, for CSV."""
    return report.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("N/A")).alias(c) for c in report.columns))
