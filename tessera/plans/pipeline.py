"""The whole run as one plan: header, mask, grid, tissue, pixels, blur, stain, features, reports.

Cheap tests come first and pixels are read only for tiles that pass them. Tile bytes never go through a shuffle: they are
read, checked, normalised and encoded in one stage. What became of each tile is written once, so reports and histograms
read no pixels; features read them once more unless the tiles are written.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..functions import resolution
from ..operators import encode, grid, mask, reconstruct, reports, tiles, tissue
from ..sources import slides as reading


@dataclass
class Run:
    slides: DataFrame
    pixels: DataFrame
    mask: DataFrame
    grid: DataFrame
    tiles: DataFrame
    errors: DataFrame
    features: DataFrame | None = None
    outcomes: DataFrame | None = None  # all valid tiles: rejected ones have a null tile, unreadable ones an error


def plan(slides: DataFrame, config: RunConfig, reader: str = "synthetic", keep: Callable[[str, DataFrame], DataFrame] = lambda name, table: table) -> Run:
    """The plan over SLIDES (with content, for raster readers).

    keep(name, table) may write a table and give it back read: the masks and the rated grid are small beside the pixels and
    have several readers. By default the plan stays lazy.
    """
    headers = resolution.header(slides, config.compat, config.set_standard_magnification, config.set_standard_mpp)
    checked = resolution.checked(headers, config.desired_magnification)
    if config.sizing_scale == "mpp":
        size = resolution.size_by_mpp(F.col("mpp_x"), config.desired_size, config.desired_mpp)
    else:
        size = resolution.size_by_magnification(F.col("magnification"), config.desired_size, config.desired_magnification)
    last = F.element_at("level_downsamples", -1)
    good = checked.where("error IS NULL").withColumns({"size": size, "scale": mask.mask_scale(last, config.mask_scale)})
    names = config.masks + (("folds",) if config.remove_folds and "folds" not in config.masks else ())
    pixels = reading.thumbnails(good, reader)
    masks = keep("masks", mask.tissue_mask(pixels, names, config.red_pen_thresh, config.blue_pen_thresh, compat=config.compat))
    every = grid.tile_grid(good, config.overlap)
    cells = lambda c, n: F.floor(F.col(c) / F.col("scale")).cast("int").alias(n)
    rated = keep("grid", tissue.with_validity(every.select("slide_id", "x", "y", "size", "scale"), masks, config.tissue_threshold, size=good.select("slide_id", cells("width", "mw"), cells("height", "mh"))))
    broken = keep("unreadable", reading.unreadable(good, reader))
    errors = reports.error_rows(checked).unionByName(reports.step_errors(good, broken, "Slide Opening"))
    errors = errors.unionByName(reports.step_errors(good, reports.without_mask(good, masks, broken), "Tissue Mask"))
    # tiles travel as blocks of origins; pixels are made where they are used
    blocks = reading.in_blocks(rated.where("is_valid"), good.drop("path", "error", "step"))
    raw = reading.read_regions(blocks, reader, config.desired_size, config.resampler)
    steps = []
    if config.remove_blurry_tiles:
        steps.append(tiles.step("blur", threshold=config.blur_threshold))
    if config.normaliser:
        steps.append(tiles.step(config.normaliser))
    every_tile = tiles.apply(raw, steps, keep_rejected=True)
    kept = every_tile.where("tile IS NOT NULL").drop("error")
    features = None
    if config.encode:
        features = encode.encode_augmented(kept, config.augmentations, extractor=config.feature_extractor, batch_size=config.encode_batch) if config.augmentations else encode.encode(kept.select("slide_id", "x", "y", "size", "tile"), config.feature_extractor, config.encode_batch, high_quality=config.extract_high_quality)
    return Run(good, pixels, masks, rated, kept, errors, features, every_tile)


def summary(run: Run, kept: DataFrame | None = None, times: dict[str, float] | None = None, compat: bool = False) -> DataFrame:
    """SUMMARY rows, one a slide that was processed. times: seconds of a slide by column."""
    counts = tissue.tile_counts(run.grid)
    left = (run.tiles if kept is None else kept).groupBy("slide_id").agg(F.count("*").alias("kept"))
    out = run.slides.select("slide_id", "path").join(counts.hint("merge"), "slide_id", "left").join(left.hint("merge"), "slide_id", "left")  # a row a slide: nothing that grows with slides goes through the driver
    n = F.coalesce("kept", F.lit(0)).cast("int")
    times = times or {}
    names = [f"time_{part}_{kind}" for kind in ("cpu", "user") for part in ("masking", "obtaining_valid_coordinates", "patching_tiles")]
    # a slide of which nothing is left is an error, not a success
    rows = out.select(F.col("slide_id").alias("sample_id"), "path", F.coalesce("total_tiles", F.lit(0)).cast("int").alias("total_tiles"), F.coalesce("valid_tiles", F.lit(0)).cast("int").alias("tiles_passing_tissue_thresh"), n.alias("non_blurry_tiles"), *(F.lit(times.get(c)).cast("double").alias(c) for c in names), F.when(n > 0, "Processed").otherwise("Error").alias("status"))
    return reports.derived(rows, compat)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _replaced(table: DataFrame, path: str) -> DataFrame:
    """Writes a small table beside `path` and puts it in its place, so that it may be made from what stood there."""
    spark, new = table.sparkSession, f"{path}.new"
    table.write.mode("overwrite").parquet(new)
    of = spark._jvm.org.apache.hadoop.fs.Path
    fs = of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(of(path), True)
    fs.rename(of(new), of(path))
    return spark.read.schema(table.schema).parquet(path)


def execute(slides: DataFrame, config: RunConfig, reader: str | None = None, finished: DataFrame | None = None) -> dict[str, str]:
    """Runs the plan to folders of config.output_path, whose paths come back by name. Slides that are finished (slide_id) are skipped.

    masks, grid, outcomes (what became of each valid tile) and unreadable; tiles, features, reconstruction (a drawing of
    what was kept) and blur (histogram of variances) as the settings ask; summary, errors, and the manifest of the slides
    with at least min_tiles tiles left. Each run adds a part run=<number> to the first kind of tables, tiles and
    features go by slide, and summary, errors and manifest are merged with those of earlier runs: a slide that was
    processed keeps its row, one that failed gets its new one. Times are the run's seconds, shared equally over its slides.
    """
    from ..sources import sinks

    spark, clock = slides.sparkSession, time.time()
    out: dict[str, str] = {}
    took: dict[str, float] = {}
    number = 0
    while _exists(spark, f"{config.output_path}/grid/run={number}"):
        number += 1

    def lap(name: str) -> None:
        nonlocal clock
        took[name], clock = time.time() - clock, time.time()

    def keep(name: str, table: DataFrame) -> DataFrame:
        out[name] = f"{config.output_path}/{name}"
        table.write.mode("overwrite").parquet(f"{out[name]}/run={number}")
        lap(name)
        return spark.read.schema(table.schema).parquet(f"{out[name]}/run={number}")

    def merge(name: str, table: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        out[name] = f"{config.output_path}/{name}"
        return _replaced(how(spark.read.parquet(out[name]), table) if _exists(spark, out[name]) else table, out[name])

    todo = reports.unfinished(slides, finished, "slide_id") if finished is not None else slides
    run, kept = plan(todo, config, reader or config.reader, keep), None
    if config.output_format is not None:
        # kept and rejected tiles are written in one pass, apart
        listed = sinks.tile_listing(run.outcomes, "png", config.desired_size, int(config.desired_magnification)).withColumn("kept", F.col("tile").isNotNull())
        sinks.write_tiles(listed, f"{config.output_path}/tiles", "kept")
        out["tiles"] = f"{config.output_path}/tiles/kept=true"
        written = spark.read.schema(listed.schema).parquet(f"{config.output_path}/tiles").join(run.slides.select("slide_id"), "slide_id", "left_semi")
        lap("tiles")
        outcomes = keep("outcomes", written.select("slide_id", "x", "y", "size", "laplacian_var", "kept", "error"))
        kept = written.where("kept")
        if config.output_format == "png":
            sinks.write_png(kept, config.output_path)
    else:
        outcomes = keep("outcomes", run.outcomes.select("slide_id", "x", "y", "size", "laplacian_var", F.col("tile").isNotNull().alias("kept"), "error"))
    left = outcomes.where("kept")
    patched = took["outcomes"] + took.get("tiles", 0.0)
    if config.remove_blurry_tiles:
        keep("blur", tiles.variance_histogram(left, 0, 100 * config.blur_threshold, 100))
    if config.reconstruct_slide:
        drawn = reconstruct.marked(run.grid.select("slide_id", "x", "y", "size", "scale"), left)
        keep("reconstruction", reconstruct.reconstructed(mask.masked_pixels(run.pixels, run.mask), drawn))
    n = max(1, run.slides.count())
    seconds = {"time_masking_user": took["masks"] / n, "time_obtaining_valid_coordinates_user": took["grid"] / n, "time_patching_tiles_user": patched / n}
    report = summary(run, left, seconds, config.compat)
    if run.features is not None:
        out["features"] = f"{config.output_path}/features"
        clock = time.time()
        sinks.write_features(run.features, out["features"])
        lap("features")
        encoded = spark.read.schema(run.features.schema).parquet(out["features"]).join(run.slides.select("slide_id"), "slide_id", "left_semi").select(F.col("slide_id").alias("sample_id")).distinct()
        report = reports.with_encoding(report, encoded.withColumns({"encoding_cpu_time": F.lit(-1.0), "encoding_user_time": F.lit(took["features"] / n)}), config.compat)
    report = merge("summary", report, lambda old, new: reports.merged(old, new, config.compat))
    errors = run.errors.unionByName(reports.step_errors(run.slides, outcomes.select("slide_id", "error"), "Patching"))
    errors = merge("errors", errors, reports.errors_merged)
    sinks.write_report(report, f"{config.output_path}/SummaryReport")
    sinks.write_report(errors, f"{config.output_path}/ErrorReport")
    rows = todo.select(F.col("slide_id").alias("Patient ID"), F.col("path").alias("Original Slide Path"), F.concat_ws("/", F.lit(config.output_path), F.lit("tiles/kept=true"), F.concat(F.lit("slide_id="), F.col("slide_id"))).alias("Preprocessing Path"))
    rows = reports.passing(rows, report, config.min_tiles) if config.min_tiles else rows
    merge("manifest", rows, lambda old, new: old.unionByName(new).dropDuplicates(["Patient ID"]))
    out |= {"summary_csv": f"{config.output_path}/SummaryReport", "errors_csv": f"{config.output_path}/ErrorReport"}
    return out
