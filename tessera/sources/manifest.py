"""Slide listings, report files and configs as DataFrames with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import names


def manifest_of(paths: DataFrame, output_path: str = "", path_col: str = "path") -> DataFrame:
    """Manifest rows of the paths that are slides, one a path, as `Patient ID`, `Original Slide Path`, `Preprocessing Path`."""
    path = F.col(path_col)
    one = names.sample_id(path)
    return paths.where(names.is_slide(path)).select(one.alias("Patient ID"), path.alias("Original Slide Path"), F.concat_ws("/", F.lit(output_path), one).alias("Preprocessing Path")).distinct()


def list_slides(spark: SparkSession, path: str, output_path: str = "", recursive: bool = False) -> DataFrame:
    """Manifest of a folder or a single file in any store that Spark reads. Contents aren't read; nothing is moved."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path")
    return manifest_of(files, output_path)


def with_encoded_path(manifest: DataFrame, folder: str) -> DataFrame:
    return manifest.withColumn("Encoded Path", F.concat_ws("/", F.lit(folder), F.concat(F.col("Patient ID"), F.lit(".parquet"))))


def read_report(spark: SparkSession, path: str, kind: str = schema.SUMMARY) -> DataFrame:
    return spark.read.schema(kind).option("header", True).option("nullValue", "N/A").csv(path)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.TILE_STORE).parquet(path)


def read_features(spark: SparkSession, path: str, augmented: bool = False) -> DataFrame:
    return spark.read.schema(schema.AUGMENTED_FEATURES if augmented else schema.FEATURES).parquet(path)


def read_png_tiles(spark: SparkSession, listing: DataFrame, folder: str) -> DataFrame:
    """Tiles (slide_id, x, y, tile_path, size, tile) of a listing with tile_path, from image files. Spark gives bytes as BGR; they become RGB."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("binary")
    def turned(raw):
        import numpy as np

        return raw.map(lambda x: np.frombuffer(x, np.uint8).reshape(-1, 3)[:, ::-1].tobytes())

    images = spark.read.format("image").option("dropInvalid", True).load(folder).select("image.*").where("nChannels = 3")
    images = images.select(F.element_at(F.split("origin", "/"), -1).alias("__name"), F.col("height").alias("size"), turned("data").alias("tile"))
    rows = listing.withColumn("__name", F.element_at(F.split("tile_path", "/"), -1))
    return rows.join(images, "__name").drop("__name")
