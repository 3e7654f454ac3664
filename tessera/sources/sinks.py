"""Where results go: partitioned Parquet, CSV reports, and image files for people to look at."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..operators import reports
from ..session import ship


def write_tiles(tiles: DataFrame, path: str, *by: str) -> None:
    """Tiles by slide (and first by other columns). A slide that is written again replaces its own partition only."""
    tiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "slide_id").parquet(path)


def write_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("slide_id").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report (a row a slide) as one CSV file with a header and N/A for null."""
    reports.as_text(report).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def tile_listing(tiles: DataFrame, folder: str, desired_size: int, desired_magnification: int) -> DataFrame:
    """tiles with tile_path and the columns of the tile listing."""
    name = names.tile_name(F.col("slide_id"), F.col("x"), F.col("y"), F.lit(desired_size), F.lit(desired_magnification))
    return tiles.withColumns({"tile_path": F.concat_ws("/", F.lit(folder), F.col("slide_id"), name), "desired_size": F.lit(desired_size), "desired_magnification": F.lit(desired_magnification)})


def png(image: np.ndarray) -> bytes:
    """An RGB image as PNG."""
    h, w, _ = image.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, w * 3)], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def png_rows(tiles: DataFrame) -> DataFrame:
    """(tile_path, content): tiles as PNG bytes, for any sink. Null tiles and those that aren't three-channel squares are left out."""
    ship(tiles.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p, png(np.frombuffer(raw, np.uint8).reshape(n, n, 3))) for p, n, raw in zip(*(b.column(c).to_pylist() for c in ("tile_path", "size", "tile")), strict=True) if raw is not None and len(raw) == n * n * 3]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["tile_path", "content"])

    return tiles.select("tile_path", "size", "tile").mapInArrow(run, "tile_path string, content binary")


def write_png(tiles: DataFrame, shared_folder: str) -> int:
    """Writes tiles as PNG files under a folder that every executor mounts; returns how many. Files are replaced whole, so a task may run twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import uuid

        for b in batches:
            for path, content in zip(b.column("tile_path").to_pylist(), b.column("content").to_pylist(), strict=True):
                at = os.path.join(shared_folder, path.lstrip("/"))
                os.makedirs(os.path.dirname(at), exist_ok=True)
                part = f"{at}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, at)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return png_rows(tiles).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
