"""Readers of slide pixels: thumbnails and regions.

A reader is registered by name and used on the executors; a region that can't be read gives a null tile and an error,
never an exception. Two come with the package: `synthetic`, deterministic tissue from the slide's id, and `ppm`, binary
P6 rasters. Readers for scanner formats need their own library and are registered by the user.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import schema
from ..operators import kernels
from ..session import ship


class SlideReader(Protocol):
    """What a reader offers. One that can read a smaller level may also have thumbnail(scale)."""

    def size(self) -> tuple[int, int]: ...

    def region(self, x: int, y: int, w: int, h: int) -> np.ndarray: ...


class Synthetic:
    """Pink tissue, an ellipse on a nearly white ground, with a blue pen stroke on every third slide; any region in any order."""

    def __init__(self, slide_id: str, width: int, height: int, content: bytes | None = None) -> None:
        self.width, self.height = width, height
        self.key = sum(ord(c) * (i + 1) for i, c in enumerate(slide_id))

    def size(self) -> tuple[int, int]:
        return self.width, self.height

    def region(self, x: int, y: int, w: int, h: int) -> np.ndarray:
        return self._at(*np.mgrid[y : y + h, x : x + w].astype(np.int64))

    def thumbnail(self, scale: int) -> np.ndarray:
        return self._at(*np.mgrid[0 : self.height // scale * scale : scale, 0 : self.width // scale * scale : scale].astype(np.int64))

    def _at(self, yy: np.ndarray, xx: np.ndarray) -> np.ndarray:
        noise = (xx * 7919 + yy * 104729 + self.key * 31) % 23
        inside = ((2 * xx - self.width) * 10 // max(self.width, 1)) ** 2 + ((2 * yy - self.height) * 10 // max(self.height, 1)) ** 2 < 49
        out = np.where(inside[..., None], np.stack([190 - noise * 3, 90 + noise, 160 - noise * 2], -1), np.stack([238 - noise % 5] * 3, -1))
        if self.key % 3 == 0:
            stroke = np.abs(yy * 4 - self.height) < max(2, self.height // 25)
            out = np.where(stroke[..., None], (40, 60, 200), out)
        off = (xx < 0) | (yy < 0) | (xx >= self.width) | (yy >= self.height)
        return np.where(off[..., None], 255, out).astype(np.uint8)


class Ppm:
    """A binary P6 raster with a byte a channel."""

    def __init__(self, slide_id: str, width: int | None, height: int | None, content: bytes) -> None:
        import re

        m = re.match(rb"P6(?:\s+#[^\n]*\n|\s)+(\d+)(?:\s+#[^\n]*\n|\s)+(\d+)(?:\s+#[^\n]*\n|\s)+255\s", content)
        if not m:
            raise ValueError("not a P6 raster with a byte a channel")
        self.width, self.height = int(m[1]), int(m[2])
        self.pixels = np.frombuffer(content, np.uint8, self.width * self.height * 3, m.end()).reshape(self.height, self.width, 3)

    def size(self) -> tuple[int, int]:
        return self.width, self.height

    def region(self, x: int, y: int, w: int, h: int) -> np.ndarray:
        out = np.full((h, w, 3), 255, np.uint8)
        part = self.pixels[max(y, 0) : y + h, max(x, 0) : x + w]
        out[max(-y, 0) : max(-y, 0) + part.shape[0], max(-x, 0) : max(-x, 0) + part.shape[1]] = part
        return out


_READERS: dict[str, type] = {"synthetic": Synthetic, "ppm": Ppm}


def register(name: str, reader: type) -> None:
    """reader(slide_id, width, height, content) with size() and region()."""
    _READERS[name] = reader


def in_blocks(tiles: DataFrame, slides: DataFrame, rows: int = 16) -> DataFrame:
    """A row for each slide and each `rows` rows of its tiles, with origins, and the slide's own columns (and content).

    A slide's bytes then travel once a block, not once a tile; a block holds at most rows x columns origins.
    """
    block = F.floor(F.col("y") / (F.col("size") * rows)).alias("block")
    own = tiles.groupBy("slide_id", "size", block).agg(F.sort_array(F.collect_list(F.struct("y", "x"))).alias("origins"))
    n = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a row a slide with its header looks small to the planner, which would send all of them through the driver
    return own.join(slides.drop("size").hint("merge"), "slide_id").repartition(n, "slide_id", "block").sortWithinPartitions("slide_id")


def read_regions(blocks: DataFrame, reader: str = "synthetic", side: int | None = None, resampler: str = "bilinear") -> DataFrame:
    """Tiles of blocks (slide_id, size, origins, width, height, content where the reader needs it, further columns), one a row.

    Out come the further columns, x, y, original_size, size, tile (bytes, at the given side) and error. What can't be read
    has a null tile and an error. A run of blocks of one slide opens it once.
    """
    kind = _READERS[reader]
    ship(blocks.sparkSession)
    names = [c for c in blocks.columns if c not in ("size", "origins", "tile", "error", "content", "width", "height", "block", "x", "y", "original_size")]
    has_content = "content" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str | None, object] = (None, None)
        for b in batches:
            cols = {c: b.column(c).to_pylist() for c in ("slide_id", "size", "width", "height")}
            for i in range(b.num_rows):
                one, n, rows, failed = cols["slide_id"][i], cols["size"][i], [], None
                if opened[0] != one:
                    try:
                        opened = (one, kind(one, cols["width"][i], cols["height"][i], b.column("content")[i].as_py() if has_content else None))
                    except Exception as e:  # a broken slide is a row of the error report
                        opened, failed = (None, None), f"{type(e).__name__}: {e}"[:500]
                for at in b.column("origins")[i].as_py():
                    image, error = None, failed
                    if failed is None:
                        try:
                            image = opened[1].region(at["x"], at["y"], n, n)
                            image = image if side is None else kernels.resized(image, side, resampler)
                        except Exception as e:
                            image, error = None, f"{type(e).__name__}: {e}"[:500]
                    rows.append((at["x"], at["y"], {"w": n, "h": n}, None if image is None else image.shape[0], None if image is None else image.tobytes(), error))
                    if len(rows) == 256:
                        yield batch(b, i, rows)
                        rows = []
                if rows:
                    yield batch(b, i, rows)

    def batch(b: pa.RecordBatch, i: int, rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.struct([("w", pa.int32()), ("h", pa.int32())]), pa.int32(), pa.binary(), pa.string())
        same = pa.array([i] * len(rows))
        return pa.RecordBatch.from_arrays([*(b.column(n).take(same) for n in names), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], [*names, "x", "y", "original_size", "size", "tile", "error"])

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields if f.name in names)
    return blocks.mapInArrow(run, f"{rest}, x int, y int, original_size struct<w:int,h:int>, size int, tile binary, error string")


def thumbnails(slides: DataFrame, reader: str = "synthetic") -> DataFrame:
    """PIXELS of slides (slide_id, width, height, scale, and content where needed): every scale-th pixel of each. Slides that can't be read have none; `unreadable` names them."""
    kind = _READERS[reader]
    ship(slides.sparkSession)
    has_content = "content" in slides.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {c: b.column(c).to_pylist() for c in ("slide_id", "width", "height", "scale")}
            for i in range(b.num_rows):
                s = cols["scale"][i]
                try:
                    slide = kind(cols["slide_id"][i], cols["width"][i], cols["height"][i], b.column("content")[i].as_py() if has_content else None)
                    w, h = slide.size()
                    step = max(1, (1 << 20) // max(1, w * s)) * s  # bands of about a million pixels
                    bands = [slide.thumbnail(s)] if hasattr(slide, "thumbnail") else [slide.region(0, y, w // s * s, min(step, h // s * s - y))[::s, ::s] for y in range(0, h // s * s, step)]
                except Exception:
                    continue
                y0 = 0
                for image in bands:
                    yy, xx = np.mgrid[y0 : y0 + image.shape[0], : image.shape[1]]
                    y0 += image.shape[0]
                    n = xx.size
                    yield pa.RecordBatch.from_arrays([pa.array([cols["slide_id"][i]] * n), pa.array(xx.ravel().astype(np.int32)), pa.array(yy.ravel().astype(np.int32)), *(pa.array(image[..., k].ravel().astype(np.int16)) for k in range(3))], ["slide_id", "x", "y", "r", "g", "b"])

    # a row is little data and much work, so rows are dealt out by number and not merged again
    return slides.repartition(slides.sparkSession.sparkContext.defaultParallelism, "slide_id").mapInArrow(run, schema.PIXELS)


def unreadable(slides: DataFrame, reader: str = "synthetic") -> DataFrame:
    """(slide_id, error) of the slides that the reader can't open, or whose corner it can't read."""
    kind = _READERS[reader]
    ship(slides.sparkSession)
    has_content = "content" in slides.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            failed = []
            for i, (one, w, h) in enumerate(zip(*(b.column(c).to_pylist() for c in ("slide_id", "width", "height")), strict=True)):
                try:
                    slide = kind(one, w, h, b.column("content")[i].as_py() if has_content else None)
                    slide.size()
                    slide.region(0, 0, 1, 1)
                except Exception as e:  # its row is the answer
                    failed.append((one, f"{type(e).__name__}: {e}"[:500]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in failed], pa.string()) for k in range(2)], ["slide_id", "error"])

    return slides.select("slide_id", "width", "height", *(["content"] if has_content else [])).mapInArrow(run, "slide_id string, error string")


class SyntheticSlides(DataSource):
    """spark.read.format("tessera_slides"): `slides` synthetic slides of `width` x `height`, for tests and benchmarks."""

    @classmethod
    def name(cls) -> str:
        return "tessera_slides"

    def schema(self) -> str:
        return "slide_id string, path string, vendor string, objective_power string, mpp_x string, mpp_y string, width int, height int, level_downsamples array<double>"

    def reader(self, schema) -> DataSourceReader:
        return _SyntheticReader(int(self.options.get("slides", 4)), int(self.options.get("width", 4096)), int(self.options.get("height", 3072)), int(self.options.get("partitions", 4)))


class _SyntheticReader(DataSourceReader):
    def __init__(self, slides: int, width: int, height: int, parts: int) -> None:
        self.slides, self.width, self.height, self.parts = slides, width, height, parts

    def partitions(self):
        return [InputPartition(k) for k in range(self.parts)]

    def read(self, partition):
        for i in range(partition.value, self.slides, self.parts):
            power, mpp = (("40", "0.25"), ("20", "0.5"), (None, "0.25"), ("40", None))[i % 4]
            yield (f"S{i:06d}", f"synthetic://S{i:06d}.svs", "synthetic", power, mpp, mpp, self.width + 32 * (i % 5), self.height, [1.0, 4.0, 16.0])


def register_source(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(SyntheticSlides)


def raster_slides(spark: SparkSession, folder: str) -> DataFrame:
    """(slide_id, path, content) of the raster files in a folder of any store that Spark reads, one row a file. Files over 2 GB don't fit a row and need a reader of their own."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.ppm").load(folder).select(F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1).alias("slide_id"), "path", "content")
