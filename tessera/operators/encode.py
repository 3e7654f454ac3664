"""Feature extraction: tiles to vectors in batches, by encoders registered by name.

No weights are fetched. Encoders that need a framework or a model file are registered by the user; two come with the
package: `moments`, deterministic statistics of colour and texture, and `empty`, zeros of a given length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import kernels
from .tiles import _image, augmented

# Channel means and deviations that image networks expect.
MEAN, STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
#: name -> function without arguments that loads an encoder: (batch of images float32 n x 3 x 224 x 224) -> n x d.
_ENCODERS: dict[str, Callable[[], Callable[[np.ndarray], np.ndarray]]] = {}
_LOADED: dict = {}


def register(name: str, load: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> None:
    _ENCODERS[name] = load


def network_input(tile: np.ndarray, side: int = 224) -> np.ndarray:
    return np.moveaxis((kernels.resized(tile, side) / 255.0 - MEAN) / STD, 2, 0).astype(np.float32)


def _moments() -> Callable[[np.ndarray], np.ndarray]:
    def run(batch: np.ndarray) -> np.ndarray:
        n = len(batch)
        cells = batch.reshape(n, 3, 4, batch.shape[2] // 4, 4, batch.shape[3] // 4)
        grad = [np.abs(np.diff(batch, axis=k)).mean(axis=(2, 3)) for k in (2, 3)]
        return np.concatenate([cells.mean(axis=(3, 5)).reshape(n, -1), cells.std(axis=(3, 5)).reshape(n, -1), *grad], axis=1)

    return run


register("moments", _moments)
register("empty", lambda: lambda batch: np.zeros((len(batch), 2048), np.float32))


def encode(tiles: DataFrame, extractor: str = "moments", batch_size: int = 16, side: int = 224, high_quality: bool = False) -> DataFrame:
    """tiles without their pixels, with features array<float>. A null tile has null features.

    high_quality: also features_high, the layer before the last, of encoders that give a pair (features, layer before); null of others.
    """
    if extractor not in _ENCODERS:
        raise ValueError(f"no such encoder: {extractor}; registered are {', '.join(sorted(_ENCODERS))}")
    load = _ENCODERS[extractor]
    ship(tiles.sparkSession)
    names = [c for c in tiles.columns if c not in ("tile", "size")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _LOADED.setdefault(extractor, load())
        for b in batches:
            raws, sizes, out, high = b.column("tile").to_pylist(), b.column("size").to_pylist(), [None] * b.num_rows, [None] * b.num_rows
            some = [i for i, raw in enumerate(raws) if raw is not None]
            for a in range(0, len(some), batch_size):
                own = some[a : a + batch_size]
                got = model(np.stack([network_input(_image(raws[i], sizes[i]), side) for i in own]))
                for vectors, into in zip(got if isinstance(got, tuple) else (got,), (out, high), strict=False):
                    for i, v in zip(own, vectors, strict=True):
                        into[i] = np.asarray(v, np.float32).ravel().tolist()
            lists = [pa.array(x, pa.list_(pa.float32())) for x in ((out, high) if high_quality else (out,))]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), *lists], [*names, "features", "features_high"][: len(names) + len(lists)])

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields if f.name in names)
    return tiles.select(*names, "size", "tile").mapInArrow(run, f"{rest}, features array<float>" + (", features_high array<float>" if high_quality else ""))


def encode_augmented(tiles: DataFrame, copies: int, **how) -> DataFrame:
    """(slide_id, x, y, features array<array<float>>): the tile's own features, then those of each copy."""
    each = encode(augmented(tiles.select("slide_id", "x", "y", "size", "tile"), copies), **how)
    rows = each.groupBy("slide_id", "x", "y").agg(F.array_sort(F.collect_list(F.struct("copy", "features"))).alias("f"))
    return rows.select("slide_id", "x", "y", F.transform("f", lambda s: s["features"]).alias("features"))
