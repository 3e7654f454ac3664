"""Kernels against plain loops, published constants and the same in DataFrame operations."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import resolution
from tessera.operators import kernels, stain


def masks(seed, h=9, w=11, share=0.4):
    return np.random.default_rng(seed).random((h, w)) < share


def flood(mask, diagonal):
    labels, n = np.zeros(mask.shape, int), 0
    steps = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (diagonal or not (dy and dx))]
    for y, x in zip(*np.nonzero(mask), strict=True):
        if labels[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        while todo:
            a, b = todo.pop()
            if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not labels[a, b]:
                labels[a, b] = n
                todo += [(a + dy, b + dx) for dy, dx in steps]
    return labels, n


@given(st.integers(0, 10**6), st.booleans(), st.sampled_from([0.2, 0.5, 0.7]))
@settings(max_examples=60, deadline=None)
def test_components(seed, diagonal, share):
    m = masks(seed, share=share)
    got, n = kernels.components(m, diagonal)
    want, k = flood(m, diagonal)
    assert n == k
    assert len(set(zip(got.ravel(), want.ravel(), strict=True))) == k + (not m.all())


@pytest.mark.parametrize("size", [1, 2, 3, 5, 6])
def test_dilate(size):
    m = masks(size, share=0.1)
    want = np.zeros_like(m)
    for y in range(m.shape[0]):
        for x in range(m.shape[1]):
            a, b = size // 2, size - size // 2
            want[y, x] = m[max(0, y - a) : y + b, max(0, x - a) : x + b].any()
    assert (kernels.dilate(m, size) == want).all()
    assert (kernels.dilate(m, size) >= m).all()


def test_otsu_parts_two_peaks():
    values = np.concatenate([np.full(50, 10.0), np.full(50, 200.0)])
    t = kernels.otsu(values)
    assert 10 <= t < 200 and kernels.otsu(np.full(5, 7.0)) == 7


def test_small_parts_and_holes():
    m = np.zeros((40, 40), bool)
    m[5:30, 5:30] = True
    m[35, 35] = True
    m[10, 10] = False
    assert not kernels.remove_small(m, size=1)[35, 35]
    assert kernels.remove_small(m, compat=True, size=1)[35, 35]
    assert kernels.fill_holes(m, 0.01)[10, 10] and not kernels.fill_holes(m, 0.0001)[10, 10]


def test_sharpness_variants():
    rng = np.random.default_rng(0)
    sharp, flat = rng.integers(0, 256, (16, 16, 3)).astype(np.uint8), np.full((16, 16, 3), 120, np.uint8)
    for v in ("laplacian", "sobel", "legacy"):
        assert kernels.sharpness(sharp, v) > 0.01
    assert kernels.sharpness(flat) == 0
    g = np.pad(kernels.gray(sharp), 1, mode="reflect")
    lap = [2 * (g[i - 1, j - 1] + g[i - 1, j + 1] + g[i + 1, j - 1] + g[i + 1, j + 1]) - 8 * g[i, j] for i in range(1, 17) for j in range(1, 17)]
    assert kernels.sharpness(sharp) == pytest.approx(np.var(lap))


def stained(seed=0, n=32):
    rng = np.random.default_rng(seed)
    od = kernels.STAINS @ rng.gamma(2.0, 0.4, (2, n * n))
    return np.clip(240 * np.exp(-od), 0, 255).T.reshape(n, n, 3).astype(np.uint8)


def test_macenko_nearly_keeps_reference_stains():
    tile = stained()
    out = kernels.macenko(tile)
    assert out.shape == tile.shape and out.dtype == np.uint8
    again = kernels.macenko(out)
    assert np.abs(again.astype(int) - out).mean() < 12
    assert kernels.macenko(np.full((8, 8, 3), 255, np.uint8)) is None
    assert kernels.macenko(np.full((8, 8, 3), 100, np.uint8), strict=True) is None


def test_resize():
    tile = stained(1, 16)
    assert (kernels.resized(tile, 16) == tile).all()
    area = kernels.resized(tile, 8, "area")
    means = tile.reshape(8, 2, 8, 2, 3).mean(axis=(1, 3))
    assert np.abs(area - means).max() <= 0.5 + 1e-9
    for how in ("bilinear", "area", "linear"):
        assert (kernels.resized(np.full((10, 10, 3), 77, np.uint8), 4, how) == 77).all()


def test_augment_is_seeded():
    tile = stained(2)
    assert (kernels.augmented(tile, 5) == kernels.augmented(tile, 5)).all()
    assert (kernels.augmented(tile, 5) != kernels.augmented(tile, 6)).any()


def test_reinhard_pixels_equal_tile(spark):
    tile = stained(3, 12)
    rows = [("s", i % 12, i // 12, *map(int, p)) for i, p in enumerate(tile.reshape(-1, 3))]
    df = spark.createDataFrame(rows, "slide_id string, x int, y int, r smallint, g smallint, b smallint")
    for masked in (True, False):
        got = {(r.x, r.y): (r.r, r.g, r.b) for r in stain.reinhard(df, "slide_id", masked).collect()}
        want = stain.reinhard_tile(tile, "masked" if masked else "all")
        assert max(abs(a - int(b)) for (x, y), p in got.items() for a, b in zip(p, want[y, x], strict=True)) <= 1


def test_covariance_equals_numpy(spark):
    tile = stained(4, 16)
    df = spark.createDataFrame([("s", *map(int, p)) for p in tile.reshape(-1, 3)], "slide_id string, r int, g int, b int")
    od = -np.log(np.maximum(tile.reshape(-1, 3), 1) / 240)
    want = np.cov(od[(od >= 0.15).all(axis=1)].T)
    got = stain.od_statistics(df, "slide_id").first()
    assert got.cov_rg == pytest.approx(want[0, 1]) and got.cov_bb == pytest.approx(want[2, 2])
    p = stain.od_percentiles(df, "slide_id").first()
    assert p.g_p99 == pytest.approx(np.percentile(od[:, 1], 99))


def test_resolution_ties_and_ends(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0.05, 0.1), (0.25, 0.25), (0.375, 0.5), (0.374, 0.25), (0.75, 1.0), (24.0, 32.0), (99.0, 32.0)], "m double, want double")
    assert all(r.got == r.want for r in df.select("want", resolution.closest_mpp(F.col("m")).alias("got")).collect())


@pytest.mark.parametrize("seed", range(5))
def test_component_numbers(seed):
    m = np.random.default_rng(seed).random((4, 9, 11)) < np.array([0.0, 0.3, 0.6, 1.0])[:, None, None]
    assert kernels.component_numbers(m).tolist() == [flood(x, True)[1] for x in m]


def test_masks_of_a_slide_at_once(spark, data):
    """Cleaned masks are made a slide at a time, without joins or windows over pixels; before cleaning they are those of DataFrame operations."""
    from tessera.operators import mask
    from tessera.plans import queries

    odd = spark.createDataFrame([("none", 0, 0, None, None, None), ("part", 0, 0, 200, 90, 180), ("part", 4, 1, None, 90, 180), ("part", 9, 1, 240, 240, 240)], "slide_id string, x int, y int, r smallint, g smallint, b smallint")
    p = queries.pixels(spark, data).unionByName(odd)
    want = sorted((*r[:3], bool(r[3])) for r in mask.tissue_mask(p, clean=False).collect())
    run = mask._whole(mask.MASKS[:6], mask.MASKS[1:6], mask._IGNORED, False, False, False)
    assert sorted(map(tuple, p.groupBy("slide_id").applyInArrow(run, "slide_id string, mx int, my int, tissue boolean").collect())) == want
    assert len({r[3] for r in want}) == 2
    plan = queries.tissue_mask_clean(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
