"""Edge cases of the engine's operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import schema
from tessera.config import RunConfig, write_template
from tessera.functions import names, resolution
from tessera.operators import encode, grid, mask, reconstruct, reports, tiles, tissue
from tessera.plans import pipeline
from tessera.sources import annotations, manifest, sinks, slides
from tessera.streaming import slides as streaming


def test_config(tmp_path):
    write_template(str(tmp_path / "c.yml"))
    assert RunConfig.from_yaml(str(tmp_path / "c.yml")) == RunConfig()
    got = RunConfig.from_args(["--config", str(tmp_path / "c.yml"), "-s", "128", "--output_format", "none", "--masks", "otsu,folds", "-e"])
    assert (got.desired_size, got.output_format, got.masks, got.encode) == (128, None, ("otsu", "folds"), True)
    assert RunConfig(augmentations=3, batch_size=18).encode_batch == 5
    for wrong in ({"overlap": 0}, {"normaliser": "x"}, {"sizing_scale": "mpp"}, {"output_format": "tiff"}):
        with pytest.raises(ValueError):
            RunConfig(**wrong)
    (tmp_path / "bad.yml").write_text("nonsense: 1\n")
    with pytest.raises(ValueError):
        RunConfig.from_yaml(str(tmp_path / "bad.yml"))


@pytest.mark.parametrize("w,h,size,overlap", [(100, 50, 256, 1), (512, 256, 256, 1), (513, 256, 256, 2), (300, 300, 100, 4), (0, 10, 5, 1)])
def test_grid_is_arange(spark, w, h, size, overlap):
    df = spark.createDataFrame([(w, h, size)], "width int, height int, size int")
    stride = size // overlap if overlap > 1 else size
    want = {(x, y) for y in np.arange(0, h - size + stride, stride) for x in np.arange(0, w - size + stride, stride)}
    rows = grid.tile_grid(df, overlap).collect()
    assert len(rows) == len(want) and {(r.x, r.y) for r in rows} == want


def test_tissue_ways_agree_and_clip(spark):
    rng = np.random.default_rng(1)
    m = rng.random((7, 9)) < 0.5
    cells = spark.createDataFrame([("s", x, y, bool(m[y, x])) for y in range(7) for x in range(9)], schema.MASK)
    t = spark.createDataFrame([("s", x, y, n, 4) for x in range(0, 44, 4) for y in range(0, 36, 4) for n in (3, 8, 16)], "slide_id string, x int, y int, size int, scale int").dropDuplicates(["slide_id", "x", "y"])
    a = {(r.x, r.y): (r.n_cells, r.n_tissue, r.is_valid, r.size) for r in tissue.with_validity(t, cells, 0.5, areas=False).collect()}
    b = {(r.x, r.y): (r.n_cells, r.n_tissue, r.is_valid, r.size) for r in tissue.with_validity(t, cells, 0.5).collect()}
    assert a == b
    for (x, y), (n, k, ok, size) in a.items():
        part = m[y // 4 : y // 4 + size // 4, x // 4 : x // 4 + size // 4]
        assert (n, k) == (part.size, part.sum()) and ok == bool(part.size and part.mean() >= 0.5)


def test_no_mask_means_no_valid_tile(spark):
    t = spark.createDataFrame([("s", 0, 0, 8, 4)], "slide_id string, x int, y int, size int, scale int")
    none = spark.createDataFrame([], schema.MASK)
    for areas in (True, False):
        assert not tissue.with_validity(t, none, 0.0, areas).first().is_valid


def test_constant_thumbnail(spark):
    p = spark.createDataFrame([("s", x, y, 240, 240, 240) for x in range(4) for y in range(4)], "slide_id string, x int, y int, r int, g int, b int")
    assert not any(r.tissue for r in mask.tissue_mask(p, mask.MASKS).collect())


def test_dilation_and_masks_equal_kernels(spark, data):
    from tessera.operators import kernels
    from tessera.plans import queries

    p = queries.pixels(spark, data)
    got = mask.otsu_mask(p).toPandas()
    for _, one in list(got.groupby("slide_id"))[:3]:
        image = lambda c, one=one: one.pivot(index="y", columns="x", values=c).to_numpy().astype(int)
        r, g, b = image("r"), image("g"), image("b")
        heat = np.minimum(np.maximum(r - g, 0), np.maximum(b - g, 0))
        assert (kernels.dilate(heat > kernels.otsu(heat), 3) == image("otsu").astype(bool)).all()


def test_names(spark):
    df = spark.createDataFrame([("/a/b.c.svs", "TCGA-A-B-11A"), ("x.SVS", "TCGA-A-B-01"), ("d/y.tif", "none")], "p string, b string")
    got = df.select(names.sample_id(F.col("p")), names.is_slide(F.col("p")), names.is_tumour(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("b", True, 0), ("x", False, 1), ("y", True, None)]


def test_header_compat(spark):
    row = [("s", "p", None, None, None, None, 10, 10, [1.0])]
    df = spark.createDataFrame(row, schema.SLIDES)
    plain = resolution.checked(resolution.header(df), 20).first()
    assert plain.step == "Property Check"
    assert resolution.checked(resolution.header(df, standard_magnification=40), 20).first().error is None
    old = resolution.checked(resolution.header(df, compat=True, standard_magnification=40), 20).first()
    assert old.magnification == 0 and old.error


def test_reports(spark):
    old = spark.createDataFrame([("a", "Processed", 1), ("b", "Error", 2)], "sample_id string, status string, v int")
    new = spark.createDataFrame([("a", "Processed", 3), ("b", "Processed", 4), ("c", "Error", 5)], "sample_id string, status string, v int")
    once = reports.merged(old, new)
    assert sorted((r.sample_id, r.v) for r in once.collect()) == [("a", 1), ("b", 4), ("c", 5)]
    assert sorted(map(tuple, reports.merged(once, new).collect())) == sorted(map(tuple, once.collect()))
    assert reports.merged(old, new, compat=True).count() == 4
    e = spark.createDataFrame([("a", -1.0, -1.0), ("b", 2.0, 3.0)], "sample_id string, encoding_cpu_time double, encoding_user_time double")
    first = reports.with_encoding(old, e)
    assert {r.sample_id: r.encoding_cpu_time for r in first.collect()} == {"a": -1.0, "b": 2.0}
    later = spark.createDataFrame([("b", -1.0, 9.0)], e.schema)
    assert {r.sample_id: (r.encoding_cpu_time, r.encoding_user_time) for r in reports.with_encoding(first, later).collect()}["b"] == (2.0, 9.0)
    m = spark.createDataFrame([("a",), ("b",), (None,)], "`Patient ID` string")
    s = spark.createDataFrame([("a", None), ("b", 3)], "sample_id string, non_blurry_tiles int")
    assert {r[0] for r in reports.passing(m, s, 5).collect()} == {"a", None}


def test_reconstruct_equals_loop(spark):
    rng = np.random.default_rng(2)
    image = rng.integers(1, 250, (24, 30, 3))
    p = spark.createDataFrame([("s", x, y, *map(int, image[y, x])) for y in range(24) for x in range(30)], schema.PIXELS)
    every = [(x, y) for y in range(0, 96, 32) for x in range(0, 120, 32)]
    inside = set(every[::3])
    t = spark.createDataFrame([("s", x, y, 32, 4, (x, y) in inside) for x, y in every], "slide_id string, x int, y int, size int, scale int, is_included boolean")
    want = image.copy()
    for x, y in every:
        if (x, y) not in inside:
            want[y // 4 : y // 4 + 8, x // 4 : x // 4 + 8] = 0
    for x, y in inside:
        for yy in range(y // 4 - 1, y // 4 + 8):
            for xx in range(x // 4 - 1, x // 4 + 8):
                edge = xx < x // 4 or yy < y // 4 or xx == x // 4 + 7 or yy == y // 4 + 7
                if edge and not (xx < x // 4 and yy < y // 4) and 0 <= xx < 30 and 0 <= yy < 24:
                    want[yy, xx] = 255
    got = {(r.x, r.y): (r.r, r.g, r.b) for r in reconstruct.reconstructed(p, t).collect()}
    assert all(got[x, y] == tuple(want[y, x]) for y in range(24) for x in range(30))


def test_ppm_png_and_broken_slides(spark, tmp_path):
    rng = np.random.default_rng(3)
    image = rng.integers(0, 256, (20, 24, 3)).astype(np.uint8)
    (tmp_path / "a.ppm").write_bytes(b"P6\n24 20\n255\n" + image.tobytes())
    (tmp_path / "b.ppm").write_bytes(b"P6 broken")
    s = slides.raster_slides(spark, str(tmp_path)).withColumns({"width": F.lit(24), "height": F.lit(20)})
    t = spark.createDataFrame([(n, 16, 8, 12) for n in "ab"], "slide_id string, x int, y int, size int")
    got = {r.slide_id: r for r in slides.read_regions(slides.in_blocks(t, s), "ppm").collect()}
    assert (got["a"].x, got["a"].y, got["a"].original_size.w) == (16, 8, 12)
    tile = np.frombuffer(got["a"].tile, np.uint8).reshape(12, 12, 3)
    assert (tile[:, :8] == image[8:20, 16:24]).all() and (tile[:, 8:] == 255).all()
    assert got["b"].tile is None and "raster" in got["b"].error
    rows = spark.createDataFrame([("s", 0, 0, "t.png", 20, bytearray(np.ascontiguousarray(image[:, :20]).tobytes())), ("s", 1, 0, "n.png", 20, None)], "slide_id string, x int, y int, tile_path string, size int, tile binary")
    assert sinks.write_png(rows, str(tmp_path / "png")) == 1
    listing = rows.select("slide_id", "x", "y", "tile_path")
    back = manifest.read_png_tiles(spark, listing, str(tmp_path / "png")).collect()
    assert len(back) == 1 and bytes(back[0].tile) == np.ascontiguousarray(image[:, :20]).tobytes()


def test_annotations(spark, tmp_path):
    (tmp_path / "s1.geojson").write_text('{"features":[{"geometry":{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10]]]},"properties":{"classification":{"name":"Tumor"}}}]}')
    (tmp_path / "s1.xml").write_text('<A><Annotation Name="n" PartOfGroup="Tumor"><Coordinates><Coordinate Order="0" X="1.5" Y="2" /><Coordinate Order="1" X="3" Y="4" /></Coordinates></Annotation></A>')
    g = annotations.geojson_polygons(spark, str(tmp_path / "s1.geojson"))
    assert g.first().label == "Tumor" and len(g.first().polygon) == 4
    assert [(p.x, p.y) for p in annotations.xml_polygons(spark, str(tmp_path / "s1.xml")).first().polygon] == [(1.5, 2.0), (3.0, 4.0)]
    t = spark.createDataFrame([("s1", 4, 4, 2), ("s1", 9, 9, 4)], "slide_id string, x int, y int, size int")
    inside = annotations.inside(t, g.select(F.lit("s1").alias("slide_id"), "label", "polygon")).collect()
    assert [(r.x, r.label) for r in inside] == [(4, "Tumor")]


def test_steps_and_encoders(spark):
    rng = np.random.default_rng(4)
    rows = [("s", i, 0, 8, bytearray(rng.integers(0, 256, (8, 8, 3)).astype(np.uint8).tobytes())) for i in range(3)] + [("s", 9, 0, 8, bytearray(bytes([200]) * 192)), ("s", 10, 0, 8, None)]
    t = spark.createDataFrame(rows, "slide_id string, x int, y int, size int, tile binary")
    out = tiles.apply(t, [tiles.step("blur", threshold=0.001), tiles.step("resize", side=4)])
    assert sorted(r.x for r in out.collect()) == [0, 1, 2] and {r.size for r in out.collect()} == {4}
    assert tiles.apply(t, [tiles.step("blur")], keep_rejected=True).count() == 5
    f = {r.x: r.features for r in encode.encode(t, side=16).collect()}
    assert f[10] is None and len({len(v) for v in f.values() if v}) == 1
    a = encode.encode_augmented(t.where("x < 2"), 2, side=16).collect()
    assert all(len(r.features) == 3 for r in a) and a[0].features[0] == pytest.approx(f[a[0].x])
    assert len(encode.encode(t.limit(1), "empty").first().features) == 2048
    encode.register("pair", lambda: lambda batch: (batch.mean(axis=(2, 3)), batch[:, :, 0, 0]))
    pair = encode.encode(t, "pair", side=16, high_quality=True).where("x = 0").first()
    assert len(pair.features) == len(pair.features_high) == 3
    with pytest.raises(ValueError):
        encode.encode(t, "nothing")
    with pytest.raises(ValueError):
        tiles.step("stainnet")
    q = tiles.qc_samples(t.select("slide_id", "x", "y").withColumn("is_blurry", F.lit(False)), 2)
    assert q.count() == 2


def test_pipeline_end_to_end(spark, tmp_path):
    slides.register_source(spark)
    s = spark.read.format("tessera_slides").option("slides", 4).option("width", 640).option("height", 480).load()
    config = RunConfig(output_path=str(tmp_path), desired_size=64, desired_magnification=20, tissue_threshold=0.5, remove_blurry_tiles=True, blur_threshold=1e-4, encode=True, reconstruct_slide=True, min_tiles=1)
    out = pipeline.execute(s, config)
    report = manifest.read_report(spark, out["summary_csv"]).collect()
    kept = spark.read.parquet(out["tiles"]).groupBy("slide_id").count().collect()
    assert {r.sample_id: r.non_blurry_tiles for r in report if r.non_blurry_tiles} == {r.slide_id: r["count"] for r in kept}
    assert manifest.read_features(spark, out["features"]).count() == sum(r["count"] for r in kept)
    assert spark.read.parquet(out["blur"]).agg({"n": "sum"}).first()[0] == sum(r["count"] for r in kept)
    assert {r[0] for r in spark.read.parquet(out["manifest"]).select("Patient ID").collect()} >= {r.slide_id for r in kept}
    assert spark.read.parquet(out["reconstruction"]).where("r = 255 and g = 255").count() > 0
    rest = reports.unfinished(s, spark.read.parquet(out["tiles"]).select("slide_id"), "slide_id")
    assert rest.count() == 4 - len(kept)
    again = pipeline.execute(s, RunConfig(output_path=str(tmp_path / "b"), output_format=None, encode=True, desired_size=64), finished=spark.read.parquet(out["tiles"]).select("slide_id"))
    assert spark.read.parquet(again["manifest"]).count() == rest.count() and "tiles" not in again


def test_resumed_run_keeps_what_was_reported(spark, tmp_path):
    """Rows of earlier runs stay; a broken slide and one without a mask have error rows; times are a slide's share."""
    image = slides.Synthetic("q", 256, 192).region(0, 0, 256, 192)
    good = b"P6\n256 192\n255\n" + image.tobytes()
    row = lambda i, content: (i, f"{i}.ppm", None, "20", "0.5", None, 256, 192, [1.0, 16.0], content)
    table = spark.createDataFrame([row("a", good), row("b", good), row("broken", good[:300]), row("c", good)], schema.SLIDES + ", content binary")
    config = RunConfig(output_path=str(tmp_path), desired_size=32, desired_magnification=20, tissue_threshold=0.5, output_format=None, encode=True, reader="ppm")
    first = pipeline.execute(table.where("slide_id IN ('a', 'broken')"), config)
    assert [tuple(r) for r in spark.read.parquet(first["errors"]).select("Sample ID", "Step in Pipeline").collect()] == [("broken", "Slide Opening")]
    before = {r.sample_id: r for r in spark.read.parquet(first["summary"]).collect()}
    assert before["a"].status == "Processed" and before["broken"].status == "Error" and before["a"].encoding_user_time > 0
    pipeline.execute(table, config, finished=spark.createDataFrame([("a",)], "slide_id string"))
    after = {r.sample_id: r for r in spark.read.parquet(first["summary"]).collect()}
    assert set(after) == {"a", "b", "c", "broken"} and after["a"] == before["a"] and after["c"].status == "Processed"
    assert spark.read.parquet(first["errors"]).count() == 1
    assert {r.slide_id for r in spark.read.parquet(first["grid"]).select("slide_id").distinct().collect()} >= {"a", "b", "c"}
    assert {r[0] for r in spark.read.parquet(first["manifest"]).select("Patient ID").collect()} == {"a", "b", "c", "broken"}


def test_command_line_over_rasters(spark, tmp_path):
    from tessera.__main__ import main

    image = slides.Synthetic("q", 512, 384).region(0, 0, 512, 384)
    (tmp_path / "q.ppm").write_bytes(b"P6\n512 384\n255\n" + image.tobytes())
    spark.createDataFrame([("q", "q.ppm", None, "20", "0.5", None, 512, 384, [1.0, 16.0])], schema.SLIDES).write.parquet(str(tmp_path / "slides.parquet"))
    out = main(["--input_path", str(tmp_path), "--output_path", str(tmp_path / "out"), "--reader", "ppm", "-s", "64", "-th", "0.5", "--output_format", "png", "-n", "macenko"], spark)
    tiles_ = spark.read.parquet(out["tiles"]).collect()
    assert tiles_ and all((tmp_path / "out" / t.tile_path).read_bytes()[:4] == b"\x89PNG" for t in tiles_)


def test_stream_meets_each_slide_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    met = []

    def each(batch, number):
        met.extend(r.slide_id for r in batch.collect())

    for name in ("a.svs", "b.txt", "c.tif"):
        (tmp_path / "in" / name).write_bytes(b"x")
    run = lambda: streaming.run_new(streaming.slide_stream(spark, str(tmp_path / "in")), each, str(tmp_path / "check"))
    run()
    assert sorted(met) == ["a", "c"]
    (tmp_path / "in" / "d.svs").write_bytes(b"x")
    run()
    assert sorted(met) == ["a", "c", "d"]
    listed = manifest.list_slides(spark, str(tmp_path / "in"), "out")
    assert sorted(r[0] for r in listed.collect()) == ["a", "c", "d"]
