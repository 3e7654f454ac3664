"""Registered queries of the engine's own operators on the standard tables, and the same in SQL.

There are no images among the tables, so images are derived from them by integer arithmetic, alike in Spark and SQL:
lineitem rows are pixels grouped by supplier; each supplier is also a slide whose thumbnail is painted from its key; parts
are slides with a size; vectors of 64 numbers are 8 x 8 gray tiles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import colour, names, resolution
from ..operators import grid, mask, reconstruct, reports, stain, tiles, tissue
from ..sources import slides as reading

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- derived images, as SQL text for both engines ({div} is integer division)

W, H = 32, 24
_X2, _Y2 = f"(2 * x - {W})", f"(2 * y - {H})"
_INSIDE = f"({_X2} * {_X2} * {H * H} + {_Y2} * {_Y2} * {W * W} < {W * W * H * H} * (4 + s % 5) {{div}} 10)"
_NOISE = "((x * 7919 + y * 104729 + s * 31) % 23)"
_STROKE = f"(s % 3 = 0 AND abs(y - {H} {{div}} 4) < 2)"
PIXEL = {
    "r": f"CASE WHEN {_STROKE} THEN 40 WHEN {_INSIDE} THEN 190 - 3 * {_NOISE} ELSE 238 - {_NOISE} % 5 END",
    "g": f"CASE WHEN {_STROKE} THEN 60 WHEN {_INSIDE} THEN 90 + {_NOISE} ELSE 238 - {_NOISE} % 5 END",
    "b": f"CASE WHEN {_STROKE} THEN 200 WHEN {_INSIDE} THEN 160 - 2 * {_NOISE} ELSE 238 - {_NOISE} % 5 END",
}
TISSUE = "((x * 31 + y * 17 + s * 7) % 11 < 4 + s % 4)"


def _dealt(slides: DataFrame) -> DataFrame:
    """slides dealt out by slide before each becomes many rows: the file is small, so it is read by one task, which would make them all."""
    return slides.repartition(int(slides.sparkSession.conf.get("spark.sql.shuffle.partitions")), "slide_id")


def _raster(spark: SparkSession, sf_dir: str, **cols: str) -> DataFrame:
    """One row a pixel of each supplier's thumbnail."""
    s = _dealt(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("slide_id"), F.col("s_suppkey").cast("int").alias("s")))
    full = s.select("slide_id", "s", F.explode(F.sequence(F.lit(0), F.lit(H - 1))).alias("y")).select("slide_id", "s", "y", F.explode(F.sequence(F.lit(0), F.lit(W - 1))).alias("x"))
    return full.select("slide_id", "x", "y", "s", *(F.expr(e.format(div="div")).alias(c) for c, e in cols.items()))


def _raster_sql(**cols: str) -> str:
    return f"(SELECT s::VARCHAR AS slide_id, x, y, s{''.join(f', ({e.format(div='//')}) AS {c}' for c, e in cols.items())} FROM (SELECT s_suppkey::INT AS s FROM supplier), (SELECT unnest(range({W}))::INT AS x), (SELECT unnest(range({H}))::INT AS y))"


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raster(spark, sf_dir, **PIXEL).drop("s")


PIXELS_SQL = _raster_sql(**PIXEL)
_LINE = "(SELECT l_suppkey AS k, (l_orderkey % 256)::INT AS r, (l_partkey % 256)::INT AS g, (l_suppkey % 256)::INT AS b FROM lineitem)"


def line_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as pixels (k, r, g, b)."""
    channel = lambda c: (F.col(c) % 256).cast("int")
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), channel("l_orderkey").alias("r"), channel("l_partkey").alias("g"), channel("l_suppkey").alias("b"))


def _triples(colour_name: str, mild: bool = False) -> str:
    signs = {"blue": "<<>", "red": "><<", "green": "<>>", "black": "<<<"}[colour_name]
    rows = {"blue": colour.BLUE_PEN, "red": colour.RED_PEN, "green": colour.GREEN_PEN, "black": colour.BLACK_PEN}[colour_name]
    rows = colour.MILD.get(colour_name, rows) if mild else rows
    return "(" + " OR ".join("(" + " AND ".join(f"{c} {o} {v}" for c, o, v in zip("rgb", signs, t, strict=True)) + ")" for t in rows) + ")"


# ---- sources, names, resolution

_PATH = "'/d/' || page_id || '.' || CASE page_id % 5 WHEN 0 THEN 'svs' WHEN 1 THEN 'tif' WHEN 2 THEN 'ndpi' WHEN 3 THEN 'SVS' ELSE 'png' END"


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.expr(_PATH).alias("path"))


@query(f"""SELECT DISTINCT split_part(split_part(path, '/', -1), '.', 1) AS patient_id, path, 'out/' || split_part(split_part(path, '/', -1), '.', 1) AS output, 'enc/' || split_part(split_part(path, '/', -1), '.', 1) || '.parquet' AS encoded
FROM (SELECT {_PATH} AS path FROM pages) WHERE regexp_matches(path, '\\.({"|".join(names.EXTENSIONS)})$')""")
def slide_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of slide files."""
    from ..sources.manifest import manifest_of, with_encoded_path

    return with_encoded_path(manifest_of(_paths(spark, sf_dir), "out"), "enc").toDF("patient_id", "path", "output", "encoded")


@query(f"SELECT page_id, regexp_matches({_PATH}, '\\.({'|'.join(names.EXTENSIONS)})$') AS is_slide, split_part(url, '/', -1) AS file, split_part(split_part(url, '/', -1), '.', 1) AS stem FROM pages")
def extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", names.is_slide(F.expr(_PATH)).alias("is_slide"), F.element_at(F.split("url", "/"), -1).alias("file"), names.sample_id(F.col("url")).alias("stem"))


def _nearest_sql(value: str, rows) -> str:
    rows = sorted(rows)
    return f"CASE WHEN {value} IS NULL THEN NULL " + " ".join(f"WHEN round({value}, 3) < {(a + b) / 2} THEN {e}::DOUBLE" for (a, e), (b, _) in zip(rows[:-1], rows[1:], strict=True)) + f" ELSE {rows[-1][1]}::DOUBLE END"


_MPP = "((p_partkey % 4000) / 100.0)::DOUBLE"
_MAG = "((p_partkey % 1201) / 10.0)::DOUBLE"


@query(f"SELECT p_partkey, {_nearest_sql(_MPP, [(k, k) for k, _ in resolution.SCALE])} AS closest, {_nearest_sql(_MPP, resolution.SCALE)} AS magnification, {_nearest_sql(_MAG, [(m, k) for k, m in resolution.SCALE])} AS mpp FROM part")
def resolution_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-key look-ups."""
    p = table(spark, sf_dir, "part")
    mpp, mag = (F.col("p_partkey") % 4000) / F.lit(100.0), (F.col("p_partkey") % 1201) / F.lit(10.0)
    return p.select("p_partkey", resolution.closest_mpp(mpp).alias("closest"), resolution.mpp_to_magnification(mpp).alias("magnification"), resolution.magnification_to_mpp(mag).alias("mpp"))


_HEAD = "SELECT s_suppkey AS k, CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'x' WHEN 2 THEN '40' WHEN 3 THEN '20.0' ELSE '10' END AS objective_power, CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '0.25' WHEN 2 THEN '0.4990' WHEN 3 THEN '1.02' WHEN 4 THEN '0.375' ELSE '0.25' END AS mpp_x, CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE '0.25' END AS mpp_y, CASE s_suppkey % 11 WHEN 0 THEN NULL ELSE 1000 END AS width, 800 AS height FROM supplier"


@query(f"""WITH h AS ({_HEAD}), a AS (SELECT *, floor(try_cast(objective_power AS DOUBLE)) AS pw, coalesce(try_cast(mpp_x AS DOUBLE), try_cast(mpp_y AS DOUBLE)) AS mx FROM h),
b AS (SELECT *, coalesce(mx, CASE WHEN pw <> 0 THEN {_nearest_sql("pw", [(m, k) for k, m in resolution.SCALE])} END) AS m FROM a),
c AS (SELECT *, coalesce({_nearest_sql("m", resolution.SCALE)}, pw) AS magnification, {_nearest_sql("m", [(k, k) for k, _ in resolution.SCALE])} AS closest_mpp FROM b),
d AS (SELECT *, concat_ws(', ', CASE WHEN magnification IS NULL OR magnification = 0 THEN 'magnification' END, CASE WHEN m IS NULL OR m = 0 THEN 'mpp' END, CASE WHEN width IS NULL OR width = 0 THEN 'width' END) AS lack FROM c)
SELECT k, m AS mpp, magnification, closest_mpp, CASE WHEN lack <> '' THEN 'missing: ' || lack WHEN magnification < 20 THEN 'magnification below the desired one' END AS error,
CASE WHEN lack <> '' THEN 'Property Check' WHEN magnification < 20 THEN 'Resolution Sanity Check' END AS step FROM d""")
def header_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header resolution and checks."""
    table(spark, sf_dir, "supplier").createOrReplaceTempView("tessera_supplier")
    h = spark.sql(_HEAD.replace("FROM supplier", "FROM tessera_supplier"))
    out = resolution.checked(resolution.header(h), 20)
    return out.select("k", F.col("mpp_x").alias("mpp"), "magnification", "closest_mpp", "error", "step")


@query("SELECT p_partkey, (floor((p_size * 2.0) / 15.0) * 256)::INT AS by_magnification, trunc(256.0 * (p_size * 2.0) / 15.0)::INT AS ratio, floor(0.5 * 256 / (p_size / 40.0))::INT AS by_mpp FROM part")
def tile_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile sizes at level 0."""
    mag = F.col("p_size") * F.lit(2.0)
    return table(spark, sf_dir, "part").select("p_partkey", resolution.size_by_magnification(mag, 256, 15).alias("by_magnification"), resolution.size_by_ratio(mag, 256, 15).alias("ratio"), resolution.size_by_mpp(F.col("p_size") / F.lit(40.0), 256, 0.5).alias("by_mpp"))


@query("""SELECT c_custkey, CASE WHEN d = '' THEN NULL WHEN d::INT >= 11 THEN 0 ELSE 1 END AS tumour, format('{}_{}_{}_size_{}_mag_{}.png', c_name, c_custkey, c_nationkey, 256, 20) AS file
FROM (SELECT *, regexp_replace(split_part('TCGA-AA-' || c_custkey || '-' || lpad((c_custkey % 15)::VARCHAR, 2, '0') || 'A', '-', 4), '[^0-9]', '', 'g') AS d FROM customer)""")
def sample_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names and diagnosis from barcodes."""
    barcode = F.concat(F.lit("TCGA-AA-"), F.col("c_custkey").cast("string"), F.lit("-"), F.lpad((F.col("c_custkey") % 15).cast("string"), 2, "0"), F.lit("A"))
    return table(spark, sf_dir, "customer").select("c_custkey", names.is_tumour(barcode).alias("tumour"), names.tile_name(F.col("c_name"), F.col("c_custkey"), F.col("c_nationkey"), F.lit(256), F.lit(20)).alias("file"))


@query("SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE (s_suppkey % 100) / 100.0::DOUBLE END AS mpp, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE (s_suppkey * 3)::INT END AS width, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE (s_suppkey * 2)::INT END AS height FROM supplier")
def comment_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a scanner's comment."""
    k = F.col("s_suppkey")
    text = F.when(k % 4 == 0, "no fields").otherwise(F.concat(F.lit("Aperio|MPP = "), F.format_string("%.2f", (k % 100) / F.lit(100.0)), F.lit("|OriginalWidth = "), (k * 3).cast("string"), F.lit("|Originalheight = "), (k * 2).cast("string")))
    return table(spark, sf_dir, "supplier").select(k.alias("k"), resolution.comment_fields(text).alias("f")).select("k", "f.*")


@query("SELECT n_nationkey, r_regionkey FROM nation, region WHERE contains(n_nationkey::VARCHAR, r_regionkey::VARCHAR) OR contains(r_regionkey::VARCHAR, n_nationkey::VARCHAR)")
def annotation_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides to annotation files by mutual containment."""
    from ..sources.annotations import matched

    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_nationkey").cast("string").alias("slide_id"))
    r = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_regionkey").cast("string").alias("name"))
    return matched(n, r).select("n_nationkey", "r_regionkey")


# ---- grids and tissue

_GRID = "SELECT p_partkey, x.x::INT AS x, y.y::INT AS y FROM part, LATERAL (SELECT unnest(range(0, p_size * 37 - 256 + {st}, {st})) AS x) x, LATERAL (SELECT unnest(range(0, p_size * 29 - 256 + {st}, {st})) AS y) y"


def _part_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 37).alias("width"), (F.col("p_size") * 29).alias("height"), F.lit(256).alias("size"))


@query(_GRID.format(st=256))
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling tiles; parts too small for one have none or an edge tile."""
    return grid.tile_grid(_part_slides(spark, sf_dir)).select("p_partkey", "x", "y")


@query(_GRID.format(st=128))
def tile_grid_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.tile_grid(_part_slides(spark, sf_dir), overlap=2).select("p_partkey", "x", "y")


def _supplier_tiles(spark: SparkSession, sf_dir: str, overlap: int = 2) -> DataFrame:
    """Tiles of 64 over slides of 16 times the thumbnail; edge tiles pass the mask."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("slide_id"), F.lit(W * 16 + 20).alias("width"), F.lit(H * 16 + 8).alias("height"), F.lit(64).alias("size"), F.lit(16).alias("scale"))
    return grid.tile_grid(_dealt(s), overlap).select("slide_id", "x", "y", "size", "scale")


_TILES_SQL = f"(SELECT s_suppkey::VARCHAR AS slide_id, x::INT AS x, y::INT AS y FROM supplier, (SELECT unnest(range(0, {W * 16 + 20} - 64 + 32, 32)) AS x), (SELECT unnest(range(0, {H * 16 + 8} - 64 + 32, 32)) AS y))"
_MASK_SQL = _raster_sql(tissue=TISSUE)
_RATED = f"""SELECT t.slide_id, t.x, t.y, count(m.s)::BIGINT AS n_cells, count(m.s) FILTER (WHERE m.tissue)::BIGINT AS n_tissue
FROM {_TILES_SQL} t LEFT JOIN {_MASK_SQL} m ON m.slide_id = t.slide_id AND m.x >= t.x // 16 AND m.x < t.x // 16 + 4 AND m.y >= t.y // 16 AND m.y < t.y // 16 + 4 GROUP BY ALL"""
_RATED = f"SELECT *, n_tissue / nullif(n_cells, 0) AS ratio, coalesce(n_tissue / nullif(n_cells, 0) >= 0.5, false) AS is_valid FROM ({_RATED})"


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raster(spark, sf_dir, tissue=TISSUE).select("slide_id", F.col("x").alias("mx"), F.col("y").alias("my"), "tissue")


@query(_RATED)
def tissue_ratio_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, A2, P4, P5, F4 by the cell join."""
    return tissue.with_validity(_supplier_tiles(spark, sf_dir), _mask(spark, sf_dir), 0.5, areas=False).drop("size", "scale")


@query(_RATED)
def tissue_ratio_sat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a summed-area table."""
    return tissue.with_validity(_supplier_tiles(spark, sf_dir), _mask(spark, sf_dir), 0.5).drop("size", "scale")


@query(f"SELECT slide_id, count(*) AS total_tiles, count(*) FILTER (WHERE is_valid) AS valid_tiles FROM ({_RATED}) GROUP BY slide_id")
def tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: tiles of each slide."""
    return tissue.tile_counts(tissue.with_validity(_supplier_tiles(spark, sf_dir), _mask(spark, sf_dir), 0.5))


# ---- masks

_HEAT = "least(greatest(r - g, 0), greatest(b - g, 0))"


def _otsu_sql(source: str, key: str, value: str) -> str:
    """Threshold of each group of source, as a sub-query body."""
    return f"""WITH v AS (SELECT {key} AS k, {value} AS v FROM {source}), e AS (SELECT k, min(v) AS lo, max(v) AS hi FROM v GROUP BY k),
n AS (SELECT v.k, least(255, floor((v - lo) / (hi - lo)::DOUBLE * 256))::INT AS bin, count(*) AS n FROM v JOIN e ON e.k = v.k WHERE lo < hi GROUP BY ALL),
f AS (SELECT e.k, b.bin, coalesce(n.n, 0) AS n, lo + (b.bin + 0.5::DOUBLE) * (hi - lo) / 256 AS c FROM e CROSS JOIN (SELECT unnest(range(256))::INT AS bin) b LEFT JOIN n ON n.k = e.k AND n.bin = b.bin WHERE lo < hi),
s AS (SELECT k, bin, c, sum(n) OVER u AS w1, sum(n) OVER d AS w2, sum(n * c) OVER u AS s1, sum(n * c) OVER d AS s2 FROM f WINDOW u AS (PARTITION BY k ORDER BY bin), d AS (PARTITION BY k ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
q AS (SELECT k, c, row_number() OVER (PARTITION BY k ORDER BY round(w1 * w2 * pow(s1 / greatest(w1, 1) - s2 / greatest(w2, 1), 2), 6) DESC, bin) AS i FROM s WHERE w2 IS NOT NULL)
SELECT k, c AS threshold FROM q WHERE i = 1 UNION ALL SELECT k, lo::DOUBLE FROM e WHERE lo = hi"""


@query(_otsu_sql("lineitem", "l_suppkey", "l_extendedprice"))
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Otsu's threshold of each supplier's prices."""
    v = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_extendedprice").alias("v"))
    return mask.otsu(v, "k", "v")


@query(f"SELECT k, {_HEAT} AS heat, count(*)::BIGINT AS n FROM {_LINE} GROUP BY ALL")
def heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colour difference heat, counted by group and level."""
    return line_pixels(spark, sf_dir).select("k", colour.heat(F.col("r"), F.col("g"), F.col("b")).alias("heat")).groupBy("k", "heat").agg(F.count("*").alias("n"))


_MARKS = [("blue", _triples("blue")), ("red", _triples("red")), ("green", _triples("green")), ("black", _triples("black")), ("gray", "(abs(r - g) <= 15 AND abs(r - b) <= 15 AND abs(g - b) <= 15)")]


@query(f"SELECT k, count(*)::BIGINT AS n, {', '.join(f'count(*) FILTER (WHERE {e})::BIGINT AS {n}' for n, e in _MARKS)}, (count(*) FILTER (WHERE {_triples('blue')}) / nullif(count(*) FILTER (WHERE {_HEAT} > 20), 0)) > 0.4 AS blue_ignored FROM {_LINE} GROUP BY k")
def pen_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pen and gray pixels of each group, and whether the blue mask would be ignored."""
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    marks = {n: colour.pen(n, r, g, b) for n in ("blue", "red", "green", "black")} | {"gray": colour.is_gray(r, g, b)}
    hot = F.count_if(colour.heat(r, g, b) > 20)
    return line_pixels(spark, sf_dir).groupBy("k").agg(F.count("*").alias("n"), *(F.count_if(c).alias(n) for n, c in marks.items()), (F.try_divide(F.count_if(marks["blue"]), hot) > 0.4).alias("blue_ignored"))


def _dilated_sql(source: str, column: str, size: int) -> str:
    a, z = size // 2, size - 1 - size // 2
    inner = f"(SELECT *, max({column}::INT) OVER (PARTITION BY slide_id, y ORDER BY x RANGE BETWEEN {a} PRECEDING AND {z} FOLLOWING) AS d FROM {source})"
    return f"(SELECT * EXCLUDE (d, {column}), max(d) OVER (PARTITION BY slide_id, x ORDER BY y RANGE BETWEEN {a} PRECEDING AND {z} FOLLOWING) = 1 AS {column} FROM {inner})"


_POINTS = "((x * 31 + y * 17 + s * 7) % 101 = 0)"


def _grown(size: int) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mask.dilated(_raster(spark, sf_dir, m=_POINTS), "m", size).select("slide_id", "x", "y", "m")

    run.__name__ = f"dilate{size}"
    run.__doc__ = "W4, W5: dilation, one axis after the other."
    query(f"SELECT slide_id, x, y, m FROM {_dilated_sql(_raster_sql(m=_POINTS), 'm', size)}")(run)


for _n in (2, 3, 5, 6):
    _grown(_n)


@query("""WITH v AS (SELECT event_type AS k, floor(value)::INT AS v FROM events WHERE value IS NOT NULL), n AS (SELECT k, v, count(*) AS n FROM v GROUP BY ALL),
t AS (SELECT k, v, n, sum(n) OVER (PARTITION BY k ORDER BY v) AS upto, sum(n) OVER (PARTITION BY k) AS every, first_value(n) OVER (PARTITION BY k ORDER BY v) AS base FROM n)
SELECT k, v, n::BIGINT AS n, CASE WHEN every = base THEN 0 ELSE floor((upto - base) * 255.0::DOUBLE / (every - base) + 0.5)::INT END AS equalised FROM t""")
def hist_equalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram equalisation of values within each event type."""
    v = table(spark, sf_dir, "events").where("value IS NOT NULL").select(F.col("event_type").alias("k"), F.floor("value").cast("int").alias("v"))
    return mask.equalised(v, "k", "v").groupBy("k", "v", "equalised").agg(F.count("*").alias("n"))


_OTSU_PX = f"(SELECT p.*, {_HEAT} > o.threshold AS otsu FROM {PIXELS_SQL} p JOIN ({_otsu_sql(PIXELS_SQL, 'slide_id', _HEAT)}) o ON o.k = p.slide_id)"
_MASKS = _dilated_sql(_OTSU_PX, "otsu", 3)
for _name, _size in (("blue", 6), ("red", 3), ("green", 3), ("black", 3)):
    _MASKS = _dilated_sql(f"(SELECT *, {_triples(_name)} AS {_name} FROM {_MASKS})", _name, _size)
_MASKS = _dilated_sql(f"(SELECT *, NOT {_MARKS[4][1]} AS gray FROM {_MASKS})", "gray", 3)
_SHARE = lambda c: f"coalesce(count(*) FILTER (WHERE {c}) OVER w / nullif(count(*) FILTER (WHERE otsu) OVER w, 0), 1e9)"
_TISSUE_SQL = f"""SELECT slide_id, x AS mx, y AS my, otsu AND ({_SHARE('blue')} > 0.4 OR NOT blue) AND ({_SHARE('red')} > 0.4 OR NOT red) AND NOT green AND NOT black AND ({_SHARE('gray')} > 0.6 OR gray) AS tissue
FROM {_MASKS} WINDOW w AS (PARTITION BY slide_id)"""


@query(_TISSUE_SQL)
def tissue_mask_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4, M5, M6, M8, U4: Otsu, pens, grays, guards, combined; all in DataFrame operations."""
    return mask.tissue_mask(pixels(spark, sf_dir), clean=False)


@query()
def tissue_mask_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 to M11 with folds, small parts and holes: connected parts aren't in SQL."""
    return mask.tissue_mask(pixels(spark, sf_dir), mask.MASKS)


# parts by their runs: within rows, joined to those of the row above that touch, also by a corner; a part is known by its first run
_PARTS = f"""WITH RECURSIVE p AS (SELECT slide_id, x, y, x - row_number() OVER (PARTITION BY slide_id, y ORDER BY x) AS island FROM {_MASK_SQL} WHERE tissue),
runs AS (SELECT slide_id, y, min(x) AS a, max(x) AS z, y * {W} + min(x) AS run FROM p GROUP BY slide_id, y, island),
up AS (SELECT l.slide_id, l.run AS l, h.run AS h FROM runs l JOIN runs h ON h.slide_id = l.slide_id AND h.y = l.y - 1 AND h.a <= l.z + 1 AND l.a <= h.z + 1),
e AS (SELECT slide_id, l, h FROM up UNION ALL SELECT slide_id, h, l FROM up),
r AS (SELECT slide_id, run, run AS origin FROM runs UNION SELECT r.slide_id, e.h, r.origin FROM r JOIN e ON e.slide_id = r.slide_id AND e.l = r.run),
f AS (SELECT slide_id, run, min(origin) AS first FROM r GROUP BY ALL),
s AS (SELECT f.slide_id, first, sum(z - a + 1)::BIGINT AS area FROM f JOIN runs ON runs.slide_id = f.slide_id AND runs.run = f.run GROUP BY ALL)
SELECT slide_id, row_number() OVER (PARTITION BY slide_id ORDER BY first)::INT AS part, area, area = max(area) OVER (PARTITION BY slide_id) AS is_largest FROM s"""


@query(_PARTS)
def component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected parts of each mask."""
    return mask.component_sizes(_mask(spark, sf_dir))


@query()
def component_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts at each of 41 thresholds of S - V."""
    p = pixels(spark, sf_dir)
    s = colour.saturation(F.col("r"), F.col("g"), F.col("b")) / F.lit(255.0)
    v = F.greatest("r", "g", "b") / F.lit(255.0)
    return mask.component_counts(p.withColumn("d", s - v), "d", tuple(round(-1 + 0.05 * k, 2) for k in range(41)))


@query(f"SELECT slide_id, x, y, {', '.join(f'(CASE WHEN tissue THEN {c} ELSE 0 END)::SMALLINT AS {c}' for c in 'rgb')} FROM {_raster_sql(**PIXEL, tissue=TISSUE)}")
def masked_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thumbnail under its mask."""
    return mask.masked_pixels(pixels(spark, sf_dir), _mask(spark, sf_dir))


@query(f"SELECT slide_id, (max(x) + 1)::INT AS width, (max(y) + 1)::INT AS height, count(*) FILTER (WHERE tissue) AS tissue_cells, count(*) FILTER (WHERE tissue) / count(*) AS tissue_share FROM {_MASK_SQL} GROUP BY slide_id")
def mask_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and tissue of each mask."""
    return mask.mask_attributes(_mask(spark, sf_dir))


@query(f"SELECT k, {', '.join(f'count(*) FILTER (WHERE {_triples(c, True)})::BIGINT AS {c}' for c in ('blue', 'red', 'green', 'black'))} FROM {_LINE} GROUP BY k")
def mild_pens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pen pixels by the milder lists."""
    rgb = F.col("r"), F.col("g"), F.col("b")
    return line_pixels(spark, sf_dir).groupBy("k").agg(*(F.count_if(colour.pen(c, *rgb, mild=True)).alias(c) for c in ("blue", "red", "green", "black")))


# ---- tiles, stain


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("slide_id"), F.posexplode("embedding").alias("i", "v"))
    return e.select("slide_id", (F.col("i") % 8).alias("x"), F.floor(F.col("i") / 8).cast("int").alias("y"), F.col("v").cast("double").alias("v"))


_LAPLACE = """WITH c AS (SELECT vec_id AS k, (i - 1) % 8 AS x, (i - 1) // 8 AS y, embedding[i]::DOUBLE AS v FROM embeddings, LATERAL (SELECT unnest(range(1, 65)) AS i) u),
t AS (SELECT * FROM (VALUES (-1, -1, 2), (1, -1, 2), (-1, 1, 2), (1, 1, 2), (0, 0, -8)) t(dx, dy, w)),
n AS (SELECT k, x, y, CASE WHEN x + dx < 0 THEN 1 WHEN x + dx > 7 THEN 6 ELSE x + dx END AS sx, CASE WHEN y + dy < 0 THEN 1 WHEN y + dy > 7 THEN 6 ELSE y + dy END AS sy, w FROM c, t),
e AS (SELECT n.k, n.x, n.y, sum(n.w * c.v) AS e FROM n JOIN c ON c.k = n.k AND c.x = n.sx AND c.y = n.sy GROUP BY ALL)
SELECT k AS slide_id, round(var_pop(e), 6) AS laplacian_var FROM e GROUP BY k"""


@query(_LAPLACE)
def laplacian_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variance of the Laplacian of each 8 x 8 tile."""
    return tiles.laplacian_sql(_vectors(spark, sf_dir), 8).withColumn("laplacian_var", F.round("laplacian_var", 6))


@query(f"SELECT * FROM ({_LAPLACE}) WHERE laplacian_var > 1.0")
def blur_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tiles that are not blurry."""
    return laplacian_var(spark, sf_dir).where("laplacian_var > 1.0")


@query(f"SELECT CASE WHEN laplacian_var < 0 THEN 0 WHEN laplacian_var >= 4 THEN 21 ELSE floor(laplacian_var / 0.2)::INT + 1 END::BIGINT AS bin, count(*) AS n FROM ({_LAPLACE}) GROUP BY 1")
def blur_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of variances."""
    return tiles.variance_histogram(laplacian_var(spark, sf_dir), 0, 4, 20)


_OD = f"(SELECT k, -ln(greatest(r, 1) / 240.0::DOUBLE) AS r, -ln(greatest(g, 1) / 240.0::DOUBLE) AS g, -ln(greatest(b, 1) / 240.0::DOUBLE) AS b FROM {_LINE})"


@query(f"SELECT k, count(*) AS n, {', '.join(f'round(covar_samp({a}, {b}), 6) AS cov_{a}{b}' for i, a in enumerate('rgb') for b in 'rgb'[i:])} FROM {_OD} WHERE r >= 0.15 AND g >= 0.15 AND b >= 0.15 GROUP BY k")
def od_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covariance of optical densities of dense pixels."""
    out = stain.od_statistics(line_pixels(spark, sf_dir), "k")
    return out.select("k", "n", *(F.round(c, 6).alias(c) for c in out.columns if c.startswith("cov_")))


@query(f"SELECT k, {', '.join(f'round(quantile_cont({c}, {q}), 6) AS {c}_p{round(100 * q)}' for c in 'rgb' for q in (0.01, 0.99))} FROM {_OD} GROUP BY k")
def od_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interpolated percentiles of optical density."""
    out = stain.od_percentiles(line_pixels(spark, sf_dir), "k")
    return out.select("k", *(F.round(c, 6).alias(c) for c in out.columns if c != "k"))


def _lab_sql(source: str) -> str:
    lin = lambda c: f"CASE WHEN {c} / 255.0::DOUBLE > 0.04045 THEN pow(({c} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) ELSE {c} / 255.0::DOUBLE / 12.92 END"
    xyz = ", ".join(f"({m[0]} * lr + {m[1]} * lg + {m[2]} * lb) / {w}::DOUBLE AS {n}" for m, w, n in zip(colour.RGB_XYZ, colour.WHITE, "uvw", strict=True))
    f = lambda c: f"CASE WHEN {c} > 0.008856 THEN pow({c}, {1 / 3}::DOUBLE) ELSE 7.787 * {c} + {16 / 116}::DOUBLE END"
    a = f"SELECT *, {lin('r')} AS lr, {lin('g')} AS lg, {lin('b')} AS lb FROM {source}"
    return f"(SELECT *, 116.0 * fy - 16.0 AS LL, 500.0 * (fx - fy) AS aa, 200.0 * (fy - fz) AS bb FROM (SELECT *, {f('u')} AS fx, {f('v')} AS fy, {f('w')} AS fz FROM (SELECT *, {xyz} FROM ({a}))))"


@query(f"SELECT k, {', '.join(f'round({fn}({c}), 5) AS {p}_{n}' for fn, p in (('avg', 'mean'), ('stddev_pop', 'std')) for c, n in (('LL', 'L'), ('aa', 'a'), ('bb', 'b')))} FROM {_lab_sql(_LINE)} WHERE LL > 0 AND LL < 100 GROUP BY k")
def reinhard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation in Lab."""
    out = stain.lab_statistics(line_pixels(spark, sf_dir), "k")
    return out.select("k", *(F.round(c, 5).alias(c) for c in out.columns if c != "k"))


@query(f"SELECT k, {', '.join(f'round({fn}({c}), 5) AS {p}_{n}' for fn, p in (('avg', 'mean'), ('stddev_samp', 'std')) for c, n in (('LL', 'L'), ('aa', 'a'), ('bb', 'b')))} FROM {_lab_sql(_LINE)} GROUP BY k")
def lab_sample_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all pixels, with the sample's deviation."""
    out = stain.lab_statistics(line_pixels(spark, sf_dir), "k", masked=False)
    return out.select("k", *(F.round(c, 5).alias(c) for c in out.columns if c != "k"))


@query()
def reinhard_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reinhard over pixels. Not in SQL because bytes at a rounding edge may differ; tests hold it against the kernel."""
    return stain.reinhard(pixels(spark, sf_dir), "slide_id")


def _byte_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an 8 x 8 stained tile: its numbers move the amounts of two stains."""
    e = F.col("embedding")
    level = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(0.5) + 2 * x))
    byte = lambda v: F.lpad(F.hex(F.floor(v).cast("int")), 2, "0")
    text = F.array_join(F.transform(e, lambda x: F.concat(byte(200 - 120 * level(x)), byte(170 - 150 * level(x)), byte(210 - 60 * level(-x)))), "")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("slide_id"), F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(8).alias("size"), F.unhex(text).alias("tile"))


@query()
def macenko_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blur, then Macenko; rejected tiles go. Tests hold the kernel against the statistics in SQL."""
    out = tiles.apply(_byte_tiles(spark, sf_dir), [tiles.step("blur", threshold=0.0), tiles.step("macenko")])
    return out.select("slide_id", F.round("laplacian_var", 9).alias("laplacian_var"), F.hex("tile").alias("tile"))


@query()
def encode_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each tile."""
    from ..operators import encode

    return encode.encode(_byte_tiles(spark, sf_dir), side=16)


@query("SELECT vec_id, unnest(range(4))::INT AS copy FROM embeddings")
def augment_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of each tile."""
    t = table(spark, sf_dir, "embeddings").select("vec_id", F.col("vec_id").alias("slide_id"), F.lit(0).alias("x"), F.lit(0).alias("y"))
    return tiles.augmentations(t, 3).select("vec_id", "copy")


@query(f"""SELECT slide_id, x, y, rank FROM (SELECT *, row_number() OVER (PARTITION BY slide_id, is_valid ORDER BY (x * 7919 + y * 104729) % 1009, x, y)::INT AS rank FROM ({_RATED})) WHERE rank <= 5""")
def qc_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five tiles of each kind, by an integer hash."""
    t = tissue.with_validity(_supplier_tiles(spark, sf_dir), _mask(spark, sf_dir), 0.5)
    return tiles.qc_samples(t.withColumn("is_blurry", ~F.col("is_valid")), 5, by=(F.col("x") * 7919 + F.col("y") * 104729) % 1009).select("slide_id", "x", "y", "rank")


# ---- reconstruction and reports


@query(f"SELECT g.slide_id, g.x, g.y, v.x IS NOT NULL AS is_included FROM {_TILES_SQL} g LEFT JOIN (SELECT * FROM ({_RATED}) WHERE is_valid) v ON v.slide_id = g.slide_id AND v.x = g.x AND v.y = g.y")
def reconstruct_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tiles of the grid are included."""
    t = _supplier_tiles(spark, sf_dir)
    return reconstruct.marked(t, tissue.with_validity(t, _mask(spark, sf_dir), 0.5).where("is_valid")).select("slide_id", "x", "y", "is_included")


_APART = _TILES_SQL.replace(" + 32, 32))", " + 64, 64))")  # tiles that don't overlap
_PAINTED = f"""(SELECT slide_id, x // 16 + dx AS x, y // 16 + dy AS y, max(CASE WHEN is_valid AND (dx < 0 OR dx > 2 OR dy < 0 OR dy > 2) AND NOT (dx < 0 AND dy < 0) THEN 2 WHEN NOT is_valid AND dx >= 0 AND dy >= 0 THEN 1 END) AS paint
FROM ({_RATED.replace(_TILES_SQL, _APART)}), (SELECT unnest(range(-1, 4)) AS dx), (SELECT unnest(range(-1, 4)) AS dy) GROUP BY ALL)"""


@query(f"SELECT p.slide_id, p.x, p.y, {', '.join(f'(CASE paint WHEN 2 THEN 255 WHEN 1 THEN 0 ELSE {c} END)::SMALLINT AS {c}' for c in 'rgb')} FROM {PIXELS_SQL} p LEFT JOIN {_PAINTED} t ON t.slide_id = p.slide_id AND t.x = p.x AND t.y = p.y")
def reconstruct_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawing itself."""
    t = _supplier_tiles(spark, sf_dir, 1)
    full = reconstruct.marked(t, tissue.with_validity(t, _mask(spark, sf_dir), 0.5).where("is_valid"))
    return reconstruct.reconstructed(pixels(spark, sf_dir), full)


@query(f"SELECT slide_id, x, y FROM {_TILES_SQL} EXCEPT SELECT slide_id, x, y FROM ({_RATED}) WHERE is_valid")
def coord_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origins that didn't survive."""
    t = _supplier_tiles(spark, sf_dir)
    return reconstruct.missing(t, tissue.with_validity(t, _mask(spark, sf_dir), 0.5).where("is_valid"))


_OLD = "SELECT o_custkey AS sample_id, max(o_orderkey) AS path, CASE WHEN o_custkey % 3 = 0 THEN 'Error' ELSE 'Processed' END AS status FROM orders WHERE o_orderkey % 2 = 0 GROUP BY o_custkey"
_NEW = "SELECT o_custkey AS sample_id, min(o_orderkey) AS path, 'Processed' AS status FROM orders WHERE o_orderkey % 2 = 1 GROUP BY o_custkey"


@query(f"""WITH old AS ({_OLD}), new AS ({_NEW}), fresh AS (SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.sample_id = new.sample_id AND old.status = 'Processed'))
SELECT * FROM old WHERE status = 'Processed' OR sample_id NOT IN (SELECT sample_id FROM fresh) UNION ALL SELECT * FROM fresh""")
def summary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New summary rows over the old ones."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("tessera_orders")
    old, new = (spark.sql(q.replace("FROM orders", "FROM tessera_orders")) for q in (_OLD, _NEW))
    return reports.merged(old, new)


@query("""WITH e AS (SELECT o_custkey AS k, CASE WHEN count(*) % 4 = 0 THEN -1 ELSE sum(o_totalprice) END AS t FROM orders GROUP BY o_custkey)
SELECT c_custkey AS sample_id, round(CASE WHEN t IS NOT NULL AND t <> -1 THEN t ELSE c_acctbal END, 2) AS encoding_cpu_time, round(CASE WHEN t IS NOT NULL AND t <> -1 THEN t ELSE 0 END, 2) AS encoding_user_time FROM customer LEFT JOIN e ON k = c_custkey""")
def encoding_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding times into the summary."""
    t = F.when(F.count("*") % 4 == 0, F.lit(-1.0)).otherwise(F.sum("o_totalprice"))
    e = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("sample_id")).agg(t.alias("encoding_cpu_time")).withColumn("encoding_user_time", F.col("encoding_cpu_time"))
    s = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_acctbal").alias("encoding_cpu_time"), F.lit(0.0).alias("encoding_user_time"))
    return reports.with_encoding(s, e).select("sample_id", *(F.round(c, 2).alias(c) for c in ("encoding_cpu_time", "encoding_user_time")))


@query("SELECT DISTINCT user_id, event_type, props FROM events WHERE event_type = 'error' AND event_id % 3 <> 0 OR event_type IN ('error', 'purchase') AND event_id % 2 = 0")
def error_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error rows of two runs that overlap, each once."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "props", "event_id")
    old, new = e.where("event_type = 'error' AND event_id % 3 <> 0"), e.where("event_type IN ('error', 'purchase') AND event_id % 2 = 0")
    return reports.errors_merged(old.drop("event_id"), new.drop("event_id"))


@query("""SELECT s_suppkey::VARCHAR AS sample_id, 's/' || s_suppkey AS path, CASE WHEN s_suppkey % 5 = 0 THEN 'Slide Opening' ELSE 'Tissue Mask' END AS step FROM supplier WHERE s_suppkey % 5 IN (0, 1)""")
def step_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rows of slides that can't be opened (a raster cut short or of another kind), and of slides without a mask."""
    good, cut, other = (b"P6\n2 2\n255\n" + bytes(12)), b"P6\n2 2\n255\n" + bytes(5), b"II*\0"
    k = F.col("s_suppkey")
    content = F.when(k % 10 == 0, F.lit(cut)).when(k % 5 == 0, F.lit(other)).otherwise(F.lit(good))
    s = table(spark, sf_dir, "supplier").select(k.cast("string").alias("slide_id"), F.concat(F.lit("s/"), k).alias("path"), F.lit(2).alias("width"), F.lit(2).alias("height"), content.alias("content"), k)
    broken = reading.unreadable(s, "ppm")
    masks = s.where("s_suppkey % 5 > 1").select("slide_id")
    out = reports.step_errors(s, broken, "Slide Opening").unionByName(reports.step_errors(s, reports.without_mask(s, masks, broken), "Tissue Mask"))
    return out.select(F.col("Sample ID").alias("sample_id"), F.col("Path").alias("path"), F.col("Step in Pipeline").alias("step"))


# ---- synthetic slides: pixels by the same integer arithmetic in SQL

_SLIDE_W, _SLIDE_H = 96, 72
_KEY = "list_sum(list_transform(range(length(slide_id)), lambda i: ord(slide_id[i + 1]) * (i + 1)))"


def _synthetic_sql(points: str) -> str:
    """(.., r, g, b) of the synthetic slides at points (slide_id, .., px, py)."""
    noise = "(px * 7919 + py * 104729 + key * 31) % 23"
    inside = f"floor((2 * px - {_SLIDE_W}) * 10 / {_SLIDE_W}::DOUBLE) ** 2 + floor((2 * py - {_SLIDE_H}) * 10 / {_SLIDE_H}::DOUBLE) ** 2 < 49"
    stroke = f"key % 3 = 0 AND abs(py * 4 - {_SLIDE_H}) < {max(2, _SLIDE_H // 25)}"
    off = f"px < 0 OR py < 0 OR px >= {_SLIDE_W} OR py >= {_SLIDE_H}"
    value = lambda pen, tissue_: f"(CASE WHEN {off} THEN 255 WHEN {stroke} THEN {pen} WHEN {inside} THEN {tissue_} ELSE 238 - {noise} % 5 END)"
    return f"(SELECT *, {value(40, f'190 - 3 * ({noise})')} AS r, {value(60, f'90 + {noise}')} AS g, {value(200, f'160 - 2 * ({noise})')} AS b FROM (SELECT *, {_KEY} AS key FROM {points}))"


def _synthetic_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("slide_id"), F.lit(_SLIDE_W).alias("width"), F.lit(_SLIDE_H).alias("height"), F.lit(4).alias("scale"))


@query(f"SELECT slide_id, x, y, r::SMALLINT AS r, g::SMALLINT AS g, b::SMALLINT AS b FROM {_synthetic_sql(f'(SELECT s_suppkey::VARCHAR AS slide_id, x::INT AS x, y::INT AS y, x * 4 AS px, y * 4 AS py FROM supplier, (SELECT unnest(range({_SLIDE_W // 4})) AS x), (SELECT unnest(range({_SLIDE_H // 4})) AS y))')}")
def thumbnail_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thumbnails through a reader."""
    return reading.thumbnails(_synthetic_slides(spark, sf_dir))


_ORIGINS = f"(SELECT s_suppkey::VARCHAR AS slide_id, x, y FROM supplier, (SELECT unnest(range(0, {_SLIDE_W}, 16)) AS x), (SELECT unnest(range(0, {_SLIDE_H}, 16)) AS y))"


@query(f"SELECT slide_id, x::INT AS x, y::INT AS y, sum(r)::BIGINT AS r, sum(g)::BIGINT AS g, sum(b)::BIGINT AS b, sum(r * (1 + (px - x) + 16 * (py - y)))::BIGINT AS weighted FROM {_synthetic_sql(f'(SELECT *, x + dx AS px, y + dy AS py FROM {_ORIGINS}, (SELECT unnest(range(16)) AS dx), (SELECT unnest(range(16)) AS dy))')} GROUP BY ALL")
def region_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions at level 0, also over the edge, read by slide in blocks of tiles; sums of their bytes, one weighted by place."""
    s = _synthetic_slides(spark, sf_dir).drop("scale")
    at = s.select("slide_id", F.lit(16).alias("size"), F.explode(F.sequence(F.lit(0), F.lit(_SLIDE_W - 1), F.lit(16))).alias("x"), F.lit(0).alias("y0")).select("slide_id", "size", "x", F.explode(F.sequence(F.lit(0), F.lit(_SLIDE_H - 1), F.lit(16))).alias("y"))
    t = reading.read_regions(reading.in_blocks(at, s))
    value = F.conv(F.hex(F.expr("substring(tile, i + 1, 1)")), 16, 10).cast("long")
    cells = t.select("slide_id", "x", "y", "tile", F.explode(F.sequence(F.lit(0), F.lit(16 * 16 * 3 - 1))).alias("i")).select("slide_id", "x", "y", "i", value.alias("v"))
    channel = lambda k: F.sum(F.when(F.col("i") % 3 == k, F.col("v"))).alias("rgb"[k])
    return cells.groupBy("slide_id", "x", "y").agg(*(channel(k) for k in range(3)), F.sum(F.when(F.col("i") % 3 == 0, F.col("v") * (1 + F.floor(F.col("i") / 3)))).alias("weighted"))


@query(f"SELECT slide_id, x, y, floor((4899 * r + 9617 * g + 1868 * b + 8192) / 16384)::INT AS gray_byte, round((0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b) / 255, 9) AS gray_float, round((0.2125::DOUBLE * r + 0.7154::DOUBLE * g + 0.0721::DOUBLE * b) / 255, 9) AS gray_display FROM {PIXELS_SQL}")
def gray_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three luminances."""
    rgb = F.col("r"), F.col("g"), F.col("b")
    return pixels(spark, sf_dir).select("slide_id", "x", "y", F.round(colour.gray(*rgb) * 255).cast("int").alias("gray_byte"), F.round(colour.gray(*rgb, "float"), 9).alias("gray_float"), F.round(colour.gray(*rgb, "display"), 9).alias("gray_display"))


@query(f"SELECT slide_id, x, y, s, round(s / 255.0::DOUBLE - greatest(r, g, b) / 255.0::DOUBLE, 9) AS s_less_v FROM (SELECT *, CASE WHEN greatest(r, g, b) = 0 THEN 0 ELSE floor((greatest(r, g, b) - least(r, g, b)) * 255.0::DOUBLE / greatest(r, g, b) + 0.5)::INT END AS s FROM {PIXELS_SQL.replace(', s,', ', s AS key,')})")
def saturation_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saturation, and what folds are told by."""
    p = pixels(spark, sf_dir).withColumn("s", colour.saturation(F.col("r"), F.col("g"), F.col("b")))
    return p.select("slide_id", "x", "y", "s", F.round(F.col("s") / F.lit(255.0) - F.greatest("r", "g", "b") / F.lit(255.0), 9).alias("s_less_v"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) < 10)")
def filter_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides with too few tiles leave the manifest; an unknown number doesn't count against one."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("sample_id")).agg(F.count("*").alias("non_blurry_tiles"))
    return reports.passing(table(spark, sf_dir, "customer"), n, 10, manifest_key="c_custkey").select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def skip_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what is left to do."""
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return reports.unfinished(table(spark, sf_dir, "orders"), done, "o_orderkey").select("o_orderkey", "o_custkey")


_SUM = f"SELECT slide_id AS sample_id, count(*) AS total_tiles, count(*) FILTER (WHERE is_valid) AS valid, count(*) FILTER (WHERE is_valid AND x % 64 = 0) AS kept FROM ({_RATED}) GROUP BY slide_id"


@query(f"SELECT sample_id, total_tiles::INT AS total_tiles, valid::INT AS tiles_passing_tissue_thresh, kept::INT AS non_blurry_tiles, round(valid / nullif(total_tiles, 0) * 100, 6) AS pct_tissue, round(kept / nullif(valid, 0) * 100, 6) AS pct_qc, 6.0::DOUBLE AS total_time_cpu, 60.0::DOUBLE AS total_time_user, 'Processed' AS status FROM ({_SUM})")
def summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of each slide."""
    t = tissue.with_validity(_supplier_tiles(spark, sf_dir), _mask(spark, sf_dir), 0.5)
    counts = t.groupBy(F.col("slide_id").alias("sample_id")).agg(F.count("*").cast("int").alias("total_tiles"), F.count_if("is_valid").cast("int").alias("tiles_passing_tissue_thresh"), F.count_if(F.col("is_valid") & (F.col("x") % 64 == 0)).cast("int").alias("non_blurry_tiles"))
    times = {f"time_{p}_{k}": F.lit(v * s) for k, s in (("cpu", 1.0), ("user", 10.0)) for p, v in (("masking", 1), ("obtaining_valid_coordinates", 2), ("patching_tiles", 3))}
    out = reports.derived(counts.withColumns(times).withColumn("status", F.lit("Processed")))
    return out.select("sample_id", "total_tiles", "tiles_passing_tissue_thresh", "non_blurry_tiles", F.round("`%_tissue`", 6).alias("pct_tissue"), F.round("`%_tiles_passing_QC`", 6).alias("pct_qc"), "total_time_cpu", "total_time_user", "status")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed counts, the batch form of the streaming query."""
    from ..streaming.slides import error_rates

    return error_rates(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query()
def valid_tiles_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole plan, a synthetic slide for each supplier: header, mask, grid, tissue, pixels, blur, Macenko."""
    from ..config import RunConfig
    from ..session import stored
    from . import pipeline

    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    slides = s.select(F.concat(F.lit("S"), k.cast("string")).alias("slide_id"), F.concat(F.lit("synthetic://S"), k.cast("string"), F.lit(".svs")).alias("path"), F.lit("synthetic").alias("vendor"), F.element_at(F.array(F.lit("40"), F.lit("20"), F.lit("5"), F.lit(None).cast("string")), (k % 4 + 1).cast("int")).alias("objective_power"), F.when(k % 4 == 0, "0.25").alias("mpp_x"), F.lit(None).cast("string").alias("mpp_y"), (F.lit(512) + (k % 5).cast("int") * 64).alias("width"), F.lit(384).alias("height"), F.array(F.lit(1.0), F.lit(16.0)).alias("level_downsamples"))
    run = pipeline.plan(slides, RunConfig(desired_size=64, desired_magnification=20, tissue_threshold=0.5, remove_blurry_tiles=True, blur_threshold=0.0001, normaliser="macenko"), keep=lambda name, t: stored(t))
    return pipeline.summary(run).select("sample_id", "total_tiles", "tiles_passing_tissue_thresh", "non_blurry_tiles", "status")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tiles of each slide are tissue: painted thumbnails, Otsu, masks, grid, ratio, counts."""
    masks = mask.tissue_mask(pixels(spark, sf_dir), clean=False)
    size = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("slide_id"), F.lit(W).alias("mw"), F.lit(H).alias("mh"))
    t = tissue.tile_counts(tissue.with_validity(_supplier_tiles(spark, sf_dir, 1), masks, 0.5, size=size))
    return t.withColumn("pct_valid", F.round(F.try_divide("valid_tiles", "total_tiles") * 100, 4))


QUERIES["valid_tile_counts"] = flagship
SQL["valid_tile_counts"] = f"""WITH m AS ({_TISSUE_SQL}), t AS (SELECT s_suppkey::VARCHAR AS slide_id, x::INT AS x, y::INT AS y FROM supplier, (SELECT unnest(range(0, {W * 16 + 20}, 64)) AS x), (SELECT unnest(range(0, {H * 16 + 8}, 64)) AS y)),
r AS (SELECT t.slide_id, t.x, t.y, count(m.mx) AS n, count(m.mx) FILTER (WHERE m.tissue) AS k FROM t LEFT JOIN m ON m.slide_id = t.slide_id AND m.mx >= t.x // 16 AND m.mx < t.x // 16 + 4 AND m.my >= t.y // 16 AND m.my < t.y // 16 + 4 GROUP BY ALL)
SELECT slide_id, count(*) AS total_tiles, count(*) FILTER (WHERE k / nullif(n, 0) >= 0.5) AS valid_tiles, round(count(*) FILTER (WHERE k / nullif(n, 0) >= 0.5) / count(*) * 100, 4) AS pct_valid FROM r GROUP BY slide_id"""
