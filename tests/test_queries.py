"""Every registered query of the engine against its SQL."""

import sys

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import database, same  # noqa: E402

from tessera.plans import queries  # noqa: E402


@pytest.fixture(scope="module")
def con(data):
    return database(data)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, data, con, name):
    same(queries.QUERIES[name](spark, data), con, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs_and_reruns_agree(spark, data, name):
    a, b = (sorted(map(repr, queries.QUERIES[name](spark, data).collect())) for _ in range(2))
    assert a and a == b


def test_entry_contract(spark, data):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["slide_id", "total_tiles", "valid_tiles", "pct_valid"]


def _broadcast_rows(df) -> list[int]:
    """Rows of each broadcast of the plan as it ran."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "BroadcastExchangeExec":
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


#: Queries whose tiles and pixels, made of a small table of slides, look small to the planner.
GROWN = ("tile_counts", "tissue_ratio_sat", "qc_sample", "summary_report", "coord_except", "reconstruct_marks", "reconstruct_pixels", "tissue_ratio_cell", "tissue_mask_sql", "masked_pixels", "valid_tile_counts", "tissue_mask_clean")


@pytest.mark.parametrize("name", GROWN)
def test_broadcasts_hold_no_more_rows_than_slides(spark, data, name):
    """Nor is all made by the one task that reads the slides."""
    assert max(_broadcast_rows(queries.QUERIES[name](spark, data)), default=0) <= spark.read.parquet(f"{data}/supplier.parquet").count()


def test_blur_histogram_counts_variances_on_edges_like_sql(spark, tmp_path):
    """Vectors scaled until their variance is a bin's edge to six places, and one step of 1e-6 to either side."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    one = np.random.default_rng(5).normal(size=64).astype(np.float32)
    pq.write_table(pa.table({"vec_id": pa.array([0]), "embedding": pa.array([one.tolist()], pa.list_(pa.float32())), "label": pa.array([0], pa.int32())}), f"{tmp_path}/embeddings.parquet")
    con = database("/root/testdata/sf0.001")
    con.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet')")
    per = con.sql(queries._LAPLACE.replace("round(var_pop(e), 6)", "var_pop(e)")).fetchall()[0][1]
    wanted = [k / 5 + d for k in range(21) for d in (-1e-6, 0, 1e-6) if k / 5 + d >= 0]
    vectors = [(one.astype(float) * (w / per) ** 0.5).astype(np.float32).tolist() for w in wanted]
    pq.write_table(pa.table({"vec_id": pa.array(range(len(wanted))), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * len(wanted), pa.int32())}), f"{tmp_path}/embeddings.parquet")
    same(queries.QUERIES["blur_histogram"](spark, str(tmp_path)), con, queries.SQL["blur_histogram"])


def test_pixels_are_made_by_more_than_one_task(spark, data):
    """Slides are one small file, read by one task."""
    assert queries.pixels(spark, data).selectExpr("spark_partition_id() AS p").distinct().count() > 1


def test_otsu_takes_the_first_of_bins_that_are_exactly_equal(spark):
    """Supplier 109 of sf0.1: bin 127 is empty, so what is told apart at 126 and 127 is the same; compared in rational numbers."""
    from fractions import Fraction

    from pyspark.sql import functions as F

    from tessera.operators import mask

    v = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").where("l_suppkey = 109").select(F.lit(0).alias("k"), F.col("l_extendedprice").alias("v"))
    values = [r.v for r in v.collect()]
    low, high = min(values), max(values)
    n = [0] * 256
    for x in values:
        n[min(255, int((x - low) / (high - low) * 256))] += 1
    c = [Fraction(low) + (Fraction(i) + Fraction(1, 2)) * (Fraction(high) - Fraction(low)) / 256 for i in range(256)]
    between = []
    for i in range(255):
        w, s = sum(n[: i + 1]), sum(a * b for a, b in zip(n[: i + 1], c))
        u, t = sum(n[i + 1 :]), sum(a * b for a, b in zip(n[i + 1 :], c[i + 1 :]))
        between.append(w * u * (s / w - t / u) ** 2)
    first = between.index(max(between))
    assert between[first] == between[first + 1] and n[first + 1] == 0
    assert abs(mask.otsu(v, "k", "v").first().threshold - float(c[first])) < 1e-6


@pytest.mark.parametrize("name", ("tissue_ratio_sat", "qc_sample", "reconstruct_pixels", "reconstruct_marks", "summary_report"))
def test_sizes_of_slides_are_not_broadcast(spark, data, name):
    assert not _broadcast_rows(queries.QUERIES[name](spark, data))


def test_steps_of_the_pipeline_broadcast_no_more_rows_than_slides(spark, data, monkeypatch):
    """The tables that the whole plan keeps on its way, not its result alone; masks are made without joins."""
    from tessera import session

    kept = []

    def stored(df, *by):
        kept.append(df)
        return df.localCheckpoint()

    monkeypatch.setattr(session, "stored", stored)
    queries.valid_tiles_pipeline(spark, data)
    assert len(kept) == 3 and "Join" not in kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert max((n for df in kept for n in _broadcast_rows(df)), default=0) <= spark.read.parquet(f"{data}/supplier.parquet").count()


def test_the_pipeline_broadcasts_no_slides(spark, data, monkeypatch):
    """Neither the tables that it keeps nor its summary send a row a slide through the driver."""
    from tessera import session

    kept = []

    def stored(df, *by):
        kept.append(df)
        return df.localCheckpoint()

    monkeypatch.setattr(session, "stored", stored)
    kept.append(queries.valid_tiles_pipeline(spark, data))
    assert len(kept) == 4 and not [n for df in kept for n in _broadcast_rows(df)]
