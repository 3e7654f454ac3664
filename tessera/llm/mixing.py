"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Targets: each source should get its weight's share of the budget, but at most `epochs` times its size. With
sources ordered by size / weight, those that reach the cap come first; the level of the others is the rest of the
budget over the rest of the weight. That is where repeated clamping and sharing of the excess ends, found by two
running sums over one row a source.

Sampling: target / size = whole + fraction. Each document is taken `whole` times; the fraction goes to the documents
of least seeded hash of id and text until the source's target is met. To find where that is without sorting a source,
sizes are summed by the top bits of the hash, a running sum finds the one bucket that crosses, the same follows with
the next bits inside that bucket, and only the few documents left are put in order. Rows that agree in id and text
have one hash: they are one group with a count, of which the source takes so many as fit. The words then still missing
are filled by the one document left whose size is nearest to them. Which rows of a group those are is told by a number
for each row: its place in its partition, and the group's rows in the partitions before.

So whether a row is taken follows from its hash and from one row a source, and no text travels for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that a level decides, and levels.
BUCKET_BITS, LEVELS = 12, 2
#: Tables of a row a source are broadcast up to so many rows, about a megabyte.
FEW_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, budget_percent: int = 150, epochs: int = 2) -> DataFrame:
    """sources (source, source_size, weight) with target.

    Sources of size 0 have target 0. Sources of equal size a weight are taken in code point order, null last. An empty
    table gives an empty result. It holds a row a source and is put in order by one task.
    """
    w = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    # the running sums: what sources up to here get when capped, and the weight of those from here on
    run = sources.withColumn("cap", F.col("source_size") * epochs)
    every = run.agg(F.sum("weight").alias("weights"), (F.sum("source_size") * budget_percent / 100.0).alias("budget"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    run = run.crossJoin(F.broadcast(every)).select("*", F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"), F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("gone"))
    run = run.withColumn("level", (F.col("budget") - F.col("capped")) / (F.col("weights") - F.col("gone")))
    run = run.withColumn("is_capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # the level of the first source that is not capped holds for all after it
    level = run.where("not is_capped").agg(F.max_by("level", -F.col("source_size") / F.col("weight")).alias("common"), F.min(F.col("source_size") / F.col("weight")).alias("least"))
    out = run.crossJoin(F.broadcast(level))
    return out.select("source", "source_size", "weight", F.when(F.col("is_capped"), F.col("cap").cast("double")).otherwise(F.col("common") * F.col("weight")).alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _few(table: DataFrame, rows: int | None = None) -> DataFrame:
    """A table of a row or two a source: broadcast where there are few, so no document need travel to meet its own."""
    return F.broadcast(table) if (table.count() if rows is None else rows) <= FEW_SOURCES else table


def _digit(draw: str, level: int) -> Column:
    return F.shiftrightunsigned(draw, 64 - BUCKET_BITS * (level + 1)).bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    """What sampling reads of a row: id, source, size and the seeded hash of id and text."""
    col = lambda c: docs[f"`{c}`"]
    draw = F.xxhash64(F.coalesce(col(id_col).cast("long"), F.lit(-1)), F.xxhash64(col(text_col)), F.lit(seed))
    return [col(id_col).cast("long").alias("doc_id"), col(source_col).alias("source"), word_count(col(text_col)).alias("size"), draw.alias("draw")]


def _plan(sized: DataFrame, weights: Sequence[int], budget_percent: int, epochs: int) -> tuple[DataFrame, DataFrame]:
    """(plan, some): a row a source with its target, whole repetitions and the hash's top bits where the fraction ends; and the groups of which some rows are taken once more, with their number."""
    buckets = stored(sized.groupBy("source", _digit("draw", 0).alias("bucket")).agg(F.sum("size").alias("words")))
    sources = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    sources = sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn))
    plan = targets(sources, budget_percent, epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.least(F.floor(ratio + F.lit(1e-12)), F.lit(epochs)))
    plan = stored(plan.withColumn("extra", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))).withColumnRenamed("source", "of").drop("weight"))
    n = plan.count()
    # level by level, the bucket in which the running sum of words passes what the source lacks
    at = plan.where("extra > 0").select("of", F.col("extra").alias("rest"), F.lit(0).cast("long").alias("cut"))
    close = sized
    for level in range(LEVELS):
        if level:
            digit = _digit("draw", level)
            buckets = stored(close.groupBy("source", digit.alias("bucket")).agg(F.sum("size").alias("words")))
        running = Window.partitionBy("source").orderBy("bucket")
        upto = buckets.withColumn("upto", F.sum("words").over(running)).join(at, _same("source", "of")).where("upto > rest")
        first = upto.groupBy("of").agg(F.min("bucket").alias("bucket"), F.min_by("upto", "bucket").alias("upto"), F.min_by("words", "bucket").alias("words"), F.first("rest").alias("rest"), F.first("cut").alias("cut"))
        at = stored(first.select("of", (F.col("rest") - (F.col("upto") - F.col("words"))).alias("rest"), (F.col("cut") * (1 << BUCKET_BITS) + F.col("bucket")).alias("cut")))
        inside = F.shiftrightunsigned("draw", 64 - BUCKET_BITS * (level + 1)) == F.col("cut")
        close = stored(close.join(_few(at, n), _same("source", "of")).where(inside).select("doc_id", "source", "size", "draw"))
    plan = stored(plan.join(at.select(F.col("of").alias("s"), "cut", "rest"), _same("of", "s"), "left").drop("s"))
    # the documents of the last bucket one by one; rows that agree in all of this are a group
    groups = close.groupBy("source", "draw", "doc_id", "size").agg(F.count("*").alias("n"))
    in_order = Window.partitionBy("source").orderBy("draw", "doc_id", "size")
    groups = groups.withColumn("before", F.sum(F.col("n") * F.col("size")).over(in_order) - F.col("n") * F.col("size"))
    groups = groups.join(_few(at.select("of", "rest"), n), _same("source", "of"))
    fits = F.when(F.col("size") > 0, F.floor((F.col("rest") - F.col("before")) / F.col("size"))).otherwise(0)
    groups = groups.withColumn("takes", F.greatest(F.lit(0), F.least(F.col("n"), fits))).select("source", "draw", "doc_id", "size", "n", "takes", "rest")
    # after the first group of which not all fits nothing more is taken but the one document that fills the gap best
    order = F.struct("draw", "doc_id", "size")
    stop = groups.where("takes < n AND size > 0").groupBy(F.col("source").alias("of")).agg(F.min(order).alias("stop"))
    groups = groups.join(_few(stop, n), _same("source", "of"), "left").drop("of")
    groups = stored(groups.withColumn("takes", F.when(F.col("stop").isNull() | (order <= F.col("stop")), F.col("takes")).otherwise(0)).drop("stop"))
    gaps = groups.groupBy(F.col("source").alias("of")).agg((F.first("rest") - F.sum(F.col("takes") * F.col("size"))).alias("gap"))
    left = sized.select("source", "draw", "doc_id", "size").join(_few(plan.where("extra > 0").select("of", "cut"), n), _same("source", "of"))
    left = left.where(F.shiftrightunsigned("draw", 64 - BUCKET_BITS * LEVELS) > F.col("cut")).drop("of", "cut")
    left = left.unionByName(groups.where("takes < n").select("source", "draw", "doc_id", "size")).join(_few(gaps, n), _same("source", "of")).drop("of")
    fill = left.groupBy("source").agg(F.min_by(F.struct("draw", "doc_id", "size", "gap"), F.struct(F.abs(F.col("size") - F.col("gap")), F.col("draw"), F.col("doc_id"))).alias("f")).select("source", "f.*").where("abs(size - gap) < gap")
    some = groups.where("takes > 0").select("source", "draw", "doc_id", "size", "takes").unionByName(fill.select("source", "draw", "doc_id", "size", F.lit(1).cast("long").alias("takes")))
    some = some.groupBy("source", "draw", "doc_id", "size").agg(F.sum("takes").alias("takes"))
    return plan.drop("rest"), stored(some)


def _copies(rows: DataFrame, plan: DataFrame, some: DataFrame, epochs: int) -> DataFrame:
    """rows (`key`, a struct of doc_id, source, size and draw, and others) with `plan`'s source_size and target, and copies."""
    some = some.select(F.struct("source", "draw", "doc_id", "size").alias("group"), "takes")
    key = F.struct("key.source", "key.draw", "key.doc_id", "key.size")
    rows = rows.join(_few(plan), F.col("key.source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.join(_few(some), key.eqNullSafe(F.col("group")), "left").drop("group")
    below = F.shiftrightunsigned("key.draw", 64 - BUCKET_BITS * LEVELS) < F.col("cut")
    copies = lambda more: F.least(F.col("whole") + more, F.lit(epochs)).cast("int").alias("copies")
    plain = rows.where("takes IS NULL").withColumn("copies", copies(F.when(below, 1).otherwise(0)))
    # rows of the groups that are taken in part get numbers, a partition at a time
    some_rows = stored(rows.where("takes IS NOT NULL").withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33)
    held = some_rows.groupBy("key", part.alias("part")).agg(F.count("*").alias("n"))
    held = held.select(F.col("key").alias("k"), F.col("part").alias("p"), (F.sum("n").over(Window.partitionBy("key").orderBy("part")) - F.col("n")).alias("earlier"))
    numbered = some_rows.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("key", "part").orderBy("row")))
    numbered = numbered.join(_few(held), F.col("key").eqNullSafe(F.col("k")) & (F.col("part") == F.col("p"))).withColumn("copies", copies(F.when(F.col("place") + F.col("earlier") <= F.col("takes"), 1).otherwise(0)))
    return plain.unionByName(numbered.select(*plain.columns))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (5, 2, 1), budget_percent: int = 150, epochs: int = 2, seed: int = 20) -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, copies.

    Size is the number of words of the whole text, however long (0 for null, empty or white texts, which are taken like
    any other and add nothing). Sources in code point order, null last and a source like any other, get the weights in
    turn. Rows without an id are told apart by their text. Rows that agree in id and text are a group, of which some may
    be taken once more than others; they are equal in this result, so it doesn't show which. Ties of the hash go to the
    smaller id. A source's words come within half of one document of its target where a document of the size of the gap
    is left, and never further than one document. An empty table gives an empty result; further columns are ignored.
    """
    sized = stored(docs.select(*_sized(docs, id_col, text_col, source_col, seed)))
    plan, some = _plan(sized, weights, budget_percent, epochs)
    out = _copies(sized.select(F.struct("doc_id", "source", "size", "draw").alias("key")), plan, some, epochs)
    return out.select("key.doc_id", "key.source", "key.size", "source_size", "target", "copies")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (5, 2, 1), budget_percent: int = 150, epochs: int = 2, seed: int = 20) -> DataFrame:
    """docs with each row as often as the mix takes it, and none that it doesn't take; nulls, ties and repeated rows as in `mixed`.

    Columns may have any names. A row's columns stay together; where rows agree in id and text but not in others, which
    of them is taken once more than the others follows their order in the table. Texts aren't shuffled.
    """
    sized = stored(docs.select(*_sized(docs, id_col, text_col, source_col, seed)))
    plan, some = _plan(sized, weights, budget_percent, epochs)
    rows = docs.select(F.struct(*(docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("held"), F.struct(*_sized(docs, id_col, text_col, source_col, seed)).alias("key"))
    rows = _copies(rows, plan, some, epochs).where("copies > 0").select("held", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return rows.select(*(F.col(f"held.c{i}").alias(c) for i, c in enumerate(docs.columns)))
