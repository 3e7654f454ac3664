"""Line dedup over levelled sorted runs of line hashes.

A run is a table of line hashes in hash order, with the number of documents that hold each line and the largest
of their ids, written in buckets by line that are sorted. Documents come in batches; a batch is counted into such a
table of its own, which merge-anti-joins the runs one by one without moving a row of either, and adds the lines it
brings as a run of level 0, while what it adds to lines already met is kept as a tally. When a level has `fanout` runs they are
merged into one run of the next level, so a line is rewritten once a level and there are few runs to join. The
runs hold 16-byte hashes of lines, never the lines, and lines are counted before they are dealt out by line.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .shared import bucketed, partitions, picked, sorted_buckets, stored, trimmed, without

_STRIP = " \t\n\x0b\x0c\r"
_LOWER = {i: i + 32 for i in range(65, 91)}


def line_key(line: str) -> str:
    return line.strip(_STRIP).translate(_LOWER)


def _hashed(line: str, least: int) -> bytes | None:
    """The hash of a line's key, if the key has at least so many code points."""
    if len(line) < least:
        return None
    key = line.strip(_STRIP)
    if len(key) < least:
        return None
    # A-Z only: as bytes, lower() leaves all others alone
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


def _lines(least: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, at = [], [], []
            for one, text, place in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("at").to_pylist(), strict=True):
                own = {_hashed(x, least) for x in (text.as_py() or "").split("\n")}
                own.discard(None)
                keys += own
                ids += [one] * len(own)
                at += [place] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(at, pa.int64())], ["line", "doc_id", "at"])

    return run


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


class LineRuns:
    """The lines met so far, in runs stored in the shared scratch folder, bucketed and sorted by line. No line is in two runs; what later batches add to a line they don't bring stands in `tallies`."""

    def __init__(self, fanout: int = 4) -> None:
        self.fanout, self.levels, self.tallies = fanout, [], []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run, _ in level]

    def _plain(self) -> list[DataFrame]:
        return [plain for level in self.levels for _, plain in level]

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(bucketed(run, "line"))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = _union([plain for _, plain in self.levels[level]]), []
            self._put(merged.repartition(partitions(merged.sparkSession), "line"), level + 1)

    def add(self, lines: DataFrame) -> None:
        """Adds a batch of distinct (line, doc_id); all rows of a document are in one batch."""
        own = lines.groupBy("line").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last"))
        runs = [run.select("line").hint("merge") for run in self.runs()]
        with sorted_buckets(lines.sparkSession):
            if runs:
                own, _ = bucketed(own, "line")
                self.tallies.append(stored(_union([own.join(run, "line", "left_semi") for run in runs])))
                for run in runs:
                    own = own.join(run, "line", "left_anti")
            self._put(own, 0)

    def common(self, least_docs: int) -> DataFrame:
        """(line, n_docs, last) of the lines that so many documents hold."""
        return _union([*self._plain(), *self.tallies]).groupBy("line").agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last")).where(F.col("n_docs") >= least_docs)


def _drop(least: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(b.column("text"), b.column("drop"), strict=True):
                lines = (text.as_py() or "").split("\n")
                n_lines.append(len(lines))
                if drop.is_valid:
                    gone = set(drop.as_py())
                    lines = [x for x in lines if _hashed(x, least) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append("\n".join(lines))
            yield pa.RecordBatch.from_arrays([b.column("held"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], ["held", "text", "n_lines", "n_dropped"])

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3, batches: int = 4, fanout: int = 4) -> DataFrame:
    """docs with lines that recur dropped from the text, and __n_lines (before) and __n_dropped.

    A line's key is the line without [\\x20\\x09-\\x0D] at its ends and with A-Z in lower case. Lines whose key has at
    least least_chars code points and is found in at least least_docs documents go, except in the document of the
    largest id that holds it (there, all of them stay). A null or empty text is one empty line and becomes the empty
    text; very long texts and lines are read whole. Rows with the same id are one document that holds the lines of all;
    rows with a null id share one document of no id, which is smaller than any other, and loses lines only where a
    document with an id has them too (each such row meets its own lines only, however many rows there are). An empty
    table gives an empty result. Other columns pass through, whatever their names, but those called as the two new ones.
    """
    docs = without(docs, "__n_lines", "__n_dropped")
    none = F.lit(-(1 << 63))
    keyed = lambda one, text: F.when(one.isNull(), F.xxhash64(text)).otherwise(0).alias("at")
    plain = picked(docs, doc_id=id_col, text=text_col)
    plain = plain.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("at", keyed(F.col("doc_id"), F.col("text")))
    lines = plain.mapInArrow(_lines(least_chars), "line binary, doc_id long, at long").distinct()
    lines = lines.withColumn("doc_id", F.coalesce("doc_id", none))
    lines = stored(lines.withColumn("batch", F.expr(f"pmod(hash(doc_id), {batches})")), "batch")
    runs = LineRuns(fanout)
    for k in range(batches):
        own = lines.where(F.col("batch") == k)
        runs.add(own.where(F.col("doc_id") != none).select("line", "doc_id").union(own.where(F.col("doc_id") == none).select("line", "doc_id").distinct()))
    common = stored(runs.common(least_docs))
    drop = lines.join(common.select("line", "last"), "line").where("doc_id <> last")
    drop = drop.groupBy(F.col("doc_id").alias("of"), F.col("at").alias("of_at")).agg(F.collect_set("line").alias("drop"))
    others = [c for c in docs.columns if c != text_col]
    one, text = docs[f"`{id_col}`"].cast("long"), docs[f"`{text_col}`"].cast("string")
    held = F.struct(F.lit(0).alias("c"), *(docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(others))).alias("held")
    full = docs.select(held, text.alias("text"), F.coalesce(one, none).alias("id"), keyed(one, text))
    full = full.join(drop, (F.col("id") == F.col("of")) & (F.col("at") == F.col("of_at")), "left").select("held", "text", "drop")
    shape = StructType([full.schema["held"], StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    out = full.mapInArrow(_drop(least_chars), shape)
    place = {c: f"held.c{i}" for i, c in enumerate(others)}
    return out.select(*(F.col(place.get(c, "text")).alias(c) for c in docs.columns), F.col("n_lines").alias("__n_lines"), F.col("n_dropped").alias("__n_dropped"))
