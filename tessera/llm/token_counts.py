"""Token counts from an exact histogram of encoded lengths.

Each document is encoded once and only its length leaves the task: documents are counted by (group, length) before the
shuffle. The histogram has a row a length, not a document, and suffix sums over it answer every question about context
limits exactly: how many documents exceed a limit, how many tokens are left when all are cut at it, and quantiles.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import picked, stored, trimmed

VOCABULARY = "byte_bpe_50k.tiktoken"
_LOADED: dict = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encoder(path: str):
    """A tiktoken encoding from a rank file; loaded once in each Python worker."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def _lengths(path: str | None, name: str):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, found = encoder(path or vocabulary_path(name)), Counter()
        for b in batches:
            for group, text in zip(b.column("grp").to_pylist(), b.column("text"), strict=True):
                found[group, len(encoding.encode_ordinary(text.as_py() or ""))] += 1
        rows = list(found.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int64()), pa.array([n for _, n in rows], pa.int64())], ["grp", "n_tokens", "docs"])

    return run


#: Totals of a row a group are broadcast up to so many groups, a few megabytes.
FEW_GROUPS = 50_000


def length_histogram(docs: DataFrame, text_col: str = "text", group_col: str | None = "source", path: str | None = None, name: str = VOCABULARY) -> DataFrame:
    """(grp, n_tokens, docs): how many documents of each group have each encoded length.

    Null and empty texts have length 0; very long ones are encoded whole. A null group is a group. Repeated rows count as
    often as they occur; there are no ties. An empty table gives an empty result. Other columns are ignored, whatever their names.
    path is the vocabulary's file, the same on all machines; without one, the file `name` of the installed public set.
    """
    rows = picked(docs, text=text_col, **({"grp": group_col} if group_col else {}))
    rows = rows.select(F.col("grp").cast("string") if group_col else F.lit(None).cast("string").alias("grp"), F.col("text"))
    return rows.mapInArrow(_lengths(path, name), "grp string, n_tokens long, docs long").groupBy("grp", "n_tokens").agg(F.sum("docs").alias("docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """For each group, and for all groups together (is_total), a row for each length met, taken as a context limit:

    docs of just that length; docs_over (longer ones) and docs_within; tokens_total of the group; tokens_within (of
    documents within the limit) and tokens_truncated (left when every document is cut at the limit); quantile, the share
    of documents within. A null group is a group. Null and empty texts have length 0. No documents give no rows.
    """
    one = histogram.select("grp", F.lit(False).alias("is_total"), "n_tokens", "docs")
    every = histogram.groupBy("n_tokens").agg(F.sum("docs").alias("docs")).select(F.lit(None).cast("string").alias("grp"), F.lit(True).alias("is_total"), "n_tokens", "docs")
    down = Window.partitionBy("is_total", "grp").orderBy(F.desc("n_tokens"))
    tokens = F.col("n_tokens") * F.col("docs")
    # suffix sums from the longest length; a frame over all of a group isn't needed, its ends are the sums at length least
    out = one.union(every).select("*", F.sum("docs").over(down).alias("docs_from"), F.sum(tokens).over(down).alias("tokens_from"))
    whole = out.groupBy("is_total", "grp").agg(F.max("docs_from").alias("docs_total"), F.max("tokens_from").alias("tokens_total")).withColumnsRenamed({"is_total": "t", "grp": "g"})
    whole = F.broadcast(whole) if one.select("grp").distinct().count() <= FEW_GROUPS else whole  # groups may be many, as domains are
    out = out.join(whole, (F.col("is_total") == F.col("t")) & F.col("grp").eqNullSafe(F.col("g")))
    over, within = F.col("docs_from") - F.col("docs"), F.col("tokens_total") - F.col("tokens_from") + tokens
    return out.select("grp", "is_total", "n_tokens", "docs", over.alias("docs_over"), (F.col("docs_total") - over).alias("docs_within"), "tokens_total", within.alias("tokens_within"), (within + over * F.col("n_tokens")).alias("tokens_truncated"), ((F.col("docs_total") - over) / F.col("docs_total")).alias("quantile"))


def quantile_length(table: DataFrame, q: float) -> DataFrame:
    """(grp, is_total, n_tokens): the least length that at least a share q of the group's documents keep within."""
    return table.where(F.col("quantile") >= q).groupBy("grp", "is_total").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, **how) -> DataFrame:
    """`context_table` of `length_histogram`; nulls, repeated rows and empty tables as there."""
    return context_table(stored(length_histogram(docs, **how)))
