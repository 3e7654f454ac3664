"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct word shingles. Two sets A and B link when
100 * |A n B| >= threshold * |A u B|. Under any one order of all shingles, linked sets share a shingle
among their first n - ceil(threshold * n / 100) + 1 (the prefix), so only sets that share a prefix
shingle can link. The steps:

1. `ids`: size and fingerprint of every set; equal sets are one from here on (`gid`), and shingles met
   often within a batch are noted.
2. The order of shingles: rare first. The frequent ones (in over 1 of 500 documents; a bounded list) come
   last and are never dealt out, so no shingle that goes through a shuffle belongs to more than a small
   share of the documents. Half of the rest is counted exactly: packed lists of shingles go to buckets of
   the hash range and only those found in two sets or more come back.
3. A set whose prefix is full of shingles that no other set has can't link with anything and is done.
   That is most of them. Only the others are read again.
4. Sets with the same prefix and size form a group.
5. Rounds that join most of what links: each set goes once to a cell, by the least hash of its prefix, so near copies
   meet. A cell holds at most `block` sets and BLOCK_BYTES, about; a prefix that many sets share is dealt over many
   cells. A cell filters pairs of groups by size and position, then expands and verifies members against each other.
   Members already joined aren't compared, so thousands of copies cost a few comparisons each.
6. The exact rest: only prefix shingles that still stand in two classes or more matter. Groups of different classes that
   share one are paired under the size and position filters, a shingle of many groups in cells of two blocks each; the
   groups of a pair are expanded and their members verified one by one.

The order and the rounds decide speed only: whatever they are, each linked pair is compared or already joined.
Shingles are told by 64-bit hashes. Sets are told by 128 bits: should two different sets have one 64-bit identifier, which
is counted, all are identified anew under another seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .shared import components, partitions, picked, stored, trimmed

#: A shingle in more than one of so many documents is frequent; at most FREQUENT_MOST of them are listed.
FREQUENT_ONE_IN, FREQUENT_MOST = 500, 1 << 18
#: The bit map of documents left has so many bits (8 MB); it tells fewer apart as it fills, which costs transfers, not results.
MAP_BITS = 26
#: About the most bytes of sets in a cell, and counted shingles in a bucket.
BLOCK_BYTES, BUCKET_TOKENS = 16 << 20, 4 << 20
_LOW40 = np.uint64((1 << 40) - 1)
_TOP = np.uint64(1 << 63)


def prefix_length(n: int, threshold: int) -> int:
    return n - -(-threshold * n // 100) + 1


def _identity(sets: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """A 64-bit fingerprint of each set; those of different seeds are independent."""
    flat = words.mix(np.concatenate([*sets, np.zeros(1, np.uint64)]) + np.uint64(seed * 0xD1B54A32D192ED03 & (1 << 64) - 1))
    total = np.concatenate([[np.uint64(0)], np.cumsum(flat, dtype=np.uint64)])
    ends = np.cumsum([len(s) for s in sets])
    starts = ends - np.array([len(s) for s in sets])
    return words.mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], most: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about `most` bytes."""
    for b in batches:
        _, at = words.buffers(b.column("text"))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            yield b.slice(i, j - i)
            i = j


def _ids(n_words: int, seed: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            sets = words.shingle_sets(b.column("text"), n_words)
            gid, n = _identity(sets, seed), np.array([len(s) for s in sets], np.int64)
            counted = np.array([np.count_nonzero(s < _TOP) for s in sets], np.int64)
            _, first = np.unique(gid, return_index=True)
            token, times = np.unique(np.concatenate([sets[i] for i in first]), return_counts=True)
            often = times >= max(2, len(first) / (2 * FREQUENT_ONE_IN))
            token, times = token[often].view(np.int64), times[often]
            k = len(token)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([b.column("doc_id").cast(pa.int64()), pa.nulls(k, pa.int64())]),
                    pa.array(np.concatenate([gid, token])),
                    pa.array(np.concatenate([n, np.full(k, -1)])),
                    pa.array(np.concatenate([counted, times])),
                    pa.concat_arrays([b.column("row"), pa.nulls(k, pa.int64())]),
                    pa.concat_arrays([pa.array(_identity(sets, -1 - seed)), pa.nulls(k, pa.int64())]),
                ],
                ["doc_id", "key", "n", "counted", "row", "other"],
            )

    return run


def _bucket(token: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket (of under 2^23) of shingles under 2^63, by their top bits."""
    return (((token >> np.uint64(31)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _deal(n_words: int, frequent, buckets: int, seed: int):
    """Counted shingles packed by bucket: set ids, how many shingles each has here, and the low 40 bits of those. Buckets under 0 hold how many of a set's counted shingles are frequent."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for b in _slices(batches, 2 << 20):
            sets = words.shingle_sets(b.column("text"), n_words)
            gid, first = np.unique(_identity(sets, seed), return_index=True)
            sets = [s[: np.searchsorted(s, _TOP)] for s in (sets[i] for i in first)]
            token = np.concatenate([*sets, np.empty(0, np.uint64)])
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            if len(often):
                known = often[np.minimum(np.searchsorted(often, token), len(often) - 1)] == token
                held = np.bincount(owner[known], minlength=len(sets))
                token, owner = token[~known], owner[~known]
            else:
                held = np.zeros(len(sets), np.int64)
            bucket = _bucket(token, buckets)
            order = np.argsort(bucket * len(sets) + owner, kind="stable")
            token, owner, bucket = token[order], owner[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            keys, bodies = [], []
            for k in np.flatnonzero(np.diff(cuts)):
                own, count = np.unique(owner[cuts[k] : cuts[k + 1]], return_counts=True)
                low = np.ascontiguousarray(token[cuts[k] : cuts[k + 1]]).view(np.uint8).reshape(-1, 8)[:, :5]
                keys.append(int(k))
                bodies.append(np.int64(len(own)).tobytes() + gid[own].tobytes() + count.astype(np.int32).tobytes() + low.tobytes())
            some = np.flatnonzero(held)
            if len(some):
                keys.append(-1 - int(words.mix(gid[some[:1]].view(np.uint64))[0] % np.uint64(buckets)))
                bodies.append(np.int64(len(some)).tobytes() + gid[some].tobytes() + held[some].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(bodies, pa.binary())], ["bucket", "body"])

    return run


def _count(table: pa.Table) -> pa.Table:
    """The shingles of a bucket that two sets or more have, with the number of sets; or the frequent ones of each set."""
    bucket, gids, counts, lows = table.column("bucket")[0].as_py(), [], [], []
    for body in table.column("body").to_pylist():
        k = int(np.frombuffer(body, np.int64, 1)[0])
        gids.append(np.frombuffer(body, np.int64, k, 8))
        counts.append(np.frombuffer(body, np.int32, k, 8 + 8 * k))
        lows.append(np.frombuffer(body, np.uint8, -1, 8 + 12 * k) if len(body) > 8 + 12 * k else np.empty(0, np.uint8))
    gid, count = np.concatenate(gids), np.concatenate(counts).astype(np.int64)
    if bucket < 0:
        gid, first = np.unique(gid, return_index=True)
        return pa.table({"gid": gid, "token": np.full(len(gid), -1), "df": count[first]})
    token = np.zeros((sum(len(x) for x in lows) // 5, 8), np.uint8)
    token[:, :5] = np.concatenate(lows).reshape(-1, 5)
    token, gid = token.view(np.uint64)[:, 0].astype(np.int64), np.repeat(gid, count)
    order = np.lexsort((gid, token))
    token, gid = token[order], gid[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (gid[1:] != gid[:-1])
    token, gid = token[fresh], gid[fresh]
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.empty(0, np.int64)
    df = np.diff(np.append(starts, len(token)))
    df = np.repeat(df, df)
    return pa.table({"gid": gid[df > 1], "token": token[df > 1] + (bucket << 40), "df": df[df > 1]})


def _prefixes(n_words: int, threshold: int, frequent, buckets: int):
    """The prefix of each set left, without shingles known to be its own, and the group: a hash of the whole prefix and the size."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for b in _slices(batches, 2 << 20):
            sets = words.shingle_sets(b.column("text"), n_words)
            groups, prefixes = [], []
            lists = b.column("shared")
            cuts, every = lists.offsets.to_numpy(), [lists.values.field(c).to_numpy(zero_copy_only=False) for c in ("token", "df")]
            for s, i, j in zip(sets, cuts[:-1], cuts[1:], strict=True):
                known = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s if len(often) else np.zeros(len(s), bool)
                rank = np.where(known, 2, np.where(s >= _TOP, 1, 0))
                df = np.zeros(len(s), np.int64)
                if j > i:
                    tokens, dfs = (x[i:j] for x in every)
                    order = np.argsort(tokens)
                    # as the buckets know them: the bucket and the low 40 bits
                    tokens, dfs, known_as = tokens[order], dfs[order], (_bucket(s & ~_TOP, buckets) << 40) + (s & _LOW40).astype(np.int64)
                    at = np.minimum(np.searchsorted(tokens, known_as), len(tokens) - 1)
                    df = np.where((rank == 0) & (tokens[at] == known_as), dfs[at], 0)
                order = np.lexsort((s, s & _LOW40, df, rank))[: prefix_length(len(s), threshold)]
                groups.append(words.mix(np.array([np.add.reduce(words.mix(s[order] + np.arange(len(order), dtype=np.uint64))) + np.uint64(len(s))]))[0])
                at = np.flatnonzero((rank[order] > 0) | (df[order] > 0))
                prefixes.append((s[order][at].view(np.int64), at.astype(np.int64)))
            ends = pa.array(np.cumsum([0, *(len(at) for _, at in prefixes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("gid"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(groups, np.uint64).view(np.int64)),
                    *(pa.ListArray.from_arrays(ends, np.concatenate(x)) for x in zip(*prefixes, strict=True)),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["gid", "n", "grp", "prefix", "places", "members"],
            )

    return run


def _marked(marks):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy()
            b = b.filter(pa.array(marks.value[h >> 6] >> (h & 63) & 1 == 1))
            yield b.select(["one", "row", "text"])

    return run


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))


def linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    if threshold * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    both = overlap(a, b)
    return 100 * both >= threshold * (len(a) + len(b) - both)


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _verify(threshold: int):
    """Links within a cell: (gid, root) with root the smallest gid joined to it here."""

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("gid").to_numpy(), table.column("grp").to_numpy(), table.column("n").to_numpy()))
        table = table.take(pa.array(order))
        gid, n, grp, root = (table.column(c).to_numpy() for c in ("gid", "n", "grp", "root"))
        prefix, places = table.column("prefix").to_pylist(), table.column("places").to_pylist()
        members = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
        forest, met = _Forest(len(gid)), {}
        for i, r in enumerate(root):
            j = met.setdefault(int(r), i)
            forest.up[i] = forest.top(j)
        groups: list[list[int]] = []
        for i in range(len(gid)):
            if i and n[i] == n[i - 1] and grp[i] == grp[i - 1]:
                groups[-1].append(i)
            else:
                groups.append([i])

        def compare(i: int, others: list[int]) -> None:
            """Joins i to every class among others that it links with; one link to a class is enough."""
            own, kinds = forest.top(i), {}
            for j in others:
                kinds.setdefault(forest.top(j), []).append(j)
            for kind, of_kind in kinds.items():
                if kind == own or forest.top(kind) == forest.top(i):
                    continue
                for j in of_kind:
                    if linked(members[i], members[j], threshold):
                        forest.up[forest.top(i)] = forest.top(j)
                        break

        lists: dict[int, list[tuple[int, int]]] = {}
        for g, own in enumerate(groups):
            size, near = int(n[own[0]]), {}
            for token, place in zip(prefix[own[0]], places[own[0]], strict=True):
                for h, there in lists.get(token, ()):
                    other = int(n[groups[h][0]])  # not over size: groups come by size
                    need = -(-threshold * (size + other) // (100 + threshold))
                    if 100 * other >= threshold * size and 1 + min(size - place, other - there) - 1 >= need:
                        near[h] = True
                lists.setdefault(token, []).append((g, place))
            others = [j for h in near for j in groups[h]]
            for k, i in enumerate(own):
                compare(i, own[:k] + others)
        least: dict[int, int] = {}
        for i in range(len(gid)):
            t = forest.top(i)
            least[t] = min(least.get(t, int(gid[i])), int(gid[i]))
        return pa.table({"gid": gid, "least": np.array([least[forest.top(i)] for i in range(len(gid))], np.int64), "root": root})

    return run


def _pairs_linked(threshold: int):
    @trimmed
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
            kept = b.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return run


def set_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, threshold: int = 80, block: int = 256, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """(ids, classes): ids has doc_id, key (the set) and n for each document; classes has (key, root) for the sets that met another."""
    spark = docs.sparkSession
    # a set's text is found again by the id of one of its rows and a hash of the text: ids may repeat or be null
    docs = picked(docs, doc_id=id_col, text=text_col).withColumn("row", F.xxhash64("text"))
    for seed in count():
        ids_and_often = stored(docs.mapInArrow(_ids(n_words, seed), "doc_id long, key long, n long, counted long, row long, other long"))
        ids = ids_and_often.where("n >= 0").drop("other")
        one = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
        sets = ids_and_often.where("n > 0").withColumn("one", one).groupBy(F.col("key").alias("gid"))
        sets = stored(sets.agg(F.min("one").alias("one"), F.min_by("row", "one").alias("row"), F.first("n").alias("n"), F.first("counted").alias("counted"), (F.min("other") != F.max("other")).alias("clash")))
        found = sets.agg(F.coalesce(F.bool_or("clash"), F.lit(False)).alias("clash"), F.coalesce(F.sum("counted"), F.lit(0)).alias("tokens")).first()
        if not found.clash:
            break
    n_docs = ids.count()
    often = ids_and_often.where("n < 0").groupBy("key").agg(F.sum("counted").alias("times")).where(F.col("times") * FREQUENT_ONE_IN >= max(n_docs, 16 * FREQUENT_ONE_IN))
    often = [r.key for r in often.orderBy(F.desc("times"), "key").limit(FREQUENT_MOST).select("key").collect()]
    frequent = spark.sparkContext.broadcast(np.sort(np.array(often, np.int64).view(np.uint64)))

    buckets = min(1 << 22, max(4 * partitions(spark), -(-found.tokens // BUCKET_TOKENS)))
    dealt = docs.mapInArrow(_deal(n_words, frequent, buckets, seed), "bucket int, body binary")
    shared = stored(dealt.groupBy("bucket").applyInArrow(_count, "gid long, token long, df long"))

    seen = shared.groupBy("gid").agg(F.sum(F.expr("if(token < 0, df, 0)")).alias("frequent"), F.sum(F.expr("if(token < 0, 0, 1)")).alias("shared"))
    need = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") / 100) + 1
    left = sets.join(seen, "gid", "left").where(F.col("counted") - F.coalesce("frequent", F.lit(0)) - F.coalesce("shared", F.lit(0)) < need)
    left = stored(left.select("gid", "one", "row"))
    lists = shared.where("token >= 0").join(left.select("gid"), "gid", "left_semi").groupBy("gid").agg(F.collect_list(F.struct("token", "df")).alias("shared"))
    # texts of other documents stay where they are: a bit map of fixed size tells most of them, the join the rest
    place = F.pmod(F.xxhash64("one", "row"), F.lit(1 << MAP_BITS))
    bits = left.select(place.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(h & 63)))").alias("bits")).collect()
    marks = np.zeros(1 << (MAP_BITS - 6), np.int64)
    marks[[r.word for r in bits]] = [r.bits for r in bits]
    near = docs.withColumn("one", one).withColumn("h", place).mapInArrow(_marked(spark.sparkContext.broadcast(marks)), "one long, row long, text string")
    texts = near.join(left.join(lists, "gid", "left"), ["one", "row"]).select("gid", "text", "shared")
    known = texts.mapInArrow(_prefixes(n_words, threshold, frequent, buckets), "gid long, n long, grp long, prefix array<long>, places array<long>, members binary")
    known = stored(known.where("n > 0").dropDuplicates(["gid"]))

    classes = None
    work = known.where(F.size("prefix") > 0)
    for turn in range(rounds):
        home = F.array_min(F.transform("prefix", lambda t: F.xxhash64(t, F.lit(turn))))  # noqa: B023
        own = _rooted(work, classes).withColumn("home", home)
        many = own.groupBy("home").agg(F.count("*").alias("k"), F.sum(F.length("members")).alias("bytes"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
        many = many.select("home", F.ceil(F.greatest(F.col("k") / block, F.col("bytes") / BLOCK_BYTES)).alias("blocks"))
        # one key for a cell, so that Spark doesn't take the join's partitioning by home for that of cells
        cell = F.xxhash64("home", F.expr(f"pmod(xxhash64(gid, {turn}), blocks)"))
        dealt = own.join(many, "home").select(cell.alias("cell"), "gid", "n", "grp", "root", "prefix", "places", "members")
        found = stored(dealt.groupBy("cell").applyInArrow(_verify(threshold), "gid long, least long, root long"))
        if classes is None:
            classes = found.selectExpr("gid AS key", "least AS root")
        else:  # what the earlier rounds joined stays joined: an edge to the class it had, and one to the least here
            edges = found.selectExpr("root AS a", "least AS b").where("a <> b")
            classes = _joined(classes, edges)
    rows = _rooted(work, classes).select("grp", "n", "root", F.explode(F.arrays_zip(F.col("prefix").alias("token"), F.col("places").alias("place"))).alias("at"))
    rows = rows.select("grp", "n", "root", "at.token", "at.place")
    open_ = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("k")).where("lo <> hi").select("token", F.ceil(F.col("k") / block).alias("blocks"))
    rows = stored(rows.join(open_, "token").distinct())
    # cells of two blocks of a shingle's groups, so no task pairs more than those
    side = F.expr("pmod(xxhash64(grp, n, root), blocks)")
    rows = rows.withColumn("side", side).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("cell", F.xxhash64("token", F.least("side", "with"), F.greatest("side", "with"))).withColumn("group", F.struct("grp", "n", "root"))
    need = F.ceil(F.lit(threshold) * (F.col("p.n") + F.col("q.n")) / (100 + threshold))
    may = (F.col("p.cell") == F.col("q.cell")) & (F.col("p.token") == F.col("q.token")) & (F.col("p.group") < F.col("q.group")) & (F.col("p.root") != F.col("q.root")) & ((F.col("p.side") != F.col("q.side")) | (F.col("p.side") == F.col("p.with")) & (F.col("q.side") == F.col("q.with")))
    may &= (threshold * F.greatest("p.n", "q.n") <= 100 * F.least("p.n", "q.n")) & (F.least(F.col("p.n") - F.col("p.place"), F.col("q.n") - F.col("q.place")) >= need)
    pairs = rows.alias("p").join(rows.alias("q"), may).select(F.col("p.group").alias("a"), F.col("q.group").alias("b")).distinct()
    members = _rooted(work, classes).select(F.struct("grp", "n", "root").alias("group"), "gid", "members")
    pairs = stored(pairs)
    if pairs.limit(1).count():
        links = pairs.join(members.select(F.col("group").alias("a"), F.col("group.root").alias("ra"), F.col("members").alias("x")), "a")
        links = links.join(members.select(F.col("group").alias("b"), F.col("group.root").alias("rb"), F.col("members").alias("y")), "b")
        links = links.select(F.col("ra").alias("a"), F.col("rb").alias("b"), "x", "y").mapInArrow(_pairs_linked(threshold), "a long, b long").distinct()
        classes = _joined(classes, links)
    return ids, classes


def _rooted(sets: DataFrame, classes: DataFrame | None) -> DataFrame:
    """sets with root, the class that each is in so far: its own gid if none."""
    if classes is None:
        return sets.withColumn("root", F.col("gid"))
    return sets.join(classes.withColumnRenamed("key", "gid"), "gid", "left").withColumn("root", F.coalesce("root", "gid"))


def _joined(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """classes (key, root) after edges between roots are followed too. Only roots meet, not the members of classes."""
    tops = stored(components(edges).withColumnRenamed("root", "top"))
    moved = classes.join(tops.withColumnRenamed("node", "root"), "root", "left").select("key", F.coalesce("top", "root").alias("root"))
    # sets that no class had so far
    fresh = tops.join(classes.select(F.col("key").alias("node")), "node", "left_anti").select(F.col("node").alias("key"), F.col("top").alias("root"))
    return stored(moved.union(fresh))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, threshold: int = 80, block: int = 256, rounds: int = 2) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Words are lower-cased (A-Z). A text of fewer than n_words words is one shingle, the whole sequence.
    Null and empty texts, and those of white space, have no shingle and link with nothing. Equal texts, and
    rows that repeat, link. A null doc_id counts as no id: such a row keeps its class but can't name it.
    Very long texts are read whole. Of equal ids the smallest names a class; there are no other ties. An empty table gives
    an empty result; further columns are ignored.
    """
    ids, classes = set_classes(docs, id_col, text_col, n_words, threshold, block, rounds)
    ids = ids.select("doc_id", "key", "n")
    # a row a set from here on; only the last join is over documents, and it can be split where a set has many copies
    sets = ids.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least")).join(classes.dropDuplicates(["key"]), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    named = sets.select("key", "root").join(least, "root").select(F.col("key").alias("k"), "component_id")
    out = ids.where("n > 0").join(named, F.col("key") == F.col("k")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.union(ids.where("n = 0").selectExpr("doc_id", "n AS n_shingles", "doc_id AS component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without near copies: of each class one row stays, of its smallest id. Where that id has several texts in the class, the one of least hash stays.

    Rows are told apart by id and text hash, so an id that repeats with texts of other classes keeps those. Rows
    without an id stay; texts without a shingle (null, empty, white) stay once for each id. An empty table gives an
    empty result. Columns may have any names.
    """
    ids, classes = set_classes(docs, id_col, text_col, **how)
    ids = ids.where("n > 0 AND doc_id IS NOT NULL").select("key", F.struct("doc_id", "row").alias("one"))
    sets = ids.groupBy("key").agg(F.min("one").alias("least")).join(classes.dropDuplicates(["key"]), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = sets.groupBy("root").agg(F.min("least").alias("stays"))
    named = sets.select("key", "root").join(least, "root").select(F.col("key").alias("k"), "stays")
    spare = ids.join(named, F.col("key") == F.col("k")).where("one <> stays").select(F.col("one.doc_id").alias("spare"), F.col("one.row").alias("spare_row")).distinct()
    held = F.struct(*(docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("held")
    rows = docs.select(held, docs[f"`{id_col}`"].cast("long").alias("one"), F.xxhash64(docs[f"`{text_col}`"]).alias("row"))
    kept = rows.join(spare, (F.col("one") == F.col("spare")) & (F.col("row") == F.col("spare_row")), "left_anti")
    kept = kept.where(F.col("one").isNotNull()).dropDuplicates(["one", "row"]).union(kept.where(F.col("one").isNull()))
    return kept.select(*(F.col(f"held.c{i}").alias(c) for i, c in enumerate(docs.columns)))
