"""Operators on documents: edge cases, brute force, and SQL."""

import hashlib
import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from helpers import database, same  # noqa: E402

from tessera.llm import jaccard_join, licences, line_dedup, mixing, pieces, pii, quality_rules, queries, shared, token_counts, words  # noqa: E402

WORDS = "the of and to thanedble ering onnt thha é reanß anwh edth le la der die".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", ",", ".\n", "", ""]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and white texts, very long ones, ties, repeated rows and columns whose names clash."""
    rng = random.Random(4)
    rows = [(i, text(rng, rng.randrange(1, 120)), "en", f"s{i % 4}", 7, i % 3) for i in range(60)]
    rows += [(100, None, None, None, None, None), (101, "", "en", "s1", 0, 1), (102, " \t\n\x0b ", "en", None, 3, 1), (103, "x" * 30_000, "en", "s1", 30_000, 1), (104, "a b " * 20_000, None, "s2", 1, 1)]
    rows += [(None, text(rng, 60), "en", "s1", 1, 1), (None, None, None, None, None, None), rows[3], rows[3], (105, rows[5][1], "en", "é", 1, 1), (106, rows[5][1].upper(), "en", "s2", 1, 1), (107, "one two", "en", "s3", 1, 1), (108, "One  two", "en", "s3", 1, 1)]
    rows += [(200 + i, "\n".join(["a line that many of the documents hold", f"own line number {i} of this one", "A LINE that many of the documents hold  ", "short"]), "en", "s0", 1, 1) for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def brute_components(rows, threshold=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


@pytest.mark.parametrize("block", [256, 8])
def test_jaccard_brute_force(spark, block):
    rng = random.Random(block)
    docs = []
    for family in range(12):
        base = [rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(rng.randrange(6, 90))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 12)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(999)}"
            docs.append(" ".join(own))
    passage = " ".join(f"p{i}" for i in range(55))
    docs += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(15)]
    rows = list(enumerate(docs))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.near_duplicates(df, block=block).collect()), key=repr)
    assert got == brute_components(rows)


def test_jaccard_names_that_clash(spark):
    df = spark.createDataFrame([(i, "a b c d e f g", i, i, i) for i in range(3)], "doc_id long, text string, __spare long, row long, one long")
    assert [tuple(r) for r in jaccard_join.one_of_each(df).collect()] == [(0, "a b c d e f g", 0, 0, 0)]
    assert {r.component_id for r in jaccard_join.near_duplicates(df).collect()} == {0}


def test_set_identities():
    sets = [np.arange(k, dtype=np.uint64) * np.uint64(77) for k in range(1, 51)]
    a, b = jaccard_join._identity(sets), jaccard_join._identity(sets, -1)
    assert len(set(a)) == len(set(b)) == 50 and not set(a) & set(b)


def test_jaccard_odd(odd, none):
    got = sorted(map(tuple, jaccard_join.near_duplicates(odd).collect()), key=repr)
    assert got == brute_components([(r.doc_id, r.text) for r in odd.collect()])
    assert jaccard_join.near_duplicates(none).count() == 0
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns and kept.where("doc_id is not null").count() == kept.where("doc_id is not null").select("doc_id").distinct().count()


def test_jaccard_ids_that_repeat_or_are_missing(spark):
    base = [f"t{i}" for i in range(60)]
    near = lambda k: " ".join(base[:k] + [f"n{k}"] + base[k + 1 :])
    rows = [(None, " ".join(base)), (5, near(3)), (5, "quite another text that shares no words at all"), (5, near(59)), (None, near(30)), (9, "z " * 9), (None, "only one of its kind here, and nameless")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.near_duplicates(df).collect()), key=repr)
    assert got == brute_components(rows)
    assert got.count((None, 56, 5)) == 2


def test_one_of_each_with_ids_that_repeat(spark):
    """Of each class one row stays; other texts of an id aren't touched by what happens to one of them."""
    base = [f"t{i}" for i in range(60)]
    near = lambda k: " ".join(base[:k] + [f"n{k}"] + base[k + 1 :])
    other, third = " ".join(f"o{i}" for i in range(30)), " ".join(f"p{i}" for i in range(30))
    rows = [(1, " ".join(base)), (5, near(3)), (5, other), (5, other), (5, third), (7, near(30)), (7, other + " more"), (9, ""), (9, None), (None, " ".join(base)), (8, third), (3, near(59)), (3, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, " ".join(base)), (5, other), (5, third), (9, ""), (9, None), (None, " ".join(base)), (3, "a b c")], key=repr)
    both = spark.createDataFrame([(2, " ".join(base)), (2, near(5)), (4, near(50))], "doc_id long, text string")
    assert jaccard_join.one_of_each(both).count() == 1


def test_jaccard_exact_threshold(spark):
    # 8 of 10 shingles shared is a link, 7 of 9 is not
    a = " ".join(f"a{i}" for i in range(13))
    df = spark.createDataFrame([(1, a), (2, " ".join(a.split()[:12]) + " x"), (3, " ".join(f"b{i}" for i in range(12))), (4, " ".join(f"b{i}" for i in range(11)) + " y")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (300, 250)]
    got = {r.node: r.root for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 300: 200, 250: 200}
    assert shared.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, data, name):
    same(queries.queries()[name](spark, data), database(data), queries.oracle_sql()[name])


def test_quality_odd(odd, none):
    rows = {(r.doc_id, r.text): r for r in quality_rules.judged(odd).collect()}
    for (_, t), r in rows.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = {}
        for i in range(len(w) - 2):
            at.setdefault(tuple(w[i : i + 3]), []).append(i)
        repeated = {p for v in at.values() if len(v) > 1 for i in v for p in (i, i + 1, i + 2)}
        m = r["__measures"]
        assert (m.n_words, m.word_chars, m.n_repeat_words, m.n_dup_lines) == (len(w), sum(map(len, w)), len(repeated), len(lines) - len(set(lines)))
        assert m.n_symbols == sum((t or "").count(c) for c in "#*$%&|<>")
        assert r["__base_failed"] == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert not (r["__base_failed"] and r["__kept"])
    assert quality_rules.kept(odd).columns == odd.columns
    assert quality_rules.judged(none).count() == 0


def test_quality_is_one_projection(odd):
    plan = quality_rules.judged(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def brute_lines(rows, least=20, docs=3):
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= least:
                held.setdefault(key, set()).add(-1 if d is None else d)
    gone = {k: max(v) for k, v in held.items() if len(v) >= docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not ((k := re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))) in gone and gone[k] != (-1 if d is None else d))]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout", [2, 4])
def test_lines(odd, none, fanout):
    out = line_dedup.dedup_lines(odd, batches=5, fanout=fanout)
    assert out.columns == [*odd.columns, "__n_lines", "__n_dropped"]
    got = sorted(((r.doc_id, r["__n_lines"], r["__n_dropped"], r.text) for r in out.collect()), key=repr)
    assert got == brute_lines([(r.doc_id, r.text) for r in odd.collect()])
    assert line_dedup.dedup_lines(none).count() == 0


def test_lines_and_quality_with_names_that_clash(spark, data):
    """Rows without an id meet their own lines only; columns may be called like an operator's own."""
    line = "a line that many of the documents hold"
    rows = [(i if i < 4 else None, f"{line}\nown line number {i} of this one", i, i, i, i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __text int, __id int, held int, at int, __kept int")
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "__n_lines", "__n_dropped"]
    got = sorted(((r.doc_id, r["__n_lines"], r["__n_dropped"], r.text) for r in out.collect()), key=repr)
    assert got == brute_lines([r[:2] for r in rows]) and all(r["__text"] == r["__id"] == r.held == r.at for r in out.collect())
    docs = spark.read.parquet(f"{data}/documents.parquet")
    clash = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(("__text", "__words", "__measures", "__kept"))))
    good = quality_rules.kept(clash)
    assert good.columns == clash.columns and good.where("__text = 0 and __measures = 2 and __kept = 3").count() == quality_rules.kept(docs).count() > 0
    assert quality_rules.judged(clash).where("__kept").count() == good.count()


def test_line_runs_hold_each_line_once(spark):
    runs = line_dedup.LineRuns(fanout=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(bytearray([x]), 10 * k + x) for x in range(k, k + 4)], "line binary, doc_id long"))
    held = [bytes(r.line) for run in runs.runs() for r in run.collect()]
    assert len(held) == len(set(held)) == 8 and len(runs.runs()) <= 3
    assert {bytes(r.line)[0]: (r.n_docs, r["last"]) for r in runs.common(3).collect()} == {x: (4 if x in (3, 4) else 3, 10 * min(x, 4) + x) for x in range(2, 6)}


def brute_targets(sizes, weights, percent, cap):
    t, open_, left = {}, set(sizes), sum(sizes.values()) * percent / 100
    while open_:
        w = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / w >= cap * sizes[s]]
        if not over:
            return t | {s: left * weights[s] / w for s in open_}
        for s in over:
            t[s] = float(cap * sizes[s])
        left -= sum(t[s] for s in over)
        open_ -= set(over)
    return t


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, odd, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 200)), None if s == 7 else f"s{s}") for i, s in enumerate(rng.choices(range(8), weights=[40, 1, 5, 9, 2, 30, 3, 6], k=900))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(df).collect()
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 150, 2)
    taken, largest = {}, {}
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert len(out) == len(rows) and all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mixed(df.repartition(3)).collect()))


def near_targets(out):
    """Each source's taken words come within one document of its target, and no row is taken more than twice."""
    taken, target, largest = {}, {}, {}
    for r in out.collect():
        taken[r.source], target[r.source] = taken.get(r.source, 0) + r.size * r.copies, r.target
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert 0 <= r.copies <= 2
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in taken), (taken, target)
    return taken


def test_mixing_odd(odd, none):
    out = mixing.mixed(odd)
    assert out.count() == odd.count() and out.where("size = 0 and copies * size > 0").count() == 0
    near_targets(out)
    again = mixing.repeated(odd)
    assert again.columns == odd.columns and again.count() == out.agg(F.sum("copies")).first()[0]
    assert mixing.mixed(none).count() == mixing.repeated(none).count() == 0
    assert mixing.mixed(odd.where("text is null")).agg(F.sum(F.col("copies") * F.col("size"))).first()[0] == 0


def test_mixing_ids_that_repeat_or_are_missing(spark):
    """Equal rows are taken in part: 900 rows without an id in three sources, and one source of one id."""
    words_ = lambda n: " ".join(["w"] * n)
    rows = [(None, words_(100), f"s{i % 3}") for i in range(900)]
    taken = near_targets(mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)))
    assert taken == {"s0": 60_000, "s1": 50_000, "s2": 25_000} or all(abs(taken[s] - t) <= 50 for s, t in (("s0", 60_000), ("s1", 50_000), ("s2", 25_000)))
    rows = [(7, words_(100), "a") for _ in range(400)] + [(i, words_(100), "b") for i in range(400)] + [(9, words_(i % 150), "c") for i in range(400)] + [(None, words_(i % 150), "c") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mixing.mixed(df)
    near_targets(out)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, mixing.mixed(df.repartition(2)).collect()))
    again = mixing.repeated(df)
    want = {(r.source, r.doc_id, r.size): r.n for r in out.groupBy("source", "doc_id", "size").agg(F.sum("copies").alias("n")).where("n > 0").collect()}
    assert {(r.source, r.doc_id, r.size): r.n for r in again.groupBy("source", "doc_id", mixing.word_count(F.col("text")).alias("size")).agg(F.count("*").alias("n")).collect()} == want


def test_mixing_names_that_clash(spark):
    df = spark.createDataFrame([(i, f"a b {i}", "s", 1, 2, 3, 4) for i in range(30)], "doc_id long, text string, source string, __copies int, key int, of int, `copies` int")
    out = mixing.repeated(df)
    assert out.columns == df.columns and out.where("__copies = 1 and key = 2 and of = 3 and copies = 4").count() == out.count() == 45
    assert mixing.mixed(df).count() == 30


def brute_pii(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii_patterns():
    rng = random.Random(6)
    for _ in range(20_000):
        letters = rng.choice(["a@.-1", "1. ", "12.", "+1() -.9", "a@b.c+ é", "0123456789 -", "01 "])
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 40)))
        assert pii.find(t) == brute_pii(t)
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "+1" + "(" * 100_000):
        pii.find(t)


def test_pii_terms(spark, odd, none):
    rng = random.Random(8)
    rows = [(i, text(rng, 40)) for i in range(300)]
    rows += [(1000 + i, f"{text(rng, 20)} reach zanthor at z.anthor@mail.example.com or {text(rng, 9)}") for i in range(9)]
    rows += [(2000 + i, f"the same passage names qwerty x.y{1}@copy.example.com every time") for i in range(9)]
    out = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    t = dict(rows)[1000]
    at = t.index("zanthor")
    assert f"term:{at}:{at + 7}" in out[1000].spans and out[1000].n_email == 1 and "anthor" not in out[1000].text
    assert "term" not in out[2000].spans  # one passage in nine copies is one context
    assert all(out[i].spans == "" and out[i].text == dict(rows)[i] for i in range(300))
    got = pii.sanitise(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest() or "term" in r.spans or "general" in r.spans or "secret" in r.spans
    assert pii.sanitise(none).count() == 0


def test_pii_terms_of_identifiers_with_few_contexts(spark):
    """At the registered parameters, a name beside an address in two texts is removed; near copies and windows that meet are one context."""
    rng = random.Random(28)
    own = lambda n, k: " ".join(f"{rng.choice(WORDS)}{rng.randrange(k)}x".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n))
    rows = [(i, own(60, 60)) for i in range(600)]
    rows += [(1000 + i, f"{own(30, 60)} reach zanthor at z.a@mail.example.com or {own(30, 60)}") for i in range(2)]
    passage = f"{own(20, 10**6)} qwertz at q.w@mail.example.com for {own(20, 10**6)}".split()
    at = passage.index("q.w@mail.example.com")
    rows += [(2000 + i, " ".join(passage[:k] + [f"changed{'abc'[i]}"] + passage[k + 1 :])) for i, k in enumerate((at - 5, at + 4, at + 7))]
    rows += [(3000, f"{own(9, 60)} meets m.m@mail.example.com yxcvbn asdfgh m.m@mail.example.com {own(9, 60)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term): r.action for r in pii.disclosing_terms(df.select("text")).collect()}
    assert got["email:z.a@mail.example.com", "zanthor"] == "remove"
    assert {(e, t) for e, t in got if t in ("qwertz", "yxcvbn", "asdfgh")} == set()
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert not any("zanthor" in out[1000 + i] for i in range(2)) and "qwertz" in out[2000] and "yxcvbn" in out[3000]


def test_pii_terms_are_counted_as_they_are_found(spark):
    """Capitals outside ASCII, and words cut out beside an identifier, have their counts."""
    rng = random.Random(18)
    rows = [(i, f"{text(rng, 40)} Große" if i % 2 else f"{text(rng, 40)} MAIL<q.q{i}@x.example.com> {text(rng, 9)}") for i in range(300)]
    rows += [(1000 + i, f"{text(rng, 20)} Große reach Émile at e.m@mail.example.com {text(rng, 9)}") for i in range(9)]
    rows += [(2000 + i, f"{text(rng, 20)} Ölaf<o.l@mail.example.com> {text(rng, 9)}") for i in range(9)]
    rows += [(3000 + i, f"{text(rng, 20)} mail<i.p@mail.example.com> {text(rng, 9)}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term): r for r in pii.disclosing_terms(df.select("text")).collect()}
    assert got["email:e.m@mail.example.com", "émile"].action == got["email:o.l@mail.example.com", "ölaf"].action == "remove"
    assert not any(t == "große" or t == "mail" and e != "email" and not e.startswith("domain:") for e, t in got)
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "Émile" not in out[1000] and "Ölaf" not in out[2000] and "Große" in out[1000]


def brute_shares(texts, window=8, support=2):
    """(entity, term): share, by plain counts of contexts; support by distinct contexts, as the test's contexts share few words."""
    import math

    contexts, docs, names = {}, {}, set()
    for t in texts:
        own = pii.Words(t)
        words_ = {w.strip(pii._EDGES).lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t)} | {x[0] for x in own.terms if x}
        for w in words_:
            docs[w] = docs.get(w, 0) + 1
        every = tuple(sorted({x for _, a, e in own.mentions for x, _, _ in own.around(a, e, window)}))
        for kind, a, e in own.mentions:
            around = tuple(x for x, _, _ in own.around(a, e, window))
            for entity in pii.entities(kind, t[a:e]):
                contexts.setdefault(entity, {})[around] = set(around)
            for name in pii.names_of(kind, t[a:e]):
                said = name in {x[0] for x in own.terms if x}
                held = contexts.setdefault(f"name:{name}", {}).setdefault(every, set())
                if said:
                    held.add(name)
                    names.add(every)
    out, n = {}, len(texts)
    for entity, own in contexts.items():
        for term in {x for held in own.values() for x in held}:
            c_te, c_e = sum(term in held for held in own.values()), len(own)
            if (len(names) if entity.startswith("name:") else c_te) >= support:
                out[entity, term] = math.log(n * c_te / (max(docs[term], c_te) * c_e)) / math.log(n / min(c_e, n - 1))
    return out


def _corpus(rng, n=400):
    own = lambda k: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(k))
    rows = [f"{own(30)} the of and {rng.choice(WORDS)}" for _ in range(n)]
    rows += [f"{own(12)} Élodie {own(12)} élodie.{k}@mail{k}.example.com {own(9)}" for k in range(3)]
    rows += [f"{own(9)} Quasimir {own(14)} quasimir.{k}@mail{k}.example.com {own(9)}" for k in range(3)]
    rows += [f"{own(9)} key = \"{'%040x' % rng.randrange(16**40)}\" {own(9)}" for _ in range(5)]
    rows += [f"{own(9)} server {10 + k}.1.2.3 {own(9)}" for k in range(4)] + [f"{own(9)} Vorwahl {own(2)} +1 (528) 555-34{k}5 {own(9)}" for k in range(4)]
    return rows


@pytest.mark.parametrize("few", [pii.FEW_TERMS, 0])
def test_pii_pooled_terms(spark, few):
    """Shares equal plain counts; entities that occur once have terms by what they share with others; both ways to hand out the terms agree."""
    rng = random.Random(5)
    rows = list(enumerate(_corpus(rng)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k: v for k, v in brute_shares([t for _, t in rows]).items() if v >= 0.6}
    got = {(r.entity, r.term): r.share for r in pii.disclosing_terms(df.select("text")).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(v) for k, v in want.items())
    assert {("secret", "key"), ("ip", "server"), ("area:1528", "vorwahl"), ("name:quasimir", "quasimir")} <= set(got)
    out = {r.doc_id: r for r in pii.sanitise(df, few=few).collect()}
    for i, t in rows[400:]:
        assert not any(x in out[i].text for x in ("Quasimir", "server", "Vorwahl", "key", "@", "555"))
        for span in out[i].spans.split(","):
            kind, a, b = span.split(":")
            assert kind != "secret" or re.fullmatch("[0-9a-f]{40}", t[int(a) : int(b)])
    assert all(out[i].spans == "" and out[i].text == t for i, t in rows[:400])


def test_pii_generalises_to_classes():
    spans = [("email", 0, 3), ("general", 4, 8), ("term", 9, 12), ("general", 13, 15)]
    assert pii.sanitised("a@b Anna der XY", spans, {(4, 8): "name", (9, 12): "email", (13, 15): "net"}) == "[email] [name]  [network]"


def test_pii_long_words():
    """Words end at identifiers and have no length limit; texts without spaces take time in proportion to their length."""
    own = pii.Words("x" * 400 + "<a@b.example>" + "y" * 500)
    assert [t for t, _, _ in own.around(*own.mentions[0][1:], 8)] == ["x" * 400, "y" * 500]
    text_ = "".join(f"n{'q' * 30}<u{i}@b.example>;" for i in range(20_000))
    own = pii.Words(text_)
    assert len(own.mentions) == 20_000 and all(len(own.around(a, e, 8)) <= 16 for _, a, e in own.mentions)


@pytest.mark.parametrize("sf", ["0.01"])
def test_pii_adds_terms_on_the_table(spark, sf):
    """The method adds spans on the given documents, and none to documents without a mention."""
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    rows = pii.sanitise(docs).select("spans", "n_email", "n_ip", "n_card", "n_phone").collect()
    assert sum("term:" in r.spans or "general:" in r.spans for r in rows) >= 10
    assert all(r.spans == "" for r in rows if not (r.n_email or r.n_ip or r.n_card or r.n_phone or "secret" in r.spans))


def test_token_counts(spark, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = odd.collect()
    lengths = [len(t.encode(r.text or "", add_special_tokens=False).ids) for r in rows]
    out = token_counts.token_counts(odd).collect()
    for total, groups in ((True, {None}), (False, {r.source for r in rows})):
        for g in groups:
            own = sorted(n for n, r in zip(lengths, rows, strict=True) if total or r.source == g)
            table = [r for r in out if r.is_total == total and r.grp == g]
            assert sorted(r.n_tokens for r in table) == sorted(set(own))
            for r in table:
                n = r.n_tokens
                assert (r.docs, r.docs_over, r.docs_within) == (own.count(n), sum(x > n for x in own), sum(x <= n for x in own))
                assert (r.tokens_total, r.tokens_within, r.tokens_truncated) == (sum(own), sum(x for x in own if x <= n), sum(min(x, n) for x in own))
    half = {r.grp: r.n_tokens for r in token_counts.quantile_length(token_counts.token_counts(odd), 0.5).where("not is_total").collect()}
    own = sorted(n for n, r in zip(lengths, rows, strict=True) if r.source == "s1")
    assert half["s1"] == own[-(-len(own) // 2) - 1]
    assert token_counts.token_counts(none).count() == 0


def folded(p, s, atoms):
    counts, ends, inner, _ = pieces.lattice(p, s, atoms)
    out, k = [], 0
    for i, a in enumerate(atoms):
        m = (1 << int(s.sizes[a]) + 1) - 1
        for e, n in zip(ends[k : k + counts[i]].tolist(), inner[k : k + counts[i]].tolist(), strict=True):
            if m & e == e and bin(m & n).count("1") == 1:
                m &= ~n
        k += counts[i]
        out.append(m)
    return np.array(out, np.int64)


@pytest.mark.parametrize("remembered", [1 << 20, 50])
def test_pieces_equal_library(monkeypatch, remembered):
    import public_tokenizers
    import sentencepiece

    monkeypatch.setattr(pieces, "REMEMBERED", remembered)
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(pieces.MODEL)))
    p, rng = pieces.load(), random.Random(remembered)
    vocabulary = [x.replace("▁", " ") for x in p.texts if x]
    texts = ["".join(rng.choice([rng.choice(vocabulary), rng.choice("ab  \n\té日🙂.,<>0x")]) for _ in range(rng.randrange(0, 14))) for _ in range(1500)]
    texts += ["", " ", "   ", "a" * 300, " " * 100, "é" * 70, "​﻿", "a▁b", "<s></s>", *vocabulary[::50]]
    ahead, behind = pieces.Memory(), pieces.Memory()
    for k in range(0, len(texts), 400):
        own = texts[k : k + 400]
        s = pieces.cut(p, own)
        new = ahead.new(s)
        ahead.add(s, new)
        flat, at = pieces.assemble(p, own, folded(p, s, new[s.by_fold[new]]), behind)
        for t, a, z in zip(own, at[:-1], at[1:], strict=True):
            assert flat[a:z].tolist() == sp.encode(t)
            assert p.decode(flat[a:z].tolist()) == t.replace("▁", " ")


def test_encode_and_decode(odd, none):
    out = pieces.encode(odd)
    rows = sorted(((r.doc_id, r.ids, r.round_trip) for r in out.collect()), key=repr)
    assert len(rows) == odd.count() and all(r[2] for r in rows)
    back = sorted(((r.doc_id, r.text) for r in pieces.decode(out.select("doc_id", "ids")).collect()), key=repr)
    assert back == sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=repr)
    assert pieces.encode(none).count() == 0


def _field(number, value):
    """A field of a protocol buffer message: text, bytes or a float."""
    import struct

    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        return bytes([number << 3, value])
    value = value.encode() if isinstance(value, str) else value
    assert len(value) < 128
    return bytes([number << 3 | 2, len(value)]) + value


def test_unigram_models_equal_library(spark, tmp_path):
    import public_tokenizers
    import sentencepiece

    rng = random.Random(3)
    # the pieces of the public vocabulary with scores of a unigram model, and a model of a few pieces without bytes; sums of these scores are exact in any precision
    public = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(pieces.MODEL)))
    kinds = [2 if public.is_unknown(i) else 3 if public.is_control(i) else 6 if public.is_byte(i) else 1 for i in range(public.get_piece_size())]
    large = b"".join(_field(1, _field(1, public.id_to_piece(i)) + _field(2, -rng.randrange(8, 200) / 16) + _field(3, kind)) for i, kind in enumerate(kinds))
    large += _field(2, _field(3, 1) + b"\x98\x02\x01") + _field(3, _field(4, 0))
    own = sorted({"▁", *"abcdé", *("".join(rng.choice("▁abcdé") for _ in range(rng.randrange(2, 6))) for _ in range(80))})
    small = b"".join(_field(1, _field(1, x) + _field(2, 0.0) + _field(3, kind)) for x, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)))
    small += b"".join(_field(1, _field(1, x) + _field(2, -rng.randrange(8, 200) / 16)) for x in own) + _field(2, _field(3, 1)) + _field(3, _field(4, 0))
    texts = ["".join(rng.choice(["a", "b", "ab", "cd", "é", " ", "xyz", "the ", "Hello", "ing", "🙂"]) for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    texts += ["", " ", "   ", "abcdé" * 60, "x" * 200, "xyxy ab", "漢字" * 50, " " * 100]
    rows = spark.createDataFrame([*enumerate(texts), (len(texts), None)], "doc_id long, text string")
    for name, model in (("large", large), ("small", small)):
        at = tmp_path / f"{name}.model"
        at.write_bytes(model)
        sp = sentencepiece.SentencePieceProcessor(model_file=str(at))
        out = {r.doc_id: r for r in pieces.encode(rows, path=str(at)).collect()}
        assert not pieces.load(str(at)).merges and len(out) == len(texts) + 1 and out[len(texts)].ids == []
        back = {r.doc_id: r.text for r in pieces.decode(spark.createDataFrame([(i, r.ids) for i, r in out.items()], "doc_id long, ids array<int>"), path=str(at)).collect()}
        for i, t in enumerate(texts):
            assert out[i].ids == sp.encode(t), (name, t)
            assert back[i] == sp.decode(out[i].ids), (name, t)
            assert name == "small" or out[i].round_trip


def test_viterbi(spark):
    scores = {"a": -2.0, "b": -2.5, "c": -3.0, "ab": -3.0, "bc": -3.5, "abc": -6.0, "ca": -4.0}
    for word in ("abc", "abcabc", "cab", "bca", "a"):
        best = [(0.0, [])] + [(float("-inf"), [])] * len(word)
        edges = []
        for e in range(1, len(word) + 1):
            for b in range(e):
                if (piece := word[b:e]) in scores:
                    edges.append((b, e, list(scores).index(piece), scores[piece]))
                    if best[b][0] + scores[piece] > best[e][0]:
                        best[e] = (best[b][0] + scores[piece], [*best[b][1], piece])
        df = spark.createDataFrame([(len(word), edges)], "n int, edges array<struct<start:int,end:int,id:int,score:double>>")
        state = df.select(pieces.viterbi(F.col("n"), F.col("edges")).alias("s")).first().s
        path, at = [], len(word)
        while at:
            path.append(word[state[at]["from"] : at])
            at = state[at]["from"]
        assert path[::-1] == best[-1][1] and state[-1].score == pytest.approx(best[-1][0])


def test_licences(spark, odd, none):
    apache = 'Copyright 2020 Foo\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.'
    cases = {
        apache: ["Apache-2.0"],
        "Some prose.\nReleased under the MIT License.\nMore prose.": ["MIT"],
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0-only"],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
        "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.": ["CC-BY-SA-4.0"],
        "Licensed under the BSD 3-Clause License.": ["BSD-3-Clause"],
        "SPDX-License-Identifier: MPL-2.0": ["SPDX:mpl-2-0"],
        "See the License for the specific language governing permissions and limitations under the License.": [],
        "The mit of licence and permission.": [],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(df).collect()}
    for i, (t, want) in enumerate(cases.items()):
        assert got[i].licences == want, t
    assert (got[0].matches[0].start, got[0].matches[0].end) == (apache.index("Licensed"), len(apache))
    out = licences.scan(odd)
    assert out.count() == odd.count() and licences.scan(none).count() == 0


def test_licences_padded():
    """A sentence over several lines is known however much white space or comment box is around its words."""
    for pad in (" " * 200, " *" * 150, "\t" * 400 + "// "):
        notice = f"\n{pad}".join("Licensed under the Apache License, Version 2.0;|you may not use|this file except|in compliance|with the|License.".split("|"))
        assert [x[1] for x in licences.identified("Some prose.\n\n" + notice)] == ["apache-notice", "apache-use"]
    licences.identified("licence " * 100_000)


GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def test_licence_notices():
    """Notices as projects carry them, among prose and as comments."""
    cases = {
        GPL2: ["GPL-2.0-or-later"],
        GPL2.replace("software; you", "software: you").replace("General", "Affero General").replace("Foundation; either version 2", "Foundation, either version 3"): ["AGPL-3.0-or-later"],
        GPL2.replace("This program", "Foo").replace("General", "Lesser General").replace("version 2", "version 2.1"): ["LGPL-2.1-or-later"],
        "foo is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.": ["GPL-2.0-only"],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.": ["MPL-2.0"],
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/": ["EPL-2.0"],
        "Distributed under the Boost Software License, Version 1.0.": ["BSL-1.0"],
        "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself.": ["Artistic-1.0-Perl OR GPL-1.0-or-later"],
    }
    for t, want in cases.items():
        for own in (t, "Some prose.\n\n" + t + "\nMore of it.", "\n".join("# " + x for x in t.split("\n"))):
            assert [x[0] for x in licences.match(licences.identified(own))] == want, own


def test_licence_texts():
    """Each text of the base is found as one licence, from its first sentence to its last that is looked up; paragraphs out of order are no other one."""
    for licence, t in licences.TEXTS.items():
        found = licences.identified(t := t.strip())
        assert licences.match(found) == [(licence, found[0][3], found[-1][4])] and found[0][3] == 0, licence
        shuffled = "\n\n".join(reversed(t.split("\n\n")))
        assert {x[0] for x in licences.match(licences.identified(shuffled))} <= {licence}
    assert len({r.sentences for r in licences.RULES}) == len(licences.RULES)


def test_licence_rules_against_brute_force():
    """match, against trying all chains of sentences in order of rule and place."""

    def brute(found, gap, rules):
        used, out = set(), []
        for rule in sorted(rules, key=lambda r: -len(r.sentences)):
            for first in range(len(found)):
                chains = [[first]] if found[first][1] == rule.sentences[0] and first not in used else []
                for name in rule.sentences[1:]:  # the earliest that fits is taken, so a chain has one way on
                    chains = [[*c, min(n)] for c in chains if (n := [j for j in range(len(found)) if j not in used and j > c[-1] and j - c[-1] <= gap + 1 and found[j][1] == name and found[j][0] - found[c[-1]][0] <= gap + 1])]
                for c in chains:
                    used.update(c)
                    out.append((rule.licence, found[c[0]][3], found[c[-1]][4]))
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))

    rng = random.Random(5)
    rules = (licences.Rule("A", ("a", "b", "c")), licences.Rule("B", ("a", "b")), licences.Rule("C", ("b", "a", "a")), licences.Rule("D", ("c",)), licences.Rule("E", ("a",)))
    for _ in range(500):
        places = sorted(rng.sample(range(30), rng.randint(0, 14)))
        found = [(k, rng.choice("abcd"), {}, 10 * k, 10 * k + 9) for k in places]
        gap = rng.randint(0, 4)
        assert licences.match(found, gap, rules) == brute(found, gap, rules)


def test_words_are_hashed_alike_wherever_they_stand():
    rng = random.Random(9)
    texts = [text(rng, 30) for _ in range(20)] + [None, "", "x" * 3000]
    whole = words.shingle_sets(pa.array(texts))
    for t, s in zip(texts, whole, strict=True):
        assert (words.shingle_sets(pa.array([t], pa.string()))[0] == s).all()
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        assert len(s) == (len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else bool(w))


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        at = shared.stored(stage(spark, at, data))
        seen[name] = at.collect()
        if name != "encode":
            assert at.columns == docs.columns
    good = {r.doc_id for r in quality_rules.judged(docs).where("__kept").collect()}
    assert {r.doc_id for r in seen["quality"]} == good
    want = {d: t for d, _, _, t in brute_lines([(r.doc_id, r.text) for r in seen["quality"]]) if t.strip(" \t\n\x0b\x0c\r")}
    assert {r.doc_id: r.text for r in seen["lines"]} == want and all(r.n_chars == len(r.text) for r in seen["lines"])
    roots = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in seen["lines"]])}
    assert {r.doc_id for r in seen["near_duplicates"]} == roots
    assert {r.doc_id for r in seen["mix"]} <= roots and sorted(r.doc_id for r in seen["encode"]) == sorted(r.doc_id for r in seen["mix"])
    assert all(r.round_trip for r in seen["encode"]) and set(before) >= roots
    assert corpus_pipeline.run(spark, data).count() == len(seen["encode"])


def test_quality_agrees_with_labels(spark, data):
    """Where the base test leaves a document to the rules, their verdict agrees with its label."""
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.judged(docs).join(labels, "doc_id").where("not __base_failed").select("__kept", "quality").collect()
    assert len(rows) > 20 and sum(r["__kept"] == bool(r.quality) for r in rows) >= 0.97 * len(rows)


def test_pieces_of_many_texts_take_little_memory_at_once():
    """The arrays of a slice of half a million characters took 52 MB here, in each of the four workers of an executor."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tessera.llm import pieces

    pieces.load()
    draw = np.random.default_rng(3)
    texts = [" ".join("".join(map(chr, w)) for w in draw.integers(97, 123, (150, 7))) for _ in range(800)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    for _ in pieces._open(None)(iter([rows])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6


def test_prefixes_of_many_texts_take_little_memory_at_once():
    """Six million characters whose shingles all are in other sets too took 180 MB here, most of it in an object for each shingle."""
    import tracemalloc
    from types import SimpleNamespace

    draw = np.random.default_rng(0)
    texts = pa.array([" ".join(f"w{k}" for k in draw.integers(0, 3000, m)) for m in draw.integers(1, 700, 3000)])
    known = [(jaccard_join._bucket(s, 200) << 40) + (s & jaccard_join._LOW40).astype(np.int64) for s in words.shingle_sets(texts)]
    token = np.concatenate(known)
    shared = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, known)]), pa.int32()), pa.StructArray.from_arrays([pa.array(token), pa.array(token % 7 + 2)], ["token", "df"]))
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts, shared], ["gid", "text", "shared"])
    run = jaccard_join._prefixes(5, 80, SimpleNamespace(value=np.empty(0, np.uint64)), 200)
    tracemalloc.start()
    n = sum(b.num_rows for b in run(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and peak < 60e6
