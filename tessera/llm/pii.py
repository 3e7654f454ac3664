"""Personal data: patterns for identifiers and secrets, and terms that give them away.

Patterns find four kinds of identifiers in each text, and secrets: opaque strings of letters and digits. Then the corpus
says which other terms disclose them. Hardly any identifier occurs twice, so statistics are pooled: a mention belongs to
its identifier and to broader entities that many identifiers share, namely its kind, the domain and the names of an
address (the words of its local part), the network of an IP address, the issuer of a card, the area of a phone number.

For a term t and an entity e, the pointwise mutual information PMI(t; e) = log(N c(t, e) / (c(t) c(e))) compared with the
information of e itself, IC(e) = log(N / c(e)), is the share of e that t reveals. c(e) counts distinct contexts of e (the
words within `window` of a mention), c(t, e) those that hold t, c(t) documents with t and N all documents. A term that
reveals at least `disclosure` of an entity, in at least `support` contexts, is disclosing: it is removed beside mentions
of that entity. One that reveals at least `general` is generalised: it is replaced by the name of the broader class that
it points to. For a name the context is the whole text, and the terms are the words equal to the name: that the name of
an address stands in its text as a word is one relation, whose support is pooled over all names.

Two contexts suffice, since most entities have few, so they must be independent: mentions in one text whose windows
meet are one context, and so are copies and near copies of a passage. For the latter a context has _BANDS signatures, each
of the least hashes of its words in three orders, which near copies share and other contexts hardly. The support of a
pair is the least number of distinct signatures in any band; c(e) and c(t, e) count contexts that differ in any word.

Words end at white space and at identifiers, and have no length limit. Counting: every document of the corpus counts, and
holds a term if one of its words is the term or if the term was cut out beside one of its mentions ("Name<mail@host>").
Only (term, entity) pairs with the support needed are looked up, and documents are counted per batch by term before the
shuffle of counts. Terms are in Unicode lower case everywhere.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .shared import picked, stored, trimmed

KINDS = ("email", "ip", "card", "phone")
#: What a generalised term is replaced by, by the entity that it points to.
CLASSES = {"email": "[address]", "domain": "[organisation]", "name": "[name]", "ip": "[host]", "net": "[network]", "card": "[account]", "issuer": "[bank]", "phone": "[contact]", "area": "[place]", "secret": "[credential]"}
#: Tables of so many disclosing (entity, term) pairs, some megabytes, go to all tasks; larger ones are joined.
FEW_TERMS = 100_000
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OPAQUE = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{20,}={0,2}(?![A-Za-z0-9_+/=-])")
_LETTERS = re.compile(r"[^\W\d_]{2,}")
_EDGES = ".,;:!?()[]{}\"'<>|*#$%&"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from the @ outwards, which is the leftmost match without trying every start."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > done and _local(text[start - 1]):
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def _local(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in "._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points: leftmost matches that don't overlap within a kind; failing ones are dropped, without another try."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if len(m[0]) < 64 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def secrets(text: str) -> list[tuple[str, int, int]]:
    """Opaque strings, as spans of kind secret: 20 letters and digits or more, in which they change places at least six times, as in keys and tokens."""
    out = []
    for m in _OPAQUE.finditer(text):
        turns = sum(x.isdigit() != y.isdigit() for x, y in zip(m[0], m[0][1:], strict=False))
        if turns >= 6 and not m[0].isdigit():
            out.append(("secret", m.start(), m.end()))
    return out


class Words:
    """A text's mentions (of all kinds, in order) and the words between them, each in lower case without punctuation at its edges."""

    def __init__(self, text: str) -> None:
        self.text, self.base = text, find(text)
        taken = [(a, e) for _, a, e in self.base]
        self.secrets = [s for s in secrets(text) if not any(a < s[2] and s[1] < e for a, e in taken)]
        self.mentions = sorted([*self.base, *self.secrets], key=lambda s: (s[1], s[2]))
        self.starts, self.ends, self.terms = [], [], []
        if self.mentions:
            at = 0
            for _, a, e in [*self.mentions, ("", len(text), len(text))]:
                if a > at:
                    for m in _WORD.finditer(text, at, a):
                        self.starts.append(m.start())
                        self.ends.append(m.end())
                        self.terms.append(self._term(m))
                at = max(at, e)

    @staticmethod
    def _term(m: re.Match) -> tuple[str, int, int] | None:
        word = m[0].strip(_EDGES)
        if len(word) < 2 or any(c.isdigit() or c == "@" for c in word):
            return None
        at = m.start() + m[0].index(word)
        return word.lower(), at, at + len(word)

    def around(self, a: int, e: int, window: int) -> list[tuple[str, int, int]]:
        """The terms among the `window` words before and after a mention."""
        i, j = bisect_left(self.ends, a + 1), bisect_left(self.starts, e)
        return [t for t in [*self.terms[max(0, i - window) : i], *self.terms[j : j + window]] if t]

    def called(self, names: set[str]) -> list[tuple[str, int, int]]:
        """The words equal to one of the names, wherever they stand."""
        return [t for t in self.terms if t and t[0] in names] if names else []


def names_of(kind: str, value: str) -> set[str]:
    """The names of an address: the words of its local part."""
    return set(_LETTERS.findall(value.partition("@")[0].lower())) if kind == "email" else set()


def entities(kind: str, value: str) -> list[str]:
    """What a mention belongs to: its identifier, its kind and what lies between. Names are apart, since their context is the text."""
    digits = re.sub("[^0-9.]", "", value)
    if kind == "email":
        return [f"email:{value.lower()}", "email", f"domain:{value.rpartition('@')[2].lower()}"]
    if kind == "ip":
        return [f"ip:{value}", "ip", "net:" + ".".join(value.split(".")[:2])]
    if kind == "card":
        return [f"card:{digits}", "card", f"issuer:{digits[:6]}"]
    if kind == "phone":
        return [f"phone:{digits}", "phone", f"area:{digits[:4]}"]
    return [f"secret:{value}", "secret"]


_BANDS = 4
_ORDERS = [int.from_bytes(hashlib.blake2b(bytes([k]), digest_size=8).digest(), "big") | 1 for k in range(3 * _BANDS)]


def _signatures(terms: list[str]) -> list[int]:
    """A hash of a context's words in order, and a signature of them for each band."""
    own = [int.from_bytes(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "big") for t in terms]
    least = [min(((x * m & (1 << 64) - 1) >> 20 for x in own), default=0) for m in _ORDERS]
    parts = [terms, *(least[3 * k : 3 * k + 3] for k in range(_BANDS))]
    return [int.from_bytes(hashlib.blake2b(repr(x).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) for x in parts]


def _contexts(words_: Words, window: int) -> Iterator[tuple[str, list[str]]]:
    """(entity, terms) of each context; mentions of an entity whose windows meet are one. A name has one context, of itself where the text has it as a word, and nothing else."""
    held: dict[str, list[tuple[int, list[str]]]] = {}
    names: set[str] = set()
    for kind, a, e in words_.mentions:
        value, around = words_.text[a:e], words_.around(a, e, window)
        terms, first, last = [t for t, _, _ in around], min([a, *(x for _, x, _ in around)]), max([e, *(y for _, _, y in around)])
        names |= names_of(kind, value)
        for entity in entities(kind, value):
            own = held.setdefault(entity, [])
            if own and first <= own[-1][0]:
                own[-1] = (max(last, own[-1][0]), own[-1][1] + terms)
            else:
                own.append((last, terms))
    for entity, own in held.items():
        for _, terms in own:
            yield entity, terms
    said = {t for t, _, _ in words_.called(names)}
    for name in names:
        yield f"name:{name}", [name] if name in said else []


def _mentions(window: int):
    """(entity, band, context, term) for the words about each mention; context is a hash (band 0) or a signature of those words. One row with a null term for each context and band. The context of a name is signed by all terms about the text's mentions."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = set()
            for text in b.column("text"):
                own = Words(text.as_py() or "")
                if own.mentions:
                    every = sorted({t for kind, a, e in own.mentions for t, _, _ in own.around(a, e, window)})
                    signed = {}  # a mention's entities mostly have the same context
                    for entity, terms in _contexts(own, window):
                        of = tuple(every if entity.startswith("name:") else terms)
                        if of not in signed:
                            signed[of] = _signatures(list(of))
                        for band, context in enumerate(signed[of]):
                            rows |= {(entity, band, context, t) for t in (None, *terms)}
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.string()), strict=True)], ["entity", "band", "context", "term"])

    return run


def _document_counts():
    """(term hash, documents) of each batch. Texts are lowered as terms are; no white space or edge changes by that."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            for i in range(0, b.num_rows, 512):
                texts = [t or "" for t in b.column("text").slice(i, 512).to_pylist()]
                data, offsets = words.buffers(pa.array([t.lower() for t in texts], pa.large_string()))
                starts, ends, rows = words.spans(data, offsets)
                starts, ends = _trimmed(data, starts, ends)
                own = words.hashes(data, starts, ends)
                each = [np.unique(np.concatenate([own[a:e], _beside(t)])) for t, a, e in zip(texts, rows[:-1], rows[1:], strict=True)]
                values, counts = np.unique(np.concatenate([*each, np.empty(0, np.uint64)]), return_counts=True)
                found.update(dict(zip(values.view(np.int64).tolist(), counts.tolist(), strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["hash", "docs"])

    return run


def _beside(text: str) -> np.ndarray:
    """Hashes of the terms that an identifier cuts off from a word."""
    own, white = Words(text), " \t\n\x0b\x0c\r"
    cut = {t[0] for t, a, e in zip(own.terms, own.starts, own.ends, strict=True) if t and (a > 0 and text[a - 1] not in white or e < len(text) and text[e] not in white)}
    return np.array([term_hash(t) for t in cut], np.int64).view(np.uint64)


_IS_EDGE = np.zeros(256, bool)
_IS_EDGE[[ord(c) for c in _EDGES]] = True


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without punctuation at the edges; those of nothing else become empty."""
    starts, ends = starts.copy(), ends.copy()
    while len(k := np.flatnonzero((starts < ends) & _IS_EDGE[data[np.minimum(starts, max(len(data) - 1, 0))]])):
        starts[k] += 1
    while len(k := np.flatnonzero((starts < ends) & _IS_EDGE[data[np.maximum(ends - 1, 0)]])):
        ends[k] -= 1
    return starts, ends


def term_hash(term: str) -> int:
    data = np.frombuffer(term.encode("utf-8", "replace"), np.uint8)
    return int(words.hashes(data, np.array([0]), np.array([len(data)])).view(np.int64)[0])


@trimmed
def _with_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([term_hash(t) for t in b.column("term").to_pylist()], pa.int64())], [*b.schema.names, "hash"])


def disclosing_terms(texts: DataFrame, window: int = 8, support: int = 2, general: float = 0.6, disclosure: float = 0.8) -> DataFrame:
    """(entity, term, share, action): terms that reveal an entity, and whether they are removed or generalised. Null and empty texts count as documents; an empty table gives an empty result."""
    n = texts.count()
    mentions = stored(texts.mapInArrow(_mentions(window), "entity string, band int, context long, term string").distinct())
    by_pair = mentions.groupBy("entity", "term", "band").count().groupBy("entity", "term")
    by_pair = by_pair.agg(F.max(F.when(F.col("band") == 0, F.col("count"))).alias("contexts"), F.min(F.when(F.col("band") > 0, F.col("count"))).alias("independent"))
    # that a name stands in its text is one relation: its support is that of all names together
    is_name = F.col("entity").startswith("name:")
    names = mentions.where(is_name & F.col("term").isNotNull()).select("band", "context").distinct().groupBy("band").count()
    names = names.agg(F.coalesce(F.min(F.when(F.col("band") > 0, F.col("count"))), F.lit(0)).alias("by_names"))  # one row
    by_pair = by_pair.crossJoin(F.broadcast(names)).withColumn("independent", F.when(is_name, F.col("by_names")).otherwise(F.col("independent"))).drop("by_names")
    by_pair = stored(by_pair.where(F.col("independent") >= support))
    whole = by_pair.where("term IS NULL").selectExpr("entity", "contexts AS c_e")
    pairs = by_pair.where("term IS NOT NULL").selectExpr("entity", "term", "contexts AS c_te")
    pairs = stored(pairs.join(whole, "entity").mapInArrow(_with_hash, "entity string, term string, c_te long, c_e long, hash long"))
    counts = texts.mapInArrow(_document_counts(), "hash long, docs long").groupBy("hash").agg(F.sum("docs").alias("c_t"))
    share = F.log(F.lit(float(max(n, 1))) * F.col("c_te") / (F.greatest("c_t", "c_te") * F.col("c_e"))) / F.log(F.lit(float(max(n, 2))) / F.least(F.col("c_e"), F.lit(max(n, 2) - 1)))
    out = pairs.join(counts, "hash", "left").withColumn("share", share).where(F.col("share") >= general)
    return out.select("entity", "term", "share", F.when(F.col("share") >= disclosure, "remove").otherwise("generalise").alias("action"))


def _disclosed(own: Words, window: int, action) -> dict[tuple[int, int], tuple[str, str]]:
    """The spans of disclosing terms, each with its kind (term if removed, general if generalised) and the class of the entity it points to. action(entity, term) is remove, generalise or None."""
    out: dict[tuple[int, int], tuple[str, str]] = {}
    names: set[str] = set()

    def put(entity: str, t: str, x: int, y: int) -> None:
        what = action(entity, t)
        if what == "remove" or what and (x, y) not in out:
            out[x, y] = ("term" if what == "remove" else "general", entity.partition(":")[0])

    for kind, a, e in own.mentions:
        names |= names_of(kind, own.text[a:e])
        for entity in entities(kind, own.text[a:e]):
            for t, x, y in own.around(a, e, window):
                put(entity, t, x, y)
    for t, x, y in own.called(names):
        put(f"name:{t}", t, x, y)
    return out


_ORDER = {k: i for i, k in enumerate((*KINDS, "secret", "term", "general"))}
_SHAPE = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, text string"


def _spans(window: int, everywhere=None):
    """Spans and sanitised texts. The actions come from `everywhere`, a broadcast table, or with each row in `known`."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, text in enumerate(b.column("text")):
                own = Words(text.as_py() or "")
                known = everywhere.value if everywhere is not None else {(k["entity"], k["term"]): k["action"] for k in b.column("known")[i].as_py() or ()}
                more = _disclosed(own, window, lambda e, t: known.get((e, t))) if known and own.mentions else {}  # noqa: B023
                spans = sorted([*own.base, *own.secrets, *((kind, x, y) for (x, y), (kind, _) in more.items())], key=lambda s: (_ORDER[s[0]], s[1]))
                counts = Counter(s[0] for s in own.base)
                out.append((*(counts[k] for k in KINDS), hashlib.sha256(joined(own.base).encode()).hexdigest(), joined(spans), len(spans), sanitised(own.text, spans, {at: of for at, (_, of) in more.items()})))
            cols = list(zip(*out, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], [x.split()[0] for x in _SHAPE.split(", ")])

    return run


def sanitised(text: str, spans: list[tuple[str, int, int]], classes: dict[tuple[int, int], str] | None = None) -> str:
    """text with each span replaced by its kind in brackets; overlapping spans are replaced as one, named after the first. Generalised terms become the name of their class, removed ones go."""
    out, at, classes = [], 0, classes or {}
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: s[1:]):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b, CLASSES.get(classes.get((a, b), ""), "[term]")])
    for kind, a, b, of in merged:
        out += [text[at:a], {"term": "", "general": of}.get(kind, f"[{kind}]")]
        at = b
    return "".join([*out, text[at:]])


def _of_text(window: int):
    """(key, entity, term) of each text with mentions: the pairs that may be disclosing in it."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = set()
            for key, text in zip(b.column("key").to_pylist(), b.column("text"), strict=True):
                own = Words(text.as_py() or "")
                if own.mentions:
                    _disclosed(own, window, lambda e, t: rows.add((key, e, t)))  # noqa: B023
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], ["key", "entity", "term"])

    return run


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 8, support: int = 2, general: float = 0.6, disclosure: float = 0.8, few: int = FEW_TERMS) -> DataFrame:
    """For each row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (of patterns, secrets and terms), n_spans and text without them.

    A null text counts as empty. Very long texts are read whole, their words too. Repeated rows are handled alike, and
    rows without an id like others: what is known of a text's terms is found by the text. Where a term is removed for
    one entity and generalised for another it is removed; of classes the first in the text's order names it. An empty
    table gives an empty result; further columns are ignored.
    """
    docs = picked(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    terms = stored(disclosing_terms(docs.select("text"), window, support, general, disclosure))
    if terms.count() <= few:
        table = terms.select("entity", "term", "action").toArrow().to_pydict()
        everywhere = docs.sparkSession.sparkContext.broadcast(dict(zip(zip(table["entity"], table["term"], strict=True), table["action"], strict=True)))
        return docs.mapInArrow(_spans(window, everywhere), _SHAPE)
    keyed = docs.withColumn("key", F.xxhash64("text"))
    known = keyed.select("key", "text").mapInArrow(_of_text(window), "key long, entity string, term string").distinct().join(terms, ["entity", "term"])
    known = known.groupBy(F.col("key").alias("of")).agg(F.collect_set(F.struct("entity", "term", "action")).alias("known"))
    return keyed.join(known, F.col("key") == F.col("of"), "left").select("doc_id", "text", "known").mapInArrow(_spans(window), _SHAPE)
