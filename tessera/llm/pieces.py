"""SentencePiece encoding and decoding over a lattice of substrings.

A text is cut where no piece of the model can span: between two characters that stand together in no piece. The atoms
that remain are encoded one by one, each distinct atom about once a task: a task remembers so many of those it met.

1. Lattice: the substrings of each distinct atom, of length 2 to the longest piece, are exploded by hash and equi-joined
   to the piece table; edges are grouped by atom, best score first. This is columnar and local to a slice, since words
   repeat within it: exploding the words of all documents into rows and shuffling them to and fro moves several
   times the input.
2. Fold: Spark's higher-order aggregate runs over each atom's edges. The state is a bit mask of the boundaries between
   symbols. For a model of merges (BPE) an edge applies if both its ends are boundaries with exactly one boundary
   between, which it removes; in order of score this gives the model's own merges, because a piece is made when its two
   last parts meet and boundaries never come back. For a unigram model the fold is Viterbi's: best score to each end, with
   the boundaries on the way there as the same mask; scores are summed in double precision within an atom.
3. The masks go back to the slice's documents, in the same task. Nothing is shuffled.

Atoms of over 62 characters, whose boundaries don't fit a mask, and for merges those with several spaces in a row (whose
pieces tie), are encoded one by one: by a queue of merges, or Viterbi's search.
Characters outside the vocabulary become byte pieces where the model has them, else the unknown piece.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import picked, trimmed
from .words import mix

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Characters of an atom that fit the mask; characters of a slice; atoms in a row of the lattice; atoms that a task remembers.
WIDEST, SLICE, ATOMS, REMEMBERED = 62, 1 << 17, 2048, 1 << 19
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MODELS: dict = {}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[0] .. starts[0]+lengths[0]-1, starts[1] .., one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _proto(data: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protocol buffer message: numbers and byte strings."""
    i = 0

    def number() -> int:
        nonlocal i
        shift = value = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        elif key & 7 == 2:
            n = number()
            yield key >> 3, data[i : i + n]
            i += n
        else:
            n = 8 if key & 7 == 1 else 4
            yield key >> 3, data[i : i + n]
            i += n


@dataclass
class Pieces:
    """A vocabulary: pieces with scores, byte pieces (or -1), the unknown piece, and how texts are prepared."""

    texts: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    prefix: bool = True
    merges: bool = True  # a model of merges, or else a unigram model

    def __post_init__(self) -> None:
        special = {int(i) for i in self.byte_ids if i >= 0} | {self.unknown}
        usable = [i for i, p in enumerate(self.texts) if p and i not in special]
        self.values = mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(77))
        self.single = np.full(0x110000, -1, np.int32)
        for i in usable:
            if len(self.texts[i]) == 1:
                self.single[ord(self.texts[i])] = i
        long = [i for i in usable if len(self.texts[i]) > 1]
        self.longest = max((len(self.texts[i]) for i in long), default=1)
        hashes = np.array([self._hash(self.texts[i]) for i in long], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(long, np.int32)[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[hashes >> np.uint64(42)] = True
        letters = sorted({ord(c) for i in long for c in self.texts[i]})
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[letters] = np.arange(1, len(letters) + 1)
        self.kinds = len(letters) + 1
        self.joined = np.zeros(self.kinds * self.kinds, bool)
        for i in long:
            k = self.kind[[ord(c) for c in self.texts[i]]].astype(np.int64)
            self.joined[k[:-1] * self.kinds + k[1:]] = True
        #: in a unigram model, the score of a character that is no piece
        self.lowest = float(min((self.scores[i] for i in usable), default=0.0)) - 10.0
        self.raw = [p.encode() for p in self.texts]
        self.raw[self.unknown] = " ⁇ ".encode()
        for value, i in enumerate(self.byte_ids):
            if i >= 0:
                self.raw[i] = bytes([value])
        self.up, self.down = _powers(_BASE, 1 << 12), _powers(_INVERSE, 1 << 12)
        self.by_text = {self.texts[i]: i for i in usable}
        # pieces of equal score have equal rank; the best is 0
        self.rank = np.unique(-self.scores, return_inverse=True)[1].reshape(-1).astype(np.int64)

    def _hash(self, text: str) -> np.uint64:
        chars = np.array([ord(c) for c in text])
        return mix(np.array([np.add.reduce(self.values[chars] * _powers(_BASE, len(chars))) + np.uint64(len(chars))]))[0]

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)

    def hashes(self, chars: np.ndarray) -> np.ndarray:
        """Running sums from which the hash of any substring follows."""
        self.reach(len(chars) + 1)
        total = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(self.values[chars] * self.up[: len(chars)], out=total[1:])
        return total

    def of(self, total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def found(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1: an equi-join to the table of pieces."""
        out = np.full(len(keys), -1, np.int32)
        if len(self.keys):
            some = np.flatnonzero(self.maybe[keys >> np.uint64(42)])
            at = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
            good = self.keys[at] == keys[some]
            out[some[good]] = self.ids[at[good]]
        return out

    def merged(self, atom: str) -> list[int]:
        """The pieces of an atom by a queue of merges; each merge is the best pair of neighbours, the leftmost of equals."""
        n = len(atom)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ends, queue = list(range(1, n + 1)), []

        def offer(a: int) -> None:
            b = after[a]
            if b < n and ends[b] - a <= self.longest and (i := self.by_text.get(atom[a : ends[b]])) is not None:
                heapq.heappush(queue, (-float(self.scores[i]), a, ends[b]))

        for a in range(n - 1):
            offer(a)
        alive = [True] * n
        while queue:
            _, a, end = heapq.heappop(queue)
            if not alive[a] or after[a] >= n or ends[after[a]] != end:
                continue
            b = after[a]
            alive[b] = False
            ends[a], after[a] = end, after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        out, a = [], 0
        while a < n:
            out += self.symbol(atom[a : ends[a]])
            a = ends[a]
        return out

    def best(self, atom: str) -> list[int]:
        """The pieces of an atom by Viterbi's search; of equal paths the one whose last piece is longest."""
        n = len(atom)
        score, origin = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        for a in range(n):
            for z in range(a + 1, min(a + self.longest, n) + 1):
                i = self.by_text.get(atom[a:z])
                if i is None and z > a + 1:
                    continue
                total = score[a] + (self.lowest if i is None else float(self.scores[i]))
                if total > score[z]:
                    score[z], origin[z] = total, a
        cuts = [n]
        while cuts[-1]:
            cuts.append(origin[cuts[-1]])
        return [i for z, a in zip(cuts[-2::-1], cuts[:0:-1], strict=True) for i in self.symbol(atom[a:z])]

    def symbol(self, text: str) -> list[int]:
        i = self.by_text.get(text)
        if i is not None:
            return [i]
        ids = [int(self.byte_ids[x]) for x in text.encode("utf-8", "replace")]
        return ids if min(ids) >= 0 else [self.unknown]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


def load(path: str | None = None) -> Pieces:
    """The vocabulary of a model file, of merges or unigram, without text normalisation; loaded once in each process."""
    if path is None:
        import public_tokenizers

        path = str(public_tokenizers.path(MODEL))
    if path not in _MODELS:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = [model.is_control(i) or model.is_unused(i) for i in range(n)]
        byte_ids = np.full(256, -1, np.int64)
        for i in range(n):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        trainer, spec = {}, {}  # a message in parts is one, the last value counts
        for number, value in _proto(model.serialized_model_proto()):
            if number == 1 and dict(_proto(value)).get(3) == 4:
                raise ValueError(f"{path} has pieces defined by a user")
            if number in (2, 3):
                (trainer if number == 2 else spec).update(_proto(value))
        kind, prefix = trainer.get(3, 1), bool(spec.get(3, 1))
        if kind not in (1, 2):
            raise ValueError(f"{path} is a model of neither merges nor unigrams")
        if spec.get(2) or spec.get(4, 1):
            raise ValueError(f"{path} normalises texts")
        _MODELS[path] = Pieces(["" if special[i] else model.id_to_piece(i) for i in range(n)], np.array([model.get_score(i) for i in range(n)]), byte_ids, model.unk_id(), prefix, kind == 2)
    return _MODELS[path]


@dataclass
class _Slice:
    """The atoms of some texts: which distinct one stands where, and the distinct ones' characters."""

    rows: np.ndarray  # the first atom of each text, and one more at the end
    which: np.ndarray  # the distinct atom at each place
    keys: np.ndarray  # hashes of the distinct atoms, in order
    chars: np.ndarray  # of the distinct atoms, one after the other
    starts: np.ndarray
    sizes: np.ndarray
    by_fold: np.ndarray  # whether the fold can encode a distinct atom


def cut(pieces: Pieces, texts: list[str]) -> _Slice:
    full = [(SPACE if pieces.prefix and t else "") + t.replace(" ", SPACE) for t in texts]
    chars = np.frombuffer("".join(full).encode("utf-32-le", "replace"), np.uint32).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in full])]).astype(np.int64)
    if not len(chars):
        none = np.empty(0, np.int64)
        return _Slice(np.zeros(len(offsets), np.int64), none, none.astype(np.uint64), none, none, none, none.astype(bool))
    kind = pieces.kind[chars]
    edge = np.ones(len(chars), bool)
    edge[1:] = ~pieces.joined[kind[:-1] * np.int32(pieces.kinds) + kind[1:]]
    edge[offsets[offsets < len(chars)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(chars))
    rows = np.searchsorted(starts, offsets)
    keys, first, which = np.unique(pieces.of(pieces.hashes(chars), starts, ends), return_index=True, return_inverse=True)
    starts, sizes = starts[first], (ends - starts)[first]
    own = chars[_ranges(starts, sizes)]
    at = np.cumsum(sizes) - sizes
    double = np.zeros(len(own) + 1, np.int64)
    inner = own == ord(SPACE)
    double[2:] = inner[1:] & inner[:-1]
    double = np.cumsum(double)
    runs = double[at + sizes] - double[at + np.minimum(1, sizes)] > 0
    return _Slice(rows, which.reshape(-1), keys, own, at, sizes, (sizes > 1) & (sizes <= WIDEST) & ~(runs & pieces.merges))


def _held(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each of wanted is among the sorted keys."""
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted if len(keys) else np.zeros(len(wanted), bool)


class Memory:
    """The atoms a task has met, with their pieces on the side that assembles. Both sides of the fold follow the same rule, so they agree on which atoms are new."""

    def __init__(self) -> None:
        self.keys, self.begin, self.count, self.flat = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def new(self, s: _Slice) -> np.ndarray:
        return np.flatnonzero(~_held(self.keys, s.keys))

    def add(self, s: _Slice, new: np.ndarray, count: np.ndarray | None = None, flat: np.ndarray | None = None) -> None:
        """Takes in the new atoms of a slice; when that is too many, only the slice's own stay."""
        at = np.searchsorted(self.keys, s.keys[new])
        self.keys = np.insert(self.keys, at, s.keys[new])
        if count is not None:
            self.begin, self.count = np.insert(self.begin, at, len(self.flat) + np.cumsum(count) - count), np.insert(self.count, at, count)
            self.flat = np.concatenate([self.flat, flat])
        if len(self.keys) > REMEMBERED:
            own = _held(s.keys, self.keys)
            self.keys = self.keys[own]
            if count is not None:
                self.count = self.count[own]
                self.flat = self.flat[_ranges(self.begin[own], self.count)]
                self.begin = np.cumsum(self.count) - self.count


def _spans(pieces: Pieces, s: _Slice, atoms: np.ndarray, single: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Atom, start, length and piece of each substring that is a piece; with single, of each character too (-1 where it is none)."""
    chars = s.chars[_ranges(s.starts[atoms], s.sizes[atoms])]
    owner = np.repeat(np.arange(len(atoms)), s.sizes[atoms])
    at = np.cumsum(s.sizes[atoms]) - s.sizes[atoms]
    place = np.arange(len(chars)) - at[owner]
    left = s.sizes[atoms][owner] - place
    total, found = pieces.hashes(chars), [(owner, place, np.ones(len(chars), np.int64), pieces.single[chars])] if single and len(chars) else []
    for n in range(2, pieces.longest + 1):
        p = np.flatnonzero(left >= n)
        if not len(p):
            break
        ids = pieces.found(pieces.of(total, p, p + n))
        p, ids = p[ids >= 0], ids[ids >= 0]
        found.append((owner[p], place[p], np.full(len(p), n), ids))
    own, start, n, ids = (np.concatenate(x) if found else np.empty(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 4))
    return own, start, n, ids


def scored(pieces: Pieces, s: _Slice, atoms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges of these atoms for a unigram model, grouped by atom, from the left and shortest first: number of each atom's edges, their starts, ends, pieces and scores."""
    own, start, n, ids = _spans(pieces, s, atoms, True)
    order = np.lexsort((n, start, own))
    own, start, n, ids = own[order], start[order], n[order], ids[order]
    return np.bincount(own, minlength=len(atoms)), start, start + n, ids, np.where(ids < 0, pieces.lowest, pieces.scores[ids])


def lattice(pieces: Pieces, s: _Slice, atoms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges of these atoms for merges, grouped by atom, best score first and then from the left: number of each atom's edges, their ends and inner boundaries as masks, and the pieces."""
    own, start, n, ids = _spans(pieces, s, atoms, False)
    # one number to sort by: atom, rank, start (6 bits), length
    order = np.argsort(((own * np.int64(len(pieces.rank)) + pieces.rank[ids]) << 6 | start) * np.int64(pieces.longest + 1) + n)
    own, start, n, ids = own[order], start[order], n[order], ids[order]
    one = np.int64(1)
    ends = (one << start) | (one << (start + n))
    inner = ((one << (n - 1)) - 1) << (start + 1)
    return np.bincount(own, minlength=len(atoms)), ends, inner, ids


def fold_merges(mask: Column, edges: Column) -> Column:
    """The boundaries left of a mask when the edges have been tried in order."""

    def step(state: Column, edge: Column) -> Column:
        fits = (state.bitwiseAND(edge["ends"]) == edge["ends"]) & (F.bit_count(state.bitwiseAND(edge["inner"])) == 1)
        return F.when(fits, state.bitwiseAND(F.bitwise_not(edge["inner"]))).otherwise(state)

    return F.aggregate(edges, mask, step)


def viterbi(length: Column, edges: Column) -> Column:
    """For a unigram model: the best path over edges (start, end, id, score) in order of start or of end, as an array of (score, from, id, cuts) for each end.

    The fold's state has an entry for each end reached; an edge improves the entry of its end. cuts has a bit for each
    boundary on the path, for lengths up to 62. All positions must be reachable, so an atom's edges include one for each
    character. Ties go to the edge met first.
    """

    def entry(score: Column, origin: Column, piece: Column, cuts: Column) -> Column:
        return F.struct(score.alias("score"), origin.cast("int").alias("from"), piece.cast("int").alias("id"), cuts.cast("long").alias("cuts"))

    begin = F.transform(F.sequence(F.lit(0), length.cast("int")), lambda i: entry(F.when(i == 0, F.lit(0.0)).otherwise(F.lit(float("-inf"))), F.lit(-1), F.lit(-1), F.when(i == 0, F.lit(1)).otherwise(F.lit(0))))

    def step(state: Column, e: Column) -> Column:
        before = F.get(state, e["start"])
        score = before["score"] + e["score"]
        better = score > F.get(state, e["end"])["score"]
        new = entry(score, e["start"], e["id"], before["cuts"].bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), e["end"])))
        return F.when(better, F.transform(state, lambda x, i: F.when(i == e["end"], new).otherwise(x))).otherwise(state)

    return F.aggregate(edges, begin, step)


def fold_best(mask: Column, edges: Column) -> Column:
    """The boundaries on the best path; mask has one bit more than the atom has characters."""
    return F.element_at(viterbi(F.bit_count(mask) - 1, edges), -1)["cuts"]


#: An edge's columns for merges, and for a unigram model.
_MERGE = pa.struct([("ends", pa.int64()), ("inner", pa.int64())])
_SCORED = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("id", pa.int32()), ("score", pa.float64())])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        size, a = 0, 0
        for i, text in enumerate(b.column("text")):
            size += len(text.as_py() or "")
            if size >= SLICE:
                yield b.slice(a, i + 1 - a)
                size, a = 0, i + 1
        if a < b.num_rows:
            yield b.slice(a)


def _open(path: str | None):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, memory = load(path), Memory()
        kind = _MERGE if pieces.merges else _SCORED
        nested = pa.list_(pa.list_(kind))
        for k, b in enumerate(_slices(batches)):
            s = cut(pieces, [t or "" for t in b.column("text").to_pylist()])
            new = memory.new(s)
            memory.add(s, new)
            atoms = new[s.by_fold[new]]
            counts, *columns = lattice(pieces, s, atoms)[:3] if pieces.merges else scored(pieces, s, atoms)
            masks, cuts = (np.int64(1) << (s.sizes[atoms] + 1)) - 1, np.concatenate([[0], np.cumsum(counts)])
            for a in range(0, len(masks), ATOMS):
                z = min(a + ATOMS, len(masks))
                edges = pa.StructArray.from_arrays([pa.array(c[cuts[a] : cuts[z]], f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))
                edges = pa.ListArray.from_arrays(pa.array((cuts[a : z + 1] - cuts[a]).astype(np.int32)), edges)
                yield _row(k, [None], [None], pa.ListArray.from_arrays(pa.array([0, z - a], pa.int32()), pa.array(masks[a:z])), pa.ListArray.from_arrays(pa.array([0, z - a], pa.int32()), edges).cast(nested))
            n = b.num_rows
            yield _row(k, b.column("doc_id"), b.column("text"), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, nested))

    return run


def _row(k: int, ids, texts, masks: pa.Array, edges: pa.Array) -> pa.RecordBatch:
    n = len(masks)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, k)), pa.array(ids, pa.int64()) if isinstance(ids, list) else ids, pa.array(texts, pa.string()) if isinstance(texts, list) else texts, masks, edges], ["slice", "doc_id", "text", "masks", "edges"])


def encoded(pieces: Pieces, s: _Slice, new: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and ids of the pieces of the new atoms, from the boundaries of those that the fold encoded."""
    size = s.sizes
    atoms, one = new[s.by_fold[new]], new[size[new] == 1]
    # substrings between boundaries, and the atoms of one character
    place = np.empty(0, np.int64)
    atom = end = place
    if len(atoms):
        which, place = np.nonzero((masks[:, None] >> np.arange(int(size[atoms].max()) + 1)) & 1 == 1)
        last = place == size[atoms][which]
        atom, end, place = atoms[which[~last]], np.append(place[1:], 0)[~last], place[~last]
    atom = np.concatenate([atom, one])
    a = s.starts[atom] + np.concatenate([place, np.zeros(len(one), np.int64)])
    z = s.starts[atom] + np.concatenate([end, np.ones(len(one), np.int64)])
    order = np.argsort(atom, kind="stable")
    atom, a, z = atom[order], a[order], z[order]
    ids = np.full(len(atom), -1, np.int32)
    short = z - a == 1
    ids[short] = pieces.single[s.chars[a[short]]]
    if not short.all():
        ids[~short] = pieces.found(pieces.of(pieces.hashes(s.chars), a[~short], z[~short]))
    # what has no piece is spelt in bytes, and what the fold can't take goes to the queue
    spelt = {int(k): pieces.symbol("".join(map(chr, s.chars[a[k] : z[k]]))) for k in np.flatnonzero(ids < 0)}
    lengths = np.ones(len(ids), np.int64)
    for k, v in spelt.items():
        lengths[k] = len(v)
    flat, at = np.repeat(ids, lengths), np.cumsum(lengths) - lengths
    for k, v in spelt.items():
        flat[at[k] : at[k] + len(v)] = v
    count = np.bincount(atom, weights=lengths, minlength=len(size)).astype(np.int64)
    begin, tail, rest = np.cumsum(count) - count, len(flat), []
    for k in new[(size[new] > 1) & ~s.by_fold[new]]:
        v = (pieces.merged if pieces.merges else pieces.best)("".join(map(chr, s.chars[s.starts[k] : s.starts[k] + size[k]])))
        count[k], begin[k], tail = len(v), tail, tail + len(v)
        rest += v
    flat = np.concatenate([flat, np.array(rest, np.int32)])
    return count[new], flat[_ranges(begin[new], count[new])]


def assemble(pieces: Pieces, texts: list[str], masks: np.ndarray, memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of all texts one after the other, and where each text's begin."""
    s = cut(pieces, texts)
    new = memory.new(s)
    memory.add(s, new, *encoded(pieces, s, new, masks))
    at = np.searchsorted(memory.keys, s.keys)[s.which]
    count = memory.count[at]
    ends = np.concatenate([[0], np.cumsum(count)])[s.rows]
    flat = memory.flat[_ranges(memory.begin[at], count)]
    if (pieces.byte_ids < 0).any():  # unknown pieces next to each other in a text are one
        again = flat == pieces.unknown
        again[1:] &= again[:-1].copy()
        again[ends[ends < len(flat)]] = False
        flat, ends = flat[~again], ends - np.concatenate([[0], np.cumsum(again)])[ends]
    return flat, ends


def _close(path: str | None, check: bool):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, memory, now, masks, ids, texts = load(path), Memory(), None, [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            if ids:
                flat, at = assemble(pieces, [t or "" for t in texts], np.concatenate([*masks, np.empty(0, np.int64)]).astype(np.int64), memory)
                out = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))
                ok = [pieces.decode(flat[a:z].tolist()) == (t or "") if check else None for a, z, t in zip(at[:-1].tolist(), at[1:].tolist(), texts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), out, pa.array(ok, pa.bool_())], ["doc_id", "ids", "round_trip"])

        for b in batches:
            for k, one, text, mask in zip(b.column("slice").to_pylist(), b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("masks"), strict=True):
                if k != now:
                    yield from done()
                    now, masks, ids, texts = k, [], [], []
                if mask.is_valid:
                    masks.append(mask.values.to_numpy(zero_copy_only=False))
                else:
                    ids.append(one)
                    texts.append(text)
        yield from done()

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, check: bool = True) -> DataFrame:
    """doc_id, ids (the pieces of the whole text) and round_trip (decoding gives the text back) for each row of docs.

    path is the model's file, of merges or unigram, the same on all machines. Null and empty texts have no pieces and decode to the empty
    text. Repeated rows are encoded alike; an empty table gives an empty result; further columns are ignored.
    A text that holds U+2581 itself decodes with spaces there, as the model has it.
    """
    rows = picked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    edge, fold = ("ends:long,inner:long", fold_merges) if load(path).merges else ("start:int,end:int,id:int,score:double", fold_best)
    opened = rows.mapInArrow(_open(path), f"slice long, doc_id long, text string, masks array<long>, edges array<array<struct<{edge}>>>")
    folded = opened.select("slice", "doc_id", "text", F.zip_with("masks", "edges", fold).alias("masks"))
    return folded.mapInArrow(_close(path, check), "doc_id long, ids array<int>, round_trip boolean")


def _decoded(path: str | None):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([pieces.decode(x) if x is not None else None for x in b.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return run


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """doc_id and text of each row's pieces; null pieces give a null text. Bytes that aren't UTF-8 become U+FFFD."""
    rows = picked(rows, doc_id=id_col, ids=ids_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoded(path), "doc_id long, text string")
