"""Byte-level BPE by a public rank file: vectorised splitting, cached pair merging, decoding."""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa

#: Where the public vocabulary files lie; a parameter of everything that encodes.
VOCABULARIES = "/opt/tokenizers"
#: Pieces whose ids a worker remembers, in two generations of at most so many (and those of one slice).
CACHE = 150_000
#: Code points that are split at once.
SLICE = 2_000_000
#: Bytes up to which pieces are merged together in a matrix; longer ones by a heap each.
SHORT = 64

# Classes of code points. The four letters and two pairs after an apostrophe are those of the
# public splitting pattern ('s 't 're 've 'm 'll 'd); they are fixed values.
L, N, SP, WS, O, AP, ONE, LL, V, R, E, END = range(12)
LETTERS = (L, ONE, LL, V, R, E)
_FIXED = {" ": SP, "'": AP, "s": ONE, "d": ONE, "m": ONE, "t": ONE, "l": LL, "v": V, "r": R, "e": E}
#: White space as the pattern's \s has it.
_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# States: what the character just read belongs to.
START, LET, NUM, OTH, SPC, WSP, APS, AL, AV, AR, CON = range(11)


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    kind = np.fromiter(({"L": L, "N": N}.get(unicodedata.category(chr(i))[0], O) for i in range(0x110000)), np.uint8, 0x110000)
    kind[_SPACE] = WS
    for c, k in _FIXED.items():
        kind[ord(c)] = k
    return kind


def step(state: int, kind: int) -> int:
    """The state after one more character."""
    if kind == END:
        return START
    if kind in (SP, WS):
        return SPC if kind == SP else WSP
    if kind == N:
        return NUM
    if kind == O:
        return OTH
    if kind == AP:  # starts a piece of its own unless it continues one or a blank goes with it
        return OTH if state in (SPC, OTH, APS) else APS
    if state == APS:
        return {ONE: CON, LL: AL, V: AV, R: AR}.get(kind, LET)
    if (state, kind) in ((AL, LL), (AV, E), (AR, E)):
        return CON
    return LET


def starts(state: int, kind: int, following: int) -> bool:
    """Whether a piece starts at a character, by the state before it and the class after it."""
    if END in (kind,) or state == START:
        return True
    if kind in (SP, WS):
        # of a run of white space the last one is left to what follows
        return state not in (SPC, WSP) or following not in (SP, WS, END)
    if state == SPC:
        return False
    if state == WSP:
        return True
    if kind == N:
        return state != NUM
    if kind in (O, AP):
        return state not in (OTH, APS)
    if state == APS:
        return not (kind == ONE or (kind, following) in ((LL, LL), (V, E), (R, E)))
    return state not in (LET, AL, AV, AR)


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The transition functions as a finite monoid.

    Gives: the element of each class, the product of any two elements, the state to which an
    element takes each state, and ``starts`` as a table.
    """
    gen = [tuple(step(s, k) for s in range(11)) for k in range(12)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(11)), *gen]))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in gen:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    elements = list(known)
    if len(elements) > 256:
        raise ValueError("the monoid no longer fits a byte")
    product = np.array([[known[tuple(g[x] for x in f)] for g in elements] for f in elements], np.uint8)
    first = np.array([[[starts(s, k, n) for n in range(12)] for k in range(12)] for s in range(11)], bool)
    return np.array([known[g] for g in gen], np.uint8), product, np.array(elements, np.uint8), first


def scan(elements: np.ndarray, block: int = 256) -> np.ndarray:
    """Products of all prefixes of ``elements``; associative, so by blocks: inside, then across."""
    product = automaton()[1]
    size, flat = len(product), product.ravel()
    n = len(elements)
    if n <= block:
        out = np.empty(n, np.uint8)
        acc = 0  # the identity
        for i, x in enumerate(elements.tolist()):
            out[i] = acc = int(product[acc, x])
        return out
    cols = -(-n // block)
    grid = np.zeros(cols * block, np.uint8)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(cols, block).T)
    acc = grid[0].astype(np.intp)
    for j in range(1, block):
        acc = flat[acc * size + grid[j]].astype(np.intp)
        grid[j] = acc
    before = np.zeros(cols, np.intp)
    before[1:] = scan(grid[-1])[:-1]
    return np.ascontiguousarray(flat[before[None, :] * size + grid].T).ravel()[:n]


def boundaries(kinds: np.ndarray) -> np.ndarray:
    """Indices at which pieces start. ``kinds`` must end with END; END splits whatever it stands between."""
    gen, _, elements, first = automaton()
    state = np.empty(len(kinds), np.uint8)
    state[0] = START
    state[1:] = elements[scan(gen[kinds]), START][:-1]
    following = np.empty_like(kinds)
    following[:-1], following[-1] = kinds[1:], END
    table = first.ravel()
    return np.flatnonzero(table[(state.astype(np.int16) * 12 + kinds) * 12 + following])


class Encoder:
    """Ids of texts by a rank file, without special tokens."""

    def __init__(self, path: str):
        lines = Path(path).read_bytes().splitlines()
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
        self.bytes = {i: t for t, i in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for t, rank in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    pairs[(a << 20) | b] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.cache: dict[bytes, list[int]] = {}
        self.older: dict[bytes, list[int]] = {}

    # -- pair merging

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = np.where((a >= 0) & (b >= 0), (a << 20) | b, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.int64(1) << 40)

    def merge_matrix(self, pieces: list[bytes]) -> list[list[int]]:
        """All pieces at once: each round merges in every piece the leftmost pair of lowest rank."""
        n, w = len(pieces), max(map(len, pieces))
        lengths = np.array([len(p) for p in pieces])
        flat = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        t = np.full((n, w + 1), -1, np.int64)
        t[np.arange(w + 1)[None, :] < lengths[:, None]] = flat
        rank = self._rank(t[:, :-1], t[:, 1:])
        out: list[list[int]] = [[] for _ in pieces]
        live = np.arange(n)
        cols = np.arange(w + 1)
        while len(live):
            at = rank.argmin(1)
            best = rank[np.arange(len(live)), at]
            done = best >= np.int64(1) << 40
            if done.any():
                for i, row in zip(live[done].tolist(), t[done].tolist(), strict=True):
                    out[i] = row[: row.index(-1)]
                keep = ~done
                live, t, rank, at, best = live[keep], t[keep], rank[keep], at[keep], best[keep]
                if not len(live):
                    break
            rows = np.arange(len(live))
            t[rows, at] = best
            move = np.minimum(cols[None, :] + (cols[None, :] > at[:, None]), w)
            t = np.take_along_axis(t, move, 1)
            t[:, w] = -1
            rank = np.take_along_axis(rank, np.minimum(move[:, :-1], w - 1), 1)
            rank[:, w - 1] = np.int64(1) << 40
            left = np.maximum(at - 1, 0)
            rank[rows, left] = self._rank(t[rows, left], t[rows, left + 1])
            rank[rows, at] = self._rank(t[rows, at], t[rows, np.minimum(at + 1, w)])
        return out

    def merge_heap(self, piece: bytes) -> list[int]:
        """One long piece: a heap of pairs over a linked list, in n log n steps."""
        t = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(t)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.pairs.get
        heap = [(r, i, t[i], t[i + 1]) for i in range(n - 1) if (r := get((t[i] << 20) | t[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if t[i] >= 0 else n
            if t[i] != a or j >= n or t[j] != b:
                continue
            t[i], t[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := get((r << 20) | t[k])) is not None:
                    heapq.heappush(heap, (q, i, r, t[k]))
            if (h := before[i]) >= 0 and (q := get((t[h] << 20) | r)) is not None:
                heapq.heappush(heap, (q, h, t[h], r))
        return [x for x in t if x >= 0]

    def ids_of(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of distinct pieces, from the cache where they are in it.

        A full generation becomes the older one; what is still asked for moves back into the new.
        """
        if len(self.cache) > CACHE:
            self.older, self.cache = self.cache, {}
        cache, older, ranks = self.cache, self.older, self.ranks
        missing: dict[int, list[bytes]] = {}
        for p in pieces:
            if p not in cache:
                if (known := older.get(p)) is not None:
                    cache[p] = known
                elif (r := ranks.get(p)) is not None:
                    cache[p] = [r]
                elif len(p) > SHORT:
                    cache[p] = self.merge_heap(p)
                elif p:
                    missing.setdefault((len(p) - 1) // 8, []).append(p)
        for alike in missing.values():
            for i in range(0, len(alike), 20_000):
                cache.update(zip(alike[i : i + 20_000], self.merge_matrix(alike[i : i + 20_000]), strict=True))
        return [cache[p] for p in pieces]

    # -- texts

    def encode(self, texts: list[str | None], gather: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids start (with the end: one more).

        Null and empty texts have no ids. Without ``gather`` the ids are only counted.
        """
        flats, counts = [], np.zeros(len(texts), np.int64)
        group: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in parts_of(text) if text else ():
                if size and size + len(part) > SLICE:
                    flats.append(self._slice(group, counts, gather))
                    group, size = [], 0
                group.append((i, part))
                size += len(part)
        if group:
            flats.append(self._slice(group, counts, gather))
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        return np.concatenate(flats) if flats else np.zeros(0, np.int32), offsets

    def _slice(self, group: list[tuple[int, str]], counts: np.ndarray, gather: bool) -> np.ndarray:
        joined = "\0".join(p for _, p in group) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        kinds = classes()[points]
        ends = np.cumsum([len(p) + 1 for _, p in group]) - 1
        kinds[ends] = END
        at = boundaries(kinds)
        data = joined.encode("utf-8", "replace")
        offsets = np.empty(len(at) + 1, np.int32)
        if len(data) == len(points):
            offsets[:-1] = at
        else:
            width = np.ones(len(points), np.int32)
            for limit in (0x80, 0x800, 0x10000):
                width += points >= limit
            offsets[:-1] = np.cumsum(width)[at] - width[at]
        offsets[-1] = len(data)
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        which = pieces.indices.to_numpy(zero_copy_only=False)
        ids = self.ids_of(pieces.dictionary.to_pylist())
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        n = lens[which]
        marks = np.searchsorted(at, ends)
        n[marks] = 0
        upto = np.cumsum(n)
        np.add.at(counts, [i for i, _ in group], np.diff(upto[marks], prepend=0))
        if not gather:
            return np.zeros(0, np.int32)
        flat = np.fromiter((x for i in ids for x in i), np.int32, int(lens.sum()))
        begin = np.cumsum(lens) - lens
        return flat[np.repeat(begin[which] - (upto - n), n) + np.arange(upto[-1])]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes[i] for i in ids).decode("utf-8", "replace")

    def widths(self) -> np.ndarray:
        """Bytes of each id."""
        out = np.zeros(max(self.bytes) + 1, np.int64)
        for i, t in self.bytes.items():
            out[i] = len(t)
        return out


def parts_of(text: str) -> list[str]:
    """A very long text cut where a piece starts whatever stands around: a blank between two letters."""
    if len(text) <= SLICE:
        return [text]
    out, lo = [], 0
    while len(text) - lo > SLICE:
        at = text.find(" ", lo + SLICE // 2)
        while at > 0 and not (text[at - 1].isalpha() and text[at + 1 : at + 2].isalpha() and text[at - 1].isascii() and text[at + 1].isascii()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[lo:at])
        lo = at
    return [*out, text[lo:]]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
