"""Distinct sampled segmentations into pieces, by Gumbel top-k without replacement, and decoding.

The pieces and byte pieces of a SentencePiece model span a lattice over a text (blanks as ``▁``, one in front). A piece
never goes on past the blank behind a word, so the lattice is a chain of lattices of words. The models here state merge
ranks instead of probabilities; a piece of rank ``r`` gets the log-probability ``-alpha * log(2 + r)``, byte pieces and
runs of blanks that of the last rank, and a segmentation the sum of its pieces, normalised over the lattice.

The search is perturbed A-star: a region is a set of segmentations with a common beginning; it holds a Gumbel variable
of its total probability, cut off at that of the region it came from. The best region is opened: its best segmentation
is drawn from its distribution, and what remains is split at every word into the segmentations that differ there
first. The k first segmentations are a sample without replacement; with the perturbed value of the next region as
threshold, each one's probability of being included is known. Random numbers are hashes of the seed, the ``doc_id``,
the draw and the place, so a row has the same result wherever it is computed.

Words of a block of texts are looked up, summed and drawn as arrays; each different word has one lattice in a block.

Defined results: a null or empty text has one segmentation, of no piece; a text with fewer than k segmentations gives
all of them; a null ``doc_id`` seeds as -1; repeated rows get equal results; characters outside the model become byte
pieces, so decoding restores every text; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from sentloom.llm.worker import kept

BLANK = 0x2581
#: Code points of texts whose words are handled as arrays at once. The arrays take some 130 bytes for each.
BLOCK = 1_000_000
#: Words after a branch that are looked at first, and the log of the share below which those behind them can wait.
LEADING, LEAST_SHARE = 96, -60.0
#: Above this log-probability of a segmentation, that of the others is summed instead of taken as the rest.
SURE = -1e-6
_BASE = 0x9E3779B97F4A7C15
_SLOTS = 22
_STEP = np.uint64(_BASE)
_SHIFTS = np.uint64(30), np.uint64(27), np.uint64(31)
_FACTORS = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _SHIFTS[0])
    x *= _FACTORS[0]
    x ^= x >> _SHIFTS[1]
    x *= _FACTORS[1]
    x ^= x >> _SHIFTS[2]
    return x


def _keyed(h: np.ndarray, *keys) -> np.ndarray:
    for k in keys:
        k = np.uint64(k & 0xFFFFFFFFFFFFFFFF) if isinstance(k, int) else np.atleast_1d(np.asarray(k)).astype(np.int64).view(np.uint64)
        h = _mix(h * _STEP + k)
    return h


def _uniform(h: np.ndarray, *keys) -> np.ndarray:
    """Numbers in (0, 1) from a state and whole-number keys."""
    return ((_keyed(h, *keys) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums and the powers that turn their differences into hashes of substrings."""
    power = np.full(len(codes) + 1, _BASE, np.uint64)
    power[0] = 1
    back = np.full(len(codes) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * np.cumprod(power)[:-1])])
    return sums, np.cumprod(back)


class Vocabulary:
    def __init__(self, path: str, alpha: float):
        model = SentencePieceProcessor(model_file=path)
        n = model.GetPieceSize()
        text = [model.IdToPiece(i) for i in range(n)]
        rank = np.array([-model.GetScore(i) for i in range(n)])
        self.bytes = np.zeros(256, np.int64)
        plain = []
        for i in range(n):
            if model.IsByte(i):
                self.bytes[int(text[i][3:-1], 16)] = i
            elif not (model.IsControl(i) or model.IsUnknown(i)):
                plain.append(i)
        self.log = -alpha * np.log(2 + np.minimum(np.maximum(rank, 0), n))
        self.byte_log = -alpha * float(np.log(2 + n))
        self.content = [bytes([int(t[3:-1], 16)]) if model.IsByte(i) else t.replace("▁", " ").encode() for i, t in enumerate(text)]
        for i in range(n):
            if model.IsControl(i) or model.IsUnknown(i):
                self.content[i] = b""
        self.content_size = np.array([len(c) for c in self.content])
        self.content_at = np.cumsum(self.content_size) - self.content_size
        self.all_content = np.frombuffer(b"".join(self.content), np.uint8)
        self.longest = max(len(text[i]) for i in plain)
        # Two tables by different bits of the hash; what both have taken already is looked up in a third by search.
        self.hash, self.slots = np.zeros(n, np.uint64), [np.full(1 << _SLOTS, -1, np.int32) for _ in range(2)]
        # Bits of the beginnings of pieces: a place where none goes on needs no longer look.
        self.begun = np.zeros(1 << _SLOTS, bool)
        left = []
        for i in plain:
            codes = np.frombuffer(text[i].encode("utf-32-le"), "<u4")
            sums, _ = _hashes(codes)
            begun = _mix(sums[1:] + np.arange(1, len(codes) + 1, dtype=np.uint64))
            self.begun[(begun & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)] = True
            h = begun[-1]
            self.hash[i] = h
            for table, at in zip(self.slots, (int(h) & (1 << _SLOTS) - 1, int(h) >> (64 - _SLOTS)), strict=True):
                if table[at] < 0:
                    table[at] = i
                    break
            else:
                left.append(i)
        self.left = np.array(sorted(left, key=lambda i: self.hash[i]), np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Pieces with these hashes, or -1."""
        mask = np.uint64((1 << _SLOTS) - 1)
        out = self.slots[0][(h & mask).astype(np.int64)]
        out = np.where((out >= 0) & (self.hash[out] == h), out, -1)
        second = self.slots[1][(h >> np.uint64(64 - _SLOTS)).astype(np.int64)]
        out = np.where((out < 0) & (second >= 0) & (self.hash[second] == h), second, out)
        if len(self.left):
            at = np.minimum(np.searchsorted(self.hash[self.left], h), len(self.left) - 1)
            out = np.where((out < 0) & (self.hash[self.left[at]] == h), self.left[at], out)
        return out


def _vocabulary(path: str, alpha: float) -> Vocabulary:
    state = kept("pieces")
    if getattr(state, "pieces_of", None) != (path, alpha):
        state.pieces, state.pieces_of = Vocabulary(path, alpha), (path, alpha)
    return state.pieces


class Lattices:
    """Lattices of words ``codes[first[i]:first[i] + size[i]]``. A node is a place in ``codes``; the edges of a node are
    next to each other, long pieces first. An edge has a piece, or minus a code point less one for its byte pieces."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray, words: Vocabulary):
        self.first, self.stop = first, first + size
        node = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        end = np.repeat(self.stop, size)
        sums, back = _hashes(codes)
        starts, stops, pieces = [], [], []
        at, stops_at = node, end
        for length in range(1, words.longest + 1):
            fits = at + length <= stops_at
            at, stops_at = at[fits], stops_at[fits]
            h = _mix((sums[at + length] - sums[at]) * back[at] + np.uint64(length))
            # A piece is a beginning of itself.
            goes_on = words.begun[(h & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)]
            if length == 1:
                code = codes[at].astype(np.int64)
                piece = np.where(code < 0x80, words.bytes[code & 0x7F], -1 - code)
                found = words.find(h[goes_on])
                piece[goes_on] = np.where(found >= 0, found, piece[goes_on])
                starts.append(at)
                stops.append(at + 1)
                pieces.append(piece)
                at, stops_at = at[goes_on], stops_at[goes_on]
                continue
            at, stops_at = at[goes_on], stops_at[goes_on]
            piece = words.find(h[goes_on])
            known = piece >= 0
            starts.append(at[known])
            stops.append(at[known] + length)
            pieces.append(piece[known])
        # What the search needs is let go before the edges are put in order.
        del sums, back, at, stops_at, h, goes_on, fits
        start, stop, piece = (np.concatenate(x[::-1]) for x in (starts, stops, pieces))
        del starts, stops, pieces
        # Runs in order, so a stable sort merges them; long pieces, mostly the likely ones, come first.
        order = np.argsort(start, kind="stable")
        start, stop, piece = start[order], stop[order], piece[order]
        cost = np.where(piece >= 0, words.log[np.maximum(piece, 0)], 0.0)
        lone = piece < 0
        code = -1 - piece[lone]
        cost[lone] = words.byte_log * (2 + (code >= 0x800) + (code >= 0x10000))
        # Sums from the ends of the words backwards, all words at once.
        left = np.zeros(len(codes) + 1, np.int64)
        left[node] = end - node
        level = left[start]
        last = stop == start + level
        far = int(level.max(initial=0))
        order = np.argsort(level.astype(np.uint16) if far < 65536 else level, kind="stable")
        total = np.zeros(len(codes) + 1)
        levels = np.searchsorted(level[order], np.arange(1, far + 2))
        for a, b in zip(levels[:-1], levels[1:], strict=True):
            if a < b:
                e = order[a:b]
                s = start[e]
                new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                total[s[new]] = np.logaddexp.reduceat(cost[e] + np.where(last[e], 0.0, total[stop[e]]), new)
        self.piece, self.next, self.last = piece, stop, last
        self.log = cost + np.where(last, 0.0, total[stop]) - total[start]
        sums = np.concatenate([[0.0], np.cumsum(np.exp(self.log))])
        self.edge = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=len(codes) + 1))])
        self.reach = sums[1:] - sums[self.edge[start]]
        final = np.concatenate([start[1:] != start[:-1], [True]]) if len(start) else np.zeros(0, bool)
        self.reach[final] = 2.0
        self.rests: dict[int, float] = {}

    def draw(self, word: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of ``word`` a segmentation: edges word by word, how many, and the log-probability."""
        n = len(word)
        # Every word has an edge, and most have no more.
        at, u = self.first[word], _uniform(h, 0)
        e = self.edge[at]
        more = np.flatnonzero(u > self.reach[e])
        while len(more):
            e[more] += 1
            more = more[u[more] > self.reach[e[more]]]
        heads = e
        count, log, taken = np.ones(n, np.int64), self.log[e], []
        active = np.flatnonzero(~self.last[e])
        at, step = self.next[e[active]], 1
        while len(active):
            u = _uniform(h[active], step)
            e = self.edge[at]
            more = np.flatnonzero(u > self.reach[e])
            while len(more):
                e[more] += 1
                more = more[u[more] > self.reach[e[more]]]
            taken.append((active, e))
            count[active] += 1
            log[active] += self.log[e]
            on = ~self.last[e]
            active, at, step = active[on], self.next[e[on]], step + 1
        begin = np.concatenate([[0], np.cumsum(count)])
        edges = np.zeros(begin[-1], np.int64)
        edges[begin[:-1]] = heads
        for k, (who, e) in enumerate(taken, 1):
            edges[begin[who] + k] = e
        return edges, begin, log

    def remaining(self, word: int, excluded: list[np.ndarray]) -> tuple[list[dict[int, int]], list[np.ndarray], np.ndarray]:
        """The segmentations of a word but ``excluded``, as a tree of the beginnings of these: the branches of each
        beginning (-1: an excluded one ends), the log-probabilities left to the edges behind it, and their sums.

        Shares are added from the ends, never taken away from one another, so the smallest is exact.
        """
        at, below = [self.first[word]], [{}]
        for path in excluded:
            t = 0
            for e in path.tolist():
                if e not in below[t]:
                    below[t][e] = -1 if self.last[e] else len(at)
                    if not self.last[e]:
                        at.append(self.next[e])
                        below.append({})
                t = below[t][e]
        weights, total = [np.zeros(0)] * len(at), np.full(len(at), -np.inf)
        for t in range(len(at) - 1, -1, -1):
            begin = self.edge[at[t]]
            weights[t] = self.log[begin : self.edge[at[t] + 1]].copy()
            for e, child in below[t].items():
                weights[t][e - begin] += total[child] if child >= 0 else -np.inf
            total[t] = np.logaddexp.reduce(weights[t])
        return below, weights, total

    def rest(self, word: int, path: np.ndarray) -> float:
        """Log-probability of the other segmentations of a word where ``path`` has nearly all of it."""
        if word not in self.rests:
            self.rests[word] = float(self.remaining(word, [path])[2][0])
        return self.rests[word]

    def draw_other(self, word: int, excluded: list[np.ndarray], h: np.ndarray) -> tuple[np.ndarray, float] | None:
        """A segmentation of one word that is none of ``excluded``, or None if there is no other."""
        below, weights, total = self.remaining(word, excluded)
        if total[0] == -np.inf:
            return None
        node, path, log, step, t = self.first[word], [], 0.0, 0, 0
        while True:
            begin = self.edge[node]
            w = self.log[begin : self.edge[node + 1]] if t is None else weights[t]
            p = np.exp(w - w.max())
            u = float(_uniform(h, step)[0]) * p.sum()
            x = int(begin + min(np.searchsorted(np.cumsum(p), u), np.flatnonzero(p)[-1]))
            path.append(x)
            log += float(self.log[x])
            if self.last[x]:
                return np.array(path), log
            t = None if t is None else below[t].get(x)
            node, step = self.next[x], step + 1


def _gumbel(log_mass: np.ndarray, below: float, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of these locations, cut off at ``below``."""
    with np.errstate(over="ignore", divide="ignore"):
        free = log_mass - np.log(-np.log(u))
        return -np.logaddexp(-free, -below)


class _Path:
    """A segmentation: for each word the draw it comes from, or edges of its own."""

    def __init__(self, draw: np.ndarray, own: dict[int, tuple[np.ndarray, float]], log: np.ndarray):
        self.draw, self.own, self.log = draw, own, log


def sample_document(lattices: Lattices, word: np.ndarray, draws: list[tuple], state: np.ndarray, k: int):
    """Up to ``k`` paths with their perturbed values, and the value of the region that would be next."""
    n = len(word)

    def edges_of(path: _Path, i: int) -> np.ndarray:
        if i in path.own:
            return path.own[i][0]
        edges, begin, _ = draws[path.draw[i]]
        return edges[begin[i] : begin[i + 1]]

    def masses(path: _Path, ahead: np.ndarray, first: int, stop: int) -> np.ndarray:
        """Log-probability of the segmentations that first differ from ``path`` at each of these words."""
        log = path.log[first:stop]
        with np.errstate(divide="ignore"):
            rest = np.log(-np.expm1(np.minimum(log, 0.0)))
        # One less nearly one has no digits left; only one segmentation of a word can have so large a share.
        near = np.flatnonzero(log > SURE)
        if len(near):
            which, one, back = np.unique(word[first + near], return_index=True, return_inverse=True)
            rest[near] = np.array([lattices.rest(int(w), edges_of(path, first + int(near[i]))) for w, i in zip(which, one, strict=True)])[back]
        return ahead[first:stop] + rest

    top = float(_gumbel(np.zeros(1), np.inf, _uniform(state, -1))[0])
    # A region: perturbed value, path it leaves, word where it leaves, edges excluded there.
    regions: list[tuple[float, _Path | None, int, list[np.ndarray]]] = [(top, None, -1, [])]
    out: list[tuple[_Path, float]] = []
    opened = 0
    while regions and len(out) < k:
        best = max(range(len(regions)), key=lambda r: regions[r][0])
        value, parent, at, excluded = regions.pop(best)
        opened += 1
        turn = len(out)
        if parent is None:
            path = _Path(np.zeros(n, np.int64), {}, draws[0][2].copy())
        else:
            other = lattices.draw_other(int(word[at]), excluded, _keyed(state, 1000 + opened, at))
            if other is None:
                continue
            draw, log = parent.draw.copy(), parent.log.copy()
            draw[at + 1 :], log[at + 1 :] = turn, draws[turn][2][at + 1 :]
            log[at] = other[1]
            path = _Path(draw, {i: x for i, x in parent.own.items() if i < at} | {at: other}, log)
        out.append((path, value))
        # Regions behind so unlikely a beginning are only looked at where the others may not give k segmentations.
        ahead = np.concatenate([[0.0], np.cumsum(path.log[: at + 1 + LEADING])])
        first, stop = at + 1, min(n, at + 1 + LEADING)
        mass = masses(path, ahead, first, stop)
        if stop < n and (ahead[stop] > LEAST_SHARE or len(regions) + int((mass > -np.inf).sum()) <= k - len(out)):
            ahead = np.concatenate([[0.0], np.cumsum(path.log)])
            mass, stop = np.concatenate([mass, masses(path, ahead, stop, n)]), n
        perturbed = _gumbel(mass, value, _uniform(state, 2000 + opened, np.arange(first, stop)))
        most = k + 1 - turn
        leading = np.argpartition(-perturbed, most - 1)[:most] if len(perturbed) > most else np.arange(len(perturbed))
        for i in leading[np.argsort(-perturbed[leading])].tolist():
            if mass[i] > -np.inf:
                regions.append((float(perturbed[i]), path, first + i, [edges_of(path, first + i)]))
        if parent is not None:
            gone = [*excluded, path.own[at][0]]
            rest = lattices.remaining(int(word[at]), gone)[2][0]
            if rest > -np.inf:
                mass = np.array([ahead[at] + rest])
                u = _uniform(state, 3000 + opened, at)
                regions.append((float(_gumbel(mass, value, u)[0]), path, at, gone))
    following = max((r[0] for r in regions), default=-np.inf)
    return out, following, edges_of


def _ids(edges: np.ndarray, lattices: Lattices, words: Vocabulary) -> np.ndarray:
    piece = lattices.piece[edges]
    if (piece < 0).any():
        parts = [words.bytes[list(chr(-1 - p).encode("utf-8", "surrogatepass"))] if p < 0 else [p] for p in piece.tolist()]
        piece = np.concatenate(parts)
    return piece.astype("<u4")


def decode_bytes(ids: np.ndarray, words: Vocabulary) -> bytes:
    """The text of ids as this module makes them, in UTF-8: blanks for ``▁`` and without the one in front."""
    size = words.content_size[ids]
    end = np.cumsum(size)
    at = np.repeat(words.content_at[ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
    return words.all_content[at].tobytes().removeprefix(b" ")


def decode_ids(ids: np.ndarray, words: Vocabulary) -> str:
    return decode_bytes(ids, words).decode("utf-8", "replace")


def sample_texts(texts: list[str], rows: list[int], words: Vocabulary, k: int, seed: int) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """``text number, rank, ids, log-probability, perturbed value, log of the inclusion probability``."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK):
            size += len(texts[end]) + 1
            end += 1
        whole = "".join(" " + t if t else "" for t in texts[at:end])
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4").copy()
        codes[codes == 0x20] = BLANK
        lengths = np.array([len(t) + 1 if t else 0 for t in texts[at:end]])
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        blank = codes == BLANK
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[bounds[:-1][lengths > 0]] = True
        first = np.flatnonzero(begins)
        size_of = np.diff(np.concatenate([first, [len(codes)]]))
        sums, back = _hashes(codes)
        # Numbers in the order in which the words come first.
        word, _ = pd.factorize(_mix((sums[first + size_of] - sums[first]) * back[first] + size_of.astype(np.uint64)))
        one = np.flatnonzero(np.diff(np.maximum.accumulate(word), prepend=-1))
        # The different words, one after another.
        sizes = size_of[one]
        begin = np.cumsum(sizes) - sizes
        codes = codes[np.repeat(first[one] - begin, sizes) + np.arange(sizes.sum())]
        del whole, blank, begins, sums, back, size_of
        lattices = Lattices(codes, begin, sizes, words)
        firsts = np.searchsorted(first, bounds)
        of = np.repeat(np.arange(end - at), np.diff(firsts))
        states = _keyed(np.zeros(1, np.uint64), seed, np.array(rows[at:end], np.int64))
        place = np.arange(len(word)) - firsts[:-1][of]
        places = _keyed(states[of], place)
        passes = [lattices.draw(word, _keyed(places, turn)) for turn in range(k)]
        for d in range(end - at):
            a, b = int(firsts[d]), int(firsts[d + 1])
            mine = [(e, begin[a : b + 1], log[a:b]) for e, begin, log in passes]
            paths, following, edges_of = sample_document(lattices, word[a:b], mine, states[d : d + 1], k)
            for rank, (path, value) in enumerate(paths, 1):
                # Stretches of words from one draw are one slice of its edges.
                cuts = sorted({0, b - a, *path.own, *(i + 1 for i in path.own), *(np.flatnonzero(np.diff(path.draw)) + 1).tolist()})
                parts = [np.zeros(0, np.int64)]
                for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                    if i in path.own:
                        parts.append(path.own[i][0])
                    else:
                        e, begin, _ = mine[path.draw[i]]
                        parts.append(e[begin[i] : begin[j]])
                log = float(path.log.sum())
                x = log - following
                included = 0.0 if x > 700 else x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))
                yield at + d, rank, _ids(np.concatenate(parts), lattices, words), log, value, included
        at = end


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into slices of about ``BLOCK`` bytes of text, so that only one of them is there as Python strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
        yield batch.slice(at, end - at)
        at = end


def sample_segmentations(docs: DataFrame, model: str, *, k: int = 2, alpha: float = 1.0, seed: int = 1, keep_ids: bool = True) -> DataFrame:
    """Up to ``k`` distinct segmentations of each row of ``docs(doc_id, text)``, in the order of their perturbed values.

    ``doc_id, rank, n_pieces, ids_crc32, log_prob, perturbed, log_inclusion``, the checksum of the decoded text, and
    with ``keep_ids`` the ids as little-endian unsigned 32-bit integers.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(model, alpha)
        for batch in batches:
            rows: list[tuple] = []
            for part in _blocks(batch):
                names = part["doc_id"].to_pylist()
                texts = [t or "" for t in part["text"].to_pylist()]
                for at, rank, ids, log, value, included in sample_texts(texts, [-1 if n is None else n for n in names], words, k, seed):
                    raw = ids.tobytes()
                    text = zlib.crc32(decode_bytes(ids, words))
                    rows.append((names[at], rank, len(ids), zlib.crc32(raw), log, value, included, text, raw if keep_ids else None))
                    if len(rows) >= 500:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types_, strict=True)], names=columns)
                        rows = []
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types_, strict=True)], names=columns)

    schema = "doc_id long, rank int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, log_inclusion double, decoded_crc32 long, ids binary"
    columns = [c.split()[0] for c in schema.split(", ")]
    types_ = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.binary()]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = texts.mapInArrow(sample, schema)
    return out if keep_ids else out.drop("ids")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with a column ``text`` made from its ids; null ids give a null text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(model, 1.0)
        for batch in batches:
            texts = [None if x is None else decode_ids(np.frombuffer(x, "<u4"), words) for x in batch["ids"].to_pylist()]
            yield pa.record_batch([*(batch[c] for c in batch.schema.names), pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    return encoded.drop("text").mapInArrow(decode, encoded.drop("text").schema.add("text", "string"))
