"""The piece lattice of many short strings at once.

A vocabulary gives pieces with integer weights (millionths of a natural log
probability, so that sums are exact and ties are real ties).  A *chunk* is a
string no piece of the vocabulary crosses the ends of: a space opens a chunk
(the mark U+2581 and what follows up to the next space), a line feed opens one
without a mark.  All substrings of a list of chunks are looked up in a hash
table with numpy, and the recursions run over all chunks side by side.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np

from .text import KeyTable, Roller, mix

MARK = "▁"
#: Stands for a mark that is part of the text itself: never in a piece.
_LITERAL = 0x110000
SCALE = 1_000_000
NONE = -(1 << 60)
_BEGIN = -3
#: Positions whose edges are kept while a chunk is searched (more begin anew).
POSITIONS = 4096
_BASE = 0xD6E8FEB86659FD93


class Vocabulary(NamedTuple):
    """Plain data: pieces by id (None: not usable in a lattice), weights by
    id, and the ids and the weight of the 256 byte pieces (characters without
    a piece of their own are spelt with these)."""

    pieces: list
    weights: np.ndarray
    byte_ids: np.ndarray
    byte_weight: int


def load_vocabulary(path: str) -> Vocabulary:
    """A SentencePiece model's pieces.  Scores that are log probabilities are
    used as they are; scores that are merge ranks (0, -1, -2, ...) become log
    probabilities by Zipf's law, 1 / (rank + 1) normalised.  Pieces scored
    below -1e8 (never chosen) and control pieces are left out; byte pieces,
    and without them the unknown piece, weigh as much as the rarest piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    usable = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e8 for i in range(n)]
    pieces = [model.id_to_piece(i) if ok else None for i, ok in enumerate(usable)]
    score = np.array([model.get_score(i) for i in range(n)])
    own = score[np.array(usable)]
    if np.all(own == np.round(own)) and np.all(np.diff(own) < 0):
        total = np.sum(1.0 / (1.0 - own))
        score = np.where(usable, -np.log(np.maximum(1.0, 1.0 - score)) - np.log(total), 0.0)
    weights = np.round(score * SCALE).astype(np.int64)
    alone = model.piece_to_id(MARK)
    if not usable[alone] and model.id_to_piece(alone) == MARK:  # a space must have a piece
        pieces[alone], weights[alone] = MARK, weights[np.array(usable)].min()
    spelt = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
    byte_ids = np.array([spelt.get(f"<0x{b:02X}>", model.unk_id()) for b in range(256)], np.int32)
    return Vocabulary(pieces, weights, byte_ids, int(weights[np.array(usable)].min()))


def chunks_of(text: str) -> list[str]:
    """The chunks of a text: one after each space, one before each line feed;
    a chunk that begins with a line feed has no mark before it."""
    return text.replace("\n", " \n").split(" ")


class _Step:
    """A piece of a path that is grown from a chunk's end, by its length.
    Steps are in the order of the lengths of their paths, from the end; a
    second pointer, further back, finds where two paths part in logarithmic
    time."""

    __slots__ = ("before", "depth", "far", "length")

    def __init__(self, length: int, before: _Step | None):
        self.length, self.before = length, before
        if before is None:
            self.depth, self.far = 0, self
        else:
            self.depth, far = before.depth + 1, before.far
            self.far = far.far if before.depth - far.depth == far.depth - far.far.depth else before

    def _back(self, depth: int) -> _Step:
        at = self
        while at.depth > depth:
            at = at.far if at.far.depth >= depth else at.before
        return at

    def __lt__(self, other: _Step) -> bool:
        depth = min(self.depth, other.depth)
        a, b = self._back(depth), other._back(depth)
        if a is b:
            return self.depth < other.depth
        while a.before is not b.before:
            a, b = (a.far, b.far) if a.far is not b.far else (a.before, b.before)
        return a.length < b.length


class Lattice:
    """Looks up the pieces of a vocabulary in chunks."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        usable = [(p, i) for i, p in enumerate(vocabulary.pieces) if p]
        assert not any("\n" in p or MARK in p[1:] for p, _ in usable), "a piece crosses a chunk"
        self.by_piece = {p: (i, int(vocabulary.weights[i])) for p, i in usable}
        self.longest = max((len(p) for p, _ in usable), default=1)
        self.roller = Roller(_BASE)
        # pieces, and what pieces begin with: a substring that is neither ends the search at its point
        known = {p[:k]: _BEGIN for p, _ in usable for k in range(1, len(p))} | dict(usable)
        points = np.frombuffer("".join(known).encode("utf-32-le"), "<u4")
        size = np.array([len(p) for p in known], np.int64)
        end = np.cumsum(size)
        keys = self._keys(points, end - size, end)
        self.table = KeyTable(keys, np.array(list(known.values()), np.int32))

    def _keys(self, points, begin, end):
        return mix(self.roller.spans(points.astype(np.uint64) + np.uint64(1), begin, end)) | np.uint64(1)

    def edges(self, chunks: list[str]):
        """(points, begin, size, ids): all code points, each chunk's begin and
        length, and by piece length L (1, 2, ...) the piece id at each point,
        -1 for none; a single point spelt in bytes has -2."""
        marked = [c if c[:1] == "\n" else MARK + c for c in chunks]
        points = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint32)
        size = np.array([len(c) for c in marked], np.int64)
        end = np.cumsum(size)
        begin = end - size
        literal = points == ord(MARK)
        first = begin[[c[:1] != "\n" for c in chunks]] if len(chunks) else begin
        literal[first] = False
        points[literal] = _LITERAL
        left = np.repeat(end, size) - np.arange(len(points))
        total = np.zeros(len(points) + 1, np.uint64)
        self.roller.spans(points, np.zeros(0, np.int64), np.zeros(0, np.int64))  # grows its powers
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.roller.up[: len(points)], out=total[1:])
        ids, at = [], np.arange(len(points))
        for length in range(1, self.longest + 1):
            at = at[left[at] >= length]
            if not len(at):
                break
            got = self.table.get(mix((total[at + length] - total[at]) * self.roller.down[at]) | np.uint64(1), -1)
            own = np.full(len(points), -2 if length == 1 else -1, np.int32)
            own[at[got >= 0]] = got[got >= 0]
            ids.append(own)
            at = at[got != -1]
        return points, begin, size, ids

    def spelt(self, points: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of each point."""
        real = np.where(points == _LITERAL, ord(MARK), points)
        return 1 + (real >= 0x80) + (real >= 0x800) + (real >= 0x10000)

    def weights(self, points: np.ndarray, ids: list[np.ndarray], by_id: np.ndarray, of_byte, none):
        """Edge weights by piece length, from weights by id."""
        out = []
        for own in ids:
            w = by_id[np.maximum(own, 0)]
            out.append(np.where(own >= 0, w, none))
        if out:
            out[0] = np.where(ids[0] == -2, self.spelt(points) * of_byte, out[0])
        return out

    @staticmethod
    def groups(size: np.ndarray):
        """Chunk indexes, longest first, of similar length together."""
        band = np.maximum(size, 1).astype(np.float64)
        band = np.ceil(np.log2(band)).astype(np.int64)
        for b in np.unique(band):
            own = np.flatnonzero(band == b)
            yield own[np.argsort(-size[own], kind="stable")]

    # ---- best paths ------------------------------------------------------
    def best(self, chunks: list[str]):
        """(ids, offsets, score, gap) of the best segmentation of each chunk:
        piece ids of all chunks one after another, where each chunk's begin
        (with the total at the end), its score, and how much less the second
        best scores (a large number if there is none).  Of equal scores the
        best is the one whose last piece is shortest, then the one before."""
        points, begin, size, ids = self.edges(chunks)
        weight = self.weights(points, ids, self.vocabulary.weights, self.vocabulary.byte_weight, NONE)
        n = len(chunks)
        score, gap = np.zeros(n, np.int64), np.full(n, -NONE, np.int64)
        owner, order, what, point = [], [], [], []
        for own in self.groups(size):
            top, at0, length = int(size[own[0]]), begin[own], size[own]
            live = np.searchsorted(-length, -np.arange(top + 1), "right")  # chunks of length >= t
            ahead = np.full((top + 1, len(own)), NONE, np.int64)
            pick = np.zeros((top + 1, len(own)), np.int16)
            ahead[0] = 0
            for t in range(1, top + 1):
                k = live[t]
                for L in range(1, min(t, len(weight)) + 1):
                    sum_ = ahead[t - L, :k] + weight[L - 1][at0[:k] + (t - L)]
                    better = sum_ > ahead[t, :k]
                    ahead[t, :k][better] = sum_[better]
                    pick[t, :k][better] = L
            score[own] = ahead[length, np.arange(len(own))]
            # backwards from each chunk's end, and the best edge off the best path
            behind = np.full((top + 1, len(own)), NONE, np.int64)
            behind[length, np.arange(len(own))] = 0
            second = np.full(len(own), NONE, np.int64)
            path = np.zeros((top + 1, len(own)), bool)  # path[t]: t ends a piece of the best path
            at, step = length.copy(), 0
            todo = np.flatnonzero(at > 0)
            while len(todo):
                path[at[todo], todo] = True
                L = pick[at[todo], todo].astype(np.int64)
                at[todo] -= L
                place = at0[todo] + at[todo]
                got = np.zeros(len(todo), np.int32)
                for x in np.unique(L):
                    same = L == x
                    got[same] = ids[x - 1][place[same]]
                owner.append(own[todo])
                order.append(np.full(len(todo), step))
                what.append(got)
                point.append(points[place])
                todo, step = todo[at[todo] > 0], step + 1
            for t in range(top - 1, -1, -1):
                for L in range(1, min(top - t, len(weight)) + 1):
                    k = live[t + L]
                    edge = weight[L - 1][at0[:k] + t]
                    sum_ = edge + behind[t + L, :k]
                    np.maximum(behind[t, :k], sum_, out=behind[t, :k])
                    off = ~(path[t + L, :k] & (pick[t + L, :k] == L))
                    through = np.where(off, sum_ + ahead[t, :k], NONE)
                    np.maximum(second[:k], through, out=second[:k])
            gap[own] = np.where(second > NONE // 2, score[own] - second, -NONE)
        if not owner:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64), score, gap
        owner, order, what, point = map(np.concatenate, (owner, order, what, point))
        by = np.lexsort((-order, owner))
        owner, what, point = owner[by], what[by], point[by]
        bytes_ = what == -2
        times = np.where(bytes_, self.spelt(point), 1)
        flat = np.repeat(what, times)
        if bytes_.any():
            real = np.where(point[bytes_] == _LITERAL, ord(MARK), point[bytes_]).astype("<u4")
            raw = np.frombuffer(real.tobytes().decode("utf-32-le").encode(), np.uint8)
            flat[np.repeat(bytes_, times)] = self.vocabulary.byte_ids[raw]
        counts = np.bincount(np.repeat(owner, times), minlength=n)
        return flat.astype(np.int32), np.concatenate(([0], np.cumsum(counts))), score, gap

    def nbest(self, chunk: str, n: int) -> list[tuple[int, list[int]]]:
        """The ``n`` best segmentations (score, ids), best first, by backward
        A* whose heuristic is the forward Viterbi score, which is exact: every
        entry taken from the heap lies on one of the best paths left.  Equal
        scores go by the lengths of the pieces from the last one, short first.

        An entry is one step with a pointer to the step before it, and only a
        step's best way on and its next sibling are put on the heap, so a
        chunk of any length is searched in space linear in it."""
        text, spelt = self._masked(chunk)
        size, get, longest = len(text), self.by_piece.get, self.longest
        ahead = [0]
        known: dict[int, list[tuple[int, int, int]]] = {}

        def ways(at: int) -> list[tuple[int, int, int]]:
            """(minus the best score by way of the edge, its length, its weight)."""
            held = known.get(at)
            if held is None:
                if len(known) >= POSITIONS:
                    known.clear()
                held = []
                for a in range(at - 1, max(at - longest, 0) - 1, -1):
                    got = get(text[a:at])
                    if got is not None:
                        held.append((-(ahead[a] + got[1]), at - a, got[1]))
                    elif a == at - 1:
                        w = len(spelt[a].encode()) * self.vocabulary.byte_weight
                        held.append((-(ahead[a] + w), 1, w))
                held.sort()
                known[at] = held
            return held

        for t in range(1, size + 1):
            ahead.append(-ways(t)[0][0])

        def push(before: _Step, at: int, done: int, rank: int) -> None:
            held = ways(at)
            if rank < len(held):
                minus, L, w = held[rank]
                heapq.heappush(heap, (minus - done, _Step(L, before), at, done, w, rank))

        heap: list = []
        out: list[tuple[int, list[int]]] = []
        if size:
            push(_Step(0, None), size, 0, 0)
        else:
            out.append((0, []))
        while heap and len(out) < n:
            _, step, at, done, w, rank = heapq.heappop(heap)
            push(step.before, at, done, rank + 1)
            if at > step.length:
                push(step, at - step.length, done + w, 0)
            else:
                out.append((done + w, self._ids(text, spelt, step)))
        return out

    @staticmethod
    def _masked(chunk: str) -> tuple[str, str]:
        """A chunk with its mark, for looking up and for spelling: a mark of
        the text itself is looked up as a line feed, which is in no piece."""
        marked = chunk if chunk[:1] == "\n" else MARK + chunk
        return marked[:1] + marked[1:].replace(MARK, "\n"), marked

    def _ids(self, text: str, spelt: str, step: _Step) -> list[int]:
        """Ids of a path, given its first piece."""
        out, at = [], 0
        while step.before is not None:
            got = self.by_piece.get(text[at : at + step.length])
            if got is not None:
                out.append(got[0])
            else:
                out += [int(self.vocabulary.byte_ids[b]) for b in spelt[at].encode()]
            at, step = at + step.length, step.before
        return out

    # ---- all paths -------------------------------------------------------
    def marginal(self, chunks: list[str], log_by_id: np.ndarray, log_byte: float, times: np.ndarray | None = None):
        """Natural log of the total probability of all segmentations of each
        chunk (forward recursion in log space); with ``times``, also how often
        each id (and, last, any byte piece) is expected, weighted by times."""
        points, begin, size, ids = self.edges(chunks)
        weight = self.weights(points, ids, log_by_id, log_byte, -np.inf)
        total = np.zeros(len(chunks))
        expected = np.zeros(len(log_by_id) + 1)
        for own in self.groups(size):
            top, at0, length = int(size[own[0]]), begin[own], size[own]
            live = np.searchsorted(-length, -np.arange(top + 1), "right")
            ahead = np.full((top + 1, len(own)), -np.inf)
            ahead[0] = 0.0
            for t in range(1, top + 1):
                k = live[t]
                for L in range(1, min(t, len(weight)) + 1):
                    np.logaddexp(ahead[t, :k], ahead[t - L, :k] + weight[L - 1][at0[:k] + (t - L)], out=ahead[t, :k])
            total[own] = ahead[length, np.arange(len(own))]
            if times is None:
                continue
            behind = np.full((top + 1, len(own)), -np.inf)
            behind[length, np.arange(len(own))] = 0.0
            for t in range(top - 1, -1, -1):
                for L in range(1, min(top - t, len(weight)) + 1):
                    k = live[t + L]
                    place = at0[:k] + t
                    through = weight[L - 1][place] + behind[t + L, :k]
                    np.logaddexp(behind[t, :k], through, out=behind[t, :k])
                    share = np.exp(through + ahead[t, :k] - total[own[:k]]) * times[own[:k]]
                    what = ids[L - 1][place]
                    real = what >= 0
                    expected[:-1] += np.bincount(what[real], share[real], len(log_by_id))
                    if L == 1 and not real.all():
                        expected[-1] += (share * self.spelt(points[place]))[~real].sum()
        return (total, expected) if times is not None else total
