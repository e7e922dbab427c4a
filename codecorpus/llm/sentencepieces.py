"""SentencePiece encoding with n-best segmentations, and exact decoding.

The vocabulary is a given SentencePiece model (never trained here). A text's pieces
form a lattice; a path's score is the sum of its pieces' scores. Viterbi runs forward
and leaves at each place the best score from the start. The search for the n best
paths then runs backward from the end: A-star, in which the forward score is the
exact cost of what is left, so that paths come out in order and none is expanded in
vain.

The lattice falls apart where no piece of the vocabulary can span two characters
(before a space, at a line break, between Latin letters and anything else; all checked
when the model is loaded). Each part is solved once and kept in a bounded table; the n
best paths of a text are the n best combinations of its parts' paths. The short parts that
some texts still lack are solved side by side: each step of the lattice, of Viterbi and of
the search is taken for all of them at once, in arrays. Solved parts stay in arrays, too.

A space is an ordinary character here, and pieces are read with U+2581 as a space. As
usual, one space is put in front of a text. Characters without a piece become bytes,
and so does a U+2581 of the text itself: every text comes back unchanged.
"""

from __future__ import annotations

import array
import functools
import heapq
import itertools
import math
import os
import re
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codecorpus.llm.common import release_memory

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
N_BEST = 3
#: Parts that a worker keeps, at most, for single texts and for many texts, and the longest part that is kept.
CACHE = 800_000
TABLE = 250_000
LONGEST_KEPT = 40
#: Rows of one output batch: ids take more room than their text. Rows and characters whose parts are solved together.
ROWS_AT_ONCE = 128
ROWS_SOLVED, CHARS_SOLVED = 2048, 1 << 21
#: Characters of the parts that are solved side by side.
CHARS_ABREAST = 1 << 17
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: For each further segmentation: place in the best ids, how many of them go, what stands there instead.
FURTHER = pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("gone", pa.int32()), ("ids", pa.list_(pa.int32()))])))
#: Of a part with one path alone.
NO_RANK = 1 << 30
#: How much worse than the least piece a byte is.
BYTE_PENALTY = 10.0


class Parts(dict):
    """Solved parts of texts in two generations: when the young one is full it becomes the old one, whose
    parts are forgotten unless they are asked for again. Frequent parts so always stay."""

    def __init__(self, solve, limit: int = CACHE):
        super().__init__()
        self.solve, self.limit, self.old = solve, limit, {}

    def __missing__(self, part: str):
        found = self.old.get(part) or self.solve(part)
        if len(part) <= LONGEST_KEPT:
            self.keep(part, found)
        return found

    def keep(self, part: str, found) -> None:
        if len(self) >= self.limit // 2:
            self.old = dict(self)
            self.clear()
        self[part] = found


class Solved(NamedTuple):
    """Parts with their n best paths: a row for each path, best first, and a column for each part."""

    parts: pa.Array  # in UTF-32
    ids: np.ndarray  # of all paths
    first: np.ndarray  # where a path's ids begin
    size: np.ndarray  # how many they are; 0: there is no such path
    score: np.ndarray  # -inf: there is no such path

    @classmethod
    def joined(cls, n_best: int, *tables: Solved) -> Solved:
        none = np.zeros((n_best, 0), np.int64)
        tables = [cls(pa.array([], pa.large_binary()), np.zeros(0, np.int32), none, none.astype(np.int32), none.astype(float)), *tables]
        shifts = itertools.accumulate((len(x.ids) for x in tables), initial=0)
        return cls(
            pa.concat_arrays([x.parts for x in tables]), np.concatenate([x.ids for x in tables]), np.concatenate([x.first + y for x, y in zip(tables, shifts, strict=False)], axis=1),
            np.concatenate([x.size for x in tables], axis=1), np.concatenate([x.score for x in tables], axis=1))

    def take(self, at: np.ndarray) -> Solved:
        size = self.size[:, at]
        ends = np.cumsum(size.ravel(), dtype=np.int64).reshape(size.shape)
        return Solved(self.parts.take(pa.array(at)), self.ids[runs(self.first[:, at].ravel(), size.ravel())], ends - size, size, self.score[:, at])

    def path(self, k: int, part: int) -> list[int]:
        """The ids of a part's path."""
        at = self.first[k, part]
        return self.ids[at : at + self.size[k, part]].tolist()


def runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size[0]`` places from ``first[0]`` on, then those of the next run, and so on."""
    ends = np.cumsum(size, dtype=np.int64)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def n_bytes(chars: np.ndarray) -> np.ndarray:
    """Bytes of each character in UTF-8."""
    return 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)


def wide(text: str) -> bytes:
    return text.encode("utf-32-le", "surrogatepass")


def lengths_of(parts: pa.Array) -> np.ndarray:
    """Characters of each part in UTF-32."""
    return pc.binary_length(parts).to_numpy() // 4


class Pieces:
    def __init__(self, path: str = MODEL, n_best: int = N_BEST):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = {i: model.get_score(i) for i in plain}
        ranks = sorted(plain, key=lambda i: (-scores[i], i))
        if all(scores[i].is_integer() for i in plain):
            # a model of merges has ranks in place of scores: log-probabilities of words by Zipf's law
            log_total = math.log(sum(1 / (k + 1) for k in range(len(ranks))))
            scores = {i: -math.log(k + 1) - log_total for k, i in enumerate(ranks)}
        self.text = {i: model.id_to_piece(i).replace("▁", " ") for i in plain}
        self.pieces = {t: (i, scores[i]) for i, t in self.text.items()}
        self.tree: dict = {}  # character -> (tree before it, ids and score of the piece that starts there)
        for t, (i, score) in self.pieces.items():
            before = self.tree
            for char in t[:0:-1]:
                before = before.setdefault(char, ({}, (), 0.0))[0]
            before[t[0]] = (before[t[0]][0] if t[0] in before else {}, (i,), score)
        # the same tree for many places at once: nodes by number, found by the node above them and their character
        steps, nodes = [], [(0, self.tree)]
        node_ids, node_scores = [-1], [0.0]
        for number, tree in nodes:
            for char, (before, ids, score) in tree.items():
                steps.append(number << 21 | ord(char))
                node_ids.append(ids[0] if ids else -1)
                node_scores.append(score)
                nodes.append((len(steps), before))
        self.steps, self.node_ids, self.node_scores = pd.Index(np.array(steps, np.int64)), np.array(node_ids, np.int32), np.array(node_scores)
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_score = min(scores.values()) - BYTE_PENALTY
        self.bytes_of = {i: t.encode() for i, t in self.text.items()} | {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.n_best = n_best
        self.kinds: np.ndarray | None = None
        self.split = self._splitter()
        self.forget()

    def forget(self) -> None:
        """Drop all solved parts."""
        self.parts, self.known = Parts(self._solve), Solved.joined(self.n_best)

    def _splitter(self):
        """A function that cuts a text where no piece can span the cut. ``kinds`` then tells the characters apart."""
        latin = re.compile(f"[{LATIN}]")
        inner = {(a, b) for t in self.pieces for a, b in itertools.pairwise(t)}
        if any(b == " " != a or "\n" in (a, b) for a, b in inner):
            return lambda text: [text] if text else []
        self.kinds = np.zeros(0x110000, np.uint8)
        self.kinds[[ord(" "), ord("\n")]] = 2, 3
        if any(a != " " and bool(latin.match(a)) != bool(latin.match(b)) for a, b in inner):
            return re.compile(r" *[^ \n]+| +|\n").findall
        self.kinds[[i for i in range(0x250) if latin.match(chr(i))]] = 1
        return re.compile(rf" *[{LATIN}]+| *[^ \n{LATIN}]+| +|\n").findall

    def lattice(
        self, part: str, known: tuple[list, list[float]] | None = None
    ) -> tuple[list[list[tuple[int, tuple[int, ...], float]]], list[float]]:
        """For each place the pieces that end there (start, ids, score), and the best score from the start (Viterbi).

        ``known``: what was found for the first places, of this part or of another that begins alike; it is extended.
        """
        ending, best = known or ([[]], [0.0])
        for j in range(len(best), len(part) + 1):
            before, i, ends = self.tree, j, []
            while i:
                node = before.get(part[i - 1])
                if node is None:
                    break
                i -= 1
                before, ids, score = node
                if ids:
                    ends.append((i, ids, score))
            if not ends or ends[0][0] != j - 1:  # no piece for this character
                ids = tuple(self.byte_ids[b] for b in part[j - 1].encode())
                ends.insert(0, (j - 1, ids, self.byte_score * len(ids)))
            ends.reverse()
            top = -math.inf
            for i, _, score in ends:
                if best[i] + score > top:
                    top = best[i] + score
            ending.append(ends)
            best.append(top)
        return ending, best

    def paths(self, part: str, n: int | None = None, lattice: tuple[list, list[float]] | None = None) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best paths of a part as (score, ids), best first: A-star from the end.

        As the forward scores are exact, each open state stands for one whole path, so no more
        states than paths still wanted need stay open.
        """
        wanted = n or self.n_best
        ending, best = lattice or self.lattice(part)
        opened = [(best[-1], len(part), 0.0, None)]  # total, place, score behind, pieces behind; best first, at a tie the older
        found = []
        while opened:
            _, at, score, tail = opened.pop(0)
            if not at:
                ids: list[int] = []
                while tail:
                    ids.extend(tail[0])
                    tail = tail[1]
                found.append((score, tuple(ids)))
                wanted -= 1
                if not wanted:
                    break
                continue
            size = len(opened)
            least = opened[-1][0] if size >= wanted else -math.inf
            for start, ids, own in ending[at]:
                behind = score + own
                total = behind + best[start]
                if total > least:
                    k = size
                    while k and total > opened[k - 1][0]:
                        k -= 1
                    opened.insert(k, (total, start, behind, (ids, tail)))
                    if size < wanted:
                        size += 1
                    else:
                        opened.pop()
                    if size == wanted:
                        least = opened[-1][0]
        return found

    def solve_all(self, parts: set[str]) -> None:
        """Solve the short ones among ``parts`` that are not kept yet."""
        new = sorted(x for x in parts if len(x) <= LONGEST_KEPT and x not in self.parts and x not in self.parts.old)
        found = self.solved(pa.array(map(wide, new), pa.large_binary()))
        for part, scores, sizes, k in zip(new, found.score.T.tolist(), found.size.T.tolist(), itertools.count()):
            ids, *others = (tuple(found.path(j, k)) for j, size in enumerate(sizes) if size)
            self.parts.keep(part, (ids, scores[0], tuple([scores[0] - x for x in scores[1 : 1 + len(others)]]), tuple(others), array.array("i", ids).tobytes()))

    def solved(self, parts: pa.Array) -> Solved:
        """The n best paths of different parts (in UTF-32): of the short ones side by side, of each long one alone."""
        lengths = lengths_of(parts)
        order = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths[order])
        at, tables = 0, []
        while at < len(order):
            if lengths[order[at]] > LONGEST_KEPT:
                tables.append(self._alone(parts[order[at]].as_py()))
                at += 1
            else:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARS_ABREAST, "right")))
                tables.append(self._abreast(parts.take(pa.array(order[at:to]))))
                at = to
        return Solved.joined(self.n_best, *tables).take(np.argsort(order))

    def _alone(self, part: bytes) -> Solved:
        found = self.paths(part.decode("utf-32-le", "surrogatepass"))
        size, score = np.zeros((self.n_best, 1), np.int32), np.full((self.n_best, 1), -np.inf)
        for k, (own, ids) in enumerate(found):
            size[k], score[k] = len(ids), own
        return Solved(pa.array([part], pa.large_binary()), np.concatenate([np.array(x, np.int32) for _, x in found]), np.cumsum(size, axis=0) - size, size, score)

    def _lattices(self, parts: pa.Array) -> tuple[np.ndarray, ...]:
        """``lattice`` of many parts, the longest part first.

        Places are numbered by their distance from the start and then by part, so those of one distance lie side
        by side. Found are the last place of each part, the best score from the start to each place, where the
        pieces that end at each place begin in the list of pieces, and of each piece its start, its node
        (a byte's character c: ``-1 - c``) and its score. As in ``lattice``, the longest piece comes first.
        """
        lengths, text = lengths_of(parts), np.frombuffer(b"".join(parts.to_pylist()), np.uint32)
        firsts, longest = np.cumsum(lengths) - lengths, int(lengths[0])
        alive = np.searchsorted(-lengths, -np.arange(longest + 1), "right")  # parts with a place at this distance
        off = np.concatenate([[0], np.cumsum(alive)])
        many, total = int(off[1]), int(off[-1])
        char, previous = np.zeros(total, np.int64), np.zeros(total, np.int32)
        for p in range(1, longest + 1):
            char[off[p] : off[p + 1]] = text[firsts[: alive[p]] + (p - 1)]
            previous[off[p] : off[p + 1]] = np.arange(off[p - 1], off[p - 1] + alive[p])
        at = end = np.arange(many, total, dtype=np.int32)
        node = np.zeros(len(end), np.int64)
        found = []  # ends, starts, nodes and scores of the pieces of each length
        while len(end):
            node = self.steps.get_indexer(node << 21 | char[at]) + 1
            on = np.flatnonzero(node)
            end, at, node = end[on], previous[at[on]], node[on]
            piece = np.flatnonzero(self.node_ids[node] >= 0)
            found.append((end[piece], at[piece], node[piece], self.node_scores[node[piece]]))
            on = np.flatnonzero(at >= many)
            end, at, node = end[on], at[on], node[on]
        bare = np.arange(total) >= many  # no piece for this character
        bare[found[0][0]] = False
        bare = np.flatnonzero(bare)
        found.insert(0, (bare, previous[bare], -1 - char[bare], self.byte_score * n_bytes(char[bare])))
        begin = np.zeros(total + 1, np.int64)
        for ends, *_ in found:
            begin[ends + 1] += 1
        begin = np.cumsum(begin)
        start, node, score = np.zeros(begin[-1], np.int32), np.zeros(begin[-1], np.int32), np.zeros(begin[-1])
        free = begin[:-1].copy()
        while found:
            ends, *columns = found.pop()
            start[free[ends]], node[free[ends]], score[free[ends]] = columns
            free[ends] += 1
        best = np.zeros(total)
        for p in range(1, longest + 1):
            a, b = begin[off[p]], begin[off[p + 1]]
            best[off[p] : off[p + 1]] = np.maximum.reduceat(best[start[a:b]] + score[a:b], begin[off[p] : off[p + 1]] - a)
        return off[lengths] + np.arange(many), best, begin, start, node, score

    def _abreast(self, parts: pa.Array) -> Solved:
        """``paths`` of many parts, the longest part first: a round takes one step in the search of each part."""
        many, n = len(parts), self.n_best
        last, best, begin, start, node, score = self._lattices(parts)
        # a state: its place, the score behind it, the piece that begins there (-1: it is the end) and the state behind that
        place, behind, piece, tail = (np.full(12 * many, x, kind) for x, kind in ((0, np.int32), (0.0, float), (-1, np.int32), (-1, np.int32)))
        place[:many], states = last, many
        who, wanted = np.arange(many), np.full(many, n)
        opened, totals = np.zeros((n, many), np.int32), np.full((n, many), -np.inf)  # best first, at a tie the older
        opened[0], totals[0] = who, best[last]
        found = np.full((n, many), -1, np.int32)
        while len(who):
            state = opened[0]
            opened, totals = np.concatenate([opened[1:], opened[:1]]), np.concatenate([totals[1:], np.full((1, len(who)), -np.inf)])
            done = np.flatnonzero(place[state] < many)
            found[n - wanted[done], who[done]] = state[done]
            wanted[done] -= 1
            at = np.flatnonzero(place[state] >= many)
            state = state[at]
            edge, stop, own = begin[place[state]], begin[place[state] + 1], behind[state]
            while len(at):
                new = own + score[edge]
                total = new + best[start[edge]]
                better = np.flatnonzero(total > totals[wanted[at] - 1, at])
                added = slice(states, states + len(better))
                if added.stop > len(place):
                    room = max(added.stop - len(place), len(place) // 4)
                    place, behind, piece, tail = (np.concatenate([x, np.zeros(room, x.dtype)]) for x in (place, behind, piece, tail))
                place[added], behind[added], piece[added], tail[added] = start[edge[better]], new[better], edge[better], state[better]
                number, total, into = np.arange(states, added.stop, dtype=np.int32), total[better], at[better]
                states = added.stop
                for k in range(n - 1, -1, -1):  # each place takes the new state, or that of the place before it, or keeps its own
                    after = total > totals[k, into]
                    before = total > totals[k - 1, into] if k else np.zeros(len(into), bool)
                    opened[k, into] = np.where(before, opened[k - 1, into], np.where(after, number, opened[k, into]))
                    totals[k, into] = np.where(before, totals[k - 1, into], np.where(after, total, totals[k, into]))
                edge = edge + 1
                on = np.flatnonzero(edge < stop)
                at, edge, stop, own, state = at[on], edge[on], stop[on], own[on], state[on]
            for k in range(1, n):
                totals[k, wanted <= k] = -np.inf
            on = np.flatnonzero((wanted > 0) & (totals[0] > -np.inf))
            if len(on) < len(who):
                who, wanted, opened, totals = who[on], wanted[on], opened[:, on], totals[:, on]
        # from the start of a path on: its pieces
        scores = np.where(found < 0, -np.inf, behind[found])
        whose, step, state = np.flatnonzero(found.ravel() >= 0), 0, found.ravel()
        state, size, steps = state[whose], np.zeros(n * many, np.int32), []
        while len(whose):
            size[whose] += 1
            steps.append((whose, node[piece[state]]))
            state = tail[state]
            on = np.flatnonzero(piece[state] >= 0)
            whose, state = whose[on], state[on]
        ends = np.cumsum(size, dtype=np.int64)
        nodes = np.zeros(ends[-1], np.int32)
        for step, (whose, own) in enumerate(steps):
            nodes[ends[whose] - size[whose] + step] = own
        ids = self.node_ids[np.maximum(nodes, 0)]
        raw = np.flatnonzero(nodes < 0)
        if len(raw):  # several ids for a character without a piece
            chars, which = np.unique(-1 - nodes[raw], return_inverse=True)
            listed = [[self.byte_ids[b] for b in chr(x).encode()] for x in chars.tolist()]
            width = np.ones(len(nodes), np.int64)
            width[raw] = np.array(list(map(len, listed)))[which]
            table = np.array(list(itertools.chain.from_iterable(listed)), np.int32)
            firsts = np.cumsum(list(map(len, listed))) - list(map(len, listed))
            wider = np.cumsum(width) - width
            ids = np.repeat(ids, width)
            ids[runs(wider[raw], width[raw])] = table[runs(firsts[which], width[raw])]
            size = np.add.reduceat(np.append(width, 0), ends - size) * (size > 0)
            ends = np.cumsum(size)
            size = size.astype(np.int32)
        return Solved(parts, ids, (ends - size).reshape(n, many), size.reshape(n, many), scores)

    def _kept(self, parts: pa.Array) -> tuple[Solved, np.ndarray]:
        """A table that holds ``parts``, and their places in it. The short ones stay for the next call, as far as there is room."""
        at = pc.index_in(parts, value_set=self.known.parts)
        new = np.flatnonzero(pc.is_null(at).to_numpy(zero_copy_only=False))
        at = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        if len(self.known.parts) + len(new) > TABLE:
            self.known = self.known.take(at[at >= 0])
            at[at >= 0] = np.arange(len(self.known.parts))
        at[new] = len(self.known.parts) + np.arange(len(new))
        table = Solved.joined(self.n_best, self.known, self.solved(parts.take(pa.array(new))))
        short = lengths_of(table.parts) <= LONGEST_KEPT
        self.known = table if short.all() else table.take(np.flatnonzero(short))
        return table, at

    def encode_many(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[float], list[list[tuple[int, int, list[int]]]]]]:
        """``encode_array`` of many texts, one after the other; their parts are solved together."""
        full = [" " + x for x in texts if x]
        if full:
            chars = np.frombuffer(wide("".join(full)), np.uint32)
            starts = np.cumsum([0, *map(len, full)])
            cuts = self._cuts(chars, starts)
            coded = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts * 4), pa.py_buffer(chars)]).dictionary_encode()
            table, at = self._kept(coded.dictionary)
            code = coded.indices.to_numpy()
            first_part = np.searchsorted(cuts, starts)
            size = table.size[0, at][code]
            ids = table.ids[runs(table.first[0, at][code], size)]
            ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
            scores = table.score[0, at][code].tolist()
            sizes, losses = table.size[1:, at], table.score[:1, at] - table.score[1:, at]
            least = self._least(np.where(sizes > 0, losses, -np.inf), code, first_part[:-1])
        k = -1
        for text in texts:
            if not text:
                yield np.zeros(0, np.int32), [], []
                continue
            k += 1
            a, b = first_part[k : k + 2].tolist()
            ways = self._ways([(x, losses[sizes[:, code[x]] > 0, code[x]].tolist()) for x in least[k]])
            total, base = sum(scores[a:b]), ends[a]
            yield ids[base : ends[b]], [total - x for x, _ in ways], [
                [(int(ends[x] - base), int(size[x]), table.path(j + 1, at[code[x]])) for x, j in sorted(way)] for _, way in ways[1:]]

    def _least(self, losses: np.ndarray, code: np.ndarray, starts: np.ndarray) -> list[list[int]]:
        """For each text the places of the n - 1 parts whose second path loses least: only they can differ among the n best.

        ``losses``: for each part how much worse its further paths are (-inf: it has none). ``code``: the parts of all
        texts, which begin at ``starts``. Parts of equal losses come by place.
        """
        found: list[list[int]] = [[] for _ in starts]
        if not len(losses):
            return found
        order = np.lexsort(losses[::-1])
        rank = np.zeros(len(order), np.int64)
        rank[order[1:]] = np.cumsum((losses[:, order[1:]] != losses[:, order[:-1]]).any(axis=0))
        rank[losses[0] == -np.inf] = NO_RANK
        key = rank[code] << 32 | np.arange(len(code))
        for _ in losses:
            first = np.minimum.reduceat(key, starts)
            for k, x in enumerate(first.tolist()):
                if x < NO_RANK << 32:
                    found[k].append(x & 0xFFFFFFFF)
            key[first & 0xFFFFFFFF] |= NO_RANK << 32
        return found

    def _cuts(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where the parts of texts begin that stand one behind the other, and the end: as ``split`` cuts each of them."""
        if self.kinds is None:
            return starts
        kind = self.kinds[chars]
        a, b = kind[:-1], kind[1:]
        cut = (a == 3) | (b == 3) | ((b == 2) & (a != 2)) | ((a < 2) & (b < 2) & (a != b))
        cut[starts[1:-1] - 1] = True
        return np.concatenate([[0], np.flatnonzero(cut) + 1, [len(chars)]])

    def _ways(self, losses: list[tuple[int, list[float]]]) -> list[tuple[float, tuple[tuple[int, int], ...]]]:
        """The n best combinations of the paths of some parts: what is lost, and the parts with a further path and which.

        ``losses``: for each part its place and how much worse its further paths are.
        """
        ways: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        for k, part in losses:
            ways = heapq.nsmallest(
                self.n_best, ((a + b, way if j is None else (*way, (k, j))) for a, way in ways for j, b in ((None, 0.0), *enumerate(part))), key=itemgetter(0))
        return ways

    def _solve(self, part: str, lattice: tuple[list, list[float]] | None = None) -> tuple[tuple[int, ...], float, tuple[float, ...], tuple[tuple[int, ...], ...], bytes]:
        """Best ids, their score, how much worse the next paths are, their ids, and the best ids as 32-bit numbers."""
        (score, ids), *others = self.paths(part, lattice=lattice)
        return ids, score, tuple([score - s for s, _ in others]), tuple([x for _, x in others]), array.array("i", ids).tobytes()

    def encode(self, text: str | None) -> tuple[list[int], list[float]]:
        """Ids of the best segmentation, and the scores of the n best. Nothing for an empty text."""
        return self.encode_all(text)[:2]

    def cut(self, text: str | None) -> list[str]:
        """The parts of a text."""
        return self.split(" " + text) if text else []

    def encode_all(self, text: str | None, parts: list[str] | None = None) -> tuple[list[int], list[float], list[list[tuple[int, int, tuple[int, ...]]]]]:
        """Ids of the best segmentation, the scores of the n best, and for each further one where it differs.

        A difference is (place in the best ids, how many of them go, the ids that stand there instead), by place.
        ``parts``: those of the text, if they are known.
        """
        ids, scores, further = self.encode_array(text, parts)
        return ids.tolist(), scores, further

    def encode_array(self, text: str | None, parts: list[str] | None = None) -> tuple[np.ndarray, list[float], list[list[tuple[int, int, tuple[int, ...]]]]]:
        """As ``encode_all``, the ids in an array."""
        if not text:
            return np.zeros(0, np.int32), [], []
        solved = list(map(self.parts.__getitem__, parts or self.cut(text)))
        ids = np.frombuffer(b"".join(map(itemgetter(4), solved)), np.int32)
        total = sum(map(itemgetter(1), solved))
        losses = list(map(itemgetter(2), solved))
        # only the n - 1 parts whose second path loses least can differ among the n best
        least: list[tuple[int, tuple[float, ...]]] = []
        after: dict[tuple[float, ...], int] = {}
        for part in heapq.nsmallest(self.n_best - 1, filter(None, losses)):
            k = losses.index(part, after.get(part, 0))
            after[part] = k + 1
            least.append((k, part))
        ways = self._ways(least)
        place = {k: sum(map(len, map(itemgetter(0), solved[:k]))) for k in {k for _, way in ways for k, _ in way}}
        further = [[(place[k], len(solved[k][0]), solved[k][3][j]) for k, j in sorted(way)] for _, way in ways[1:]]
        return ids, [total - x for x, _ in ways], further

    def same_text(self, ids: list[int], changes: list[tuple[int, int, tuple[int, ...]]]) -> bool:
        """Whether a further segmentation decodes to what the best ``ids`` decode to."""
        joined = lambda x: b"".join(map(self.bytes_of.__getitem__, x))
        return all(joined(ids[at : at + gone]) == joined(new) for at, gone, new in changes)

    def segmentations(self, text: str, n: int | None = None) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of a text with their ids, best first."""
        n = n or self.n_best
        found: list[tuple[float, list[int]]] = [(0.0, [])]
        for part in self.cut(text):
            paths = self.paths(part, n)
            found = heapq.nlargest(n, ((a + b, x + list(y)) for a, x in found for b, y in paths), key=itemgetter(0))
        return found if text else []

    def decode(self, ids) -> str:
        """The text of any segmentation."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def replaced(ids: list[int], changes) -> list[int]:
    """The ids of a further segmentation from those of the best one and its differences."""
    found, seen = [], 0
    for at, gone, new in changes:
        found += [*ids[seen:at], *new]
        seen = at + gone
    return found + list(ids[seen:])


@functools.lru_cache(maxsize=2)
def load(path: str = MODEL, n_best: int = N_BEST) -> Pieces:
    """Once per worker."""
    return Pieces(path, n_best)


def encode(text: Column, path: str = MODEL, n_best: int = N_BEST) -> Column:
    """``ids`` and ``scores`` of a text; a null or empty text has none."""

    @F.pandas_udf("ids array<int>, scores array<double>")
    def of(texts: pd.Series) -> pd.DataFrame:
        pieces = load(path, n_best)
        found = [(np.array(x, np.int32), np.array(y, float)) for x, y in map(pieces.encode, texts)]
        return pd.DataFrame({"ids": [x for x, _ in found], "scores": [y for _, y in found]})

    return of(text)


def decode(ids: Column, path: str = MODEL) -> Column:
    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        pieces = load(path)
        return pd.Series([None if x is None else pieces.decode(x.tolist()) for x in rows], dtype=object)

    return of(ids)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose parts are solved together."""
    for batch in batches:
        lengths = np.cumsum(pc.fill_null(pc.utf8_length(batch["text"]), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(batch):
            chars = CHARS_SOLVED + (lengths[at - 1] if at else 0)
            some = min(ROWS_SOLVED, max(1, int(np.searchsorted(lengths, chars)) - at))
            yield batch.slice(at, some)
            at += some


def encoded(docs: DataFrame, path: str = MODEL, n_best: int = N_BEST) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, ids, n_pieces, scores, exact, further``.

    ``ids``: the best segmentation. ``scores``: of the n best, best first. ``further``: for each of the others its
    differences from ``ids`` (``replaced`` makes the ids). ``exact``: decoding each of the n gives the text back (null counts as empty).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path, n_best)
        try:
            for some in _small(batches):
                texts = some["text"].to_pylist()
                found = pieces.encode_many(texts)
                for k in range(0, len(some), ROWS_AT_ONCE):
                    ids, scores, exact, further = [], [], [], []
                    for text, (own, best, others) in zip(texts[k : k + ROWS_AT_ONCE], found, strict=False):
                        ids.append(own)
                        scores.append(best)
                        own = own.tolist()
                        exact.append(pieces.decode(own) == (text or "") and all(pieces.same_text(own, x) for x in others))
                        further.append([[{"at": at, "gone": gone, "ids": new} for at, gone, new in x] for x in others])
                    lengths = np.array(list(map(len, ids)), np.int64)
                    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                    yield pa.record_batch({
                        "doc_id": some["doc_id"].slice(k, ROWS_AT_ONCE), "ids": pa.ListArray.from_arrays(ends, np.concatenate(ids)), "n_pieces": lengths,
                        "scores": pa.array(scores, pa.list_(pa.float64())), "exact": exact, "further": pa.array(further, FURTHER)})
        finally:  # solved parts stay for one task only: a reused worker does not carry them into later stages
            pieces.forget()
            release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, n_pieces bigint, scores array<double>, exact boolean, "
        "further array<array<struct<at:int,gone:int,ids:array<int>>>>")
