"""Operator 4: SentencePiece encoding and decoding with n-best segmentations.

A text is a lattice of vocabulary pieces.  A forward Viterbi pass gives each
position the best score of any segmentation up to it; a backward A-star search
from the end uses these scores as its (exact) heuristic, so complete
segmentations leave the agenda in order of their scores: the first is the best
one, the first n are the n best.

Pieces hold white space at their beginning only, so a lattice falls apart before each
run of spaces, and wherever no piece holds two neighbouring characters side by side.  A part's forward and backward scores give its best segmentation and
what the second best loses; the n best of a text can differ from the best one only
in the n - 1 parts that lose least, and these are searched.  The other n - 1 segmentations of a
text are given as edits of the first one: at a token, so many tokens go and others come.
Scores are whole numbers (millionths of a nat), which keeps equal sums equal.

The texts of a chunk are cut at all these places at once, in an array of their bytes, and equal
parts become one number.  The forward and backward scores of the parts that the chunk brings anew are
computed together, in arrays over parts of equal length; substrings are looked up
by 64-bit hashes of their characters.  Tokens, scores and what is least to lose are then
gathered from the parts in arrays over the chunk.

Unigram models bring their scores.  BPE models bring merge ranks only; a piece
then has the Zipf probability 1 / (rank + 2), normalised, and the result is the
likeliest segmentation, not the order of merges.  Characters without a piece
fall back to byte pieces.  Spaces are the only white space that pieces spell as a
mark; a mark character in the text itself is spelled in bytes, so decoding is
exact for every text.  Only models without text normalisation are read.

Null and empty texts have no pieces and decode to the empty text.  Other columns
are ignored.  The vocabulary (bounded by its file) is broadcast.
"""

from __future__ import annotations

import gc
import heapq
import math
import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import accumulate, chain, groupby
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.llm.common import chunks, id_long, id_text, mix, ship_package

N_BEST = 4
SCALE = 1_000_000
_MEMO_LIMIT = 300_000
_TOGETHER = 48
_CELLS = 1 << 21
_CHUNK = 1 << 21
_PAIR_CELLS = 1 << 24
_NONE = -(1 << 52)
_HELD_BITS = 20
_HELD_SHIFT = np.uint64(64 - _HELD_BITS)
_STEP = np.uint64(0x9E3779B97F4A7C15)
# fixed values of the model file: types of pieces, kinds of models
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out, shift = 0, 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


class Vocabulary:
    """Pieces with their ids and whole-number scores."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int = _UNIGRAM, prefix: bool = True) -> None:
        self.prefix = prefix
        self.digest = hash((tuple(pieces), kind, prefix))
        self.score: dict[str, tuple[int, int]] = {}
        self.byte_ids = [-1] * 256
        self.spell: list[bytes] = []
        usable = [(k, p, s) for k, (p, s, t) in enumerate(pieces) if t in (_NORMAL, _USER) and s > -1e8]
        if kind == _BPE:
            total = math.log(sum(1 / (2 - s) for _, _, s in usable))
            usable = [(k, p, -math.log(2 - s) - total) for k, p, s in usable]
        for k, (piece, _, type_) in enumerate(pieces):
            if type_ == _BYTE:
                self.byte_ids[int(piece[3:-1], 16)] = k
                self.spell.append(bytes([int(piece[3:-1], 16)]))
            elif type_ in (_NORMAL, _USER, _UNUSED):
                self.spell.append(piece.replace("▁", " ").encode())
            else:
                self.spell.append(b"")
        self._spell = pa.array(self.spell, pa.large_binary())
        self.unknown = next((k for k, p in enumerate(pieces) if p[2] == _UNKNOWN), 0)
        self.whole = False  # a piece with a space after another character: lattices then stay whole
        for k, piece, s in usable:
            text = piece.replace("▁", " ")
            self.whole |= " " in text.lstrip(" ")
            self.score[text] = (k, round(s * SCALE))
        self.longest = max(map(len, self.score), default=1)
        # white space that no piece holds is spelled in bytes and ends a part too
        held = set("".join(self.score))
        alone = "".join(c for c in "\n\r\t" if c not in held)
        self._alone = np.zeros(256, bool)
        self._alone[[ord(c) for c in alone]] = True
        self._part = re.compile(f" +[^ {alone}]*|[^ {alone}]+" + (f"|[{alone}]" if alone else ""))
        self.pairs = {p[j : j + 2] for p in self.score for j in range(len(p) - 1)}
        # a number for each character (0: in no pair), and for two of them whether they make a pair
        ends = sorted(set("".join(self.pairs)))
        self._number = np.zeros(0x110000, np.int32)
        self._number[[ord(c) for c in ends]] = np.arange(1, len(ends) + 1)
        self._numbers = len(ends) + 1
        x, y = (self._number[[ord(p[k]) for p in self.pairs]].astype(np.int64) for k in (0, 1))
        self._beside = np.sort(x * self._numbers + y)
        if self._numbers**2 <= _PAIR_CELLS:
            self._beside = np.isin(np.arange(self._numbers**2), self._beside)
        self.prefixes = {p[:j] for p in self.score for j in range(1, len(p))}
        self.fallback = min((s for _, s in self.score.values()), default=0) - 10 * SCALE
        self._same = list(range(len(pieces)))  # one object per id, however often it is remembered
        keys = np.concatenate([[np.uint64(0)], *[self._hashes(self._codes([p]))[-1][:, 0] for p in self.score]])
        order = np.argsort(keys, kind="stable")
        self._keys = keys[order]
        self._found = np.array([(-1, _NONE), *self.score.values()], np.int64)[order]
        # most substrings are no pieces: a table of the hashes' first bits tells so for nearly all
        self._held = np.zeros(1 << _HELD_BITS, bool)
        self._held[self._keys >> _HELD_SHIFT] = True
        if (np.diff(self._keys) == 0).any():
            raise ValueError("two pieces share a hash")

    @classmethod
    def parse(cls, model: bytes) -> Vocabulary:
        pieces, kind, prefix = [], _UNIGRAM, True
        for field, value in _fields(model):
            if field == 1:
                own = dict(_fields(value))
                score = np.frombuffer(own[2], "<f4")[0] if 2 in own else 0.0
                pieces.append((own.get(1, b"").decode(), float(score), own.get(3, _NORMAL)))
            elif field == 2:
                kind = dict(_fields(value)).get(3, _UNIGRAM)
            elif field == 3:
                own = dict(_fields(value))
                prefix = bool(own.get(3, 1))
                if own.get(2) or own.get(4, 1):
                    raise ValueError("the model normalises text; decoding could not be exact")
        if kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models have a piece lattice")
        return cls(pieces, kind, prefix)

    def char_ids(self, char: str) -> list[int]:
        ids = [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]
        return [self.unknown] if min(ids) < 0 else ids

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text if self.prefix else text
        return [text] if self.whole else self._part.findall(text)

    def cut_all(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """``parts`` of many texts, each ``split``: all pieces of parts in one array, the first piece of each
        part, and the number of parts of each text.  White space, which patterns look for, is one byte."""
        if self.prefix:
            texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        _, where, data = texts.buffers()
        begin = np.frombuffer(where, np.int32, len(texts) + 1, texts.offset * 4)
        low, high = int(begin[0]), int(begin[-1])
        if low == high:
            return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        chars = np.frombuffer(data, np.uint8, high - low, low)
        first = np.zeros(high - low, bool)
        if not self.whole:
            space, alone = chars == 32, self._alone[chars]
            first |= space | alone
            first[1:] &= ~space[:-1] | alone[1:]
            first[1:] |= alone[:-1]
        first[(begin[:-1] - low)[np.diff(begin) > 0]] = True
        places = np.flatnonzero((chars & 0xC0) != 0x80)
        cut = first.copy()
        cut[places[1:][~self._side_by_side(np.frombuffer(chars.tobytes().decode().encode("utf-32-le"), "<u4"))]] = True
        starts = np.flatnonzero(cut)
        of_part = np.flatnonzero(first[starts])
        count = np.diff(np.searchsorted(starts[of_part], begin - low))
        offsets = pa.py_buffer(np.append(starts + low, high).astype(np.int32))
        return pa.StringArray.from_buffers(len(starts), offsets, data), of_part, count

    def _side_by_side(self, codes: np.ndarray) -> np.ndarray:
        """Per character but the last: does a piece hold it and the next one side by side?"""
        numbers = self._number[codes].astype(np.int64)
        pairs = numbers[:-1] * self._numbers + numbers[1:]
        return self._beside[pairs] if self._beside.dtype == bool else np.isin(pairs, self._beside)

    def split(self, part: str) -> list[str]:
        """A part cut between characters that no piece holds side by side: the
        lattice has a node there that every segmentation passes."""
        held = list(map(self.pairs.__contains__, map(add, part, part[1:])))
        if all(held):
            return [part]
        cuts = [0, *[j for j, x in enumerate(held, 1) if not x], len(part)]
        return [part[lo:hi] for lo, hi in zip(cuts, cuts[1:])]

    def lattice(self, text: str) -> tuple[list[list[tuple[int, int, int]]], list[int]]:
        """For each end position the pieces that end there, (begin, score, id) with
        id -1 for a character spelled in bytes, and the best score up to there."""
        n = len(text)
        edges: list[list[tuple[int, int, int]]] = [[] for _ in range(n + 1)]
        ahead = [0] + [-(1 << 62)] * n
        find, known = self.score.get, self.prefixes
        for i in range(n):
            here = ahead[i]
            for j in range(i + 1, min(n, i + self.longest) + 1):
                piece = text[i:j]
                found = find(piece)
                if found is not None:
                    k, s = found
                elif j == i + 1:
                    k, s = -1, self.fallback
                else:
                    if piece not in known:
                        break
                    continue
                edges[j].append((i, s, k))
                if here + s > ahead[j]:
                    ahead[j] = here + s
                if j == i + 1 and piece not in known:
                    break
        return edges, ahead

    def first_two(self, text: str) -> tuple[tuple[int, ...], int, int]:
        """(ids, score) of a best segmentation and what the second best loses: the
        best one that uses a piece which the first does not."""
        edges, ahead = self.lattice(text)
        top = ahead[-1]
        behind = [-(1 << 62)] * len(edges)
        behind[-1] = 0
        on, second, path = len(text), -(1 << 62), []
        for j in range(len(text), 0, -1):
            after, step = behind[j], None
            for i, s, k in edges[j]:
                s += after
                if s > behind[i]:
                    behind[i] = s
                s += ahead[i]
                if j == on and step is None and s == top:
                    step = i, k
                elif s > second:
                    second = s
            if step is not None:
                on = step[0]
                path.append((step[1], j, on))
        ids: list[int] = []
        for k, j, i in reversed(path):
            ids += [k] if k >= 0 else self.char_ids(text[i:j])
        return tuple(ids), top, top - second

    @staticmethod
    def _codes(texts: list[str]) -> np.ndarray:
        """Characters of texts of one length, a row each."""
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        return flat.reshape(len(texts), -1).astype(np.uint64)

    def _hashes(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each size up to the longest piece: hashes of the substrings of that size."""
        n, out = codes.shape[1], []
        with np.errstate(over="ignore"):
            single = mix(codes + np.uint64(1))
            for size in range(1, min(n, self.longest) + 1):
                before = out[-1][:, : n - size + 1] * _STEP if out else np.uint64(0)
                out.append(before + single[:, size - 1 :])
        return out

    def _look_up(self, hashes: np.ndarray, missing: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the pieces with these hashes; -1 and ``missing`` for no piece."""
        flat = np.ascontiguousarray(hashes).ravel()
        ids, scores = np.full(len(flat), -1), np.full(len(flat), missing)
        may = np.flatnonzero(self._held[flat >> _HELD_SHIFT])
        at = np.minimum(np.searchsorted(self._keys, flat[may]), len(self._keys) - 1)
        hit = (self._keys[at] == flat[may]) & (self._found[at, 0] >= 0)
        ids[may[hit]], scores[may[hit]] = self._found[at[hit], 0], self._found[at[hit], 1]
        return ids.reshape(hashes.shape), scores.reshape(hashes.shape)

    def solve(self, texts: list[str]) -> list[tuple[tuple[int, ...], int, int]]:
        """``first_two`` of many texts of one length at once."""
        n, m = len(texts[0]), len(texts)
        codes = self._codes(texts)
        ids, scores = [], []
        for size, h in enumerate(self._hashes(codes), 1):
            k, s = self._look_up(h.T, self.fallback if size == 1 else _NONE)
            ids.append(k)
            scores.append(s)
        longest = len(scores)
        # a place per row; a path over a piece that is none stays far below any other
        ahead = np.full((n + 1, m), _NONE)
        behind = np.full((n + 1, m), _NONE)
        ahead[0] = behind[n] = 0
        for j in range(1, n + 1):
            for size in range(1, min(j, longest) + 1):
                np.maximum(ahead[j], ahead[j - size] + scores[size - 1][j - size], out=ahead[j])
        for i in range(n - 1, -1, -1):
            for size in range(1, min(n - i, longest) + 1):
                np.maximum(behind[i], behind[i + size] + scores[size - 1][i], out=behind[i])
        top = ahead[n]
        # from the end the longest piece of a best segmentation, as the search of one text does it
        on, second = np.full(m, n), np.full(m, _NONE)
        path = np.full((m, n, 2), -2)
        count = np.zeros(m, np.int64)
        for j in range(n, 0, -1):
            step = np.zeros(m, np.int64)
            for size in range(min(j, longest), 0, -1):
                total = ahead[j - size] + scores[size - 1][j - size] + behind[j]
                rows = np.flatnonzero(total == top)
                rows = rows[(on[rows] == j) & (step[rows] == 0)]
                step[rows] = size
                path[rows, count[rows], 0] = ids[size - 1][j - size, rows]
                path[rows, count[rows], 1] = j - 1
                total[rows] = _NONE
                np.maximum(second, total, out=second)
            count += step > 0
            on -= step
        lost = np.where(second < _NONE // 2, top + (1 << 62), top - second)
        out, same = [], self._same
        rows, plain = path[:, :, 0].tolist(), (path[:, :, 0] != -1).all(1)
        for r, (c, t, x) in enumerate(zip(count.tolist(), top.tolist(), lost.tolist())):
            if plain[r]:
                own = [same[k] for k in rows[r][c - 1 :: -1]]
            else:
                own = []
                for k, end in path[r, :c][::-1].tolist():
                    own += [k] if k >= 0 else self.char_ids(texts[r][end])
            out.append((tuple(own), t, x))
        return out

    def best(self, text: str, n: int) -> list[tuple[int, list[int]]]:
        """The n best segmentations of a text as (score, ids), best first."""
        edges, ahead = self.lattice(text)
        found = []
        push, pop = heapq.heappush, heapq.heappop
        # of equal hypotheses the one nearest the beginning goes on, so ties don't fan out
        agenda = [(-ahead[-1], len(text), 0, 0, None)]
        made = 0
        while agenda and len(found) < n:
            _, node, _, behind, path = pop(agenda)
            if node == 0:
                ids = []
                at = 0
                while path is not None:
                    piece, end, path = path
                    ids += [piece] if piece >= 0 else self.char_ids(text[at:end])
                    at = end
                found.append((behind, ids))
                continue
            for i, s, piece in edges[node]:
                made -= 1
                s += behind
                push(agenda, (-ahead[i] - s, i, made, s, (piece, node, path)))
        return found

    def decode(self, ids) -> str:
        spell = self.spell
        raw = b"".join([spell[k] for k in ids])
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


    def decodes(self, ids: np.ndarray, begin: np.ndarray, texts: pa.StringArray) -> np.ndarray:
        """Per text: do its ids, which begin at ``begin``, decode to it?"""
        spelled = self._spell.take(pa.array(ids, pa.int64()))
        _, where, data = spelled.buffers()
        where = np.frombuffer(where, np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if len(ids) and data.size else np.empty(0, np.uint8)
        ends = where[begin]
        _, offsets, chars = texts.buffers()
        own = np.frombuffer(offsets, np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        chars = np.frombuffer(chars, np.uint8) if chars is not None and chars.size else np.empty(0, np.uint8)
        out = np.zeros(len(texts), bool)
        for k in range(len(texts)):
            a, b, lo, hi = ends[k], ends[k + 1], own[k], own[k + 1]
            if self.prefix and b > a and raw[a] == 32:
                a += 1
            # texts are valid, so other bytes can only decode to them where they are none
            out[k] = np.array_equal(raw[a:b], chars[lo:hi]) or self.decode(ids[begin[k] : begin[k + 1]].tolist()) == texts[k].as_py()
        return out


class Encoder:
    """Encodes texts part by part; remembers the parts that it met last: one to two times
    ``memo`` of them, some 400 bytes each, and those that one call brings.  Texts encoded together
    have only parts remembered that do not fall apart."""

    def __init__(self, vocabulary: Vocabulary, n: int, memo: int | None = None) -> None:
        self.vocabulary, self.n = vocabulary, n
        self.memo = memo or _MEMO_LIMIT
        self._new: dict[str, tuple] = {}
        self._old: dict[str, tuple] = {}
        self._others: dict[str, list[int]] = {}

    def _keep(self, part: str, got: tuple) -> tuple:
        if len(self._new) >= self.memo:
            self._old, self._new = self._new, {}
        self._new[part] = got
        return got

    def meet(self, parts: list[str]) -> list[tuple]:
        """(ids, score, loss) of different parts that do not fall apart.  Those that are not remembered are solved together."""
        new, old = self._new, self._old
        got = list(map(new.get, parts))
        added, fresh = {}, []
        for k, part in enumerate(parts):
            if got[k] is None:
                known = old.get(part)
                if known is None:
                    fresh.append(k)
                else:
                    got[k] = added[part] = known
        for k, each in zip(fresh, self._solved([parts[k] for k in fresh])):
            got[k] = added[parts[k]] = each
        if new and len(new) + len(added) > self.memo:
            self._old, self._new = new, {}
        self._new.update(added)
        return got

    def _solved(self, parts: list[str]) -> list[tuple]:
        """(ids, score, loss) of different parts that do not fall apart and are not remembered."""
        solved = {}
        for size, same in groupby(sorted(parts, key=len), len):
            own = list(same)
            if size > _TOGETHER:
                solved.update(zip(own, map(self.vocabulary.first_two, own)))
                continue
            most = max(1, _CELLS // size**2)
            for lo in range(0, len(own), most):
                solved.update(zip(own[lo : lo + most], self.vocabulary.solve(own[lo : lo + most])))
        return [solved[p] for p in parts]

    def together(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, list[list[tuple]]]:
        """The texts' segmentations (see ``__call__``): ids of all best ones, where each text's
        begin in them, and the n best of each."""
        each, of_part, count = self.vocabulary.cut_all(texts)
        if not len(each):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64), [[] for _ in range(len(texts))]
        coded = each.dictionary_encode()
        code = coded.indices.to_numpy()
        pieces, scores, losses = zip(*self.meet(coded.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter(chain.from_iterable(pieces), np.int32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        own = sizes[code]
        at = np.concatenate([[0], np.cumsum(own)])
        ids = flat[np.repeat(begin[code] - at[:-1], own) + np.arange(at[-1])]
        # from here on by parts: a part loses what the piece of it that loses least does
        loss = np.minimum.reduceat(np.array(losses, np.int64)[code], of_part)
        score = np.add.reduceat(np.array(scores, np.int64)[code], of_part)
        edge = np.append(of_part, len(code))
        at = at[edge]
        bound = np.concatenate([[0], np.cumsum(count)])
        some = np.flatnonzero(count)
        top = np.add.reduceat(score, bound[some]).tolist()
        # only the n - 1 parts that lose least by their second choice can differ in the n best
        least: list[list[int]] = [[] for _ in some]
        owner = np.repeat(np.arange(len(some)), count[some])
        for r in range(self.n - 1):
            # the first part of least loss of each text; then it is out of the way
            low = np.minimum.reduceat(loss, bound[some])
            lowest = np.flatnonzero(loss == low[owner])
            lowest = lowest[np.diff(owner[lowest], prepend=-1) > 0]
            loss[lowest] = np.iinfo(np.int64).max
            more = count[some] > r
            for k, p in zip(np.flatnonzero(more).tolist(), lowest[more].tolist()):
                least[k].append(p)
        _, where, data = each.buffers()
        where = np.frombuffer(where, np.int32, len(each) + 1)[edge]
        data = memoryview(data)
        found: list[list[tuple]] = [[] for _ in range(len(texts))]
        for k, zero, best, chosen in zip(some.tolist(), at[bound[some]].tolist(), top, least):
            found[k] = self._best_of(
                best, [(str(data[where[p] : where[p + 1]], "utf-8"), int(at[p]) - zero, int(at[p + 1] - at[p])) for p in sorted(chosen)])
        return ids, at[bound], found

    def many(self, texts: list[str | None]) -> Iterator[tuple]:
        """The texts' segmentations (see ``__call__``)."""
        ids, begin, found = self.together(pa.array([t or "" for t in texts], pa.string()))
        return ((ids[lo:hi].tolist(), f) for lo, hi, f in zip(begin[:-1], begin[1:], found))

    def _part(self, part: str) -> tuple:
        got = self._old.get(part)
        if got is None:
            own = self.vocabulary.split(part)
            if len(own) == 1:
                got = self.vocabulary.first_two(part)
            else:
                each = [self._new.get(p) or self._part(p) for p in own]
                got = (sum([e[0] for e in each], ()), sum([e[1] for e in each]), min([e[2] for e in each]))
        return self._keep(part, got)

    def _choices(self, part: str) -> list[tuple[int, list[int]]]:
        """The n best segmentations of a part: what they lose against the first, and their ids."""
        got = self._others.get(part)
        if got is None:
            if len(self._others) >= self.memo // 10:
                self._others.clear()
            found = self.vocabulary.best(part, self.n)
            got = self._others[part] = [(found[0][0] - s, ids) for s, ids in found]
        return got

    def __call__(self, text: str | None) -> tuple[list[int], list[tuple[int, list[tuple[int, int, list[int]]]]]]:
        """(ids of the best segmentation, the n best as (score, edits of the best))."""
        return self._encoded(self.vocabulary.parts(text or ""))

    def _encoded(self, parts: list[str]) -> tuple[list[int], list[tuple]]:
        if not parts:
            return [], []
        got = list(map(self._new.get, parts))
        if not all(got):
            got = [g or self._new.get(p) or self._part(p) for g, p in zip(got, parts)]
        pieces, scores, losses = zip(*got)
        ids = list(chain.from_iterable(pieces))
        top = sum(scores)
        starts = list(accumulate(map(len, pieces), initial=0))
        # only the n - 1 parts that lose least by their second choice can differ in the n best
        least = heapq.nsmallest(self.n - 1, zip(losses, range(len(losses))))
        return ids, self._best_of(top, [(parts[k], starts[k], starts[k + 1] - starts[k]) for k in sorted(k for _, k in least)])

    def _best_of(self, top: int, places: list[tuple[str, int, int]]) -> list[tuple]:
        """The n best as (score, edits), from the parts in which they can differ: (part, place of
        its first token, number of its tokens)."""
        choices = [self._choices(part) for part, _, _ in places]
        found: list[tuple[int, tuple[tuple[int, int], ...]]] = [(0, ())]
        for k, own in enumerate(choices):
            more = [(lost + x, (*made, (k, r)) if r else made) for lost, made in found for r, (x, _) in enumerate(own)]
            found = sorted(more)[: self.n]
        return [(top - lost, [(*places[k][1:], choices[k][r][1]) for k, r in made]) for lost, made in found]


def edited(ids: list[int], edits: list[tuple[int, int, list[int]]]) -> list[int]:
    """A segmentation made from the best one by its edits."""
    out, done = [], 0
    for at, drop, own in edits:
        out += [*ids[done:at], *own]
        done = at + drop
    return out + list(ids[done:])


@contextmanager
def _no_collection() -> Iterator[None]:
    """What an encoder remembers has no cycles: spare the collector from walking through it."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary, n: int, memo: int) -> Encoder:
    """The encoder of this Python worker: what it remembers serves its later tasks too."""
    key = (vocabulary.digest, n, memo)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, n, memo)
    return _ENCODERS[key]


def _lists(sizes: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int32()), values)


def _numbers(lists: list[list[int]]) -> pa.Array:
    return _lists(list(map(len, lists)), pa.array(np.fromiter(chain.from_iterable(lists), np.int32)))


def _n_best(found: list[list[tuple]]) -> list[pa.Array]:
    """Scores and edits of the n best."""
    each = list(chain.from_iterable(found))
    edits = list(chain.from_iterable(e for _, e in each))
    scores = np.array([s for s, _ in each], np.float64) / SCALE
    fields = [pa.array([e[0] for e in edits], pa.int32()), pa.array([e[1] for e in edits], pa.int32()), _numbers([e[2] for e in edits])]
    sizes = list(map(len, found))
    of_each = _lists([len(e) for _, e in each], pa.StructArray.from_arrays(fields, ["at", "drop", "ids"]))
    return [_lists(sizes, pa.array(scores)), _lists(sizes, of_each)]


def _columns(encoder: Encoder, texts: pa.StringArray) -> list[pa.Array]:
    """Number of tokens, tokens, scores and edits of texts without nulls, and whether the tokens decode to the text."""
    ids, begin, found = encoder.together(texts)
    tokens = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids))
    same = encoder.vocabulary.decodes(ids, begin, texts)
    return [pa.array(np.diff(begin)), tokens, *_n_best(found), pa.array(same)]


def read_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """The model file at ``path``: a URI that Spark reads, or the driver's file."""
    if "://" in path:
        model = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            model = f.read()
    return Vocabulary.parse(model)


def encode(
    docs: DataFrame,
    model_path: str,
    n: int = N_BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    memo: int = _MEMO_LIMIT,
    chunk: int = _CHUNK,
) -> DataFrame:
    """``(id_col, n_tokens, token_ids, nbest_scores, nbest_edits, round_trip)`` per row: the
    best segmentation, the scores of the n best, how each of them is made from the best one (see
    ``edited``), and whether the ids decode to the text.

    A Python worker keeps its memory for the jobs after this one: ``memo`` (parts remembered) and
    ``chunk`` (characters encoded together) bound it against time.  They change no row."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(spark, model_path))
    names = [id_col, "n_tokens", "token_ids", "nbest_scores", "nbest_edits", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        encoder = _encoder(vocabulary, n, memo)
        for batch in batches:
            every = pc.fill_null(batch.column(1).cast(pa.string()), "")
            sizes = pc.utf8_length(every).to_pylist()
            for lo, hi in chunks([size or 1 for size in sizes], chunk):
                with _no_collection():
                    columns = _columns(encoder, every.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], names)

    own = docs.select(id_text(id_col), F.col(text_col).cast("string").alias("text"))
    edits = "array<array<struct<at: int, drop: int, ids: array<int>>>>"
    schema = f"{id_col} string, n_tokens long, token_ids array<int>, nbest_scores array<double>, nbest_edits {edits}, round_trip boolean"
    return id_long(own.mapInArrow(run, schema), id_col)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "token_ids") -> DataFrame:
    """``encoded`` with the column ``text`` decoded from ``ids_col`` (null: null)."""
    spark = encoded.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(spark, model_path))

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else shared.value.decode(x) for x in ids], dtype=object)

    return encoded.withColumn("text", text(ids_col))
