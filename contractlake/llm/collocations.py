"""Phrase collocations by weighted acyclic automata.

An automaton reads a phrase word by word; the weight of the arc that reads its last word is its count. Automata are built
incrementally from sorted phrases: a state whose phrases have all come is frozen, and if the register knows an equal one
(same words, weights and targets) that one is used, so endings that phrases share are stored once.

1. Each task counts the one- to three-word phrases of its texts by language, a bounded run of words at a time, sorts them and builds
   an automaton of each language's (a shard).
2. Languages are cut into ranges of sorted phrases, at points that all shards propose in proportion to their phrases, so that each
   range holds about ``RANGE_PHRASES``. A phrase that begins many others doesn't make a range large: cuts fall between any two phrases.
   Shards are cut there and dealt by range; each range unites its pieces, summing the weights, and keeps phrases with the least count.
3. Parts are looked up by composition: each range's candidates ask for the phrases that their cuts leave, as an automaton for each
   range that holds some; there it is composed with the range's counts, and the weighted answer goes back. What travels is
   automata, once for each pair of ranges and part, not a row for each cut.
4. Scores, the rule of longer candidates and the ranking are DataFrame expressions over candidates, in exact decimals.

All parts of a candidate are at least as frequent as it is, so ranges need keep no phrase below the least count. No task
holds more than a run of words, or a range; a text's words are read as one list, so the longest text bounds a task as well.

Contract: texts are lower-cased in A-Z only and split at ``.,;:!?`` and line ends into pieces, and those at blanks and tabs into
words; phrases don't cross pieces. A null language is ``und``, a null text empty. Counts are over all rows, repeated ones
too, and 64 bits wide. No words give no rows; equal scores go by count, then phrase in byte order. Other columns are not read.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlake.llm.stage import broadcast_if_small, saved

LONGEST = 3
#: Words that a task gathers before it builds automata of them; phrases of a range, about; phrases for each cut that a shard proposes.
RUN_WORDS, RANGE_PHRASES, PROPOSAL = 1 << 20, 1 << 20, 1 << 15
#: Phrases that a builder takes at a time.
BLOCK_PHRASES = 1 << 18
NO_LANGUAGE = "und"

# Upper-case letters and the tab, what they become, and the signs and line ends that part pieces.
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", b"abcdefghijklmnopqrstuvwxyz "
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Stands for the end of a piece; no byte of UTF-8.
BREAK = b"\xff"
_CLEAN = bytes.maketrans(UPPER + PIECE_ENDS, LOWER + BREAK * len(PIECE_ENDS))

Phrase = tuple[bytes, ...]


@dataclass
class Phrases:
    """Sorted phrases with counts: ``ids`` has a row of ``LONGEST`` word numbers each, from 1 by ``words``, 0 behind the last."""
    words: list[bytes]
    ids: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)

    def at(self, i: int) -> Phrase:
        return tuple(self.words[k - 1] for k in self.ids[i].tolist() if k)

    def rows(self, chosen: np.ndarray | slice) -> Phrases:
        return Phrases(self.words, self.ids[chosen], self.counts[chosen])

    def find(self, phrase: Phrase) -> int:
        """How many come before ``phrase``."""
        lo, hi = 0, len(self)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if self.at(mid) < phrase else (lo, mid)
        return lo


def _order(ids: np.ndarray, words: int) -> np.ndarray:
    """One number for each row of ``ids`` that sorts as the row does."""
    base, key = words + 1, np.zeros(len(ids), dtype=np.int64)
    if base ** LONGEST < 1 << 62:
        for k in range(LONGEST):
            key = key * base + ids[:, k]
        return key
    _, first = np.unique(ids[:, 0].astype(np.int64) * base + ids[:, 1], return_inverse=True)
    return first.astype(np.int64) * base + ids[:, 2]


def summed(words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> Phrases:
    """The distinct rows of ``ids``, sorted, with their counts added up."""
    if not len(ids):
        return Phrases(words, ids.reshape(0, LONGEST).astype(np.int32), counts.astype(np.int64))
    key = _order(ids, len(words))
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    return Phrases(words, ids[order[starts]].astype(np.int32), np.add.reduceat(counts[order], starts))


#: Odd numbers that mix an arc's label, weight and target to 64 bits, twice.
_SALTS = [tuple(np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)),
          tuple(np.array([0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9FB21C651E98DF25], dtype=np.uint64))]


class Builder:
    """Incremental construction: ``add`` takes the next block of sorted phrases and freezes all states whose phrases have come;
    the last word's and the last two words' states stay open until a later phrase leaves them. The register knows frozen states
    by two 64-bit sums over their arcs, which are taken for the arcs themselves."""

    def __init__(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # first sums of frozen states, sorted, with their second sums and numbers
        self.known_other, self.known_state = self.known, np.zeros(0, dtype=np.int64)
        self.states, self.arcs = 1, 0  # state 0 ends
        self.first: list[np.ndarray] = [np.zeros(2, dtype=np.int64)]
        self.done_arcs: list[tuple[np.ndarray, ...]] = []
        none = np.zeros(0, dtype=np.int64)
        self.ids, self.weights = np.zeros((0, LONGEST), dtype=np.int64), none  # phrases that begin with the last two words
        # arcs that left the states after one word and after none, with the word before them
        self.level: list[tuple[np.ndarray, ...]] = [(none, none, none), (none, none, none, none)]

    def _freeze(self, starts: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The states of runs of arcs; a run begins at each of ``starts`` and none is empty."""
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        sums = []
        for salt in _SALTS:
            x = label.astype(np.uint64) * salt[0] + weight.astype(np.uint64) * salt[1] + target.astype(np.uint64) * salt[2]
            x ^= x >> np.uint64(31)
            x *= salt[3]
            sums.append(np.add.reduceat(x ^ (x >> np.uint64(29)), starts))
        key, at, same = np.unique(sums[0], return_index=True, return_inverse=True)
        other = sums[1][at]
        place = np.minimum(np.searchsorted(self.known, key), max(len(self.known) - 1, 0))
        seen = (self.known[place] == key) & (self.known_other[place] == other) if len(self.known) else np.zeros(len(key), dtype=bool)
        fresh = ~seen
        state = np.empty(len(key), dtype=np.int64)
        state[seen] = self.known_state[place[seen]]
        state[fresh] = np.arange(self.states, self.states + int(fresh.sum()))
        self.states += int(fresh.sum())
        order = np.argsort(both := np.concatenate((self.known, key[fresh])), kind="stable")
        self.known = both[order]
        self.known_other = np.concatenate((self.known_other, other[fresh]))[order]
        self.known_state = np.concatenate((self.known_state, state[fresh]))[order]
        out = state[same]
        odd = np.flatnonzero(sums[1] != other[same])  # equal in one sum only: a state of its own
        out[odd] = np.arange(self.states, self.states + len(odd))
        self.states += len(odd)
        new = np.concatenate((at[fresh], odd))
        ends = np.append(starts, len(label))
        n = ends[new + 1] - ends[new]
        arc = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[new], n)
        self.done_arcs.append((label[arc], weight[arc], target[arc]))
        self.first.append(self.arcs + np.cumsum(n))
        self.arcs += int(n.sum())
        return out

    def add(self, ids: np.ndarray, weights: np.ndarray, last: bool = False) -> None:
        ids, weights = np.vstack((self.ids, ids)), np.concatenate((self.weights, weights))
        # states after two words: phrases by their first two words; the last ones wait for the next block
        begins = np.flatnonzero(np.r_[True, (ids[1:, 0] != ids[:-1, 0]) | (ids[1:, 1] != ids[:-1, 1])]) if len(ids) else np.zeros(0, dtype=np.int64)
        keep = len(ids) if last or not len(begins) else int(begins[-1])
        self.ids, self.weights = ids[keep:], weights[keep:]
        ids, weights, begins = ids[:keep], weights[:keep], begins[begins < keep]
        own = np.where(ids[begins, 2] == 0, weights[begins], 0)  # the count of the two words, or of one, themselves
        inner = ids[:, 2] > 0
        group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, keep)))[inner]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=np.int64)
        state = np.zeros(len(begins), dtype=np.int64)
        state[group[starts]] = self._freeze(starts, ids[inner, 2], weights[inner], np.zeros(int(inner.sum()), dtype=np.int64))
        a, b = ids[begins, 0], ids[begins, 1]
        # states after one word: a row without a second word carries the word's own count
        before, label, weight, target = (np.concatenate(x) for x in zip(self.level[1], (a, b, own, state)))
        begins = np.flatnonzero(np.r_[True, before[1:] != before[:-1]]) if len(before) else np.zeros(0, dtype=np.int64)
        keep = len(before) if last or not len(begins) else int(begins[-1])
        self.level[1] = (before[keep:], label[keep:], weight[keep:], target[keep:])
        before, label, weight, target, begins = before[:keep], label[:keep], weight[:keep], target[:keep], begins[begins < keep]
        own = np.where(label[begins] == 0, weight[begins], 0)
        inner = label > 0
        group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, keep)))[inner]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=np.int64)
        state = np.zeros(len(begins), dtype=np.int64)
        state[group[starts]] = self._freeze(starts, label[inner], weight[inner], target[inner])
        self.level[0] = tuple(np.concatenate(x) for x in zip(self.level[0], (before[begins], own, state)))

    def done(self, words: list[bytes]) -> Automaton:
        self.add(np.zeros((0, LONGEST), dtype=np.int64), np.zeros(0, dtype=np.int64), last=True)
        label, weight, target = self.level[0]
        root = int(self._freeze(np.zeros(1, dtype=np.int64), label, weight, target)[0]) if len(label) else 0
        arcs = [np.concatenate(x) for x in zip(*self.done_arcs)] if self.done_arcs else [np.zeros(0, dtype=np.int64)] * 3
        return Automaton(words, np.concatenate(self.first), *arcs, root)


@dataclass
class Automaton:
    """Weighted acyclic automaton over words. State s has the arcs first[s]..first[s + 1], sorted by label (a number from 1 by ``words``);
    a weight is the count of the phrase that ends with the arc, 0 if none does."""
    words: list[bytes]
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    root: int

    def _step(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of ``states``: the place of the state and the arc, in order."""
        n = self.first[states + 1] - self.first[states]
        at = np.repeat(np.arange(len(states)), n)
        return at, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[states][at]

    def phrases(self) -> Phrases:
        """All phrases, sorted."""
        if not self.root:
            return Phrases(self.words, np.zeros((0, LONGEST), dtype=np.int32), np.zeros(0, dtype=np.int64))
        _, one = self._step(np.array([self.root]))
        under, two = self._step(self.target[one])
        below, three = self._step(self.target[two])
        ends_one, ends_two = self.weight[one] > 0, self.weight[two] > 0
        # where each stands among all, an arc's own phrase before those that go on from it
        sizes = ends_two + np.bincount(below, minlength=len(two))
        ahead_one, ahead_two = np.cumsum(ends_one), np.cumsum(ends_two)
        sums = np.bincount(under, weights=sizes, minlength=len(one)).astype(np.int64)
        places = [(ahead_one + np.cumsum(sums) - sums - 1)[ends_one], (ahead_one[under] + np.cumsum(sizes) - sizes)[ends_two],
                  ahead_one[under[below]] + ahead_two[below] + np.arange(len(three))]
        n = sum(len(x) for x in places)
        ids, counts = np.zeros((n, LONGEST), dtype=np.int32), np.empty(n, dtype=np.int64)
        ways = [(one[ends_one],), (one[under][ends_two], two[ends_two]), (one[under[below]], two[below], three)]
        for place, way in zip(places, ways):
            for k, arc in enumerate(way):
                ids[place, k] = self.label[arc]
            counts[place] = self.weight[way[-1]]
        return Phrases(self.words, ids, counts)

    def compose(self, asked: Automaton) -> Phrases:
        """``asked``'s phrases that this automaton has, with its weights: both are walked together, a word at a time."""
        known = {w: k for k, w in enumerate(self.words, 1)}
        to = np.array([0] + [known.get(w, 0) for w in asked.words], dtype=np.int64)
        base = len(self.words) + 1
        arcs = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) * base + self.label  # sorted
        found, mine, theirs, way = [], np.array([self.root]), np.array([asked.root]), np.zeros((1, 0), dtype=np.int32)
        for depth in range(LONGEST):
            at, arc = asked._step(theirs)
            key = mine[at] * base + to[asked.label[arc]]
            own = np.minimum(np.searchsorted(arcs, key), max(len(arcs) - 1, 0))
            both = arcs[own] == key if len(arcs) else np.zeros(len(key), dtype=bool)
            at, arc, own = at[both], arc[both], own[both]
            way = np.hstack((way[at], asked.label[arc, None].astype(np.int32)))
            ends = (asked.weight[arc] > 0) & (self.weight[own] > 0)
            found.append((np.pad(way[ends], ((0, 0), (0, LONGEST - depth - 1))), self.weight[own][ends]))
            on = (asked.target[arc] > 0) & (self.target[own] > 0)
            theirs, mine, way = asked.target[arc][on], self.target[own][on], way[on]
        return summed(asked.words, np.vstack([f[0] for f in found]), np.concatenate([f[1] for f in found]))

    def restricted(self, lo: Phrase | None, hi: Phrase | None) -> Automaton | None:
        """The automaton of the phrases from ``lo`` on and before ``hi``; None if there are none. States off the two edges are
        taken over as they are; on each edge, the states along it are cut."""
        def label(word: bytes) -> float:
            k = bisect_left(self.words, word)
            return k + 1 if k < len(self.words) and self.words[k] == word else k + 0.5

        edges = [None if e is None else [label(w) for w in e] for e in (lo, hi)]
        cut: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # new states, children first

        def cut_state(state: int, low: list[float] | None, high: list[float] | None) -> int:
            """Number, from -1 down, of the new state; 0 if nothing is left."""
            here = slice(self.first[state], self.first[state + 1])
            names, weights, targets = (x[here].copy() for x in (self.label, self.weight, self.target))
            keep = np.ones(len(names), dtype=bool)
            if low is not None:
                keep &= names >= low[0]
                weights[(names == low[0]) & (len(low) > 1)] = 0
            if high is not None:
                keep &= (names < high[0]) | ((names == high[0]) & (len(high) > 1))
            names, weights, targets = names[keep], weights[keep], targets[keep]
            for k in {k for e in (low, high) if e is not None and len(e) > 1 for k in np.flatnonzero(names == e[0]).tolist()}:
                below = [e[1:] if e is not None and len(e) > 1 and names[k] == e[0] else None for e in (low, high)]
                if targets[k] > 0:
                    targets[k] = cut_state(int(targets[k]), *below)
            keep = (weights > 0) | (targets != 0)
            if not keep.any():
                return 0
            cut.append((names[keep], weights[keep], targets[keep]))
            return -len(cut)

        if self.root == 0 or cut_state(self.root, *edges) == 0:
            return None
        reached = np.zeros(len(self.first) - 1, dtype=bool)
        for _, _, targets in cut:
            reached[targets[targets > 0]] = True
        _, arc = self._step(np.flatnonzero(reached))  # states after one word or two; what they lead to comes after two or three
        reached[self.target[arc]] = True
        reached[0] = False
        known = np.flatnonzero(reached)
        _, arc = self._step(known)
        columns = [np.concatenate(x) for x in zip((self.label[arc], self.weight[arc], self.target[arc]), *cut)]
        first = np.concatenate(([0, 0], np.cumsum(np.concatenate((self.first[known + 1] - self.first[known], [len(c[0]) for c in cut])))))
        place = np.zeros(len(reached), dtype=np.int64)
        place[known] = np.arange(1, len(known) + 1)
        number = np.where(columns[2] >= 0, place[columns[2]], len(known) - columns[2])
        used = np.flatnonzero(np.bincount(columns[0], minlength=len(self.words) + 1))
        names = np.zeros(len(self.words) + 1, dtype=np.int64)
        names[used] = np.arange(1, len(used) + 1)
        return Automaton([self.words[k - 1] for k in used.tolist()], first.astype(np.int64), names[columns[0]], columns[1], number, len(known) + len(cut))

    def pack(self) -> bytes:
        text = b" ".join(self.words)  # words hold no blanks
        arrays = [x.astype(np.int64 if x.size and x.max() >= 1 << 31 else np.int32) for x in (self.first, self.label, self.weight, self.target)]
        head = struct.pack("<3q4b", self.root, len(self.words), len(text), *[a.itemsize for a in arrays]) + struct.pack("<4q", *[a.size for a in arrays])
        return zstandard.ZstdCompressor(level=1).compress(head + text + b"".join(a.tobytes() for a in arrays))

    @staticmethod
    def unpack(data: bytes) -> Automaton:
        raw = zstandard.ZstdDecompressor().decompress(data)
        root, n_words, n_text, *kinds = struct.unpack_from("<3q4b", raw)
        at = struct.calcsize("<3q4b")
        sizes = struct.unpack_from("<4q", raw, at)
        at += struct.calcsize("<4q")
        words = raw[at:at + n_text].split(b" ") if n_words else []
        at += n_text
        arrays = []
        for size, width in zip(sizes, kinds):
            arrays.append(np.frombuffer(raw, dtype=f"<i{width}", count=size, offset=at).astype(np.int64))
            at += size * width
        return Automaton(words, *arrays, root)


def build(p: Phrases) -> Automaton:
    """The automaton of sorted phrases, over the words that they use."""
    used = np.flatnonzero(np.bincount(p.ids.ravel(), minlength=len(p.words) + 1)[1:]) + 1
    number = np.zeros(len(p.words) + 1, dtype=np.int64)
    number[used] = np.arange(1, len(used) + 1)
    builder = Builder()
    for lo in range(0, len(p), BLOCK_PHRASES):
        builder.add(number[p.ids[lo:lo + BLOCK_PHRASES]], p.counts[lo:lo + BLOCK_PHRASES])
    return builder.done([p.words[k - 1] for k in used.tolist()])


def united(parts: list[Phrases]) -> Phrases:
    """The union of ``parts``, weights summed."""
    words = sorted(set().union(*[p.words for p in parts]))
    known = {w: k for k, w in enumerate(words, 1)}
    ids = [np.array([0] + [known[w] for w in p.words], dtype=np.int32)[p.ids] for p in parts]
    return summed(words, np.vstack(ids), np.concatenate([p.counts for p in parts]))


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Run:
    """Words of one language, gathered to be counted."""

    def __init__(self) -> None:
        self.known = _Numbers({BREAK: 0})
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = text.translate(_CLEAN).replace(BREAK, b" " + BREAK + b" ").split()
        self.texts.append(np.fromiter(map(self.known.__getitem__, words), dtype=np.int32, count=len(words)))
        self.texts.append(np.zeros(1, dtype=np.int32))
        self.size += len(words) + 1

    def counted(self) -> tuple[int, Phrases]:
        """Number of words, and all phrases with their counts."""
        words = sorted(w for w in self.known if w != BREAK)
        rank = np.zeros(len(self.known), dtype=np.int64)
        rank[[self.known[w] for w in words]] = np.arange(1, len(words) + 1)
        flat = np.concatenate((rank[np.concatenate(self.texts)], np.zeros(LONGEST, dtype=np.int64)))
        self.texts = []
        n, base = len(flat) - LONGEST, len(words) + 1
        first, second = flat[:n], flat[1:n + 1]
        third = np.where(second > 0, flat[2:n + 2], 0)
        begins = first > 0  # the longest phrase from each word on
        if base ** LONGEST >= 1 << 62:
            ids = np.stack((first[begins], second[begins], third[begins]), axis=1)
            return len(ids), with_prefixes(summed(words, ids, np.ones(len(ids), dtype=np.int64)))
        key = ((first * base + second) * base + third)[begins]
        del flat, first, second, third, begins
        key.sort()
        n = len(key)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        counts, key = np.diff(np.append(starts, len(key))), key[starts]
        ids = np.stack((key // (base * base), key // base % base, key % base), axis=1).astype(np.int32)
        return n, with_prefixes(Phrases(words, ids, counts))


def with_prefixes(full: Phrases) -> Phrases:
    """Sorted phrases, each counted where no longer one was, -> all phrases that they begin with, counted everywhere."""
    ids, n = full.ids, full.counts
    if not len(n):
        return full
    one = np.r_[True, ids[1:, 0] != ids[:-1, 0]]
    two = (one | np.r_[True, ids[1:, 1] != ids[:-1, 1]]) & (ids[:, 1] > 0)
    rows = [(one, 1, np.add.reduceat(n, np.flatnonzero(one)))]
    if two.any():
        rows.append((two, 2, np.add.reduceat(np.where(ids[:, 1] > 0, n, 0), np.flatnonzero(two))))
    three = ids[:, 2] > 0
    rows.append((three, 3, n[three]))
    ahead = np.cumsum(sum(r[0].astype(np.int64) for r in rows))
    place = ahead - sum(r[0].astype(np.int64) for r in rows)  # of the first row that comes out for each
    out, counts = np.zeros((ahead[-1], LONGEST), dtype=np.int32), np.empty(ahead[-1], dtype=np.int64)
    for begins, length, sums in rows:
        out[place[begins], :length] = ids[begins, :length]
        counts[place[begins]] = sums
        place = place + begins
    return Phrases(full.words, out, counts)


def _shards(run_words: int, proposal: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches (lang, text) -> (lang, n_words, n_phrases, proposals, automaton)."""
    names = ["lang", "n_words", "n_phrases", "proposals", "automaton"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary()]

    def built(runs: dict[str, _Run]) -> Iterator[pa.RecordBatch]:
        for lang, run in runs.items():
            n, p = run.counted()
            if n:
                offset = (int(p.counts.sum()) * 7919 + len(p)) % proposal  # a place that differs from shard to shard
                proposals = [b" ".join(p.at(i)) for i in range(offset, len(p), proposal)]
                row = ([lang], [n], [len(p)], [proposals], [build(p).pack()])
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, _Run] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                run = runs.setdefault(lang, _Run())
                before = run.size
                run.add(text.as_buffer().to_pybytes())
                size += run.size - before
                if size >= run_words:
                    yield from built(runs)
                    runs, size = {}, 0
        yield from built(runs)

    return shards


def _parts(cuts: dict[str, list[Phrase]], lang: str, p: Phrases) -> Iterator[tuple[int, Phrases]]:
    """``p`` cut into ranges: (range, its phrases)."""
    own = cuts.get(lang, [])
    edges = [0, *[p.find(c) for c in own], len(p)]
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if lo < hi:
            yield k, p.rows(slice(lo, hi))


def _cut(cuts: dict[str, list[Phrase]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch["lang"].to_pylist(), batch["automaton"]):
                whole, edges = Automaton.unpack(data.as_buffer()), [None, *cuts.get(lang, []), None]
                for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    if (part := whole.restricted(lo, hi)) is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([k], pa.int32()), pa.array([part.pack()])], ["lang", "part", "automaton"])

    return pieces


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[dict]]]:
    from itertools import groupby

    rows = ({name: batch[name][i].as_py() for name in batch.schema.names} for batch in batches for i in range(batch.num_rows))
    return groupby(rows, key=lambda r: (r["lang"], r["part"]))


def _union(least: int, range_phrases: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces sorted by range -> (lang, part, automaton) of each range's phrases with ``least`` occurrences or more."""
    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, k), rows in _by_range(batches):
            whole, waiting, size = None, [], 0
            for row in rows:
                waiting.append(Automaton.unpack(row["automaton"]).phrases())
                size += len(waiting[-1])
                if 2 * size >= range_phrases:  # sum them up before more come
                    whole, waiting, size = united([*([whole] if whole else []), *waiting]), [], 0
            whole = united([*([whole] if whole else []), *waiting])
            frequent = whole.rows(whole.counts >= least)
            if len(frequent):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([k], pa.int32()), pa.array([build(frequent).pack()])], ["lang", "part", "automaton"])

    return unite


def _cut_at(p: Phrases) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For k = 1 and 2: which phrases can be cut after k words, the first parts' ids and the rests' ids."""
    out = []
    for k in range(1, LONGEST):
        can = np.flatnonzero(p.ids[:, k] > 0)
        head, tail = p.ids[can].copy(), np.zeros_like(p.ids[can])
        head[:, k:] = 0
        tail[:, :LONGEST - k] = p.ids[can][:, k:]
        out.append((can, head, tail))
    return out


def _ask(cuts: dict[str, list[Phrase]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ranges (lang, part, automaton) -> (lang, part, asker, automaton): the parts that range ``asker`` wants to know of range ``part``."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p = Automaton.unpack(row["automaton"]).phrases()
                wanted = np.vstack([x for _, head, tail in _cut_at(p) for x in (head, tail)])
                for k, part in _parts(cuts, row["lang"], summed(p.words, wanted, np.ones(len(wanted), dtype=np.int64))):
                    columns = [pa.array([row["lang"]]), pa.array([k], pa.int32()), pa.array([row["part"]], pa.int32()), pa.array([build(part).pack()])]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "part", "asker", "automaton"])

    return ask


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, its counts (no asker) before what is asked of it -> (lang, part, asker, automaton) to the asking range."""
    for (lang, k), rows in _by_range(batches):
        counts = None
        for row in rows:
            if row["asker"] is None:
                counts = Automaton.unpack(row["automaton"])
                continue
            told = build(counts.compose(Automaton.unpack(row["automaton"])))
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([row["asker"]], pa.int32()), pa.array([k], pa.int32()), pa.array([told.pack()])], ["lang", "part", "asker", "automaton"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, its counts before the answers -> (lang, words, a, l1, r1, l2, r2, head, tail), one per phrase of two words or more.
    l1 and r1 are the counts of the parts of the cut after one word, l2 and r2 after two (null for two words); head and tail
    are a three-word phrase's first and last two words."""
    for (lang, _), rows in _by_range(batches):
        p = Automaton.unpack(next(rows)["automaton"]).phrases()
        answers = [Automaton.unpack(row["automaton"]).phrases() for row in rows]
        if not answers:
            continue
        told = united([Phrases(p.words, p.ids[:0], p.counts[:0]), *answers])
        known = {w: k for k, w in enumerate(told.words, 1)}
        to = np.array([0] + [known.get(w, 0) for w in p.words], dtype=np.int32)
        base = _order(told.ids, len(told.words)) if len(told.words) ** LONGEST < 1 << 62 else None
        index = None if base is not None else {tuple(r): c for r, c in zip(told.ids.tolist(), told.counts.tolist())}

        def counted(ids: np.ndarray) -> np.ndarray:
            if base is None:
                return np.array([index[tuple(r)] for r in ids.tolist()], dtype=np.int64)
            return told.counts[np.searchsorted(base, _order(to[ids], len(told.words)))]

        (two, head1, tail1), (three, head2, tail2) = _cut_at(p)
        l1, r1 = counted(head1), counted(tail1)
        l2, r2 = np.zeros(len(p), dtype=np.int64), np.zeros(len(p), dtype=np.int64)
        l2[three], r2[three] = counted(head2), counted(tail2)
        longer = p.ids[two][:, 2] > 0
        for lo in range(0, len(two), 10_000):
            some = two[lo:lo + 10_000]
            words = [b" ".join(p.at(i)).decode() for i in some.tolist()]
            short = ~longer[lo:lo + 10_000]
            parts = [w.split(" ") for w in words]
            columns = [pa.array([lang] * len(some)), pa.array(words), pa.array(p.counts[some]), pa.array(l1[lo:lo + 10_000]), pa.array(r1[lo:lo + 10_000]),
                       pa.array(l2[some], mask=short), pa.array(r2[some], mask=short),
                       pa.array([None if len(x) < 3 else " ".join(x[:2]) for x in parts], pa.string()), pa.array([None if len(x) < 3 else " ".join(x[1:]) for x in parts], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "a", "l1", "r1", "l2", "r2", "head", "tail"])


#: Automata that go to a task at a time: one can have some megabytes.
BATCH_AUTOMATA = 8


def saved_by_few(df: DataFrame, label: str) -> DataFrame:
    """``saved``, with automata handed to the tasks a few at a time; the session's batch size is as before afterwards."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    try:
        conf.set(key, str(BATCH_AUTOMATA))
        return saved(df, label)
    finally:
        conf.set(key, before)


def cuts_of(shards: DataFrame, range_phrases: int, proposal: int) -> dict[str, list[Phrase]]:
    """Sorted cuts of each language that needs some. A proposal stands for ``proposal`` phrases, so the driver sees range_phrases / proposal for each range."""
    per = max(1, range_phrases // proposal)
    large = shards.groupBy("lang").agg(F.sum("n_phrases").alias("n")).where(F.col("n") > range_phrases)
    rows = shards.select("lang", F.explode("proposals").alias("cut")).join(broadcast_if_small(large.select("lang")), "lang", "left_semi").collect()
    out: dict[str, list[Phrase]] = {}
    for lang, cut in rows:
        out.setdefault(lang, []).append(tuple(bytes(cut).split(b" ")))
    return {lang: sorted(set(sorted(all_)[per // 2::per])) for lang, all_ in out.items()}


def counts(docs: DataFrame, least: int, text_col: str = "text", lang_col: str = "lang", run_words: int = RUN_WORDS, range_phrases: int = RANGE_PHRASES,
           proposal: int = PROPOSAL) -> tuple[DataFrame, DataFrame, dict[str, list[Phrase]]]:
    """(lang, n) of all words; (lang, part, automaton) of the phrases with ``least`` occurrences or more, by range; the cuts of the ranges."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shards = saved(texts.mapInArrow(_shards(run_words, proposal), "lang string, n_words long, n_phrases long, proposals array<binary>, automaton binary"), "phrase-shards")
    cuts = cuts_of(shards, range_phrases, proposal)
    pieces = shards.select("lang", "automaton").mapInArrow(_cut(cuts), "lang string, part int, automaton binary")
    ranges = saved_by_few(pieces.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(_union(least, range_phrases), "lang string, part int, automaton binary"), "phrase-ranges")
    return shards.groupBy("lang").agg(F.sum("n_words").alias("n")), ranges, cuts


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)), exactly: a and so the result is at most 1000000, so a double is near enough to be mended."""
    big = "decimal(38,0)"
    top = (a.cast("decimal(19,0)") * a.cast("decimal(19,0)")).cast(big) * F.lit(1_000_000).cast("decimal(7,0)")
    bottom = (l.cast("decimal(19,0)") * r.cast("decimal(19,0)")).cast(big)
    near = F.floor(F.lit(1e6) * (a / l) * (a / r)).cast("long")
    guesses = [near - 1, near, near + 1]
    fits = lambda q: (q.cast("decimal(8,0)") * bottom).cast(big) <= top.cast(big)
    return F.when(fits(guesses[2]), guesses[2]).when(fits(guesses[1]), guesses[1]).otherwise(guesses[0])


def collocations(docs: DataFrame, least: int = 10, covered_percent: int = 50, first: int = 2000, text_col: str = "text", lang_col: str = "lang", **sizes: int) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``first`` candidates by the score of their weakest cut.
    ``sizes`` are those of ``counts``."""
    words, ranges, cuts = counts(docs, least, text_col, lang_col, **sizes)
    shape = "lang string, part int, asker int, automaton binary"
    known = ranges.select("lang", "part", F.lit(None).cast("int").alias("asker"), "automaton")
    asked = ranges.mapInArrow(_ask(cuts), shape)
    meet = lambda df: known.unionByName(df).repartition("lang", "part").sortWithinPartitions("lang", "part", F.col("asker").asc_nulls_first())
    answers = saved_by_few(meet(asked).mapInArrow(_answer, shape), "phrase-answers")
    found = meet(answers).mapInArrow(_candidates, "lang string, phrase string, a long, l1 long, r1 long, l2 long, r2 long, head string, tail string")
    found = saved_by_few(found, "phrase-candidates")

    covers = lambda part, n: F.when(F.col("a") * 100 >= F.col(n) * covered_percent, F.col(part))
    covered = (found.where(F.col("head").isNotNull())
               .select("lang", F.explode(F.array(covers("head", "l2"), covers("tail", "r1"))).alias("phrase")).where(F.col("phrase").isNotNull()).distinct())
    s1, s2 = score(F.col("a"), F.col("l1"), F.col("r1")), score(F.col("a"), F.col("l2"), F.col("r2"))
    scored = found.withColumn("s1", s1).withColumn("s2", s2).withColumn("late", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False)))
    pick = lambda x, y: F.when(F.col("late"), F.col(y)).otherwise(F.col(x))
    scored = scored.select("lang", "phrase", "a", pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score"))
    ranked = (scored.join(covered, ["lang", "phrase"], "left_anti")
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")).where(F.col("rank") <= first))
    return ranked.join(broadcast_if_small(saved(words, "phrase-words")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
