"""BPE encoding and decoding through a tokenization automaton.

The merge list is compiled, one merge gadget after the other, into a deterministic automaton whose
arcs are tokens. A state stands for "the last token read"; an arc that is missing means that the two
tokens cannot stand side by side in a correct tokenization. For the merge ``a b`` the gadget

* cuts the ``b`` arc of the state behind ``a`` (after ``a`` comes no ``b`` any more: it would have merged),
* adds an ``ab`` arc beside every ``a`` arc that exists at that moment,
* lets the new arc end in a copy of the state behind ``b`` as it is at that moment.

Written out, fifty thousand gadgets give some seventy million missing arcs. The automaton is therefore
kept as what each gadget changed, stamped with the gadget's number, and rows of the transition table are
filled in when they are first read (``Automaton.cut_at``). A correct tokenization of a prefix is unique, so
reading a pre-split word is a walk over the table that never visits a byte position twice.

Contract: null text counts as empty (no ids); nothing is truncated; the text of an added token (for
instance an end-of-text mark) becomes that token's id; tokens decode by their arc labels, bytes that are
no UTF-8 to U+FFFD. Repeated rows give repeated results; other columns of the input are left alone.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Splits text before merging. Fixed value of the byte-level vocabulary.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
NEVER = 1 << 60
#: Words and transition-table cells kept per Python worker.
WORDS_KEPT, CELLS_KEPT = 1_000_000, 600_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """{'vocab': {label bytes: id}, 'merges': [(left bytes, right bytes)], 'added': {text: id}} of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    as_bytes = byte_alphabet()

    def label(token: str) -> bytes:
        return bytes(as_bytes[c] for c in token)

    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return {"vocab": {label(t): i for t, i in spec["model"]["vocab"].items()},
            "merges": [(label(a), label(b)) for a, b in merges],
            "added": {t["content"]: t["id"] for t in spec.get("added_tokens", [])}}


class Automaton:
    """The compiled automaton of one vocabulary. ``encode`` and ``decode`` work on whole texts."""

    def __init__(self, vocabulary: dict):
        ids = vocabulary["vocab"]
        self.size = max([*ids.values(), *vocabulary["added"].values()]) + 1
        self.labels: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            self.labels[i] = token
        self.born = [-1] * self.size  # number of the gadget that made the token's arcs; -1: a single byte
        self.left: list[int] = [-1] * self.size
        self.right: list[int] = [-1] * self.size
        self.merged: dict[int, int] = {}  # state * size + arc -> the gadget that cut the arc
        for number, (a, b) in enumerate(vocabulary["merges"]):
            self._gadget(number, ids[a], ids[b], ids[a + b])
        self.cells: dict[int, int] = {}
        self.ids = ids
        lengths: dict[bytes, set[int]] = {}
        for token in ids:
            lengths.setdefault(token[:2], {1}).add(len(token))
        self.lengths = {head: sorted(found, reverse=True) for head, found in lengths.items()}
        self.added = dict(vocabulary["added"])
        for text, i in self.added.items():
            self.labels[i] = text.encode()
        self.added_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.split = regex.compile(SPLIT)
        self.words = _Words(self)

    def _gadget(self, number: int, a: int, b: int, ab: int) -> None:
        self.merged.setdefault(a * self.size + b, number)
        self.born[ab], self.left[ab], self.right[ab] = number, a, b

    def cut_at(self, state: int, arc: int) -> int:
        """The gadget since which ``state`` has no ``arc``; NEVER if it still has it. Fills in the table cell."""
        cell = state * self.size + arc
        known = self.cells.get(cell)
        if known is not None:
            return known
        at = self.merged.get(cell, NEVER)
        made, arc_made = self.born[state], self.born[arc]
        if made >= 0 and arc_made <= made and self.cut_at(self.right[state], arc) < made:
            at = min(at, made)  # the state began as a copy of one that had lost the arc
        if arc_made >= 0 and made <= arc_made and self.cut_at(state, self.left[arc]) <= arc_made:
            at = min(at, arc_made)  # the arc was added beside one that the state had lost
        if len(self.cells) >= CELLS_KEPT:
            self.cells.clear()
        self.cells[cell] = at
        return at

    def read(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word: the only path through the automaton that spells it."""
        n, at, path, starts = len(word), 0, [], []
        ids, lengths, cut_at, single = self.ids, self.lengths, self.cut_at, (1,)
        dead = bytearray(n + 1)
        tried = [0] * (n + 1)  # how many of a position's token lengths, longest first, have been tried
        while at < n:
            last = path[-1] if path else -1
            options = lengths.get(word[at:at + 2], single)
            for k in range(tried[at], len(options)):
                end = at + options[k]
                if end > n or dead[end]:
                    continue
                i = ids.get(word[at:end])
                if i is not None and (last < 0 or cut_at(last, i) == NEVER):
                    tried[at] = k + 1
                    path.append(i)
                    starts.append(at)
                    at = end
                    break
            else:
                dead[at] = 1
                if not path:
                    raise ValueError("a byte of the text is not in the vocabulary")
                path.pop()
                at = starts.pop()
        return path

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        words, split = self.words, self.split
        if self.added_split is None or not any(t in text for t in self.added):
            return b"".join(map(words.__getitem__, split.findall(text)))
        out = []
        for k, part in enumerate(self.added_split.split(text)):
            out += [self.added[part].to_bytes(4, "little")] if k % 2 else map(words.__getitem__, split.findall(part))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.labels.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


class _Words(dict):
    """Ids by word, filled in by reading the word through the automaton; holds WORDS_KEPT words at most."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        ids = b"".join(i.to_bytes(4, "little") for i in self.automaton.read(word.encode()))
        if len(self) < WORDS_KEPT and len(word) <= 64:
            self[word] = ids
        return ids


_compiled: dict[str, Automaton] = {}


def compiled(vocabulary: dict, key: str) -> Automaton:
    """The automaton, compiled once per Python worker."""
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Automaton(vocabulary)
    return _compiled[key]


def _broadcast(spark: SparkSession, path: str):
    """The vocabulary goes to the executors as a value: its size is that of the vocabulary file, whatever the corpus."""
    vocabulary = read_vocabulary(path)
    key = hashlib.sha256(repr(sorted(vocabulary["vocab"].items())[:1000]).encode() + path.encode()).hexdigest()
    return spark.sparkContext.broadcast(vocabulary), key


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Rows (id, n_tokens, ids binary: little-endian unsigned 32-bit). One pass, no shuffle.

    With ``digests`` the ids are decoded again at once and only (id, n_tokens, ids_sha256, decoded_sha256) leave the task.
    """
    shared, key = _broadcast(docs.sparkSession, path)
    id_type = docs.schema[id_col].dataType.simpleString()
    out = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(shared.value, key)
        for batch in batches:
            counts, first, second = [], [], []
            for value in batch.column(1):
                ids = automaton.encode(value.as_py() or "")
                counts.append(len(ids) // 4)
                if digests:
                    first.append(hashlib.sha256(ids).hexdigest())
                    second.append(hashlib.sha256(automaton.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
                else:
                    first.append(ids)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string() if digests else pa.binary())]
            names = [id_col, "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids"])]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(second, pa.string())] if digests else []), names=names)

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, f"{id_col} {id_type}, n_tokens long, {out}")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text) from the output of ``encode``; null ids give the empty text."""
    shared, key = _broadcast(encoded.sparkSession, path)
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(shared.value, key)
        for batch in batches:
            texts = [automaton.decode(np.frombuffer(v.as_py() or b"", "<u4")) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(F.col(id_col), F.col(ids_col).alias("_ids")).mapInArrow(run, f"{id_col} {id_type}, text string")
