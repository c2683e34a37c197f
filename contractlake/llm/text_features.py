"""Hashed text features, computed on the bytes of many documents at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes worked on at a time; longer texts are read in pieces that end at white space where there is some.
PIECE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def held_out(id_col: str) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text is divisible by 5. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``most`` (id, y) rows to learn from, first by a hash of the id. Rows without id or label, held-out rows and ids with two labels are left out."""
    one = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
           .groupBy(id_col).agg(F.min(label_col).alias("y"), F.max(label_col).alias("other")).where("y = other").select(id_col, F.col("y").cast("int")))
    return one.orderBy(F.xxhash64(id_col), id_col).limit(most)


def sampled_texts(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, y, h, bytes) of the documents with an id in the bounded ``sample`` (id, y); h is a hash of the text. An id may be on many
    rows: tasks go by ``fresh``, and ``one_of_each`` leaves one."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("bytes")).join(
        F.broadcast(sample.select(F.col(id_col).alias("id"), "y")), "id").select("id", "y", "h", "bytes")


def fresh(batch: pa.RecordBatch, seen: dict) -> pa.RecordBatch:
    """The rows of ``batch`` whose text has a smaller hash than any that this task has met of its id: of many rows of one id, the
    logarithm of their number at most in any order of texts, and one if they agree."""
    rows = []
    for k, (i, h) in enumerate(zip(batch["id"].to_pylist(), batch["h"].to_pylist())):
        if i not in seen or h < seen[i]:
            seen[i] = h
            rows.append(k)
    return batch.take(pa.array(rows, pa.int64()))


def one_of_each(rows: DataFrame) -> DataFrame:
    """Of the rows that tasks found, one for each id: that with the smallest hash."""
    others = [c for c in rows.columns if c not in ("id", "h")]
    return rows.groupBy("id").agg(F.min(F.struct("h", *others)).alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in others])


@lru_cache(maxsize=4)
def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, base, dtype=np.uint64))))


class Chunk:
    """Pieces of documents, one after the other with a line feed behind each: ``data``, and the document number of each piece."""

    def __init__(self, pieces: list[bytes], docs: list[int]):
        self.data = np.frombuffer(b"\n".join([*pieces, b""]), dtype=np.uint8)
        self.docs = np.array(docs, dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum([len(p) + 1 for p in pieces])))

    def owner(self, at: np.ndarray) -> np.ndarray:
        return self.docs[np.searchsorted(self.starts, at, side="right") - 1]

    def words(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the runs of bytes that ``member`` marks."""
        inside = member[self.data]
        inside[self.starts[1:] - 1] = False
        change = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        return change[::2], change[1::2]

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """Prefix hashes of ``data``, for ``span``."""
        size = 1 << max(16, int(len(data)).bit_length())
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(size, BASE)[:len(data)])))

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of data[start:end], the same wherever the bytes stand."""
        size = 1 << max(16, int(len(self.data)).bit_length())
        h = (prefix[end] - prefix[start]) * powers(size, INVERSE)[start]
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, value) of every run of n <= 4 bytes inside a piece."""
        size = np.maximum(np.diff(self.starts) - n, 0)
        at = np.repeat(self.starts[:-1] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        wide = self.data.astype(np.uint32)
        value = wide[:len(wide) - n + 1].copy()
        for k in range(1, n):
            value |= wide[k:len(wide) - n + 1 + k] << np.uint32(8 * k)
        return np.repeat(self.docs, size), value[at]


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """The whole texts (binary; null: empty) of a batch in chunks of bounded size."""
    pieces, docs, held = [], [], 0
    for number, value in enumerate(texts):
        text = value.as_py() or b""
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE_BYTES)
            if end < len(text):
                end = max(text.rfind(b" ", at + 1, end), text.rfind(b"\n", at + 1, end)) + 1 or end
            if held + end - at > PIECE_BYTES and pieces:
                yield Chunk(pieces, docs)
                pieces, docs, held = [], [], 0
            pieces.append(text[at:end])
            docs.append(number)
            held += end - at
            at = end
    if pieces:
        yield Chunk(pieces, docs)


def counted(owner: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, times) without repeats."""
    pair, times = np.unique((owner.astype(np.int64) << 32) | ids.astype(np.int64), return_counts=True)
    return pair >> 32, pair & 0xFFFFFFFF, times
