"""Quality classifier: supervised subword embeddings.

Words, pairs of neighbouring words and runs of three and four bytes are hashed to ``2**BITS`` vectors, which are
averaged over the whole document, each of the four kinds with the same weight, and go through a linear layer and a softmax. Vectors and layer are trained together by
numpy stochastic gradient descent on a bounded sample of labelled documents (``TRAIN_ROWS``); a part of the sample is
kept back to set scale and offset of the output, which the trained documents would make too sure. A word that repeats
its predecessor makes the pair feature "repeated", whichever word it is. As the layer is linear, a document's score is the
average of one number per feature, and scoring is one pass without a shuffle over all documents.

Contract: null and empty texts have no features and get the score of the trained bias; texts of any length are read
whole; repeated rows get equal scores; without labels of both kinds the score is the smoothed share of label 1 (0.5
without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlake.llm.stage import saved
from contractlake.llm.text_features import SPACE, Chunk, chunks, counted, fresh, held_out, labelled_sample, one_of_each, sampled_texts

KINDS, BITS, DIM, EPOCHS, BATCH, RATE, SEED = 4, 17, 8, 6, 32, 0.3, 7
#: A small sample is gone through more often, so that so many steps are taken.
LEAST_STEPS = 500
#: Labelled documents to learn from, at most.
TRAIN_ROWS = 4000
#: One labelled document in so many is kept back from the training to set the softmax's scale and offset.
CALIBRATION = 4


def features(chunk: Chunk) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, documents, features) of all occurrences."""
    shift = np.uint64(64 - BITS)
    start, end = chunk.words(SPACE == False)  # noqa: E712
    word, doc = chunk.span(chunk.hashes(chunk.data), start, end), chunk.owner(start)
    yield 0, doc, (word >> shift).astype(np.int64)
    if len(word) > 1:
        pair = (word[:-1] * np.uint64(0x94D049BB133111EB) + word[1:]) * np.uint64(0x9E3779B97F4A7C15)
        pair[word[:-1] == word[1:]] = np.uint64(1 << 63)
        inside = doc[:-1] == doc[1:]
        yield 1, doc[1:][inside], (pair[inside] >> shift).astype(np.int64)
    for n in (3, 4):
        owner, value = chunk.grams(n)
        yield n - 1, owner, ((value * np.uint32(2654435761 + 2 * n)) >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass
class Model:
    table: np.ndarray  # a feature's share of the difference of the two outputs before the softmax
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        total, n = np.zeros((KINDS, len(texts))), np.zeros((KINDS, len(texts)))
        for chunk in chunks(texts):
            for kind, doc, ids in features(chunk):
                total[kind] += np.bincount(doc, weights=self.table[ids], minlength=len(texts))
                n[kind] += np.bincount(doc, minlength=len(texts))
        mean = (total / np.maximum(n, 1)).sum(axis=0) / KINDS
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -50, 50)))


def calibration(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(scale, offset) of the logistic curve through outputs and labels, by Newton steps with a small ridge."""
    x, w = np.stack([raw, np.ones(len(raw))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 0.05 * (w - [1, 0])
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2), slope).clip(-1, 1)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def train(docs: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """``docs``: (label, features, share of each feature among the document's features)."""
    y = np.array([d[0] for d in docs], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(1 << BITS, dtype=np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(SEED)
    back = np.arange(len(docs)) % CALIBRATION == 0 if min(np.bincount(y)) >= 10 * CALIBRATION else np.zeros(len(docs), dtype=bool)
    learn = np.flatnonzero(~back)
    vectors, layer, bias = rng.standard_normal((1 << BITS, DIM), dtype=np.float32) / DIM, rng.standard_normal((DIM, 2)) / DIM, np.zeros(2)
    seen = [np.full_like(x, 1e-6) for x in (vectors, layer, bias)]

    def step(x: np.ndarray, so_far: np.ndarray, slope: np.ndarray, rows=slice(None)) -> None:
        so_far[rows] += slope * slope  # steps shrink with the slopes seen so far
        x[rows] -= RATE * slope / np.sqrt(so_far[rows])

    for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // len(learn))):
        order = rng.permutation(learn)
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            ids = np.concatenate([docs[k][1] for k in some])
            share = np.concatenate([docs[k][2] for k in some])
            doc = np.repeat(np.arange(len(some)), [len(docs[k][1]) for k in some])
            starts = np.concatenate(([0], np.cumsum([len(docs[k][1]) for k in some])[:-1]))
            mean = np.add.reduceat(vectors[ids] * share[:, None], starts, axis=0)  # every document has features
            out = mean @ layer + bias
            out = np.exp(out - out.max(axis=1, keepdims=True))
            out /= out.sum(axis=1, keepdims=True)
            out[np.arange(len(some)), y[some]] -= 1
            back_to = (out @ layer.T)[doc] * share[:, None]
            rows = np.flatnonzero(np.bincount(ids, minlength=len(vectors)))
            step(vectors, seen[0], np.stack([np.bincount(ids, weights=back_to[:, k], minlength=len(vectors))[rows] for k in range(DIM)], axis=1), rows)
            step(layer, seen[1], mean.T @ out)
            step(bias, seen[2], out.sum(axis=0))
    toward = layer[:, 1] - layer[:, 0]
    table, offset = vectors @ toward, float(bias[1] - bias[0])
    raw = np.array([table[docs[k][1]] @ docs[k][2] + offset for k in np.flatnonzero(back)])
    scale, shift = calibration(raw, y[back]) if len(raw) else (1.0, 0.0)
    return Model((scale * table).astype(np.float32), scale * offset + shift)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Trains on ``TRAIN_ROWS`` labelled documents at most; only their feature counts come to the driver."""
    sample = labelled_sample(labels, label_col, TRAIN_ROWS, id_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for whole in batches:
            batch = fresh(whole, seen)
            if not batch.num_rows:
                continue
            parts = [(kind, *counted(doc, ids)) for chunk in chunks(batch["bytes"]) for kind, doc, ids in features(chunk)]
            if not parts:
                continue
            kind = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
            doc, ids, times = (np.concatenate(x) for x in zip(*(p[1:] for p in parts)))
            share = times / np.bincount(doc * KINDS + kind, weights=times)[doc * KINDS + kind] / KINDS
            pair, at = np.unique((doc << 32) | ids, return_inverse=True)
            share, lengths = np.bincount(at, weights=share), np.bincount(pair >> 32, minlength=batch.num_rows)
            cut = np.cumsum(lengths)[:-1]
            yield pa.RecordBatch.from_arrays([
                batch["id"], batch["h"], batch["y"], pa.array([x.astype(np.int32).tobytes() for x in np.split(pair & 0xFFFFFFFF, cut)]),
                pa.array([x.astype(np.float32).tobytes() for x in np.split(share, cut)])], names=["id", "h", "y", "ids", "share"])

    own = sampled_texts(docs, sample, id_col, text_col)
    id_type = own.schema["id"].dataType.simpleString()
    found = saved(own.mapInArrow(count, f"id {id_type}, h long, y int, ids binary, share binary"), "quality-sample")
    rows = one_of_each(found).toLocalIterator()  # TRAIN_ROWS rows at most
    rows = sorted((r["y"], bytes(r["ids"]), bytes(r["share"])) for r in rows if r["ids"])
    return train([(y, np.frombuffer(i, np.int32), np.frombuffer(s, np.float32)) for y, i, s in rows])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Rows (id, held_out, score, predicted), one per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers, whatever the corpus
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=[id_col, "held_out", "score", "predicted"])

    rows = docs.select(id_col, held_out(id_col).alias("held_out"), F.col(text_col).cast("binary").alias("_bytes"))
    return rows.mapInArrow(run, f"{id_col} {id_type}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``. One pass; whole rows go through the task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            yield batch.filter(pa.array(shared.value.scores(texts) >= threshold))

    return docs.mapInArrow(run, docs.schema)
