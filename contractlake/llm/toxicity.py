"""Toxicity by weak supervision.

1. Voters. Words and word beginnings (four to six bytes) that are much more frequent in documents labelled toxic make
   lexicon voters, dealt out by rank; a fixed list of insults and patterns (an insult after a second person, a
   run of insults, shouting) make pattern voters. A voter says toxic, clean or nothing.
2. Label model. A generative model with one hidden class per document explains the votes of a bounded sample of
   documents, labelled and unlabelled: each voter's accuracies, and its correlation with one other voter given the class
   (the tree of largest mutual information in either class), by expectation maximization. Labels hold the class in place
   there. Its posteriors given the votes are the training labels.
3. Classifier. A linear model on hashed words and word beginnings is trained on the posteriors by stochastic gradient
   descent; all documents are scored by it in one pass without a shuffle.

Only rows that aren't held out are learned from, in every step. Contract: null and empty texts get the score of the
trained bias; texts are read whole; repeated rows get equal scores; without toxic labels only the fixed voters remain,
and without any sample row the score is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlake.llm.stage import saved
from contractlake.llm.text_features import LETTER, LOWER, Chunk, chunks, fresh, held_out, labelled_sample, one_of_each, sampled_texts

BITS, SEED = 22, 11
#: Labelled documents that entries are picked from, and all documents the label model and the classifier learn from, at most.
LABELLED_ROWS, SAMPLE_ROWS = 8000, 9000
#: An entry needs so many toxic documents and so large a share of them, not counting near copies, and so large a log odds ratio.
ENTRY_DOCS, ENTRY_SHARE, ENTRY_ODDS, ENTRIES, LEXICONS = 4, 0.012, 2.8, 4000, 6
PREFIXES = (4, 5, 6)
SILENCE = 0.3
NEAR, SKETCH = 0.8, 16
EPOCHS, BATCH, RATE, SHRINK = 12, 64, 0.2, 1e-5
# English words of abuse.
INSULTS = ("idiot", "stupid", "moron", "loser", "scum", "clown", "pathetic", "worthless", "disgusting", "trash",
           "garbage", "dumb", "fool", "jerk", "imbecile", "filth", "vermin", "bastard", "asshole", "bitch")
INSULT = re.compile(rb"\b(?:" + b"|".join(w.encode() for w in INSULTS) + rb")\b", re.I)
AT_YOU = re.compile(rb"\b(?:you|your|ur)\b(?:\W+\w+){0,3}?\W+(?:" + b"|".join(w.encode() for w in INSULTS) + rb")\b", re.I)
RUN = re.compile(rb"\b(?:" + b"|".join(w.encode() for w in INSULTS) + rb")(?:\W+(?:\w+\W+){0,12}(?:" + b"|".join(w.encode() for w in INSULTS) + rb"))\b", re.I)
SHOUT = re.compile(rb"(?:\b[A-Z]{4,}\b\W+){6}")


def features(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, feature) of all words, then of the beginnings of longer words, kind by kind."""
    lower = LOWER[chunk.data]
    start, end = chunk.words(LETTER)
    prefix, doc, shift = chunk.hashes(lower), chunk.owner(start), np.uint64(64 - BITS)
    yield doc, (chunk.span(prefix, start, end) >> shift).astype(np.int64)
    for n in PREFIXES:
        long = end - start > n
        h = chunk.span(prefix, start[long], start[long] + n) + np.uint64(n << 59)
        yield doc[long], (h >> shift).astype(np.int64)


def distinct_features(texts: pa.Array) -> list[np.ndarray]:
    """The sorted set of features of each text; the kind (0: words, k: beginnings) stands above the feature."""
    found: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
    for chunk in chunks(texts):
        for kind, (doc, ids) in enumerate(features(chunk)):
            pair = np.unique((doc << 32) | (kind << BITS) | ids)
            owner = pair >> 32
            for k in np.unique(owner):
                found[k].append(pair[slice(*np.searchsorted(owner, [k, k + 1]))] & 0xFFFFFFFF)
    return [np.unique(np.concatenate(f)) if f else np.empty(0, dtype=np.int64) for f in found]


def pattern_votes(text: bytes) -> list[int]:
    """Fixed voters: 1 toxic, 0 nothing, -1 clean."""
    hits = len(INSULT.findall(text))
    return [1 if hits else 0, 1 if hits > 2 else 0, 1 if hits and AT_YOU.search(text) else 0, 1 if hits > 1 and RUN.search(text) else 0,
            1 if hits and SHOUT.search(text) else 0]


def tally(rows: list[np.ndarray], weights: np.ndarray | None = None) -> np.ndarray:
    """How many rows have each feature, or the sum of their weights."""
    total = np.zeros((1 + len(PREFIXES)) << BITS, dtype=np.float32)
    for k, feats in enumerate(rows):
        total[feats] += 1 if weights is None else weights[k]
    return total


def without_near_copies(rows: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray]]:
    """One of each group of near copies: a document is left out only if it shares NEAR of its features with one of its label that stays.
    Minimum hashes tell which are worth comparing in full."""
    factors = np.random.default_rng(SEED).integers(1, 1 << 62, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    kept: list[tuple[int, np.ndarray]] = []
    for label in (0, 1):
        own = [f for y, f in rows if y == label and len(f)]
        sketches, stay = np.zeros((len(own), SKETCH), dtype=np.uint64), []
        for f in own:
            mixed = (f.astype(np.uint64) + np.uint64(1))[:, None] * factors[None, :]
            sketch = (mixed ^ (mixed >> np.uint64(29))).min(axis=0)
            alike = np.flatnonzero((sketches[:len(stay)] == sketch).sum(axis=1) >= SKETCH // 2)
            near = False
            for k in alike.tolist():
                both = len(np.intersect1d(f, stay[k], assume_unique=True))
                near = near or both >= NEAR * (len(f) + len(stay[k]) - both)
            if not near:
                sketches[len(stay)] = sketch
                stay.append(f)
        kept += [(label, f) for f in stay]
    return kept


def pick_entries(rows: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
    """Lexicons: features that are much more frequent in toxic documents, dealt to LEXICONS lists of each kind by rank."""
    toxic, clean = ([f for y, f in without_near_copies(rows) if y == k] for k in (1, 0))
    n1, n0 = len(toxic), len(clean)
    count, other = tally(toxic), tally(clean)
    names = np.flatnonzero(count >= max(ENTRY_DOCS, ENTRY_SHARE * n1))
    count, other = count[names], other[names]
    odds = np.log((count + 0.5) / (n1 + 1)) - np.log((other + 0.5) / (n0 + 1))
    lists = []
    for kind in range(1 + len(PREFIXES)):
        good = np.flatnonzero((names >> BITS == kind) & (odds >= ENTRY_ODDS))
        good = good[np.lexsort((names[good], -(odds * np.sqrt(count))[good]))][:ENTRIES]
        lists += [np.sort(names[good[k::LEXICONS]]) for k in range(LEXICONS) if len(good) > k]
    return lists


def vote(feats: np.ndarray, patterns: list[int], lexicons: list[np.ndarray]) -> list[int]:
    """A lexicon says toxic where it has an entry of the document, else clean."""
    return [*patterns, *(1 if np.isin(lexicon, feats, assume_unique=True).any() else -1 for lexicon in lexicons)]


class LabelModel:
    """Hidden class, and each voter given the class and at most one other voter.

    Accuracies and correlations are estimated from the votes on all documents; where a label is ``known`` (0 or 1, else
    -1) it holds the hidden class in place while they are estimated. The posteriors come from the votes alone. A lexicon holds a part of the vocabulary, perhaps of one
    language, so that it finds nothing says little about a single document: in the posteriors that are handed on, all
    votes but "toxic" count by ``SILENCE``.
    """

    def __init__(self, votes: np.ndarray, known: np.ndarray | None = None, rounds: int = 20):
        n, v = votes.shape
        hot = np.stack([votes == k for k in (-1, 0, 1)], axis=2).reshape(n, 3 * v).astype(np.float64)
        says = (votes == 1).sum(axis=1) - 0.25 * (votes == -1).sum(axis=1)
        p = np.clip(1 / (1 + np.exp(-says)), 0.02, 0.98)  # first guess: a weighted majority
        for turn in range(rounds + 1):
            p = p if known is None else np.where(known >= 0, np.clip(known, 0.02, 0.98), p)
            joint = np.stack([hot.T @ (w[:, None] * hot) for w in (1 - p, p)]).reshape(2, v, 3, v, 3) + 0.05
            joint /= joint.sum(axis=(2, 4), keepdims=True)
            single = joint.sum(axis=4)[:, :, :, :]  # class, voter, says, voter: the same for each other voter, up to smoothing
            single = single[:, np.arange(v), :, np.arange(v)].transpose(1, 0, 2)
            prior = np.clip(np.array([1 - p.mean(), p.mean()]), 1e-3, None)
            info = (joint * np.log(joint / (single[:, :, :, None, None] * single[:, None, None, :, :]))).sum(axis=(2, 4))
            parent = self.tree(info.max(axis=0))
            log = np.tile(np.log(prior), (n, 1))
            for k in range(v):
                a, weight = votes[:, k] + 1, np.where((votes[:, k] == 1) | (turn < rounds), 1, SILENCE)
                for y in (0, 1):
                    if parent[k] < 0:
                        log[:, y] += weight * np.log(single[y, k])[a]
                    else:
                        table = joint[y, k][:, parent[k], :]
                        log[:, y] += weight * np.log(table / table.sum(axis=0))[a, votes[:, parent[k]] + 1]
            new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -40, 40)))
            p = new
        self.posterior, self.parent, self.accuracy = p, parent, single

    @staticmethod
    def tree(info: np.ndarray, least: float = 0.1) -> list[int]:
        """Each voter's parent in the maximum spanning tree (-1: root, or none that tells more than ``least``: weaker links would explain the class away)."""
        parent, inside, best, link = [-1] * len(info), np.zeros(len(info), dtype=bool), np.full(len(info), -np.inf), np.full(len(info), -1)
        for _ in range(len(info)):
            k = int(np.argmax(np.where(inside, -np.inf, best)))
            if inside[k] or best[k] == -np.inf:
                k = int(np.argmin(inside))
            elif best[k] >= least:
                parent[k] = int(link[k])
            inside[k] = True
            closer = ~inside & (info[k] > best)
            best[closer], link[closer] = info[k][closer], k
        return parent


@dataclass
class Model:
    names: np.ndarray  # features with a weight, sorted
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        if len(self.names):
            for part in _matches(texts, self.names):
                total += np.bincount(part >> 32, weights=self.weights[part & 0xFFFFFFFF], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _matches(texts: pa.Array, names: np.ndarray) -> Iterator[np.ndarray]:
    """(document << 32 | place in names), each once per document, for the features that are in ``names``."""
    table = np.zeros(1 << BITS, dtype=bool)
    table[names & ((1 << BITS) - 1)] = True
    found = []
    for chunk in chunks(texts):
        for kind, (doc, ids) in enumerate(features(chunk)):
            some = table[ids]
            doc, key = doc[some], (kind << BITS) | ids[some]
            place = np.minimum(np.searchsorted(names, key), len(names) - 1)
            same = names[place] == key
            found.append(np.unique((doc[same] << 32) | place[same]))
    if found:
        yield np.unique(np.concatenate(found))


def classifier(rows: list[np.ndarray], p: np.ndarray) -> Model:
    """Linear model on feature sets and posterior labels. Features that tell the classes apart take part."""
    n1, n0 = p.sum() + 1, (1 - p).sum() + 1
    if not any(len(r) for r in rows):
        return Model(np.empty(0, dtype=np.int64), np.empty(0), float(np.log(n1 / n0)) if rows else -50.0)
    seen, toxic, rate = tally(rows), tally(rows, p), n1 / (n1 + n0)
    names = np.flatnonzero(seen >= 3)
    seen, toxic = seen[names], toxic[names]
    names = names[np.abs(toxic - seen * rate) > 4 * np.sqrt(seen * rate * (1 - rate))]
    place = np.full((1 + len(PREFIXES)) << BITS, -1, dtype=np.int32)
    place[names] = np.arange(len(names))
    lists = [x[x >= 0] for x in (place[r] for r in rows)]
    rng, weights, bias = np.random.default_rng(SEED), np.zeros(len(names)), float(np.log(n1 / n0))
    past, past_bias = np.full(len(weights), 1e-3), 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            ids, owner = np.concatenate([lists[k] for k in some]), np.repeat(np.arange(len(some)), [len(lists[k]) for k in some])
            out = np.bincount(owner, weights=weights[ids], minlength=len(some)) + bias
            miss = 1 / (1 + np.exp(-np.clip(out, -50, 50))) - p[some]
            slope = np.bincount(ids, weights=miss[owner], minlength=len(weights)) + SHRINK * weights
            past += slope * slope
            weights -= RATE * slope / np.sqrt(past)
            past_bias += miss.sum() ** 2
            bias -= RATE * miss.sum() / np.sqrt(past_bias)
    return Model(names, weights, bias)


def _feature_rows(docs: DataFrame) -> list:
    """(y, features, pattern votes), one for each id of a bounded set of documents (id, y, h, bytes), to the driver, in a fixed order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for whole in batches:
            batch = fresh(whole, seen)
            if not batch.num_rows:
                continue
            feats = distinct_features(batch["bytes"])
            votes = [pattern_votes(v.as_py() or b"") for v in batch["bytes"]]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["h"], batch["y"], pa.array([f.astype(np.int32).tobytes() for f in feats], pa.binary()),
                                              pa.array(votes, pa.list_(pa.int8()))], names=["id", "h", "y", "feats", "votes"])

    id_type = docs.schema["id"].dataType.simpleString()
    found = one_of_each(saved(docs.mapInArrow(run, f"id {id_type}, h long, y int, feats binary, votes array<tinyint>"), "toxicity-sample"))
    rows = sorted((-1 if r["y"] is None else r["y"], bytes(r["feats"]), list(r["votes"])) for r in found.toLocalIterator())
    return [(y, np.frombuffer(f, np.int32), v) for y, f, v in rows]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Voters from labelled documents, label model and classifier from these and some more documents."""
    known = labelled_sample(labels, label_col, LABELLED_ROWS, id_col)
    picked = (docs.where(~held_out(id_col) & F.col(id_col).isNotNull()).select(id_col).distinct()
              .orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_ROWS - LABELLED_ROWS))
    sample = known.union(picked.join(known, id_col, "left_anti").select(id_col, F.lit(None).cast("int"))).select(id_col, "y")
    rows = _feature_rows(sampled_texts(docs, sample, id_col, text_col))  # SAMPLE_ROWS rows at most
    labelled = [(y, f) for y, f, _ in rows if y >= 0]
    lexicons = pick_entries(labelled) if any(y == 1 for y, _ in labelled) else []
    feats = [f for _, f, _ in rows]
    if not rows:
        return Model(np.empty(0, dtype=np.int64), np.empty(0), -50.0)
    votes = np.array([vote(f, v, lexicons) for _, f, v in rows])
    return classifier(feats, LabelModel(votes, np.array([y for y, _, _ in rows])).posterior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows (id, held_out, score, predicted), one per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # features of a bounded sample, whatever the corpus
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=[id_col, "held_out", "score", "predicted"])

    rows = docs.select(id_col, held_out(id_col).alias("held_out"), F.col(text_col).cast("binary").alias("_bytes"))
    return rows.mapInArrow(run, f"{id_col} {id_type}, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays under ``threshold``. One pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            yield batch.filter(pa.array(shared.value.scores(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
