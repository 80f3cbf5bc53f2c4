"""Quality classifier: random-indexing word vectors, pooled, then a small network.

Every word has a sparse random index vector that follows from its hash. A word's vector
is the sum of the index vectors of its neighbours over the training texts; it is kept
for hash buckets, so its size is fixed. A document is the mean of its words' vectors and
the mean index vector of its words' shapes (letters, capitals, digits, signs, the word
before once more), so that words never seen still tell something. A network of two layers in numpy gives a
probability; its temperature is fitted on labelled rows that training left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrier.llm.blocks import LOWER, WHITE, Block, blocks, mix
from terrier.llm.training import PARTS, averaged, emit, labelled_sample
from terrier.session import cut_lineage

BUCKETS, DIMENSIONS, NONZERO, WINDOW = 1 << 14, 48, 4, 2
_KINDS = np.full(256, 3, np.uint8)          # signs
_KINDS[97:123] = 0
_KINDS[65:91] = 1
_KINDS[48:58] = 2
_KINDS[0x80:] = 0


def index_vectors() -> np.ndarray:
    """Sparse random vectors of all buckets, the same in every worker."""
    random = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    for _ in range(NONZERO):
        out[np.arange(BUCKETS), random.integers(0, DIMENSIONS, BUCKETS)] += random.choice([-1.0, 1.0], BUCKETS).astype(np.float32)
    return out


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, shape buckets and owners of all words of a block."""
    starts, ends = block.words
    raw, data = block.data, LOWER[block.data]
    owner = block.owners(starts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, owner
    lower = Block.__new__(Block)
    lower.data = data
    words = (lower.hashes(starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64)
    # Shape: which kinds of bytes a word has at its ends and how many signs and capitals.
    kinds = _KINDS[raw]
    signs, capitals = (np.add.reduceat((kinds == k) & ~WHITE[raw], starts, dtype=np.int64) for k in (3, 1))
    lengths = np.minimum(ends - starts, 31)
    last = raw[ends - 1].astype(np.uint64)
    last[kinds[ends - 1] != 3] = kinds[ends - 1][kinds[ends - 1] != 3]
    first = kinds[starts].astype(np.uint64)
    shape = first | last << np.uint64(2) | np.minimum(signs, 3).astype(np.uint64) << np.uint64(10) | np.minimum(capitals, 3).astype(np.uint64) << np.uint64(12) | (lengths // 6).astype(np.uint64) << np.uint64(14)
    again = np.zeros(len(words), np.uint64)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    shape |= again << np.uint64(20)
    return words, (mix(shape + np.uint64(1 << 40)) & np.uint64(BUCKETS - 1)).astype(np.int64), owner


def contexts(words: np.ndarray, owner: np.ndarray, index: np.ndarray, out: np.ndarray) -> None:
    """Add the neighbours' index vectors to each word's bucket."""
    if len(words) < 2:
        return
    near = np.zeros((len(words), DIMENSIONS), np.float32)
    for k in range(1, WINDOW + 1):
        same = (owner[k:] == owner[:-k])[:, None]
        near[k:] += index[words[:-k]] * same
        near[:-k] += index[words[k:]] * same
    order = np.argsort(words, kind="stable")
    kinds, first = np.unique(words[order], return_index=True)
    out[kinds] += np.add.reduceat(near[order], first, axis=0)


def unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(block: Block, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Feature rows of a block's texts; an empty text has zeros."""
    words, shapes, owner = tokens(block)
    counts = np.bincount(owner, minlength=block.count)
    out = np.zeros((block.count, 2 * DIMENSIONS + 1), np.float32)
    some = np.flatnonzero(counts)
    if len(some):
        first = (np.cumsum(counts) - counts)[some]
        for table, codes, at in ((vectors, words, 0), (index, shapes, DIMENSIONS)):
            for lo in range(0, len(some), 512):          # a few texts at a time
                hi = min(lo + 512, len(some))
                a, b = first[lo], first[hi] if hi < len(some) else len(codes)
                out[some[lo:hi], at: at + DIMENSIONS] = np.add.reduceat(table[codes[a:b]], first[lo:hi] - a, axis=0) / counts[some[lo:hi], None]
    out[:, -1] = np.log1p(counts)
    return out


@dataclass
class Model:
    """Word vectors, scaling, two layers, temperature."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.maximum((features - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def train_network(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, hidden: int = 32, rounds: int = 60) -> Model:
    """Adam on all but every fifth row, temperature on those; classes weigh the same."""
    mean, scale = x.mean(0) if len(x) else np.zeros(x.shape[1]), np.maximum(x.std(0), 1e-3) if len(x) else np.ones(x.shape[1])
    random = np.random.default_rng(11)
    w = [random.normal(0, 0.2, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, 0.2, hidden), np.zeros(1)]
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(vectors, mean, scale, w[0] * 0, w[1], w[2] * 0, float(np.log((share + 1e-3) / (1 - share + 1e-3))), 1.0)
    held = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.zeros(len(x), bool)
    z, t = ((x - mean) / scale)[~held], y[~held]
    weight = np.where(t == 1, 0.5 / max(t.mean(), 1e-3), 0.5 / max(1 - t.mean(), 1e-3))
    m, v, step = [0 * a for a in w], [0 * a for a in w], 0
    for _ in range(rounds):
        for rows in np.array_split(random.permutation(len(z)), max(1, len(z) // 128)):
            a = z[rows] @ w[0] + w[1]
            h = np.maximum(a, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30)))
            d = weight[rows] * (p - t[rows]) / len(rows)
            back = np.outer(d, w[2]) * (a > 0)
            grads = [z[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ d + 1e-4 * w[2], np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean.astype(np.float32), scale.astype(np.float32), w[0].astype(np.float32), w[1].astype(np.float32), w[2].astype(np.float32), float(w[3][0]), 1.0)
    if held.any():
        logits, t = model.logits(x[held]), y[held]
        loss = lambda c: float(np.mean(np.logaddexp(0, -(2 * t - 1) * logits / c)))
        model.temperature = min(np.geomspace(0.5, 8, 41), key=loss)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 12_000) -> Model:
    """Learn from at most ``most`` labelled documents, chosen by the hash of their id.

    Word vectors need no labels and are summed over all of ``docs``, each task with sums of
    fixed size; the network learns from one row of 97 numbers per sampled document on the
    driver. Without labels every score is 0.5.
    """
    sample = cut_lineage(labelled_sample(docs, labels, label, most), "quality-sample")
    index = index_vectors()

    def learn(batches):
        out, n = np.zeros((BUCKETS, DIMENSIONS), np.float32), 0
        for block in blocks(batches, "text", 1 << 20):
            words, shapes, owner = tokens(block)
            contexts(words, owner, index, out)
            n += len(words)
        yield emit(out / max(n, 1), float(n), kind=np.float32)

    # Single precision, as a word seen once in a large corpus is too small a share for half.
    total, n = averaged(docs.select("text").mapInArrow(learn, PARTS), kind=np.float32)
    vectors = unit(total.reshape(BUCKETS, DIMENSIONS) * np.float32(n)) if len(total) else np.zeros((BUCKETS, DIMENSIONS), np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches):
        for block in blocks(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([
                block.rows.column("doc_id"), block.rows.column("label"),
                pa.array([r.tobytes() for r in pooled(block, shared.value, index)], pa.binary())], names=["doc_id", "label", "x"])

    rows = sample.mapInArrow(features, "doc_id long, label int, x binary").toPandas().sort_values("doc_id")
    x = np.array([np.frombuffer(v, np.float32) for v in rows["x"]]).reshape(-1, 2 * DIMENSIONS + 1)
    # Row order by hash, so that every fifth row is no pattern of the ids.
    order = np.argsort(mix(rows["doc_id"].to_numpy().astype(np.uint64)))
    return train_network(x[order], rows["label"].to_numpy()[order].astype(np.float64), vectors)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1); a column of that name is replaced.

    NULL and empty texts have the score of no words. Repeated rows have equal scores. No
    shuffle; whole texts in bounded blocks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score")

    def run(batches):
        index = index_vectors()
        for block in blocks(batches, "text", 2 << 20):
            scores = shared.value.scores(pooled(block, shared.value.vectors, index))
            yield pa.RecordBatch.from_arrays([*block.rows.columns, pa.array(scores.astype(np.float64))], names=[*block.rows.schema.names, "score"])

    schema = StructType(docs.schema.fields[:]).add("score", "double")
    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.35, fold: tuple[int, int] | None = (4, 2)) -> DataFrame:
    """Documents whose score reaches ``threshold``, with their own columns.

    ``fold`` leaves out of training the ids whose crc32 has this remainder.
    """
    model = fit(training_rows(docs, fold), labels)
    named = [F.col(c).alias(f"_{k}") for k, c in enumerate(docs.columns)]
    inner = docs.select(*named, F.col("text"))
    kept = score(inner, model).where(F.col("score") >= threshold)
    return kept.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)])


def remainder(column: str, modulus: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def training_rows(docs: DataFrame, fold: tuple[int, int] | None) -> DataFrame:
    return docs if fold is None else docs.where(remainder("doc_id", fold[0]) != fold[1])
