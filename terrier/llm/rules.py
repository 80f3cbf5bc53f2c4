"""Quality rules: hashed n-gram logistic regression beside fixed counting rules.

Features are the shares of word n-grams (one and two words) and character trigrams that
fall into hash buckets, so a score is the mean weight of a text's n-grams and does not
depend on its length. The weights are learnt from labelled rows and calibrated on rows
that training left out; scoring compares probabilities with a fixed threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrier.llm.blocks import LOWER, Block, blocks, grams, mix, whole_windows
from terrier.llm.training import labelled_sample
from terrier.session import cut_lineage

BUCKETS = 1 << 12
GROUPS = ("words", "pairs", "trigrams")
#: Fixed thresholds of the counting rules and of the calibrated probability.
LEAST_WORDS, MOST_REPEATED_PERCENT, LEAST_PROBABILITY = 10, 20, 0.3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts(block: Block) -> dict[str, np.ndarray]:
    """The counting columns of a block's texts."""
    starts, ends = block.words
    n = block.counts(starts)
    inside = np.zeros(len(block.data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    chars = (np.cumsum(inside[:-1]) > 0) & ((block.data & 0xC0) != 0x80)
    return {"n_words": n, "word_chars": block.per_text(chars), "n_symbols": block.per_text(SYMBOLS[block.data]),
            "n_dup_lines": repeated_lines(block), "n_repeat_words": repeated_words(block, n)}


def repeated_lines(block: Block) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    stops = np.flatnonzero(block.data == 10)
    starts = np.concatenate([[0], stops[:-1] + 1])
    words = np.diff(np.searchsorted(block.words[0], np.append(starts, len(block.data)))) > 0
    starts, stops = starts[words], stops[words]
    if not len(starts):
        return np.zeros(block.count, np.int64)
    owner = np.searchsorted(block.offsets, starts, "right") - 1
    _, codes = block.codes(starts, stops)
    keys = owner.astype(np.int64) << 32 | codes
    _, first = np.unique(keys, return_index=True)
    return np.bincount(owner, minlength=block.count) - np.bincount(owner[first], minlength=block.count)


def repeated_words(block: Block, n: np.ndarray, size: int = 5) -> np.ndarray:
    """Words inside windows of five words that their text has twice or more."""
    starts, ends = block.words
    if len(starts) < size:
        return np.zeros(block.count, np.int64)
    owner = block.owners(starts)
    hashes = block.hashes(starts, ends)
    keys = grams(hashes, size) ^ mix(owner[: len(hashes) - size + 1].astype(np.uint64) + np.uint64(1))
    at = np.flatnonzero(whole_windows(n, size, len(starts)))
    order = at[np.argsort(keys[at], kind="stable")]
    same = keys[order[1:]] == keys[order[:-1]]
    again = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    covered = np.zeros(len(starts) + 1, np.int32)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + size, -1)
    return np.bincount(owner, weights=np.cumsum(covered[:-1]) > 0, minlength=block.count).astype(np.int64)


def bucketed(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and owners of each group of n-grams."""
    lower = Block.__new__(Block)
    lower.data = LOWER[block.data]
    starts, ends = block.words
    owner = block.owners(starts)
    words = lower.hashes(starts, ends)
    mask = np.uint64(BUCKETS - 1)
    pairs = np.flatnonzero(whole_windows(block.counts(starts), 2, len(starts)))
    data = lower.data.astype(np.uint32)
    three = (data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)) if len(data) > 2 else np.zeros(0, np.uint32)
    three = (three * np.uint32(0x9E3779B1)) >> np.uint32(20)
    return [((words & mask).astype(np.int32), owner),
            ((grams(words, 2)[pairs] & mask).astype(np.int32), owner[pairs]),
            (three.astype(np.int32), np.repeat(np.arange(block.count), np.diff(block.offsets))[: len(three)])]


def features(block: Block) -> np.ndarray:
    """Shares per bucket of each group, side by side; only for bounded samples."""
    out = np.zeros((block.count, len(GROUPS) * BUCKETS), np.float32)
    for k, (codes, owner) in enumerate(bucketed(block)):
        total = np.maximum(np.bincount(owner, minlength=block.count), 1)
        np.add.at(out, (owner, k * BUCKETS + codes), (1 / total)[owner])
    return out


@dataclass
class Rules:
    """Weights per bucket, intercept and calibration (slope and shift of the logit)."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0

    def probabilities(self, block: Block) -> np.ndarray:
        logit = np.full(block.count, self.intercept)
        for k, (codes, owner) in enumerate(bucketed(block)):
            total = np.maximum(np.bincount(owner, minlength=block.count), 1)
            logit += np.bincount(owner, weights=self.weights[k * BUCKETS: (k + 1) * BUCKETS][codes], minlength=block.count) / total
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, ridge: float = 1e-4) -> Rules:
    """Gradient steps on all but every fifth row, calibration on those; classes weigh the same."""
    width = x.shape[1]
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 1.0
        return Rules(np.zeros(width), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    held = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.zeros(len(x), bool)
    z, t = x[~held], y[~held]
    scale = 1 / np.sqrt(np.maximum((z * z).mean(0), 1e-8))
    weight = np.where(t == 1, 0.5 / max(t.mean(), 1e-3), 0.5 / max(1 - t.mean(), 1e-3)) / len(t)
    w, b, m, v = np.zeros(width), 0.0, np.zeros(width), np.zeros(width)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(z @ (w * scale).astype(np.float32) + b, -30, 30)))
        d = (weight * (p - t)).astype(np.float32)
        g = (d @ z) * scale + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        b -= 0.5 * float(d.sum())
    rules = Rules(w * scale, b)
    if held.any():
        logit, t = x[held] @ rules.weights.astype(np.float32) + b, y[held]
        loss = lambda c: float(np.mean(np.logaddexp(0, -(2 * t - 1) * (c[0] * logit + c[1]))))
        rules.slope, rules.shift = min(((a, s) for a in np.geomspace(0.1, 4, 20) for s in np.linspace(-3, 3, 25)), key=loss)
    return rules


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 2_000) -> Rules:
    """Learn from at most ``most`` labelled documents, chosen by the hash of their id.

    A sampled document is a row of at most 12,288 shares; 2,000 of them are under 100 MB.
    Without labels nothing is rejected by probability.
    """
    sample = cut_lineage(labelled_sample(docs, labels, label, most), "rules-sample")

    def run(batches):
        for block in blocks(batches, "text", 1 << 20):
            for lo in range(0, block.count, 64):
                part = Block(block.rows.slice(lo, 64), "text")
                rows = features(part)
                cells = [np.flatnonzero(r) for r in rows]
                yield pa.RecordBatch.from_arrays([
                    part.rows.column("doc_id"), part.rows.column("label"),
                    pa.array([c.astype(np.uint16).tobytes() for c in cells], pa.binary()),
                    pa.array([r[c].tobytes() for r, c in zip(rows, cells)], pa.binary())], names=["doc_id", "label", "at", "x"])

    table = sample.mapInArrow(run, "doc_id long, label int, at binary, x binary").toPandas()
    order = np.argsort(mix(table["doc_id"].to_numpy().astype(np.uint64)))
    x = np.zeros((len(table), len(GROUPS) * BUCKETS), np.float32)
    for k, i in enumerate(order):
        x[k, np.frombuffer(table["at"][i], np.uint16)] = np.frombuffer(table["x"][i], np.float32)
    return train(x, table["label"].to_numpy()[order].astype(np.float64))


def judge(docs: DataFrame, rules: Rules) -> DataFrame:
    """Counts, ``base_failed``, probability and ``kept`` for every row of ``docs``.

    NULL texts have no words and fail. Lines and windows are compared within a text only;
    repeated rows are judged alike. Result columns replace columns of the same name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rules)
    made = [*COLUMNS, "base_failed", "probability", "kept"]
    docs = docs.drop(*made)

    def run(batches):
        for block in blocks(batches, "text", 2 << 20):
            found = counts(block)
            failed = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED_PERCENT * found["n_words"])
            likely = shared.value.probabilities(block)
            yield pa.RecordBatch.from_arrays([
                *block.rows.columns, *(pa.array(found[c], pa.int64()) for c in COLUMNS), pa.array(failed),
                pa.array(likely), pa.array(~failed & (likely >= LEAST_PROBABILITY))], names=[*block.rows.schema.names, *made])

    schema = StructType(docs.schema.fields[:])
    for c in COLUMNS:
        schema = schema.add(c, "long")
    return docs.mapInArrow(run, schema.add("base_failed", "boolean").add("probability", "double").add("kept", "boolean"))


def keep_sound(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that neither a counting rule nor the probability rejects, with their own columns."""
    rules = fit(docs, labels)
    named = [F.col(c).alias(f"_{k}") for k, c in enumerate(docs.columns)]
    kept = judge(docs.select(*named, F.col("text")), rules).where("kept")
    return kept.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)])
