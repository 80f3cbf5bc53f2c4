"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The class of a word follows from
its ending. The first factor is a maximum-entropy model over hashed features: the word
before, the word before that (a skip), and both together. The second factor is the
closed-form maximum-entropy model of a word inside its class, from counts over all
training documents, with one unknown word per class, so probabilities sum to 1.

1. Texts are read once and written as coded blocks: a block has its distinct tokens,
   their counts in training texts, and the code of every token.
2. Counts are summed per token over all blocks (one shuffle of distinct tokens per
   block, not of tokens) and go back to the blocks that asked; the coded texts stay
   where they are written and meet their counts only when they are scored.
3. Tasks take gradient steps on the blocks they read; the driver averages what they
   changed (a table of fixed size) and sends it out for the next round.
4. Blocks are scored in sparse numpy batches.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm.blocks import Block, blocks, mix
from terrier.llm.training import PARTS, averaged, emit
from terrier.session import cut_lineage

CLASSES, BUCKETS, BATCH = 32, 1 << 13, 1 << 14
_FEATURES = 3 * BUCKETS + 1                      # the last row is the bias
_BEGIN = np.uint32(0x51ED270B)
CODED = "block long, ids binary, held binary, sizes binary, codes binary, kinds binary, hashes binary, tokens array<binary>, counts array<long>"
FILLED = "block long, known binary, totals binary"


def _packed(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def coded(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """Blocks of coded texts. Token 0 of a block is the end of a text (empty bytes)."""
    def run(batches):
        number = 0
        for block in blocks(batches, "text", 12 << 20, lower=True):
            starts, ends = block.words
            words, codes = block.codes(starts, ends)
            per = block.counts(starts)
            sequence = np.insert(codes + 1, np.cumsum(per), 0).astype(np.int32)
            ids = block.rows.column("doc_id").to_pylist()
            held = np.array([zlib.crc32(str(i).encode()) % modulus == remainder if i is not None else False for i in ids])
            counts = np.bincount(sequence[np.repeat(~held, per + 1)], minlength=len(words) + 1)
            hashes = (block_hashes(words) >> np.uint64(32)).astype(np.uint32)
            kinds = word_classes(words)
            tokens = pa.concat_arrays([pa.array([b""], pa.large_binary()), words]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId() << 32 | number], pa.int64()),
                pa.array([np.array([-1 if i is None else i for i in ids], np.int64).tobytes() + bytes(i is None for i in ids)], pa.binary()),
                pa.array([held.astype(np.uint8).tobytes()], pa.binary()), pa.array([(per + 1).astype(np.int64).tobytes()], pa.binary()),
                pa.array([_packed(sequence)], pa.binary()),
                pa.array([_packed(np.append(np.uint8(0), kinds))], pa.binary()),
                pa.array([np.append(np.uint32(1), hashes).astype(np.uint32).tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), tokens),
                pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts, pa.int64())),
            ], names=[f.split(" ")[0] for f in CODED.split(", ")])
            number += 1

    return docs.select("doc_id", "text").mapInArrow(run, CODED)


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    edges = np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2] or b"", np.uint8), edges


def block_hashes(words: pa.Array) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    data, edges = _bytes_of(words)
    runs = Block.__new__(Block)
    runs.data = data
    return runs.hashes(edges[:-1], edges[1:])


def word_classes(words: pa.Array) -> np.ndarray:
    """Class of each word by its last two bytes; class 0 is the end of a text."""
    if not len(words):
        return np.zeros(0, np.uint8)
    data, edges = _bytes_of(words)
    last = data[edges[1:] - 1].astype(np.uint64)
    before = np.where(np.diff(edges) > 1, data[np.maximum(edges[1:] - 2, 0)], 0).astype(np.uint64)
    return (1 + (mix(last << np.uint64(8) | before) % np.uint64(CLASSES - 1))).astype(np.uint8)


def filled(parts: DataFrame) -> DataFrame:
    """Per block the training count of each of its tokens, and totals per class.

    ``totals`` of a block cover the tokens that no earlier block has, so their sum over
    all blocks counts every token once.
    """
    asked = parts.select("block", F.posexplode(F.arrays_zip("tokens", "counts")).alias("code", "x"))
    # Code and count travel in one number, and so do the count found and the mark of its first block.
    half = F.lit(1 << 32)
    asked = asked.select("block", F.col("x")["tokens"].alias("token"), (F.col("code").cast("long") * half + F.col("x")["counts"]).alias("told"))
    same = Window.partitionBy("token")
    told = asked.select("block", F.shiftright("told", 32).cast("int").alias("code"),
                        (F.sum(F.col("told").bitwiseAND(half - 1)).over(same) * 2 + (F.col("block") == F.min("block").over(same)).cast("long")).alias("known"))

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({f.split(" ")[0]: pa.array([], pa.int64() if f.endswith("long") else pa.binary()) for f in FILLED.split(", ")})
        kinds = _unpacked(left["kinds"][0].as_py(), np.uint8)
        known, first = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), bool)
        at = right["code"].to_numpy()
        known[at], first[at] = right["known"].to_numpy() >> 1, (right["known"].to_numpy() & 1) > 0
        use = first & (known > 0)
        totals = np.stack([np.bincount(kinds[use], weights=known[use], minlength=CLASSES), np.bincount(kinds[use], minlength=CLASSES)])
        return left.select(["block"]).append_column("known", pa.array([_packed(known)], pa.binary())).append_column("totals", pa.array([totals.astype(np.float64).tobytes()], pa.binary()))

    return parts.select("block", "kinds").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(join, FILLED)


def contexts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, class and feature rows (three per token) of a block."""
    codes, sizes = _unpacked(row["codes"], np.int32), np.frombuffer(row["sizes"], np.int64)
    words = np.frombuffer(row["hashes"], np.uint32)[codes].astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    one = np.concatenate([[np.uint64(_BEGIN)], words[:-1]]) if len(words) else words
    one[starts] = _BEGIN
    two = np.concatenate([[np.uint64(_BEGIN)], one[:-1]]) if len(words) else words
    two[starts] = _BEGIN
    mask, bits = np.uint64(BUCKETS - 1), np.uint64(40)
    rows = np.stack([(mix(x + np.uint64(k << 33)) >> bits & mask).astype(np.int32) + np.int32(k * BUCKETS)
                     for k, x in enumerate((one, two, one * np.uint64(0x9E3779B1) ^ two << np.uint64(16)))], axis=1)
    return codes, _unpacked(row["kinds"], np.uint8)[codes].astype(np.int64), rows


def softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = weights[rows[:, 0]] + weights[rows[:, 1]] + weights[rows[:, 2]] + weights[-1]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def train_on(row: dict, weights: np.ndarray, seen: np.ndarray, rate: float) -> int:
    """Gradient steps over the training texts of a block; returns their tokens."""
    _, kinds, rows = contexts(row)
    use = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, np.frombuffer(row["sizes"], np.int64))
    kinds, rows = kinds[use], rows[use]
    for lo in range(0, len(kinds), BATCH):
        y, f = kinds[lo: lo + BATCH], rows[lo: lo + BATCH]
        slope = softmax(weights, f)
        slope[np.arange(len(y)), y] -= 1
        for k in range(3):
            order = np.argsort(f[:, k], kind="stable")
            names, first = np.unique(f[order, k], return_index=True)
            n = np.diff(np.append(first, len(y))).astype(np.float32)
            seen[names] += n
            weights[names] -= (rate / np.sqrt(seen[names] * n))[:, None] * np.add.reduceat(slope[order], first, axis=0)
        seen[-1] += len(y)
        weights[-1] -= rate / np.sqrt(seen[-1] * len(y)) * slope.sum(0)
    return len(kinds)


def train(parts: DataFrame, rounds: int = 2, rate: float = 0.5) -> np.ndarray:
    """Weights after as many rounds; each round reads its own share of the blocks.

    Every task starts from the shared weights and returns what its steps changed, weighted
    by its tokens.
    """
    spark = parts.sparkSession
    weights = np.zeros((_FEATURES, CLASSES), np.float32)
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches):
            mine, seen, tokens = shared.value.copy(), np.full(_FEATURES, 1e-3, np.float32), 0
            for batch in batches:
                for k in range(len(batch)):
                    tokens += train_on(batch.slice(k, 1).to_pylist()[0], mine, seen, rate)
            yield emit(mine - shared.value, float(tokens))

        share = parts.where(F.pmod(F.xxhash64("block"), F.lit(rounds)) == r)
        change, tokens = averaged(share.select("held", "sizes", "codes", "kinds", "hashes").mapInArrow(run, PARTS))
        if tokens:
            weights = weights + change.reshape(weights.shape)
        shared.unpersist()
    return weights


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, modulus: int = 5, remainder: int = 1) -> DataFrame:
    """Base and model log10 probability of every whole text.

    Texts whose crc32 of doc_id has the remainder are held out of all counts and steps.
    NULL and empty texts are the end token alone. Rows without an id are training rows.
    Repeated rows count as often as they stand there. Extra columns are not read. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    parts = cut_lineage(coded(docs, modulus, remainder), "lm-coded")
    counted = cut_lineage(filled(parts), "lm-counts")

    def sums(batches):
        total = np.zeros((2, CLASSES))
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.float64).reshape(2, CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(total[0]), pa.array(total[1])], names=["kind", "n", "v"])

    rows = counted.select("totals").mapInArrow(sums, "kind int, n double, v double").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rows:
        tokens[r["kind"]], kinds[r["kind"]] = r["n"], r["v"]
    shared = spark.sparkContext.broadcast((train(parts), tokens, kinds))

    def run(batches):
        weights, per_class, kinds_in = shared.value
        n, v = per_class.sum(), kinds_in.sum()
        inside = np.log10(per_class + 0.5 * (kinds_in + 1))
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                codes, kind, feats = contexts(row)
                known = _unpacked(row["known"], np.int64)
                word = np.log10(known + 0.5)
                sizes = np.frombuffer(row["sizes"], np.int64)
                starts = np.cumsum(sizes) - sizes
                out = np.empty(len(codes))
                for lo in range(0, len(codes), BATCH):
                    p = softmax(weights, feats[lo: lo + BATCH])
                    out[lo: lo + BATCH] = np.log10(np.maximum(p[np.arange(len(p)), kind[lo: lo + BATCH]], 1e-30))
                out += word[codes] - inside[kind]
                ids = row["ids"]
                numbers = np.frombuffer(ids[: 8 * len(sizes)], np.int64)
                none = np.frombuffer(ids[8 * len(sizes):], np.uint8) != 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(numbers, pa.int64(), mask=none), pa.array(np.frombuffer(row["held"], np.uint8) != 0), pa.array(sizes),
                    pa.array(np.add.reduceat((known > 0)[codes].astype(np.int64), starts)), pa.array(np.full(len(sizes), int(n), np.int64)),
                    pa.array(np.add.reduceat(word[codes], starts) - sizes * np.log10(n + 0.5 * (v + 1))),
                    pa.array(np.add.reduceat(out, starts))], names=[f.split(" ")[0] for f in SCHEMA.split(", ")])

    texts = parts.select("block", "ids", "held", "sizes", "codes", "kinds", "hashes")
    return texts.join(counted.select("block", "known"), "block").mapInArrow(run, SCHEMA)
