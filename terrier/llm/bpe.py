"""Byte-pair encoding and decoding with forced boundaries.

Two bytes that stand together inside no token of the vocabulary can never end up in one
token, so a text may be cut between them: no merge crosses the cut, on either side the
merges are the same. ``fragments`` cuts whole blocks of texts at such places, equal
fragments are encoded once per block, and the ids are put together again.

The table of cuts leaves out places where the pre-tokenizer's pattern could see the cut:
after white space (its look-ahead reads on), before an apostrophe (contractions), and
inside a character.

``Merger`` applies merges to many byte strings at once: in every round each string
merges its pair of lowest rank, all its occurrences from left to right.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from terrier.llm.blocks import WHITE, Block, blocks

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NONE = np.int32(2**31 - 1)

# The pre-tokenizer's pattern of the byte-level vocabulary.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merger:
    """Merges of one vocabulary, applied to many strings of symbols at once."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]):
        """``pairs`` in order of rank, and the symbol that each makes."""
        keys = np.array([a << 20 | b for a, b in pairs], np.int64)
        self.bits = max(8, 2 + len(pairs).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        self.made = np.array(made, np.int32)
        ranks, at = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = self.keys[at] < 0
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            take = first[free[first]]
            self.keys[at[take]], self.ranks[at[take]] = keys[take], ranks[take]
            left = np.ones(len(keys), bool)
            left[take] = False
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.ranks[at], NONE)
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out

    def __call__(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and counts per string after all merges; every string has a symbol."""
        done_ids, done_owner, done_count = [], [], []
        owner = np.arange(len(counts))
        symbols, counts = symbols.astype(np.int32), counts.astype(np.int64)
        ranks = np.full(len(symbols), NONE, np.int32)
        if len(symbols):
            ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
            ranks[np.cumsum(counts) - 1] = NONE
        while len(counts):
            begins = np.cumsum(counts) - counts
            least = np.minimum.reduceat(ranks, begins)
            over = least == NONE
            if over.mean() > 0.2 or over.all():
                mask = np.repeat(over, counts)
                done_ids.append(symbols[mask])
                done_owner.append(owner[over])
                done_count.append(counts[over])
                symbols, ranks, owner, counts, least = symbols[~mask], ranks[~mask], owner[~over], counts[~over], least[~over]
                if not len(counts):
                    break
            hit = np.flatnonzero((ranks == np.repeat(least, counts)) & (ranks != NONE))
            # Of overlapping occurrences (aaa) every second one counts, from the left.
            run = np.concatenate([[True], np.diff(hit) != 1])
            place = np.arange(len(hit))
            hit = hit[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
            symbols[hit] = self.made[ranks[hit]]
            ends = np.zeros(len(symbols), bool)
            ends[np.cumsum(counts) - 1] = True
            last = ends[hit + 1]
            strings = np.repeat(np.arange(len(counts)), counts)[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            at = (np.cumsum(keep) - 1)[hit]
            symbols, ranks = symbols[keep], ranks[keep]
            counts = counts - np.bincount(strings, minlength=len(counts))
            ranks[at] = NONE
            go = at[~last]
            ranks[go] = self.rank(symbols[go], symbols[go + 1])
            begins = np.zeros(len(symbols), bool)
            begins[np.cumsum(counts) - counts] = True
            before = at[~begins[at]]
            ranks[before - 1] = self.rank(symbols[before - 1], symbols[before])
        owner, counts, ids = np.concatenate(done_owner or [owner]), np.concatenate(done_count or [counts]), np.concatenate(done_ids or [symbols])
        return spread(ids, counts, np.argsort(owner, kind="stable"))


def spread(values: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of values (``counts`` each) taken in the given order, and their counts."""
    begins = np.cumsum(counts) - counts
    taken = counts[order]
    at = np.repeat(begins[order] - (np.cumsum(taken) - taken), taken) + np.arange(taken.sum())
    return values[at], taken


class Vocabulary:
    """A byte-level vocabulary: merges, cuts between bytes, bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        vocab, merges = parts["model"]["vocab"], parts["model"]["merges"]
        letters = byte_symbols()
        back = {c: b for b, c in enumerate(letters)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.first = np.array([vocab[c] for c in letters], np.int32)
        self.merger = Merger([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs])
        names = [b""] * (1 + max([*vocab.values(), *(x["id"] for x in parts["added_tokens"])]))
        for name, i in vocab.items():
            names[i] = bytes(back[c] for c in name)
        self.special = {x["content"]: x["id"] for x in parts["added_tokens"]}
        within = np.zeros((256, 256), bool)
        for name in names:
            b = np.frombuffer(name, np.uint8)
            within[b[:-1], b[1:]] = True
        for name, i in self.special.items():
            names[i] = name.encode()
        self.bytes = np.frombuffer(b"".join(names), np.uint8)
        self.lengths = np.array([len(x) for x in names], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        cut = ~within
        cut[WHITE] = False                    # the look-ahead after white space
        cut[0x1C:0x20] = False
        cut[:, 0x27] = False                  # contractions
        cut[:, 0x80:0xC0] = False             # inside a character
        self.cut = cut.reshape(-1)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def fragments(self, data: np.ndarray) -> np.ndarray:
        """Places where a new fragment certainly begins."""
        pair = data[:-1].astype(np.int32) << 8 | data[1:]
        at = np.flatnonzero(self.cut[pair]) + 1
        # White space of two or three bytes: C2 85, C2 A0, E1 9A 80, E2 80 .., E2 81 9F, E3 80 80.
        before = data[np.maximum(at - 2, 0)]
        wide = (data[at - 1] >= 0x80) & np.isin(before, np.array([0xC2, 0x9A, 0x80, 0x81], np.uint8))
        return at[~wide]

    def encode_fragments(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each fragment, one after the other, and how many each has."""
        pieces, owners = [], np.empty(len(parts), np.int64)
        for k, part in enumerate(parts):
            if (part[1:] if part[:1] == b" " else part).isalpha():
                pieces.append(part)
                owners[k] = 1
            else:
                found = [x.encode() for x in PIECES.findall(part.decode())]
                pieces += found
                owners[k] = len(found)
        if not pieces:
            return np.zeros(0, np.int32), owners
        symbols = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        ids, counts = self.merger(symbols, np.fromiter(map(len, pieces), np.int64, len(pieces)))
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(owners)
        return ids, bounds[ends] - bounds[ends - owners]

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, one after the other, and how many each has."""
        data, stops = block.data, block.offsets[1:] - 1
        # The line break after each text is a fragment of its own, left out again.
        begins = np.unique(np.concatenate([self.fragments(data), block.offsets[:-1], stops]))
        edges = np.append(begins, len(data)).astype(np.int64)
        runs = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        real = np.ones(len(begins), bool)
        real[np.searchsorted(begins, stops)] = False
        taken = runs.dictionary_encode()
        ids, counts = self.encode_fragments(taken.dictionary.to_pylist())
        codes = taken.indices.to_numpy()[real]
        out, sizes = spread(ids, counts, codes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        per = ends[np.searchsorted(begins[real], block.offsets)]
        return self._marked(block, out, np.diff(per))

    def _marked(self, block: Block, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Special tokens written out in a text stand for their ids; such texts are encoded part by part."""
        whole = block.data.tobytes()
        if not any(name.encode() in whole for name in self.special):
            return ids, counts
        ends, rows, sizes = np.cumsum(counts), [], counts.copy()
        for i in range(block.count):
            text = block.text(i).decode()
            row = ids[ends[i] - counts[i]: ends[i]]
            if any(name in text for name in self.special):
                row = np.concatenate([np.zeros(0, np.int32), *(
                    np.array([self.special[x]], np.int32) if x in self.special else self.encode_text(x)
                    for x in self.marks.split(text) if x)])
                sizes[i] = len(row)
            rows.append(row)
        return np.concatenate(rows), sizes

    def encode_text(self, text: str) -> np.ndarray:
        return self.encode_fragments([text.encode()])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        at = np.repeat(self.begins[ids] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return self.bytes[at].tobytes()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker."""
    return Vocabulary(path)


def encode_decode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """Number of ids, digest of the ids, digest of the decoded text, per document.

    NULL texts are empty: no ids. ``path`` is read by every worker, so it is a path that
    all machines have. No shuffle; rows stay rows, also repeated ones; extra columns are
    not read. Texts are encoded whole, however long.
    """
    def run(batches):
        words = vocabulary(path)
        for block in blocks(batches, column):
            ids, counts = words.encode(block)
            ends = np.cumsum(counts)
            rows = [ids[e - n: e] for e, n in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([
                block.rows.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                pa.array([hashlib.sha256(words.decode(r).decode("utf-8", "replace").encode()).hexdigest() for r in rows], pa.string()),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", column).mapInArrow(run, SCHEMA)
