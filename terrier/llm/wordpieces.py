"""Ids of a vocabulary with word ends, lower case, white space dropped.

Words between white space are independent in this vocabulary, so each block encodes its
distinct pieces once. Plain words (ASCII and Latin-1 letters) are split and merged in
batches; any other word goes through the installed tokenizers library.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from terrier.llm.blocks import LOWER, WHITE, Block
from terrier.llm.bpe import Merger, byte_symbols, spread

# Byte classes of the vocabulary's split pattern: letters, single digits, other signs.
SPACE, LETTER, DIGIT, SIGN = 0, 1, 2, 3
CLASSES = np.full(256, SIGN, np.uint8)
CLASSES[WHITE] = SPACE
CLASSES[97:123] = CLASSES[0x80:] = LETTER
CLASSES[48:58] = DIGIT
ODD = np.zeros(256, bool)                # bytes that send a word to the library
ODD[:0x20] = ~WHITE[:0x20]
ODD[[0x27, 0x7F]] = True                 # contractions; a control character


class WordVocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end, letters = model["vocab"], model["end_of_word_suffix"], byte_symbols()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + end] for c in letters], np.int32)
        self.merger = Merger([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs])
        self.library = Tokenizer.from_file(path)

    def pieces(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower-case bytes, places where a piece or white space begins, odd bytes.

        A word with an odd byte is one piece. Odd is what is not ASCII or a Latin-1 letter,
        an apostrophe, and the opening of a special token.
        """
        raw = block.data
        before = np.concatenate([[np.uint8(0)], raw[:-1]])
        data, latin = LOWER[raw], before == 0xC3
        data[latin & (raw >= 0x80) & (raw <= 0x9E)] += 0x20
        odd = ODD[raw] | ((raw == 0x7C) & (before == 0x3C))
        high = raw >= 0x80
        if high.any():
            odd |= high & ~((raw == 0xC3) | (latin & (raw != 0x97) & (raw != 0xB7)))
        kinds = CLASSES[data]
        change = np.ones(len(data), bool)
        change[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        at = np.flatnonzero(odd)
        if len(at):
            starts, ends = block.words
            inside = np.unique(np.searchsorted(starts, at, "right") - 1)
            for k in inside:
                change[starts[k] + 1: ends[k]] = False
                data[starts[k]: ends[k]] = raw[starts[k]: ends[k]]
                kinds[starts[k]: ends[k]] = SIGN
        return data, np.flatnonzero(change), odd

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, one after the other, and how many each has."""
        data, begins, odd = self.pieces(block)
        real = ~WHITE[data[begins]]
        edges = np.append(begins, len(data)).astype(np.int64)
        runs = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        taken = runs.dictionary_encode()
        codes = taken.indices.to_numpy()
        strange = np.unique(codes[np.searchsorted(begins, np.flatnonzero(odd), "right") - 1])
        ids, sizes = self.encode_pieces(taken.dictionary, strange)
        out, per = spread(ids, sizes, codes[real])
        bounds = np.concatenate([[0], np.cumsum(per)])
        return out, np.diff(bounds[np.searchsorted(begins[real], block.offsets)])

    def encode_pieces(self, pieces: pa.Array, strange: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces; those at the places in ``strange`` go through the library."""
        edges = np.frombuffer(pieces.buffers()[1], np.int64)[: len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], np.uint8)[: edges[-1]]
        symbols = self.inner[data]
        symbols[edges[1:] - 1] = self.final[data[edges[1:] - 1]]
        lengths = np.diff(edges)
        if len(strange):
            keep = np.ones(len(pieces), bool)
            keep[strange] = False
            symbols = symbols[np.repeat(keep, lengths)]
            lengths = lengths[keep]
        ids, sizes = self.merger(symbols, lengths)
        if not len(strange):
            return ids, sizes
        other = self.library.encode_batch([x.decode() for x in pieces.take(pa.array(strange)).to_pylist()], add_special_tokens=False)
        extra = np.array([i for x in other for i in x.ids], np.int32)
        sizes = np.concatenate([sizes, [len(x.ids) for x in other]]).astype(np.int64)
        order = np.argsort(np.concatenate([np.flatnonzero(keep), strange]), kind="stable")
        return spread(np.concatenate([ids, extra]), sizes, order)


@lru_cache(2)
def word_vocabulary(path: str) -> WordVocabulary:
    """One vocabulary per worker."""
    return WordVocabulary(path)
