"""License scans: ordered signature rules behind a keyword prefilter.

A rule is a pattern over lower-case text with a label and a priority. The rules are made
from a table of licenses and a few sentence forms, some hundreds in all. A rule has the
single words without which it never matches, so that line breaks and comment signs
between them do not matter. A block of texts is searched once for the longest word of
each rule; a text is matched only against the rules of which it has all words. Of overlapping detections the one of higher priority stays, then the
longer, then the earlier; a detection inside another one's interval is dropped, unless
it comes from a base phrase.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from terrier.llm.blocks import Block, blocks

# Phrases and labels that always count, by consecutive words.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}

# Licenses by label: names in running text, SPDX stems, versions.
LICENSES = {
    "mit": (["mit", "x11", "expat"], ["mit", "mit-0"], []),
    "apache": (["apache", "apache software"], ["apache"], ["1.0", "1.1", "2.0"]),
    "gpl": (["gnu general public", "gnu gpl", "gpl"], ["gpl"], ["1", "2", "3", "2.0", "3.0"]),
    "lgpl": (["gnu lesser general public", "gnu library general public", "lgpl"], ["lgpl"], ["2", "2.1", "3", "3.0"]),
    "agpl": (["gnu affero general public", "affero general public", "agpl"], ["agpl"], ["1.0", "3", "3.0"]),
    "fdl": (["gnu free documentation", "gfdl"], ["gfdl"], ["1.1", "1.2", "1.3"]),
    "bsd": (["bsd", "new bsd", "simplified bsd", "modified bsd"], ["bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "0bsd"], []),
    "mpl": (["mozilla public", "mpl"], ["mpl"], ["1.0", "1.1", "2.0"]),
    "epl": (["eclipse public", "epl"], ["epl"], ["1.0", "2.0"]),
    "cddl": (["common development and distribution", "cddl"], ["cddl"], ["1.0", "1.1"]),
    "cpl": (["common public"], ["cpl"], ["1.0"]),
    "isc": (["isc", "internet systems consortium"], ["isc"], []),
    "artistic": (["artistic", "perl artistic"], ["artistic"], ["1.0", "2.0"]),
    "zlib": (["zlib", "zlib/libpng"], ["zlib"], []),
    "boost": (["boost software", "boost"], ["bsl"], ["1.0"]),
    "unlicense": (["unlicense"], ["unlicense"], []),
    "wtfpl": (["do what the fuck you want to public", "wtfpl"], ["wtfpl"], ["2"]),
    "eupl": (["european union public", "eupl"], ["eupl"], ["1.1", "1.2"]),
    "osl": (["open software", "osl"], ["osl"], ["2.0", "2.1", "3.0"]),
    "afl": (["academic free", "afl"], ["afl"], ["2.1", "3.0"]),
    "ms-pl": (["microsoft public", "ms-pl"], ["ms-pl"], []),
    "ms-rl": (["microsoft reciprocal", "ms-rl"], ["ms-rl"], []),
    "python": (["python software foundation", "psf"], ["psf", "python"], ["2.0"]),
    "php": (["php"], ["php"], ["3.0", "3.01"]),
    "ruby": (["ruby"], ["ruby"], []),
    "openssl": (["openssl"], ["openssl"], []),
    "postgresql": (["postgresql"], ["postgresql"], []),
    "ofl": (["sil open font", "open font", "ofl"], ["ofl"], ["1.0", "1.1"]),
    "cc0": (["creative commons zero", "cc0"], ["cc0"], ["1.0"]),
    "cc-by": (["creative commons attribution", "cc by", "cc-by"], ["cc-by"], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    "cc-by-sa": (["creative commons attribution-sharealike", "creative commons attribution share alike", "cc by-sa"], ["cc-by-sa"], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    "cc-by-nc": (["creative commons attribution-noncommercial", "cc by-nc"], ["cc-by-nc"], ["2.0", "3.0", "4.0"]),
    "cc-by-nd": (["creative commons attribution-noderivatives", "cc by-nd"], ["cc-by-nd"], ["2.0", "3.0", "4.0"]),
    "odbl": (["open database", "odbl"], ["odbl"], ["1.0"]),
    "public-domain": (["public domain"], [], []),
    "proprietary": (["proprietary", "commercial"], [], []),
    "sspl": (["server side public", "sspl"], ["sspl"], ["1.0"]),
    "busl": (["business source"], ["busl"], ["1.1"]),
    "upl": (["universal permissive", "upl"], ["upl"], ["1.0"]),
    "vim": (["vim"], ["vim"], []),
    "curl": (["curl"], ["curl"], []),
    "w3c": (["w3c software"], ["w3c"], []),
    "ncsa": (["university of illinois/ncsa open source", "ncsa"], ["ncsa"], []),
    "qpl": (["q public", "qpl"], ["qpl"], ["1.0"]),
    "json": (["json"], ["json"], []),
    "beerware": (["beer-ware", "beerware"], ["beerware"], ["42"]),
}
# Sentences that only one license's text has.
SENTENCES = {
    "mit": ["permission is hereby granted, free of charge, to any person obtaining a copy"],
    "isc": ["permission to use, copy, modify, and/or distribute this software for any purpose"],
    "bsd": ["redistribution and use in source and binary forms, with or without"],
    "gpl": ["this program is free software; you can redistribute it and/or modify", "this program is free software: you can redistribute it and/or modify"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "boost": ["permission is hereby granted, free of charge, to any person or organization obtaining"],
    "zlib": ["this software is provided 'as-is', without any express or implied warranty"],
    "cc0": ["has waived all copyright and related or neighboring rights"],
    "proprietary": ["all rights reserved"],
}
SPLIT = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]"
WORD = rf"[^\x00-\x2f\x3a-\x60\x7b-\x7f]"
OUTSIDE = np.zeros(256, bool)
OUTSIDE[:0x30] = OUTSIDE[0x3A:0x61] = OUTSIDE[0x7B:0x80] = True


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    needs: tuple[str, ...]
    priority: int
    weight: float
    base: bool = False

    @property
    def keyword(self) -> str:
        return max(self.needs, key=len)


def _spaced(words: str) -> str:
    return r"[\s*#/]+".join(map(re.escape, words.split()))


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """All rules in order of priority: sentences, identifiers, versions, grants, names."""
    made = []
    edge, stop = rf"(?<!{WORD})", rf"(?!{WORD})"

    def add(label, pattern, needs, priority, weight, base=False):
        made.append(Rule(label, re.compile(pattern), tuple(needs.split()), priority, weight, base))

    for label, words in PHRASES.items():
        add(label, edge + (SPLIT + "+").join(words) + stop, " ".join(words), 50, 0.7, True)
    for label, sentences in SENTENCES.items():
        for text in sentences:
            weight = 0.3 if label == "proprietary" else 1.0
            add(label, _spaced(text), text, 100, weight)
    for label, (names, stems, versions) in LICENSES.items():
        for stem in stems:
            add(label, rf"spdx-license-identifier:\s*{re.escape(stem)}(?![a-z])(-?[\d.]+)?(-only|-or-later|\+)?", "spdx", 90, 1.0)
            for version in versions:
                add(label, rf"{edge}{re.escape(stem)}-{re.escape(version)}(-only|-or-later|\+)?(?![\d.]*\d)", f"{stem}-{version}", 80, 0.9)
        for name in names:
            said, suffix = edge + _spaced(name), r"(?:[\s-]+(?:software[\s-]+)?licen[sc]e)"
            for version in versions:
                add(label, rf"{said}{suffix}?,?[\s(]+(?:version|ver\.?|v\.?)\s*{re.escape(version)}(?![\d.]*\d)", name, 70, 0.9)
            add(label, rf"(?:licensed|released|distributed|available|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?{_spaced(name)}{stop}", f"{name} under", 60, 0.9)
            if label not in ("proprietary",):
                add(label, rf"{said}{suffix}{stop}", f"{name} licen", 40, 0.7)
    for label, place in {"apache": "apache.org/licenses", "gpl": "gnu.org/licenses", "mit": "opensource.org/licenses/mit",
                         "mpl": "mozilla.org/mpl", "cc-by": "creativecommons.org/licenses/by", "cc0": "creativecommons.org/publicdomain/zero"}.items():
        add(label, re.escape(place), place, 85, 0.9)
    return tuple(sorted(made, key=lambda r: -r.priority))


@lru_cache(1)
def prefilter():
    """Keywords to rule places, and an automaton over the keywords."""
    by: dict[str, list[int]] = {}
    for k, rule in enumerate(rules()):
        by.setdefault(rule.keyword, []).append(k)
    found = ahocorasick.Automaton()
    for word in by:
        found.add_word(word, word)
    found.make_automaton()
    return by, found


def settle(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections that stay: base phrases, and others that overlap nothing stronger."""
    kept: list[tuple[int, int, Rule]] = []
    taken = bytearray(max((end for _, end, _ in found), default=0))
    for start, end, rule in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label)):
        if rule.base or taken.find(b"x", start, end) < 0:
            kept.append((start, end, rule))
            taken[start:end] = b"x" * (end - start)
    return kept


def detect(text: str) -> list[tuple[int, int, Rule]]:
    """Detections in a lower-case text."""
    by, automaton = prefilter()
    words = {word for _, word in automaton.iter(text)}
    listed = rules()
    places = sorted(k for w in words for k in by[w] if all(need in text for need in listed[k].needs))
    return settle([(m.start(), m.end(), listed[k]) for k in places for m in listed[k].pattern.finditer(text)])


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame) -> DataFrame:
    """Words, base phrases, labels and a score for every document.

    NULL and empty texts have no words and no labels. ``score`` is 1 - product(1 - weight)
    over the labels, 0 without one. Whole texts in bounded blocks, no shuffle; repeated
    rows give repeated results; extra columns are not read.
    """
    def run(batches):
        by, automaton = prefilter()
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for block in blocks(batches, "text", 2 << 20, lower=True):
            starts, _ = block.split(OUTSIDE)
            counts = block.counts(starts)
            rows = [(0, None, None, "", "", 0.0)] * block.count
            for i in suspects(block, automaton):
                rows[i] = judge(block, i, starts)
            yield pa.RecordBatch.from_arrays([
                block.rows.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
                *(pa.array([r[k] for r in rows], pa.string()) for k in (3, 4)),
                pa.array([r[5] for r in rows], pa.float64())], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def suspects(block: Block, automaton) -> list[int]:
    """Texts of a block that hold a keyword; keywords are ASCII, so bytes are read as Latin-1."""
    ends = [end for end, _ in automaton.iter(block.data.tobytes().decode("latin-1"))]
    return np.unique(np.searchsorted(block.offsets, ends, "right") - 1).tolist() if ends else []


def judge(block: Block, i: int, starts: np.ndarray) -> tuple:
    found = detect(block.text(i).decode())
    if not found:
        return 0, None, None, "", "", 0.0
    base = [s for s, _, r in found if r.base]
    first = last = None
    if base:
        text = block.text(i).decode()
        at = np.array([len(text[:s].encode()) for s in (min(base), max(base))]) + block.offsets[i]
        first, last = (np.searchsorted(starts, at) - np.searchsorted(starts, block.offsets[i])).tolist()
    weights: dict[str, float] = {}
    for _, _, rule in found:
        weights[rule.label] = max(weights.get(rule.label, 0.0), rule.weight)
    score = 1 - float(np.prod([1 - w for w in weights.values()]))
    return len(base), first, last, ",".join(sorted({r.label for _, _, r in found if r.base})), ",".join(sorted(weights)), score
