"""Personal data by weak supervision.

Regex, gazetteer and context labelers vote on candidate spans: each says personal, not
personal, or nothing. Vote patterns are counted over all documents; expectation-
maximisation estimates how reliable each labeler is, and a final span classifier (a
logistic model over votes and shape) learns from the resulting probabilities. Spans that
it accepts are added to the base spans, which always stay.

Vote patterns and shapes are few, whatever the size of the corpus, so the counts that
reach the driver are bounded.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrier.llm.blocks import Block, blocks
from terrier.session import cut_lineage

# The base patterns, in the order in which kinds are listed.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")    # a match can only begin where its digits do
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ["email", "ip", "card", "phone"]
#: Kinds that the method may add, listed after the base kinds.
ADDED = ["secret", "number", "contact", "name"]

# Gazetteers and context words, in the languages of the corpus.
GIVEN_NAMES = "anna anne carlos claire daniel david elena emma hans heinrich isabel james jean john jose juan julia klaus laura louis luis maria marie martin mary michael paul peter pierre robert sarah sofia thomas william".split()
TITLES = "mr mrs ms dr prof herr frau monsieur madame señor señora".split()
SECRET_WORDS = "token secret password passwd apikey api_key access_key private_key bearer auth".split()
CONTACT_WORDS = "phone tel telephone mobile fax call contact mail email telefon teléfono téléphone handy".split()
NUMBER_WORDS = "iban account konto compte cuenta ssn passport passeport pasaporte ausweis card".split()

_HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SECRET = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])(?:[A-Z]{2}[0-9]{2}[\x20]?[A-Z0-9]{4}(?:[\x20]?[0-9]{4}){2,6}|[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9A-Za-z])")
_CONTACT = re.compile(r"(?<![0-9A-Za-z+])(?:\(?0[0-9]{1,4}\)?[\x20/-][0-9]{3,8}(?:[\x20-][0-9]{2,6})*|[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4})(?![0-9A-Za-z])")
_NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora?)\.?\x20[A-ZÀ-Ý][\w'-]+(?:\x20[A-ZÀ-Ý][\w'-]+)?")
CANDIDATES = [("secret", _SECRET), ("number", _NUMBER), ("contact", _CONTACT), ("name", _NAME)]
_WORDS = re.compile(r"\w+")
LABELERS = ["pattern", "gazetteer", "before", "after", "mixture", "length"]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[str, int, int]]:
    """Spans of ``EMAIL``, found from each ``@`` backwards, so that long runs of letters are read once."""
    out, last = [], 0
    for m in _HOST.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append(("email", start, m.end()))
            last = m.end()
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans of a text: leftmost, non-overlapping per kind, failing ones dropped."""
    out = emails(text)
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        if kind == "phone" and "+" not in text:
            continue
        for m in pattern.finditer(text):
            if kind == "ip":
                good = all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))
            else:
                digits = "".join(c for c in m[0] if "0" <= c <= "9")
                good = 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15
            if good:
                out.append((kind, *m.span()))
    return out


def votes(text: str, kind: str, start: int, end: int) -> tuple[list[int], int]:
    """Each labeler's vote (1 personal, 0 not, -1 nothing) and the span's shape."""
    span = text[start:end]
    before = {w.lower() for w in _WORDS.findall(text[max(0, start - 24): start])}
    after = {w.lower() for w in _WORDS.findall(text[end: end + 16])}
    near = {"secret": SECRET_WORDS, "number": NUMBER_WORDS, "contact": CONTACT_WORDS, "name": TITLES}[kind]
    digits, letters = sum(c.isdigit() for c in span), sum(c.isalpha() for c in span)
    hexadecimal = all(c in "0123456789abcdefABCDEF-_" for c in span)
    names = any(w.lower() in GIVEN_NAMES for w in _WORDS.findall(span))
    mixed = digits and letters and min(digits, letters) * 6 >= len(span)
    out = [
        {"secret": 1 if hexadecimal or mixed else 0, "number": 1, "contact": -1, "name": 1}[kind],
        1 if names else (-1 if kind == "name" else 0 if _WORDS.fullmatch(span) and not digits else -1),
        1 if before & set(near) else (0 if kind in ("contact", "secret") else -1),
        1 if after & set(near) else -1,
        1 if mixed or (kind != "secret" and digits >= 7) else (0 if kind == "secret" else -1),
        1 if 24 <= len(span) <= 80 or (kind != "secret" and len(span) >= 9) else 0,
    ]
    return out, ADDED.index(kind) * 4 + min(3, len(span) // 16)


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float]:
    """EM over vote patterns: P(vote | class) per labeler, and the share of personal spans.

    Returns posteriors through ``posterior``; without patterns, the starting values.
    """
    rates = np.array([[[0.7, 0.2], [0.2, 0.7]]] * patterns.shape[1])      # labeler, class, vote
    share = 0.5
    for _ in range(rounds if len(patterns) else 0):
        p = posterior(patterns, rates, share)
        share = float(np.clip((p * counts).sum() / counts.sum(), 0.02, 0.98))
        for j in range(patterns.shape[1]):
            for c, w in ((0, 1 - p), (1, p)):
                said = np.array([(counts * w)[patterns[:, j] == v].sum() for v in (0, 1)]) + 1.0 + 2.0 * np.eye(2)[c]
                rates[j, c] = said / said.sum()
    return rates, share


def posterior(patterns: np.ndarray, rates: np.ndarray, share: float) -> np.ndarray:
    logit = np.full(len(patterns), np.log(share / (1 - share)))
    for j in range(patterns.shape[1]):
        for v in (0, 1):
            logit[patterns[:, j] == v] += np.log(rates[j, 1, v] / rates[j, 0, v])
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def classifier_rows(patterns: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """One-hot votes and shapes."""
    out = np.zeros((len(patterns), 3 * patterns.shape[1] + 4 * len(ADDED)))
    for j in range(patterns.shape[1]):
        out[np.arange(len(out)), 3 * j + patterns[:, j] + 1] = 1
    out[np.arange(len(out)), 3 * patterns.shape[1] + shapes] = 1
    return out


def train_classifier(x: np.ndarray, p: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Logistic weights fitted to probabilities, each pattern weighing as often as it occurs."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds if len(x) else 0):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += 2.0 * (x.T @ (counts * (p - q)) / counts.sum() - 1e-4 * w)
    return w


FOUND = "base array<struct<kind:string,start:long,end:long>>, cand array<struct<kind:string,start:long,end:long,key:string>>"


def find(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` with base spans and candidate spans of every text."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    cand = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("key", pa.string())])

    def run(batches):
        for block in blocks(batches, "text", 2 << 20):
            base, more = [], []
            plain = _without_digits(block)
            for i in range(block.count):
                text = block.text(i).decode()
                found = base_spans(text) if not plain[i] else emails(text)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                rows, taken = [], bytearray(len(text))
                for _, s, e in found:
                    taken[s:e] = b"x" * (e - s)
                for kind, pattern in CANDIDATES:
                    if plain[i] and kind != "name":
                        continue
                    for m in pattern.finditer(text):
                        if taken.find(b"x", *m.span()) < 0:
                            vote, shape = votes(text, kind, *m.span())
                            taken[m.start(): m.end()] = b"x" * (m.end() - m.start())
                            rows.append({"kind": kind, "start": m.start(), "end": m.end(), "key": ",".join(map(str, [*vote, shape]))})
                more.append(rows)
            yield pa.RecordBatch.from_arrays([*block.rows.columns, pa.array(base, pa.list_(span)), pa.array(more, pa.list_(cand))], names=[*block.rows.schema.names, "base", "cand"])

    docs = docs.drop("base", "cand")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL(FOUND).fields]))


def _without_digits(block: Block) -> np.ndarray:
    return block.per_text((block.data >= 0x30) & (block.data <= 0x39)) == 0


def accepted(found: DataFrame, threshold: float = 0.5) -> list[str]:
    """Vote patterns that the final classifier accepts, learnt from all documents."""
    rows = found.select(F.explode("cand.key").alias("key")).groupBy("key").count().orderBy("key").collect()
    if not rows:
        return []
    parsed = np.array([[int(v) for v in r["key"].split(",")] for r in rows])
    patterns, shapes, counts = parsed[:, :-1], parsed[:, -1], np.array([r["count"] for r in rows], float)
    rates, share = reliabilities(patterns, counts)
    x = classifier_rows(patterns, shapes)
    w = train_classifier(x, posterior(patterns, rates, share), counts)
    return [r["key"] for r, z in zip(rows, x @ w) if 1 / (1 + np.exp(-z)) >= threshold]


def detect(docs: DataFrame) -> DataFrame:
    """``docs`` (without columns named base, cand or added) with all spans per row.

    ``base`` are the base spans, ``added`` those the classifier accepts. NULL and empty
    texts have none. Repeated rows have equal spans. Candidates are written to the shared
    folder, so every text is searched once; only counts per vote pattern are shuffled.
    """
    found = cut_lineage(find(docs.drop("added")), "pii")
    keys = F.array(*[F.lit(k) for k in accepted(found)]).cast("array<string>")
    return found.withColumn("added", F.filter("cand", lambda c: F.array_contains(keys, c["key"]))).drop("cand")


def _listing(spans) -> object:
    """kind:start:end by start, then kind as listed, joined by commas."""
    rank = F.create_map(*[x for k, kind in enumerate(KINDS + ADDED) for x in (F.lit(kind), F.lit(k))])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(detected: DataFrame) -> DataFrame:
    """Counts per base kind, digest of the base spans, list of all spans."""
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    added = F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return detected.select("doc_id", *map(of, KINDS), F.sha2(_listing(F.col("base")), 256).alias("base_sha256"), _listing(F.concat("base", added)).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets.

    Overlapping spans are masked as one, named by the first. Text columns keep their
    place; ``n_chars``, if present, is counted anew. NULL texts stay NULL.
    """
    names = docs.columns
    inner = docs.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(names)], F.col("text"))
    added = F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    spans = F.array_sort(F.transform(F.concat("base", added), lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        gap = F.greatest(s["start"] - acc["at"], F.lit(0).cast("long"))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.concat(acc["text"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), gap.cast("int")), mark).alias("text"), F.greatest(acc["at"], s["end"]).alias("at"))

    end = F.aggregate(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))), start, step)
    clean = F.when(F.size(spans) == 0, F.col("text")).otherwise(F.concat(end["text"], F.substring(F.col("text"), (end["at"] + 1).cast("int"), F.length("text"))))
    done = detect(inner).withColumn("_clean", clean)
    out = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return done.select(*[(out[c] if c in out and (c == "text" or dict(docs.dtypes)[c] == "bigint") else F.col(f"_{k}")).alias(c) for k, c in enumerate(names)])

