"""Near-duplicate documents by order min-hash.

A document is its sequence of five-word shingles, each labelled with its occurrence
number, so that repeats count. Every sketch takes the few labelled shingles of smallest
hash and keeps the order in which they stand in the text; equal sketches therefore say
that the shared shingles stand in the same order, as they do after small edits. As many
sketches take distinct shingles without their number and keep no order; they find texts
that repeat the same passages more or less often or have them in another order.

1. Equal word sequences become one representative (partial aggregation first).
2. Representatives that share a sketch form a bucket. Buckets with the same members are
   met once. Members of a bucket are dealt into chunks of bounded size.
3. Inside a chunk, members of different classes are compared; a link joins their classes,
   so members that are joined already are not compared again and no pair list arises.
   A pair is settled by a banded alignment of its shingles: see below.
4. Buckets of a few sketches come first, whole, and their links give connected components.
   Of the other buckets only those that still hold several components go on. In large
   ones, one member of each component is compared first, so that a large group of near
   copies becomes one component; then all that is still apart, chunk by chunk and chunks
   of different components with each other. A text moves only into buckets that go on.

Similarity is aligned over all distinct shingles, and links have 0.8 or more. Aligned are
the distinct shingles in chains of equal labelled shingles, each chain in increasing order
inside a band round the densest diagonal of what is left, so that moved paragraphs align
with a chain of their own. A stretch of fewer than ``CHAIN`` shingles (of fewer than all, in
shorter texts) far from the next one of its chain is chance and aligns nothing. Aligned shingles are shared ones, so pairs that
share less than 0.8 of their sets are left out before any alignment.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm.blocks import blocks, grams, mix, whole_windows
from terrier.session import cut_lineage

SHINGLE, SIMILARITY, SKETCHES, SETS, SAMPLED, CHUNK, BAND, CHAIN = 5, 0.8, 20, 20, 3, 512, 32, 4
#: Members and words of a chunk that is compared with others: bounds of a task's memory.
MEMBERS, WORDS = 2048, 1 << 21
#: Sketches of either kind whose buckets come first.
EARLY = 4
#: Buckets of more members begin with heads of classes; smaller ones are compared whole at once.
HEADS = 32
#: Heads meet where they are at most this share of the members; else the whole bucket costs little more.
FEW = 0.25
#: Turns in which only heads of classes meet; what they leave apart is compared whole.
HEAD_TURNS = 3
_SKETCHED = "doc_id long, h1 long, h2 long, size long, sketches array<long>"


def shingles(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and their owners; a shorter text is one shingle."""
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(whole_windows(counts, SHINGLE, len(words)))
    keys, owners = grams(words, SHINGLE)[at], owner[at]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        begins = np.cumsum(counts) - counts
        extra = []
        for i in short:
            h = np.uint64(counts[i])
            for w in words[begins[i]: begins[i] + counts[i]]:
                h = mix(np.array([h ^ w]))[0]
            extra.append(h)
        order = np.argsort(np.concatenate([owners, short]), kind="stable")
        keys, owners = np.concatenate([keys, np.array(extra, np.uint64)])[order], np.concatenate([owners, short])[order]
    return keys, owners


def occurrences(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """How often each key stood before in its text."""
    mixed = keys ^ mix(owners.astype(np.uint64))
    order = np.argsort(mixed, kind="stable")
    new = np.concatenate([[True], mixed[order][1:] != mixed[order][:-1]]) if len(order) else np.zeros(0, bool)
    place = np.arange(len(order))
    out = np.empty(len(order), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(new, place, 0)) if len(order) else 0
    return out


def sketch(keys: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """One row of sketches per text, ordered ones and those of sets; texts without shingles have zeros."""
    out = np.zeros((n, SKETCHES + SETS), np.uint64)
    if not len(keys):
        return out
    times = occurrences(keys, owners)
    first = times == 0
    seeds = mix(np.arange(1, SKETCHES + SETS + 1, dtype=np.uint64)) | np.uint64(1)
    _smallest(mix(keys + mix(times.astype(np.uint64))), owners, seeds[:SKETCHES], True, out[:, :SKETCHES])
    _smallest(mix(keys[first]), owners[first], seeds[SKETCHES:], False, out[:, SKETCHES:])
    return out


def _smallest(labelled: np.ndarray, owners: np.ndarray, seeds: np.ndarray, ordered: bool, out: np.ndarray) -> None:
    """Fill in the sketches of distinct shingles, in order of the text or of their hash."""
    counts = np.bincount(owners, minlength=len(out))
    some = np.flatnonzero(counts)
    begins = (np.cumsum(counts) - counts)[some]
    sizes = counts[some]
    top = np.uint64(2**64 - 1)
    for s, seed in enumerate(seeds):
        values = labelled * seed
        values ^= values >> np.uint64(29)
        places = np.full((SAMPLED, len(some)), len(labelled))
        for r in range(SAMPLED):
            least = np.minimum.reduceat(values, begins)
            hit = np.flatnonzero(values == np.repeat(least, sizes))
            first = np.searchsorted(hit, begins)
            at = hit[np.minimum(first, len(hit) - 1)]
            real = least != top
            places[r, real] = at[real]
            values[at[real]] = top
        if ordered:
            places.sort(axis=0)                               # text order
        h = np.full(len(some), seed)
        for r in range(SAMPLED):
            real = places[r] < len(labelled)
            h = np.where(real, mix(h ^ labelled[np.minimum(places[r], len(labelled) - 1)]), h)
        out[some, s] = mix(h + np.uint64(s))


def sketched(docs: DataFrame) -> DataFrame:
    """Per row: 128-bit digest and number of the words, sketches; a text without words has NULL sketches."""
    def run(batches):
        for block in blocks(batches, "text", 2 << 20):
            starts, ends = block.words
            words, counts = block.hashes(starts, ends), block.counts(starts)
            keys, owners = shingles(words, counts)
            rows = sketch(keys, owners, block.count).astype(np.int64)
            stops = np.cumsum(counts)
            digests = []
            for k in (1, 2):
                place = np.arange(len(words)) - np.repeat(stops - counts, counts)
                mixed = mix(words + mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(k)))
                total = np.concatenate([[np.uint64(0)], np.cumsum(mixed)])
                digests.append(mix(total[stops] - total[stops - counts] + counts.astype(np.uint64)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([
                block.rows.column("doc_id").cast(pa.int64()), pa.array(digests[0]), pa.array(digests[1]), pa.array(counts, pa.int64()),
                pa.array([r if n else None for r, n in zip(rows, counts)], pa.list_(pa.int64()))], names=["doc_id", "h1", "h2", "size", "sketches"])

    return docs.select("doc_id", "text").mapInArrow(run, _SKETCHED)


def word_hashes(docs: DataFrame) -> DataFrame:
    """id and word hashes (32 bits each) of the texts of ``docs``."""
    def run(batches):
        for block in blocks(batches, "text", 2 << 20):
            words, counts = block.hashes(*block.words).astype(np.uint32), block.counts(block.words[0])
            stops = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays([
                block.rows.column("doc_id").cast(pa.int64()),
                pa.array([words[e - n: e].tobytes() for e, n in zip(stops, counts)], pa.binary())], names=["id", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, "id long, words binary")


class Chunk:
    """Members of a chunk with their shingles, and the classes that links have joined."""

    def __init__(self, ids: list[int], words: list[bytes], classes: list[int]):
        self.ids = ids
        self.runs = []
        for data in words:
            seq = np.frombuffer(data, np.uint32).astype(np.uint64)
            self.runs.append(shingles(seq, np.array([len(seq)]))[0])
        self.sets = [np.unique(r) for r in self.runs]
        self.labelled = [mix(r + mix(occurrences(r, np.zeros(len(r), np.int64)).astype(np.uint64))) for r in self.runs]
        self.parent = {c: c for c in classes}
        self.classes = classes
        self.links: list[tuple[int, int]] = []

    def root(self, c: int) -> int:
        while self.parent[c] != c:
            self.parent[c] = self.parent[self.parent[c]]
            c = self.parent[c]
        return c

    def shared(self) -> np.ndarray:
        """Shared distinct shingles of all members, counted by columns of shared shingles."""
        if len(self.sets) == 2:
            n = len(np.intersect1d(*self.sets, assume_unique=True))
            return np.array([[len(self.sets[0]), n], [n, len(self.sets[1])]], np.float32)
        every = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        rows = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
        keys, columns, counts = np.unique(every, return_inverse=True, return_counts=True)
        often = counts > 1
        keep = often[columns]
        rows, columns = rows[keep], (np.cumsum(often) - 1)[columns[keep]]
        out = np.zeros((len(self.sets), len(self.sets)), np.float32)
        order = np.argsort(columns, kind="stable")
        rows, columns = rows[order], columns[order]
        width = 4096
        for lo in range(0, int(often.sum()), width):
            a, b = np.searchsorted(columns, [lo, lo + width])
            m = np.zeros((len(self.sets), width), np.float32)
            m[rows[a:b], columns[a:b] - lo] = 1
            out += m @ m.T
        return out

    def link(self, across: int | None = None) -> list[tuple[int, int]]:
        """Links between classes. ``across`` compares the members before it with the rest only."""
        sizes = np.array([len(s) for s in self.sets], np.float64)
        both = self.shared()
        likely = both >= SIMILARITY * (sizes[:, None] + sizes[None] - both) - 1e-6
        likely &= sizes[:, None] > 0
        pairs = np.argwhere(np.triu(likely, 1))
        if across is not None:
            pairs = pairs[(pairs[:, 0] < across) & (pairs[:, 1] >= across)]
        for i, j in pairs.tolist():
            a, b = self.root(self.classes[i]), self.root(self.classes[j])
            if a != b and self.similar(i, j, both[i, j]):
                self.parent[max(a, b)] = min(a, b)
                self.links.append((self.ids[i], self.ids[j]))
        return self.links

    def similar(self, i: int, j: int, both: float) -> bool:
        """Whether the aligned distinct shingles are 0.8 or more of all."""
        union = len(self.sets[i]) + len(self.sets[j]) - both
        return aligned(self.runs[i], self.labelled[i], self.labelled[j], SIMILARITY * union - 1e-6)


def aligned(run: np.ndarray, a: np.ndarray, b: np.ndarray, wanted: float) -> bool:
    """Whether chains align at least ``wanted`` distinct shingles of ``run``, those of text ``a``.

    Each chain lies in a band round the densest diagonal of the places that no chain has
    taken yet, and breaks where the next equal place is further away than the band is wide.
    Stretches of fewer than ``CHAIN`` places do not count. The search ends when enough are
    aligned or all places are taken.
    """
    _, x, y = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(x)
    x, y = x[order], y[order]
    least = min(CHAIN, len(a), len(b))
    found = np.zeros(len(a), bool)
    while len(x) >= least:
        diagonal = x - y
        slots, counts = np.unique(diagonal // BAND, return_counts=True)
        middle = np.median(diagonal[diagonal // BAND == slots[np.argmax(counts)]])
        near = np.flatnonzero(np.abs(diagonal - middle) <= BAND)
        chain = near[increasing(y[near])]
        cuts = np.flatnonzero((np.diff(x[chain]) > BAND) | (np.diff(y[chain]) > BAND)) + 1
        kept = [piece for piece in np.split(chain, cuts) if len(piece) >= least]
        rest = np.ones(len(x), bool)
        if kept:
            chain = np.concatenate(kept)
            found[x[chain]] = True
            if len(np.unique(run[found])) >= wanted:
                return True
        rest[chain] = False
        x, y = x[rest], y[rest]
    return len(np.unique(run[found])) >= wanted


def increasing(y: np.ndarray) -> np.ndarray:
    """Places of the longest increasing chain of ``y``, found by bisection."""
    if not len(y) or (np.diff(y) > 0).all():
        return np.arange(len(y))
    tails, heads, back = [], [], np.empty(len(y), np.int64)
    for k, v in enumerate(y.tolist()):
        at = bisect_left(tails, v)
        back[k] = heads[at - 1] if at else -1
        tails[at: at + 1], heads[at: at + 1] = [v], [k]
    chain, k = [], heads[-1]
    while k >= 0:
        chain.append(k)
        k = back[k]
    return np.array(chain[::-1])


def _compare(table: pa.Table) -> pa.Table:
    """Links of one chunk, or between the two sides of a pair of chunks."""
    rows = table.select(["side", "id", "class", "words"]).to_pylist()
    rows.sort(key=lambda r: (r["side"], r["id"]))
    one = sum(r["side"] == 0 for r in rows)
    chunk = Chunk([r["id"] for r in rows], [r["words"] for r in rows], [r["class"] for r in rows])
    links = chunk.link(None if one == len(rows) else one)
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def components(links: DataFrame, label: str = "classes") -> DataFrame:
    """id and class (the smallest id reached) of every id in ``links`` (a, b).

    Large-star and small-star rounds until nothing changes; every round is written to the
    shared folder. A node's neighbours are aggregated, never collected into a list.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    state = cut_lineage(edges, label)
    before = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        state = cut_lineage(small.where("u <> v").distinct(), label)
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    ends = state.groupBy("u").agg(F.min("v").alias("class"))
    return cut_lineage(ends.select(F.col("u").alias("id"), "class"), label) if before else spark.createDataFrame([], "id long, class long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class) and class_size for every row.

    Documents with equal words, or linked by similarity of 0.8 or more, share a class;
    NULL texts and texts without a word share one. Texts of fewer than five words are
    near-duplicates only if equal. Repeated rows (one id twice) stay rows of one class.
    Rows without an id keep a NULL class. Extra columns are not read.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    rows = cut_lineage(sketched(known), "sketches")
    firsts = cut_lineage(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.min_by("sketches", "doc_id").alias("sketches"), F.min("size").alias("size")), "heads")
    reps = rows.select("doc_id", "h1", "h2").join(firsts.select("h1", "h2", "id"), ["h1", "h2"]).select("doc_id", F.col("id").alias("rep"))
    links = near_links(firsts.where("sketches IS NOT NULL").select("id", "size", "sketches"), known)
    named = reps.join(components(links).withColumnRenamed("id", "rep"), "rep", "left")
    out = cut_lineage(named.select("doc_id", F.coalesce("class", "rep").alias("class_id")), "classes")
    sizes = out.groupBy("class_id").agg(F.count("*").alias("class_size"))
    out = out.join(sizes, "class_id").select("doc_id", "class_id", "class_size")
    lost = docs.where(F.col("doc_id").isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return out.unionByName(lost)


def buckets(heads: DataFrame) -> DataFrame:
    """bucket, id, size, n, early for buckets of two or more members; equal member sets are met once.

    ``early`` says that one of the buckets with these members is of the first sketches.
    """
    placed = heads.select("id", "size", F.posexplode("sketches").alias("place", "bucket"))
    mark = F.xxhash64("id")
    turn = F.when(F.col("place") < SKETCHES, F.col("place")).otherwise(F.col("place") - SKETCHES)
    kinds = placed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(mark.cast("decimal(30,0)")).alias("s"), F.bit_xor(mark).alias("x"), F.min(turn).alias("turn"))
    once = kinds.where("n > 1").groupBy("n", "s", "x").agg(F.min("bucket").alias("bucket"), (F.min("turn") < EARLY).alias("early"))
    return placed.select("id", "size", "bucket").join(once.select("bucket", "n", "early"), "bucket")


def near_links(heads: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that join all near-duplicate representatives.

    Only texts of documents in a bucket are read again and moved; those of one id twice
    count with the text of the smallest order. The join is a sort-merge join at every size.
    """
    members = cut_lineage(buckets(heads), "buckets")
    chunks = F.expr(f"cast(ceil(n / {CHUNK}) as long)")
    dealt = members.where("early").withColumns({"chunk": F.pmod(F.xxhash64("id"), chunks), "side": F.lit(0), "class": F.col("id")})
    schema = "a long, b long"
    asked = members.select(F.col("id").alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text").join(asked.hint("merge"), "doc_id", "left_semi")
    words = cut_lineage(word_hashes(texts).groupBy("id").agg(F.min("words").alias("words")), "words")
    first = cut_lineage(dealt.drop("n", "early", "size").join(words, "id").groupBy("bucket", "chunk").applyInArrow(_compare, schema), "links")
    # Heads of classes next, so that large groups become one class before their texts move.
    links, known = first, with_classes(members, first)
    for turn in range(HEAD_TURNS):
        met = class_heads(known.where(f"n > {HEADS}"), turn).join(words, "id").groupBy("bucket", "chunk").applyInArrow(_compare, schema)
        met = cut_lineage(met, "links")
        if not met.head(1):
            break
        links = links.unionByName(met)
        known = with_classes(known.drop("class"), links)
    # Then compare all that is still apart and was not compared whole already.
    apart = known.where(f"NOT early OR n > {CHUNK}").groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("bucket")
    # Chunks in order of class, so that chunks of one class are told apart from mixed ones. A
    # member's share of a chunk is the greater of its shares of the members and of the words.
    share = F.greatest(F.lit(WORDS // MEMBERS), "size")
    filled = F.sum(share).over(Window.partitionBy("bucket").orderBy("class", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = cut_lineage(known.join(apart, "bucket").select("bucket", "id", "class", F.floor((filled - 1) / WORDS).alias("chunk")), "chunks")
    ranges = placed.groupBy("bucket", "chunk").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    per = ranges.groupBy("bucket").agg(F.collect_list(F.struct("chunk", "lo", "hi")).alias("all"))
    pairs = ranges.join(per, "bucket").select("bucket", "chunk", F.explode(F.filter("all", lambda c: (c["chunk"] > F.col("chunk")) & ~((c["lo"] == F.col("hi")) & (c["hi"] == F.col("lo")) & (F.col("lo") == F.col("hi"))))).alias("other"))
    pairs = pairs.select("bucket", F.col("chunk").alias("left"), F.col("other")["chunk"].alias("right"))
    inside = ranges.where("lo <> hi").select("bucket", F.col("chunk").alias("left"), F.col("chunk").alias("right"))
    sides = pairs.unionByName(inside).select("bucket", "left", "right", F.explode(F.when(F.col("left") == F.col("right"), F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("chunk")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("chunk")), F.struct(F.lit(1).alias("side"), F.col("right").alias("chunk"))))).alias("s"))
    sides = sides.select("bucket", "left", "right", F.col("s")["side"].alias("side"), F.col("s")["chunk"].alias("chunk"))
    second = sides.join(placed, ["bucket", "chunk"]).join(words, "id").groupBy("bucket", "left", "right").applyInArrow(_compare, schema)
    return cut_lineage(links.unionByName(second), "links")


def with_classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the class that ``links`` give each; an id without a link is its own."""
    known = members.join(components(links), "id", "left").withColumn("class", F.coalesce("class", "id"))
    return cut_lineage(known, "known")


def class_heads(known: DataFrame, turn: int) -> DataFrame:
    """One member of each class of a bucket with several but few, dealt into chunks; another one each turn."""
    mark = F.xxhash64("id", F.lit(turn))
    heads = known.groupBy("bucket", "class").agg(F.min_by("id", mark).alias("id"), F.max("n").alias("n"))
    sizes = heads.groupBy("bucket").agg(F.count("*").alias("heads"), F.max("n").alias("n")).where(f"heads > 1 AND heads <= {FEW} * n")
    chunks = F.ceil(F.col("heads") / CHUNK).cast("long")
    return heads.join(sizes, "bucket").select("bucket", "id", "class", F.pmod(mark, chunks).alias("chunk"), F.lit(0).alias("side"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class: the row of its smallest doc_id, with its own columns.

    Of repeated rows of that id one stays. Rows without an id stay.
    """
    names = docs.columns
    inner = docs.select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(names)], "doc_id", "text")
    found = classes(inner.select("doc_id", "text"))
    heads = found.where("doc_id = class_id").select("doc_id").distinct()
    kept = inner.join(heads, "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy("text", *[f"_{k}" for k in range(len(names))])
    kept = kept.withColumn("_row", F.row_number().over(order)).where("_row = 1").drop("_row")
    return kept.unionByName(inner.where("doc_id IS NULL")).select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(names)])
