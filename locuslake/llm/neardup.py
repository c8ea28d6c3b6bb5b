"""MinHash near-dedup (4): ProbMinHash sketches of weighted five-word shingles, banding, exact verification.

Words are lower-case runs of letters, digits and non-ASCII characters; a text of fewer than five words has
one shingle, all its words. A shingle weighs 1 + ln(times it occurs). Each shingle is a Poisson process of
arrivals at its weight's rate; every arrival falls into one of `bands * rows` registers, and a register
keeps the shingle that arrives first. Arrivals later than a horizon by which all registers are very
likely full are never drawn (the early termination); a text with an empty register is drawn again to twice
the horizon, so the sketch is the exact one. Two sketches agree in a register with the probability Jaccard
similarity of the two weighted sets. A text with repeated shingles has a second sketch in which all of them weigh
1, as they do in the sketch of a text without repeats: these agree with the Jaccard similarity of the sets, which is
what is verified, so that a pair at the threshold shares a band with 99.96 % however unevenly its lines repeat.

Texts with equal words are one content. Contents that share a band are candidates; their shingle sets are
compared exactly (Jaccard of `threshold` or more links them). Within a band's bucket contents are first
compared with its pivot, the one that shares buckets with most others. Where a bucket still holds several components,
their texts are joined across components by rare shingles: in one order of all shingles, rarest first, two sets at
the threshold share one of the first n - ceil(threshold n) + 1 of the larger and of the first
n - ceil(2 threshold / (1 + threshold) n) + 1 of the smaller. Shingles that one text alone has are left out, the
component that holds most of a shingle's texts is not paired with itself, and what a pair shares at most follows
from its shared places and from bitmaps of both sets (two sets differ in at least as many shingles as their bitmaps in
bits); these are bounds, never guesses. So no link between different components is lost among candidates, and neither a bucket
nor a group of copies becomes all pairs.

Defined cases: null and empty texts and those without a word belong to no group (class_id is doc_id);
a null doc_id is linked like any other, its class_id is the smallest doc_id of its group, or null; rows that
share a doc_id are each judged by their own text; repeated rows return as often as they came. Extra columns are ignored by
`classes` and kept by `dedup`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslake.llm import bytewords
from locuslake.llm.graph import components
from locuslake.llm.shared import drop_written, small_batches, written


@dataclass(frozen=True)
class Params:
    words: int = 5
    threshold: float = 0.8
    bands: int = 20
    rows: int = 5
    seed: int = 11
    slots: int = 1 << 20  # of the shingles' frequencies, 8 MB
    broadcast_ids: int = 500_000  # texts whose ids may be broadcast (20 MB); more of them are joined by shuffle


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int, seed: int = 11) -> np.ndarray:
    """n x m sketches of weighted sets given as (set index, element, weight); an empty set's row is zero."""
    sketch = np.zeros((n, m), dtype=np.uint64)
    total = np.bincount(doc, weight, n)
    todo = total > 0
    horizon = m * (np.log(m) + 3.0) / np.where(todo, total, 1.0)
    while todo.any():
        best = np.full(n * m, np.inf)
        live = np.flatnonzero(todo[doc])
        state = bytewords.mix(element[live] ^ np.uint64(seed * 0x9E3779B1))
        time = -np.log(_unit(state)) / weight[live]
        hits, times, who = [], [], []
        while True:
            keep = time < horizon[doc[live]]
            live, state, time = live[keep], state[keep], time[keep]
            if not len(live):
                break
            state = bytewords.mix(state + np.uint64(0x9E3779B97F4A7C15))
            slot = doc[live] * m + (state % np.uint64(m)).astype(np.int64)
            np.minimum.at(best, slot, time)
            hits.append(slot), times.append(time), who.append(live)
            state = bytewords.mix(state + np.uint64(0x9E3779B97F4A7C15))
            time = time - np.log(_unit(state)) / weight[live]
        if hits:
            slot, time, owner = np.concatenate(hits), np.concatenate(times), np.concatenate(who)
            first = time == best[slot]
            flat = sketch.reshape(-1)
            flat[slot[first]] = element[owner[first]]
        todo &= np.isinf(best.reshape(n, m)).any(axis=1)
        horizon = horizon * 2
    return sketch


def weighted_shingles(texts: list[str | None], p: Params) -> tuple[bytewords.Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words, and (text index, shingle, times) of each distinct shingle, by text and shingle."""
    w = bytewords.words(texts)
    doc, h = bytewords.shingles(w, p.words)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return w, doc[at], h[at], np.diff(np.append(at, len(h)))


def sketch_texts(texts: list[str | None], p: Params) -> dict[str, np.ndarray]:
    w, doc, h, times = weighted_shingles(texts, p)
    n, m = len(texts), p.bands * p.rows
    sig = prob_minhash(doc, h, 1.0 + np.log(times), n, m, p.seed)
    # texts with repeated shingles: once more as plain sets
    again = np.zeros(n, dtype=bool)
    again[doc[times > 1]] = True
    within, of = np.cumsum(again) - 1, again[doc]
    plain = prob_minhash(within[doc[of]], h[of], np.ones(of.sum()), int(again.sum()), m, p.seed)
    # by text: bands of its weights, then those of its set
    sig = np.concatenate([sig, plain])[np.argsort(np.append(np.arange(n), np.flatnonzero(again)), kind="stable")]
    band = np.zeros((len(sig), p.bands), dtype=np.uint64)
    for r in range(p.rows):
        band = bytewords.mix(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, r :: p.rows])
    band = bytewords.mix(band + np.arange(p.bands, dtype=np.uint64)[None, :])
    # 128 bits that name the sequence of words
    hashes = w.hashes()
    place = (np.arange(len(hashes)) - w.bounds[w.doc]).astype(np.uint64) if len(hashes) else np.zeros(0, np.uint64)
    key = np.zeros((n, 2), dtype=np.uint64)
    for k, odd in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
        np.add.at(key[:, k], w.doc, bytewords.mix(hashes * np.uint64(odd) + place))
    return {"bands": band.view(np.int64), "n_bands": p.bands * (1 + again), "key": key.view(np.int64), "n_words": np.diff(w.bounds), "n_shingles": np.bincount(doc, minlength=n)}


SKETCHES = "doc_id long, t long, k1 long, k2 long, n_shingles long, bands array<long>"


def sketches(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, t, k1, k2, n_shingles, bands) of every text; t is its hash, k1 and k2 name its word sequence, bands is null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            got = sketch_texts(batch.column("text").to_pylist(), p)
            none = got["n_words"] == 0
            offsets = pa.array(np.where(np.append(none, False), None, np.concatenate([[0], np.cumsum(got["n_bands"])])).tolist(), pa.int32())
            bands = pa.ListArray.from_arrays(offsets, pa.array(got["bands"].reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("t"), pa.array(got["key"][:, 0]), pa.array(got["key"][:, 1]), pa.array(got["n_shingles"].astype(np.int64)), bands], ["doc_id", "t", "k1", "k2", "n_shingles", "bands"])

    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(run, SKETCHES)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


def verify(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """(a, b, likeness) with the exact Jaccard similarity of the shingle sets of each pair's texts."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None)  # pairs of one pivot come one after the other

        def of(text: str) -> np.ndarray:
            return weighted_shingles([text], p)[2]

        for batch in batches:
            out = []
            for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                if held[0] != (x := x.as_py()):
                    held = (x, of(x))
                out.append(jaccard(held[1], of(y.as_py())))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "likeness"])

    return joined.mapInArrow(run, "a long, b long, likeness double")


def frequencies(texts: DataFrame, p: Params) -> np.ndarray:
    """How often the shingles of these texts occur, summed in `slots` slots: 8 bytes each, whatever the input's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            h = weighted_shingles(batch.column("text").to_pylist(), p)[2]
            slot, n = np.unique(h % np.uint64(p.slots), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(n.astype(np.int64))], ["slot", "n"])

    sums = texts.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(p.slots, np.int64)
    table[sums.column("slot").to_numpy()] = sums.column("n").to_numpy()
    return table


WORDS = 8  # of 64 bits in a text's bitmap


def bitmaps(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """n x WORDS: each distinct shingle of a text turns one bit; shingles that two texts share turn equal bits in both."""
    out = np.zeros((n, WORDS), np.uint64)
    bit = (h >> np.uint64(20)) % np.uint64(64 * WORDS)
    np.bitwise_xor.at(out, (doc, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return out


def postings(texts: DataFrame, table: np.ndarray, p: Params) -> DataFrame:
    """(key, node, n, alone, place, short, m0 ...): the shingles in the front of each text, less those (`alone` of them) that no other text has by the
    table; `place` is that among its n shingles, rarest first, places under `short` are enough for larger partners, m0 ... is the bitmap."""
    slim = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            _, doc, h, _ = weighted_shingles(batch.column("text").to_pylist(), p)
            often = slim.value[(h % np.uint64(p.slots)).astype(np.int64)]
            order = np.lexsort((h, often, doc))
            n = np.bincount(doc, minlength=batch.num_rows)
            place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            size = n - np.ceil(p.threshold * n - 1e-9).astype(np.int64) + 1
            short = n - np.ceil(2 * p.threshold / (1 + p.threshold) * n - 1e-9).astype(np.int64) + 1
            kept = np.flatnonzero((place < size[doc]) & (often[order] > 1))
            of, alone = doc[kept], np.bincount(doc[often == 1], minlength=batch.num_rows)
            bits = bitmaps(doc, h, batch.num_rows)[of].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h[order][kept].view(np.int64)), batch.column("node").take(pa.array(of)), *(pa.array(x.astype(np.int32)) for x in (n[of], alone[of], place[kept], short[of])), *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(WORDS))], names)

    names = ["key", "node", "n", "alone", "place", "short", *(f"m{k}" for k in range(WORDS))]
    return texts.select("node", "text").mapInArrow(run, "key long, node long, n int, alone int, place int, short int, " + ", ".join(f"m{k} long" for k in range(WORDS)))


def across(posts: DataFrame, p: Params) -> DataFrame:
    """(a, b) of different components that may be at the threshold, from postings with their `component`."""
    each = posts.groupBy("key", "component").agg(F.count("*").alias("c"))
    most = each.groupBy("key").agg(F.max(F.struct("c", "component"))["component"].alias("major"), F.count("*").alias("components")).where("components > 1").select("key", "major")
    shared = written(posts.join(most, "key").withColumn("major", F.col("component") == F.col("major")), "postings")
    x, y = shared.where("not major").alias("x"), shared.alias("y")
    apart = F.col("y.major") | (F.col("x.component") < F.col("y.component"))
    sizes = F.least("x.n", "y.n") >= F.lit(p.threshold - 1e-9) * F.greatest("x.n", "y.n")
    larger = (F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.node") > F.col("y.node")))
    fronts = F.when(larger, F.col("y.place") < F.col("y.short")).otherwise(F.col("x.place") < F.col("x.short"))
    both = (F.col("x.n") + F.col("y.n")).cast("double")
    # of a shared shingle: those before it that may be shared, itself, and those after it
    most = F.least(F.col("x.place") - F.col("x.alone"), F.col("y.place") - F.col("y.alone")) + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    differ = sum((F.bit_count(F.col(f"x.m{k}").bitwiseXOR(F.col(f"y.m{k}"))) for k in range(WORDS)), F.lit(0))
    may = (most * F.lit(1 + p.threshold) >= F.lit(p.threshold - 1e-9) * both) & (differ * F.lit(1 + p.threshold) <= F.lit(1 - p.threshold + 1e-9) * both)
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & apart & sizes & fronts & may)
    # which of the two is x differs from shingle to shingle
    first = F.col("x.node") < F.col("y.node")
    side = lambda c, of: F.when(first if of == "a" else ~first, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}"))
    met = met.select(*[side(c, of).alias(f"{c}_{of}") for c in ("node", "place", "n") for of in "ab"])
    pair = met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(F.count("*").alias("same"), F.max("place_a").alias("at_a"), F.max("place_b").alias("at_b"), F.max("n_a").alias("na"), F.max("n_b").alias("nb"))
    common = F.col("same") + F.least(F.col("na") - F.col("at_a"), F.col("nb") - F.col("at_b")) - 1
    return pair.where(common * F.lit(1 + p.threshold) >= F.lit(p.threshold - 1e-9) * (F.col("na") + F.col("nb"))).select("a", "b")


def grouped(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """The written tables (doc_id, t, k1, k2, ...) of every row and (k1, k2, doc_id, t, copies, class_id, first) of every content:
    of its least row, and whether it is the first content of its class."""
    marks = written(sketches(docs, p), "sketches")
    row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("row")
    contents = marks.where("bands is not null").groupBy("k1", "k2").agg(row, F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    contents = written(contents.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "row.doc_id", "row.t", "copies", "n", "bands"), "contents")

    # buckets of more than one content, each with a pivot: the member of largest support
    members = contents.select("node", "n", F.explode(F.array_distinct("bands")).alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    placed = written(members.join(sizes, "key"), "placed")
    support = placed.groupBy("node").agg(F.sum("size").alias("support"))  # the text that a group was made from shares buckets with most of it
    heads = placed.join(support, "node").groupBy("key").agg(F.max(F.struct("support", F.xxhash64("node").alias("h"), "node", "n")).alias("head")).select("key", F.col("head.node").alias("pivot"), F.col("head.n").alias("pivot_n"))
    shared = written(placed.join(heads, "key").select("key", "node", "n", "pivot", "pivot_n"), "buckets")
    drop_written(placed)

    near = F.least("n", "pivot_n") >= F.lit(p.threshold - 1e-9) * F.greatest("n", "pivot_n")
    first = shared.where(F.col("node") != F.col("pivot")).where(near).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    wanted = written(shared.select("node").distinct().join(contents.select("node", F.col("doc_id").alias("_d"), F.col("t").alias("_t")), "node"), "wanted")
    small = F.broadcast(wanted) if wanted.count() <= p.broadcast_ids else wanted
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("t")).join(small, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")))
    texts = written(found.select("node", "text").dropDuplicates(["node"]), "texts")
    drop_written(wanted)
    tried = written(verify(first, texts, p), "tried")
    links = tried.where(F.col("likeness") >= p.threshold - 1e-9).select("a", "b")

    # what the pivots left apart: texts of buckets that hold more than one component
    comp = written(components(links, "a", "b"), "components")
    of = shared.select("key", "node").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = of.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    rest = written(of.join(split, "key", "left_semi").select("node", "component").distinct(), "rest")
    drop_written(shared)
    left = written(texts.join(rest, "node", "left_semi"), "left")
    posts = postings(left, frequencies(left, p), p).join(rest, "node")
    pairs = across(posts, p).join(tried.select("a", "b"), ["a", "b"], "left_anti").join(tried.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
    more = verify(pairs, texts, p).where(F.col("likeness") >= p.threshold - 1e-9).select("a", "b")
    # the components so far stand in for their links
    joined = comp.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    final = components(joined, "a", "b")
    named = final.join(contents.select("node", "doc_id"), "node")
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    named = contents.join(final.join(least, "component"), "node", "left")
    named = written(named.select("k1", "k2", "doc_id", "t", "copies", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id"), (F.coalesce("component", "node") == F.col("node")).alias("first")), "classes")
    for t in (contents, texts, tried, comp, rest, left):
        drop_written(t)
    return marks, named


def classes(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, class_id, copies): one row per document; copies is the number of rows with the same words."""
    marks, named = grouped(docs, p)
    out = marks.select("doc_id", "k1", "k2", F.col("bands").isNotNull().alias("grouped")).join(named.select("k1", "k2", "copies", "class_id"), ["k1", "k2"], "left")
    return out.select("doc_id", F.when(F.col("grouped"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.when(F.col("grouped"), F.col("copies")).otherwise(1).cast("long").alias("copies"))


def dedup(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One document of each class, that of smallest doc_id (one of its rows where it is repeated); all columns.

    Of a class without any doc_id one row stays. Documents without words stay.
    """
    marks, named = grouped(docs, p)
    width = docs.columns
    keep = named.where("doc_id = class_id").select("doc_id").unionByName(marks.where("bands is null and doc_id is not null").select("doc_id")).select(F.col("doc_id").alias("_kept")).distinct()
    row = F.xxhash64(*[F.col(c) for c in width if not dict(docs.dtypes)[c].startswith("map")])
    some = docs.where("doc_id is not null").join(keep, F.col("doc_id") == F.col("_kept"), "left_semi")
    some = some.withColumn("_row", row).dropDuplicates(["doc_id", "_row"]).select(*width)
    bare = docs.where("doc_id is null").withColumn("_t", F.xxhash64("text"))
    alone = bare.join(named.where("class_id is null and first").select(F.col("t").alias("_t")), "_t", "left_semi").dropDuplicates(["_t"])
    wordless = bare.join(marks.where("bands is null and doc_id is null").select(F.col("t").alias("_t")).distinct(), "_t", "left_semi")
    return some.unionByName(alone.select(*width)).unionByName(wordless.select(*width))


def op4_near_dedup(docs: DataFrame, p: Params = Params()) -> DataFrame:
    return classes(docs, p)
