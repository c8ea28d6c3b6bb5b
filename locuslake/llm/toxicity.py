"""Toxicity (5): subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed character n-grams (3 to 5 bytes, with word ends) and of
the whole word; a window of `window` words is the mean of its words; a linear softmax reads each window
and the text takes the window that speaks most for label 1, so that a long text does not dilute an
insult. Embeddings and softmax are trained together on the text's label through that (soft) maximum.
`AVERAGED` is the same model with the whole text as its only window: the plain averaged bag.

Training reads at most `max_per_label` labelled texts of each label, those of smallest hash of doc_id and of any
length, as far as they come to `max_chars` characters a label: a bounded sample. The final score is calibrated with
each text weighted by the number of labelled texts it stands for, so that the score answers to the labels' shares in
the whole input and not in the sample. The sample is fitted in one task, whose memory those bounds limit; only the
model comes to the driver. Scoring reads every whole text.

Defined cases: a null or empty text scores as a text without words (the share learned for no evidence);
a null doc_id is scored, never learned from, and counts as not held out; of rows with one doc_id, one text (that of
smallest hash) is learned from; a doc_id labelled both ways counts as 1; without labels of both kinds
every score is 0; repeated rows get equal scores; extra columns are ignored by the query and kept by
`reject`.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslake.llm import bytewords
from locuslake.llm.shared import drop_written, small_batches, written


@dataclass
class Params:
    buckets: int = 1 << 16
    dim: int = 8
    window: int | None = 3  # None: the whole text
    low: int = 3
    high: int = 5
    max_per_label: int = 2000
    max_chars: int = 24_000_000  # of one label's texts
    epochs: int = 7
    batch: int = 64
    batch_words: int = 100_000  # of one batch's texts, so that long texts take no more memory
    rate: float = 0.25
    seed: int = 7

    @property
    def span(self) -> int:
        return self.window or 1 << 40


#: The plain average: its gradients are small, so it takes more and longer steps.
AVERAGED = Params(window=None, epochs=12, rate=0.2)


@dataclass
class Model:
    params: Params
    vectors: np.ndarray  # buckets x dim
    weights: np.ndarray  # dim x 2
    bias: np.ndarray  # 2
    scale: tuple[float, float] = (1.0, 0.0)  # text logit to calibrated logit
    empty: float = 0.0  # score of a text without words
    pull: np.ndarray = field(default=None)  # per bucket: what its vector adds to the logit of label 1

    def fold(self) -> None:
        self.pull = (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)


def word_features(w: bytewords.Words, index: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, first feature of each word) for the words at `index`: hashes of the word between two
    spaces and of its n-grams, each the sum of its bytes plus one by the power of their place."""
    space = np.uint64(33)
    start, length = w.start[index], w.end[index] - w.start[index]
    # only the words asked for, each between two spaces
    first = np.cumsum(length + 2) - (length + 2)
    inner = np.repeat(first + 1, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    data = np.full(int((length + 2).sum()), space)
    data[inner] = w.data[np.repeat(start, length) + inner - np.repeat(first + 1, length)].astype(np.uint64) + np.uint64(1)
    power = bytewords.powers(max(int(length.max()) + 2, p.high))
    place = np.arange(len(data)) - np.repeat(first, length + 2)
    owner, value = [np.arange(len(index))], [bytewords.mix(np.add.reduceat(data * power[place], first) + np.uint64(99))]
    for n in range(p.low, p.high + 1):
        many = np.maximum(0, length + 3 - n)
        who = np.repeat(np.arange(len(index)), many)
        if not len(who):
            continue
        at = first[who] + np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
        gram = np.zeros(len(at), np.uint64)
        for k in range(n):
            gram += data[at + k] * power[k]
        owner.append(who)
        value.append(bytewords.mix(gram + np.uint64(n)))
    owner, value = np.concatenate(owner), np.concatenate(value)
    order = np.argsort(owner, kind="stable")
    return (value[order] % np.uint64(p.buckets)).astype(np.int64), np.searchsorted(owner[order], np.arange(len(index)))


def text_logits(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The largest window logit of each text, and whether the text has words."""
    p, w = model.params, bytewords.words(texts)
    out, some = np.zeros(len(texts)), np.diff(w.bounds) > 0
    if not len(w.start):
        return out, some
    _, index, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
    feats, first = word_features(w, index, p)
    counts = np.diff(np.append(first, len(feats)))
    word = (np.add.reduceat(model.pull[feats].astype(np.float64), first) / counts)[which]
    total = np.concatenate([[0.0], np.cumsum(word)])
    end = np.minimum(np.arange(len(word)) + p.span, w.bounds[w.doc + 1])
    begin = np.maximum(np.minimum(np.arange(len(word)), w.bounds[w.doc + 1] - p.span), w.bounds[w.doc])
    logit = (total[end] - total[begin]) / (end - begin)
    filled = np.flatnonzero(some)
    out[filled] = np.maximum.reduceat(logit, w.bounds[filled]) + float(model.bias[1] - model.bias[0])
    return out, some


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    a, b = model.scale
    if a == 0:  # learned from labels of one kind or none
        return np.zeros(len(texts))
    logit, some = text_logits(texts, model)
    return np.where(some, 1 / (1 + np.exp(-np.clip(a * logit + b, -60, 60))), model.empty)


def pieces(texts: list[str], most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about `most` characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if len(texts) > start:
        yield start, len(texts)


def vocabulary(texts: list[str], p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word number of each word, words' bounds by text, features by word, first feature and number of them), piece by piece."""
    which, sizes, names, feats, counts = [], [], [], [], []
    for k, z in pieces(texts):
        w = bytewords.words(texts[k:z])
        found, index, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
        f, first = word_features(w, index, p) if len(index) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        which.append(inverse + sum(map(len, names)))
        sizes.append(np.diff(w.bounds))
        names.append(found)
        feats.append(f.astype(np.int32))
        counts.append(np.diff(np.append(first, len(f))))
    _, index, merged = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    feats, counts = np.concatenate(feats), np.concatenate(counts)
    first = np.cumsum(counts) - counts
    return merged[np.concatenate(which)], np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), feats, first[index], counts[index]


def batches_of(order: np.ndarray, sizes: np.ndarray, p: Params) -> Iterator[np.ndarray]:
    """Runs of at most `batch` texts and, beyond a first text, `batch_words` words."""
    start, held = 0, 0
    for i, n in enumerate(sizes[order]):
        if i > start and (i - start == p.batch or held + n > p.batch_words):
            yield order[start:i]
            start, held = i, 0
        held += n
    if len(order) > start:
        yield order[start:]


def train(texts: list[str], labels: list[int], p: Params = Params(), stands: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Fit embeddings and softmax jointly on whole texts; the same texts in the same order give the same model.

    `stands` says for how many labelled texts one of label 0 and one of label 1 stands.
    """
    rng = np.random.default_rng(p.seed)
    y = np.asarray(labels, dtype=np.int64)
    model = Model(p, rng.normal(0, 0.1, (p.buckets, p.dim)), rng.normal(0, 0.5, (p.dim, 2)), np.zeros(2))
    model.fold()
    if len(set(labels)) < 2:
        model.scale, model.empty = (0.0, -60.0), 0.0
        return model
    which, bounds, feats, first, counts = vocabulary(texts, p)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    tiny = 1e-4 if p.window else 1e-9
    square_v, square_w = np.full((p.buckets,), tiny), np.full((p.dim, 2), tiny)
    step = max(1, p.span // 2)
    for epoch in range(p.epochs):
        sharp = 0.5 * 2.0**epoch if epoch else 0.0  # from the mean of the windows towards their maximum
        order = rng.permutation(filled)
        for docs in batches_of(order, np.diff(bounds), p):
            spans = [np.arange(bounds[d], bounds[d + 1]) for d in docs]
            words, inverse = np.unique(which[np.concatenate(spans)], return_inverse=True)
            many = counts[words]
            at = np.repeat(first[words], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            f, head = feats[at], np.cumsum(many) - many
            vec = np.stack([np.add.reduceat(model.vectors[f, j], head) for j in range(p.dim)], axis=1) / many[:, None]
            total = np.concatenate([np.zeros((1, p.dim)), np.cumsum(vec[inverse], axis=0)])
            begins, ends, owner, base = [], [], [], 0
            for i, s in enumerate(spans):
                b = np.arange(0, max(1, len(s) - p.span + step), step)
                begins.append(base + b), ends.append(base + np.minimum(b + p.span, len(s))), owner.append(np.full(len(b), i))
                base += len(s)
            begins, ends, owner = np.concatenate(begins), np.concatenate(ends), np.concatenate(owner)
            bag = (total[ends] - total[begins]) / (ends - begins)[:, None]
            logits = bag @ model.weights + model.bias
            z = logits[:, 1] - logits[:, 0]
            heads = np.searchsorted(owner, np.arange(len(docs)))
            top = np.maximum.reduceat(z, heads)
            pool = np.exp(sharp * (z - top[owner]))
            pool /= np.add.reduceat(pool, heads)[owner]
            text = np.add.reduceat(pool * z, heads)
            error = (1 / (1 + np.exp(-text)) - y[docs]) / len(docs)
            dz = pool * error[owner]
            back = np.stack([-dz, dz], axis=1)
            grad_w, grad_bag = bag.T @ back, back @ model.weights.T
            model.bias -= p.rate * back.sum(axis=0)
            flow = np.zeros((len(inverse) + 1, p.dim))
            share = grad_bag / (ends - begins)[:, None]
            np.add.at(flow, begins, share)
            np.subtract.at(flow, ends, share)
            flow = np.cumsum(flow, axis=0)[:-1]
            dvec = np.stack([np.bincount(inverse, flow[:, j], len(words)) for j in range(p.dim)], axis=1) / many[:, None]
            touched, spot = np.unique(f, return_inverse=True)
            grad_v = np.stack([np.bincount(spot, np.repeat(dvec[:, j], many), len(touched)) for j in range(p.dim)], axis=1)
            square_v[touched] += (grad_v**2).mean(axis=1)
            square_w += grad_w**2
            model.vectors[touched] -= p.rate * grad_v / np.sqrt(square_v[touched])[:, None]
            model.weights -= p.rate * 0.2 * grad_w / np.sqrt(square_w)
    model.fold()
    parts = [text_logits(texts[k:z], model) for k, z in pieces(texts)]
    logit, some = (np.concatenate(x) for x in zip(*parts, strict=True))
    model.scale = _calibrate(logit[some], y[some], np.asarray(stands)[y[some]])
    model.empty = float(np.clip(1 / (1 + np.exp(-model.scale[1])), 0, 0.49))
    return model


def _calibrate(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on one number with weighted rows, by Newton steps with a small ridge."""
    weight = weight * (len(weight) / max(weight.sum(), 1e-300))
    x = np.stack([logit, np.ones_like(logit)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hess = x.T @ (x * (weight * q * (1 - q))[:, None]) + 0.05 * np.eye(2)
        at = at - np.clip(np.linalg.solve(hess, x.T @ (weight * (q - y)) + 0.05 * (at - [1.0, 0.0])), -2, 2)
    return float(max(at[0], 1e-3)), float(at[1])


def held_out(df: DataFrame):
    """True where crc32 of doc_id as text leaves no remainder by 5; false for a null doc_id."""
    return F.coalesce(F.crc32(df["doc_id"].cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitted(sample: DataFrame, p: Params, stands: tuple[float, float]) -> Model:
    """Train on the rows (draw, y, text) of a bounded sample in one task; the driver gets the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(b.column("draw").to_pylist(), b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True))
        model = train([r[1] for r in rows], [r[2] for r in rows], p, stands)
        model.vectors = None  # folded into `pull`
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    got = sample.select("draw", "text", "y").repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(got["model"]) if got else train([], [], p)


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """Train on a bounded sample of the labelled rows of `docs` that are not held out."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    known = known.where(~held_out(known)).withColumn("draw", F.xxhash64(F.lit(p.seed), "doc_id"))
    texts = docs.where(F.length("text") > 0).select("doc_id", F.xxhash64("text").alias("h"), "text")
    # the sample is drawn among labels, ids and lengths, so that texts only travel where they are wanted
    found = known.join(texts.select("doc_id", F.struct("h", F.length("text").alias("chars")).alias("t")), "doc_id").groupBy("doc_id", "y", "draw").agg(F.min("t").alias("t"))
    found = written(found.select("doc_id", F.when(F.col("y") > 0, 1).otherwise(0).alias("y"), "draw", "t.h", "t.chars"), "labelled")
    sample, stands = None, [1.0, 1.0]
    for y in (0, 1):
        of = found.where(F.col("y") == y)
        drawn = of.select("draw", "chars").orderBy("draw").limit(p.max_per_label).collect()
        if not drawn:
            continue
        many = max(1, int(np.searchsorted(np.cumsum([r["chars"] for r in drawn]), p.max_chars, side="right")))
        stands[y] = of.count() / many
        part = of.where(F.col("draw") <= drawn[many - 1]["draw"])
        sample = part if sample is None else sample.unionByName(part)
    if sample is None:
        return train([], [], p)
    wanted = F.broadcast(sample.select("doc_id", "h", "draw", "y"))  # at most max_per_label rows a label
    model = fitted(texts.join(wanted, ["doc_id", "h"]).dropDuplicates(["doc_id"]), p, tuple(stands))
    drop_written(found)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(every column of docs, score double): whole texts, in Arrow batches; a text's score depends on it alone."""
    spark = docs.sparkSession
    slim = spark.sparkContext.broadcast(Model(model.params, None, None, model.bias, model.scale, model.empty, model.pull))  # buckets x 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, most=1 << 20):
            got = pa.array(scores(batch.column("text").to_pylist(), slim.value), pa.float64())
            yield pa.RecordBatch.from_arrays([*(c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "score"), got], [*(n for n in batch.schema.names if n != "score"), "score"])

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([f for f in docs.schema.fields if f.name != "score"]).add("score", DoubleType())
    return docs.mapInArrow(run, schema)


def op5_toxicity(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    model = fit(docs, labels, p)
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """docs without those that score 0.5 or more; columns as they came."""
    names = docs.columns
    return score(docs.drop("score"), fit(docs, labels, p)).where("score < 0.5").select(*names)
