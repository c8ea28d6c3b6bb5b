"""Quality classifier (13): regularised quadratic discriminant over transformed document statistics.

A text's statistics (numbers and shares of words, letters, capitals, digits, marks, lines, repeats, common words) are worked out
over the whole text; shares enter by their logit, numbers by their logarithm. Each class has a mean and a
covariance, shrunk towards the covariance both share and towards the identity. They come from sums over all labelled
rows outside the held-out third, combined before the shuffle: nothing is sampled, and only sums come to the driver. A text's
score is the difference of the two Mahalanobis log-densities, worked out by forward substitution in each class's Cholesky
factor (made once and broadcast), and calibrated by a logistic regression over counts of that difference by label.

Defined cases: a null or empty text has the statistics of no words and is scored by them; a null doc_id is scored, never learned
from, and counts as not held out; of rows with one doc_id, one text (that of smallest hash) is learned from; a doc_id
labelled both ways is not learned from; with labels of one kind every score is that kind's (1 or 0), without labels 0.5; repeated rows get
equal scores; an empty table gives no rows; extra columns are ignored by the query and kept by `score`. A text is held whole by its task, with
some hundred bytes for each character.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from locuslake.llm.bytewords import mix, powers
from locuslake.llm.shared import drop_written, small_batches, written

#: Words that are common in running text of the languages at hand.
COMMON = (
    "the of and to in a is that it was for on with as are be this by an at or from not have but",
    "le la les de des du et un une en est que qui dans pour par sur au aux ne pas ce il elle",
    "der die das und von ist nicht den dem ein eine mit zu im für auf sich des auch es als",
    "el los las y una por con del se su para como no más lo al que",
)
SPACE, LETTER, CAPITAL, DIGIT, STOP, POINT, MARK = range(7)
NAMES = ("words", "word_length", "line_length", "letters", "capitals", "digits", "marks", "stops", "kinds", "echoes", "same_lines", "common", "bare", "long")


@dataclass(frozen=True)
class Params:
    common: tuple[str, ...] = COMMON
    pool: float = 0.1  # share of the common covariance in a class's
    ridge: float = 0.01  # share of the identity, where statistics have unit variance
    step: float = 0.25  # width of the counts' bins of log-density differences
    reach: float = 200.0  # their ends


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(class, lower case) of each code point of the basic plane; the other planes count as marks."""
    kind = np.full(1 << 16, MARK, np.uint8)
    low = np.arange(1 << 16, dtype=np.uint32)
    for k in range(1 << 16):
        c, category = chr(k), unicodedata.category(chr(k))
        if c.isspace():
            kind[k] = SPACE
        elif category[0] in "LM":
            kind[k] = CAPITAL if category in ("Lu", "Lt") else LETTER
            if len(c.lower()) == 1:
                low[k] = ord(c.lower())
        elif category[0] == "N":
            kind[k] = DIGIT
        elif c in ".?;:":
            kind[k] = STOP
        elif c in ",'\"()-’":
            kind[k] = POINT
    return kind, low


def hashed(code: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run code[start : start + length], the same wherever the run stands."""
    if not len(start):
        return np.zeros(0, np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    data = code[np.repeat(start, length) + place].astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(data * powers(int(length.max()) + 1)[place], first) + length.astype(np.uint64))


@functools.cache
def common_hashes(p: Params) -> np.ndarray:
    words = sorted({w for line in p.common for w in line.split()})
    code, length = np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), np.array([len(w) for w in words])
    return hashed(code, np.cumsum(length) - length, length)


def runs(inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of True that do not cross a text's first character."""
    before = np.concatenate([[False], inside[:-1]])
    before[first[first < len(inside)]] = False
    start = np.flatnonzero(inside & ~before)
    # a run ends where the next character is outside or begins another text
    after = np.concatenate([inside[1:], [False]])
    edge = first[(first > 0) & (first <= len(inside))] - 1
    after[edge] = False
    return start, np.flatnonzero(inside & ~after) - start + 1


def kinds_of(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each owner."""
    _, at = np.unique(mix(hashes + mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(owner[at], minlength=n)


def statistics(texts: list[str | None], p: Params = Params()) -> np.ndarray:
    """texts x len(NAMES): transformed statistics of whole texts."""
    texts = [t or "" for t in texts]
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size) - size
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    kinds, lower = tables()
    low_plane = code < 1 << 16
    short = np.where(low_plane, code, 0)
    kind = np.where(low_plane, kinds[short], np.uint8(MARK))
    n = len(texts)

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[first + size] - sums[first]

    letter = (kind == LETTER) | (kind == CAPITAL)
    start, length = runs(kind != SPACE, first)
    owner = np.searchsorted(first + size, start, side="right")
    words = np.bincount(owner, minlength=n)
    hashes = hashed(code, start, length)
    echo = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    sums = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    filled = np.flatnonzero(sums[start + length] > sums[start])
    # the core of a word reaches from its first letter to its last
    where = np.flatnonzero(letter)
    head = where[sums[start[filled]]] if len(filled) else np.zeros(0, np.int64)
    tail = where[sums[(start + length)[filled]] - 1] if len(filled) else np.zeros(0, np.int64)
    core = hashed(np.where(low_plane, lower[short], code), head, tail - head + 1)
    known = np.isin(core, common_hashes(p))
    at, lengths = runs(code != 10, first)
    line = np.searchsorted(first + size, at, side="right")
    lines = np.bincount(line, minlength=n)
    spaces, letters = total(kind == SPACE), total(letter)
    solid = size - spaces
    by_word = lambda rows: np.bincount(owner[rows], minlength=n)
    share = lambda part, whole: np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))
    out = {
        "words": np.log1p(words), "word_length": np.log((solid + 1) / (words + 1)), "line_length": np.log((words + 1) / (lines + 1)),
        "letters": share(letters, solid), "capitals": share(total(kind == CAPITAL), letters), "digits": share(total(kind == DIGIT), solid),
        "marks": share(total(kind == MARK), solid), "stops": share(total(kind == STOP), words),
        "kinds": np.log((kinds_of(owner, hashes, n) + 1) / (words + 1)), "echoes": share(by_word(np.flatnonzero(echo) + 1), words),
        "same_lines": share(lines - kinds_of(line, hashed(code, at, lengths), n), lines), "common": share(by_word(filled[known]), words),
        "bare": share(words - by_word(filled), words), "long": share(by_word(length > 20), words),
    }
    return np.stack([out[name] for name in NAMES], axis=1)


def measured(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, h, x): statistics of each row's whole text, h its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, most=1 << 20):
            x = statistics(batch.column("text").to_pylist(), p)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), lists], ["doc_id", "h", "x"])

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h long, x array<double>")


@dataclass
class Model:
    center: np.ndarray | None = None  # of all rows
    scale: np.ndarray | None = None
    means: list[np.ndarray] | None = None  # of label 0 and 1, in units of scale
    factors: list[np.ndarray] | None = None  # Cholesky factors of their covariances
    line: tuple[float, float] = (1.0, 0.0)  # log-density difference to logit
    always: float | None = None  # the score where there is nothing to tell apart


def forward(factor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """z with factor z = row for each row, column by column: a row's result depends on it alone."""
    z = np.empty_like(rows)
    for i in range(len(factor)):
        left = rows[:, i].copy()
        for j in range(i):
            left -= factor[i, j] * z[:, j]
        z[:, i] = left / factor[i, i]
    return z


def difference(x: np.ndarray, m: Model) -> np.ndarray:
    """Log-density of label 1 less that of label 0."""
    rows, out = (x - m.center) / m.scale, []
    for mean, factor in zip(m.means, m.factors, strict=True):
        z = forward(factor, rows - mean)
        square = np.zeros(len(z))
        for i in range(z.shape[1]):
            square += z[:, i] * z[:, i]
        out.append(-0.5 * square - np.log(np.diag(factor)).sum())
    return out[1] - out[0]


def scores(x: np.ndarray, m: Model, p: Params = Params()) -> np.ndarray:
    if m.always is not None:
        return np.full(len(x), m.always)
    return 1 / (1 + np.exp(-np.clip(m.line[0] * np.clip(difference(x, m), -p.reach, p.reach) + m.line[1], -60, 60)))


def discriminant(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, p: Params = Params()) -> Model:
    """The model of two classes from their numbers of rows, sums and sums of products."""
    center = sums.sum(axis=0) / n.sum()
    spread = np.diag(squares.sum(axis=0)) / n.sum() - center**2
    scale = np.sqrt(np.maximum(spread, 1e-12))
    means, covariances = [], []
    for k in (0, 1):
        mean = sums[k] / n[k]
        covariances.append((squares[k] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - center) / scale)
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / n.sum()
    shrunk = [(1 - p.ridge) * ((1 - p.pool) * c + p.pool * pooled) + p.ridge * np.eye(len(center)) for c in covariances]
    return Model(center, scale, means, [np.linalg.cholesky(c) for c in shrunk])


def held_out(df: DataFrame):
    """True where crc32 of doc_id as text leaves 1 by 3; false for a null doc_id."""
    return F.coalesce(F.crc32(df["doc_id"].cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(y, x): the statistics of every labelled doc_id that is not held out."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z")
    known = known.where(~held_out(known)).select("doc_id", F.when(F.col("y") > 0, 1).otherwise(0).alias("y"))
    return rows.join(known, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("h", "x")).alias("t")).select("y", "t.x")


def fit(rows: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """From measured rows and labels: sums of both classes, then counts for the calibration."""
    learned = written(labelled(rows, labels), "learned")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, held = len(NAMES), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = batch.column("x").flatten().to_numpy().reshape(-1, d), batch.column("y").to_numpy()
            for k in (0, 1):
                mine = x[y == k]
                put = np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()])
                held[k] = held[k] + put if k in held else put
        for k, put in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(put), k, np.int32)), pa.array(np.arange(len(put), dtype=np.int32)), pa.array(put)], ["y", "i", "v"])

    d = len(NAMES)
    total = np.zeros((2, 1 + d + d * d))
    for r in learned.mapInArrow(sums, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).collect():  # 2 (1 + d + d d) numbers
        total[r["y"], r["i"]] = r["v"]
    n = total[:, 0]
    if not n.all():
        drop_written(learned)
        return Model(always=0.5 if not n.any() else float(n[1] > 0))
    model = discriminant(n, total[:, 1 : d + 1], total[:, d + 1 :].reshape(2, d, d), p)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = difference(batch.column("x").flatten().to_numpy().reshape(-1, d), model)
                yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(np.round(np.clip(s, -p.reach, p.reach) / p.step).astype(np.int32))], ["y", "bin"])

    seen = learned.mapInArrow(counts, "y int, bin int").groupBy("y", "bin").count().collect()  # 2 x 2 reach / step at most
    model.line = calibrated(np.array([r["bin"] * p.step for r in seen]), np.array([r["y"] for r in seen]), np.array([r["count"] for r in seen], float))
    drop_written(learned)
    return model


def calibrated(s: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on one number with weighted rows, by Newton steps with a small ridge."""
    x, at = np.stack([s / 10, np.ones_like(s)], axis=1), np.zeros(2)
    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hess = x.T @ (x * (weight * q * (1 - q))[:, None]) + 0.5 * np.eye(2)
        at = at - np.clip(np.linalg.solve(hess, x.T @ (weight * (q - y)) + 0.5 * at), -2, 2)
    return float(max(at[0] / 10, 1e-6)), float(at[1])


def score(docs: DataFrame, model: Model, p: Params = Params()) -> DataFrame:
    """(every column of docs, score): whole texts, measured and scored in one pass."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, most=1 << 20):
            got = pa.array(scores(statistics(batch.column("text").to_pylist(), p), spread.value, p))
            yield pa.RecordBatch.from_arrays([*(c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "score"), got], [*(n for n in batch.schema.names if n != "score"), "score"])

    return docs.mapInArrow(run, StructType([f for f in docs.schema.fields if f.name != "score"]).add("score", DoubleType()))


def op13_quality(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """Every text is measured once; the model is fitted on, and applied to, the written statistics."""
    rows = written(measured(docs, p), "measured")
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(x, model.value, p))], ["doc_id", "score"])

    out = rows.select("doc_id", "x").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", held_out(out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
