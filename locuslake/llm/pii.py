"""PII (9): a skip-chain conditional random field over the mentions of each document.

Mentions are the base matches (email, ip, card, phone; fixed patterns with their checks) and what looks like
one: runs of digits with separators, and addresses written with or without the at sign. They are nodes
in text order. Neighbours in the text share a chain potential; each mention and the next one that repeats it
(equal characters, equal digits or equal last seven digits) share a skip potential, and so do a free mention and
the base match it repeats (the latest before it, else the first after it), however far apart they stand and
however many repeats lie between: no message has to pass through the repeats. Loopy sum-product passing over all documents of a batch at once, each until its own
messages change by less than `settled`, gives each node's belief (a document whose messages have not settled after
`rounds` says so in the query's column `settled`); base
matches are clamped to their kind, and a free node whose belief in one kind exceeds `least` becomes a span.

Weights are trained by pseudo-likelihood on the base matches of a bounded sample (the `sample` documents with mentions
of smallest hash, as far as they come to `sample_mentions` mentions), in one task: free nodes that repeat a base match are unknown there and left out, the others count as
none. Scoring reads every whole text.

Defined cases: null and empty texts have no spans (empty strings, zero counts); repeated rows return as
often as they came; a null doc_id stays; counts and base_sha256 are of base matches, spans of all.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslake.llm.shared import small_batches

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # as the pattern without possessive runs, in linear time
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+")
_BLOCK = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")  # a card's digits without separators stand alone
_AT = re.compile(r"\x20?[(\[]at[)\]]\x20?|\x20at\x20", re.IGNORECASE)
_WRITTEN = re.compile(r"[A-Za-z0-9-]+(?:(?:\x20?[(\[]dot[)\]]\x20?|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
_SPOKEN = re.compile(r"[A-Za-z0-9-]+(?:\x20dot\x20[A-Za-z0-9-]+)+", re.IGNORECASE)
_DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Params:
    sample: int = 4000
    sample_mentions: int = 100_000
    least: float = 0.5
    rounds: int = 200
    settled: float = 1e-4
    steps: int = 150
    ridge: float = 1e-3
    skip_prior: float = 3.0  # where repeats are too rare to learn from: how strongly they share a kind
    seed: int = 5


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each at sign outwards: linear where the pattern alone would be quadratic."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, end))
            at = text.find("@", end)
        else:
            end = max(end, start)
            at = text.find("@", at + 1)
    return out


def spelt(text: str) -> list[tuple[int, int]]:
    """Addresses whose at sign is written or spoken, found from the sign outwards, of any length."""
    out, end = [], 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and _LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        if end <= start < m.start() and (d := (_SPOKEN if m[0].strip().lower() == "at" else _WRITTEN).match(text, m.end())):
            end = d.end()
            out.append((start, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, by kind and start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if text.count(".") > 2:
            out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(q := p.lstrip("0")) < 4 and int(q or "0") <= 255 for p in m[0].split("."))]
        out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() > 15 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


N_FEATURES = 24 + 64


def features(text: str, start: int, end: int) -> list[int]:
    """Indices of a mention's binary features: its shape and a hash of the word before it."""
    s, d = text[start:end], _digits(text[start:end])
    n = len(d)
    size = 0 if n == 0 else 1 if n < 7 else 2 if n < 10 else 3 if n < 12 else 4 if n < 16 else 5 if n < 20 else 6
    out = [0, 1 + size]
    for k, yes in enumerate((s[0] == "+", "(" in s, "." in s, " " in s, "-" in s, "@" in s, any("a" <= c.lower() <= "z" for c in s), 16 <= n <= 19 and luhn(d), s.count(".") == 3, s.count(".") == 3 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in s.split(".")))):
        if yes:
            out.append(8 + k)
    before = re.findall(r"[A-Za-z]+", text[max(0, start - 24) : start])
    word = before[-1].lower() if before else ""
    out.append(24 + (int.from_bytes(hashlib.md5(word.encode()).digest()[:4]) % 64))
    return out


def mentions(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base matches, free mentions as (NONE, start, end) that no base match overlaps)."""
    if not text:
        return [], []
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    found = []
    for m in _NUMBER.finditer(text) if _DIGIT.search(text) else ():
        if m.end() - m.start() >= 7:
            at = m.start()
            for block in _BLOCK.finditer(text, m.start(), m.end()):
                found += [(at, block.start()), block.span()]
                at = block.end()
            found.append((at, m.end()))
    found = [(s + len(x) - len(x.lstrip(" .-")), s + len(x.rstrip(" .(-"))) for s, e in found if (x := text[s:e]).strip(" .()-")]
    low = text.lower()
    if " dot " in low or "at)" in low or "at]" in low:
        found += spelt(text)
    free, k, last = [], 0, -1
    for s, e in sorted(found):
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if (k == len(taken) or taken[k][0] >= e) and s >= last and (len(_digits(text[s:e])) >= 7 or any("a" <= c <= "z" for c in text[s:e].lower())):
            free.append((NONE, s, e))
            last = e
    return base, free


def likenesses(s: str) -> list[str]:
    """Keys under which mentions count as repeats of each other."""
    d = _digits(s)
    out = ["=" + re.sub(r"\s*(\(at\)|\[at\]| at )\s*", "@", re.sub(r"\s*(\(dot\)|\[dot\]| dot )\s*", ".", s.lower()))]
    if len(d) >= 7:
        out += ["#" + d, "~" + d[-7:]]
    return out


@dataclass
class Graph:
    """The mentions of many documents: nodes, clamped labels, features and edges."""

    doc: list
    start: list
    end: list
    label: list
    feats: list
    chain: list  # (node, next node)
    skip: list

    @staticmethod
    def empty() -> Graph:
        return Graph([], [], [], [], [], [], [])

    def add(self, doc: int, text: str | None) -> list[tuple[int, int, int]]:
        base, free = mentions(text)
        nodes = sorted(base + free, key=lambda x: (x[1], x[2], x[0]))
        keys = [likenesses(text[s:e]) for _, s, e in nodes]
        first = len(self.doc)
        match: dict[str, int] = {}  # the first base match of each key, then the latest
        for k in reversed(range(len(nodes))):
            if nodes[k][0] != NONE:
                match.update(dict.fromkeys(keys[k], first + k))
        last: dict[str, int] = {}
        skip: set[tuple[int, int]] = set()
        for k, (label, s, e) in enumerate(nodes):
            at = first + k
            self.doc.append(doc), self.start.append(s), self.end.append(e), self.label.append(label)
            self.feats.append(features(text, s, e))
            if k:
                self.chain.append((at - 1, at))
            skip |= {(last[key], at) for key in keys[k] if key in last}
            if label == NONE:
                skip |= {(min(match[key], at), max(match[key], at)) for key in keys[k] if key in match}
            else:
                match.update(dict.fromkeys(keys[k], at))
            last.update(dict.fromkeys(keys[k], at))
        self.skip += sorted(skip)
        return base


def train(feats: list[list[int]], label: np.ndarray, chain: np.ndarray, skip: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unary, chain, skip) weights by pseudo-likelihood; the likelihood of each known node given its neighbours."""
    n = len(label)
    x = np.zeros((n, N_FEATURES))
    for i, f in enumerate(feats):
        x[i, f] = 1
    unknown = np.zeros(n, bool)
    for a, b in skip:  # a free mention that repeats a base match
        unknown[a] |= label[a] == NONE and label[b] != NONE
        unknown[b] |= label[b] == NONE and label[a] != NONE
    y = np.eye(LABELS)[label]
    seen = np.where(unknown[:, None], 0.0, y)
    prior = [np.zeros((LABELS, LABELS)), np.diag([p.skip_prior] * NONE + [0.0])]
    unary, links = np.zeros((N_FEATURES, LABELS)), [w.copy() for w in prior]
    around = []
    for edges in (chain, skip):
        agg = np.zeros((n, LABELS))
        if len(edges):
            np.add.at(agg, edges[:, 1], seen[edges[:, 0]])
            np.add.at(agg, edges[:, 0], seen[edges[:, 1]])
        around.append(agg)
    known, count = ~unknown, max(1, (~unknown).sum())
    velocity = [np.zeros_like(unary), *(np.zeros_like(w) for w in links)]
    for _ in range(p.steps):
        z = x @ unary + around[0] @ links[0] + around[1] @ links[1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = (z / z.sum(axis=1, keepdims=True) - y) * known[:, None] / count
        grads = [x.T @ g + p.ridge * unary, *(a.T @ g + p.ridge * (w - w0) for a, w, w0 in zip(around, links, prior, strict=True))]
        for k, grad in enumerate(grads):
            grad = (grad + grad.T) / 2 if k else grad  # an edge has no direction
            velocity[k] = 0.9 * velocity[k] - 0.5 * grad
        unary += velocity[0]
        links[0] += velocity[1]
        links[1] += velocity[2]
    return unary, links[0], links[1]


def beliefs(g: Graph, weights: tuple[np.ndarray, np.ndarray, np.ndarray], p: Params = Params()) -> tuple[np.ndarray, set[int]]:
    """Loopy sum-product beliefs of every node, and the documents whose messages did not settle. All documents of the graph pass messages at once, each until its own
    have settled, so that what a document gets does not depend on those beside it."""
    unary, chain, skip = weights
    label, doc = np.asarray(g.label), np.asarray(g.doc)
    length = [len(f) for f in g.feats]
    own = np.add.reduceat(unary[np.concatenate([np.asarray(f) for f in g.feats])], np.cumsum(length) - length, axis=0)
    own = np.where((label != NONE)[:, None], np.where(np.eye(LABELS, dtype=bool)[label], 0.0, -50.0), own)
    m = len(g.chain) + len(g.skip)
    edges = np.array(g.chain + g.skip, dtype=np.int64).reshape(-1, 2)
    src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    kind = np.tile(np.arange(m) >= len(g.chain), 2).astype(np.int64)
    pairs = np.stack([chain, skip])
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    msg, live = np.zeros((2 * m, LABELS)), np.arange(2 * m)
    for _ in range(p.rounds):
        if not len(live):
            break
        total = own.copy()
        np.add.at(total, dst[live], msg[live])
        # an edge has no direction: its potential is symmetric
        out = (total[src[live]] - msg[back[live]])[:, :, None] + pairs[kind[live]]
        top = out.max(axis=1, keepdims=True)
        out = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new = 0.5 * msg[live] + 0.5 * (out - out.max(axis=1, keepdims=True))
        moved = np.zeros(doc.max() + 1)
        np.maximum.at(moved, doc[src[live]], np.abs(new - msg[live]).max(axis=1))
        msg[live] = new
        live = live[moved[doc[src[live]]] >= p.settled]
    total = own
    np.add.at(total, dst, msg)
    total = np.exp(total - total.max(axis=1, keepdims=True))
    return total / total.sum(axis=1, keepdims=True), {*doc[src[live]].tolist()}


def find(texts: list[str | None], weights, p: Params) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], bool]]:
    """(base matches, all spans, whether its messages settled) of each text, spans as (kind, start, end) by kind and start."""
    g = Graph.empty()
    base = [g.add(i, t) for i, t in enumerate(texts)]
    added: dict[int, list] = {}
    moving: set[int] = set()
    if g.doc and NONE in g.label:
        belief, moving = beliefs(g, weights, p)
        belief = belief[:, :NONE]
        for i in np.flatnonzero((np.asarray(g.label) == NONE) & (belief.max(axis=1) > p.least)):
            added.setdefault(g.doc[i], []).append((int(belief[i].argmax()), g.start[i], g.end[i]))
    return [(b, sorted(b + added[i]) if i in added else b, i not in moving) for i, b in enumerate(base)]


def fit(docs: DataFrame, p: Params = Params()):
    """Weights from the sample. Texts stay where they are: labels, features and links of the sample go to one task, weights to the driver."""
    # the sample's largest draw is found among draws alone, so that no text is sorted or shuffled
    drawn = docs.select(F.xxhash64(F.lit(p.seed), "doc_id", "text").alias("draw"), "text").where(F.col("text").rlike("[0-9]{2}|@"))
    cut = drawn.select("draw").distinct().orderBy("draw").limit(p.sample).agg(F.max("draw")).first()[0]
    drawn = drawn.where(F.col("draw") <= F.lit(cut).cast("long"))

    def graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for draw, text in zip(batch.column("draw").to_pylist(), batch.column("text").to_pylist(), strict=True):
                g = Graph.empty()
                g.add(0, text)
                if g.label:
                    rows.append((draw, pickle.dumps((g.label, g.feats, g.chain, g.skip))))
            cols = list(zip(*rows, strict=True)) if rows else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], ["draw", "graph"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, feats, chain, skip = [], [], [], []
        for graph in (g.as_py() for batch in batches for g in batch.column("graph")):
            one = pickle.loads(graph)
            at = len(label)
            if at and at + len(one[0]) > p.sample_mentions:
                break
            label += one[0]
            feats += one[1]
            chain += [(a + at, b + at) for a, b in one[2]]
            skip += [(a + at, b + at) for a, b in one[3]]
        edges = lambda e: np.array(e, dtype=np.int64).reshape(-1, 2)
        if label:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(feats, np.asarray(label), edges(chain), edges(skip), p))], pa.binary())], ["weights"])

    found = drawn.mapInArrow(graphs, "draw long, graph binary").dropDuplicates(["draw"]).repartition(1).sortWithinPartitions("draw")
    got = found.mapInArrow(learn, "weights binary").first()
    if got is None:
        return np.zeros((N_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))  # no mention in the sample, no added span
    return pickle.loads(got["weights"])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for k, s, e in spans])


def op9_pii(docs: DataFrame, p: Params = Params()) -> DataFrame:
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, p))  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = find(batch.column("text").to_pylist(), weights.value, p)
            counts = [pa.array([sum(k == kind for k, _, _ in base) for base, _, _ in found], pa.int64()) for kind in range(NONE)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b, _, _ in found]), pa.array([_joined(a) for _, a, _ in found]), pa.array([s for _, _, s in found])], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "settled"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, settled boolean")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """text with each span replaced by its kind in angle brackets; of spans that overlap, their union by the first's kind."""
    out, at = [], 0
    merged: list[list[int]] = []
    for k, s, e in sorted(spans, key=lambda x: (x[1], x[0])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([k, s, e])
    for k, s, e in merged:
        out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """docs with every span masked and n_chars (where there is one) the new length; null texts stay null."""
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            clean = [t if t is None or not spans else masked(t, spans) for t, (_, spans, _) in zip(texts, find(texts, weights.value, p), strict=True)]
            put = dict(zip(batch.schema.names, batch.columns, strict=True))
            put["text"] = pa.array(clean, pa.string())
            if "n_chars" in put:
                put["n_chars"] = pa.array([None if t is None else len(t) for t in clean], pa.int64()).cast(put["n_chars"].type)
            yield pa.RecordBatch.from_arrays([*put.values()], [*put])

    return docs.mapInArrow(run, docs.schema)
