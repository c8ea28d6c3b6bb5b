"""The quality classifier: statistics in plain Python, the discriminant against densities, held-out accuracy, odd rows."""

import math
import random
import zlib

import numpy as np

from locuslake.llm import quality

D = "/root/testdata/sf0.001"


def plain(text, p=quality.Params()):
    """The statistics of one text, one character at a time."""
    text, kinds = text or "", quality.tables()[0]
    kind = [int(kinds[ord(c)]) if ord(c) < 1 << 16 else quality.MARK for c in text]
    words = "".join([" " if k == quality.SPACE else c for c, k in zip(text, kind)]).split(" ")
    words = [w for w in words if w]
    lines = [x for x in text.split("\n") if x]
    common = {w for line in p.common for w in line.split()}
    is_letter = lambda c: ord(c) < 1 << 16 and kinds[ord(c)] in (quality.LETTER, quality.CAPITAL)
    many = lambda *ks: sum(k in ks for k in kind)
    share = lambda a, b: math.log((a + 0.5) / (max(b - a, 0) + 0.5))

    def core(w):
        at = [i for i, c in enumerate(w) if is_letter(c)]
        return "".join([c.lower() if len(c.lower()) == 1 else c for c in w[at[0] : at[-1] + 1]]) if at else None

    n, solid, letters = len(words), len(text) - many(quality.SPACE), many(quality.LETTER, quality.CAPITAL)
    return [
        math.log1p(n), math.log((solid + 1) / (n + 1)), math.log((n + 1) / (len(lines) + 1)), share(letters, solid), share(many(quality.CAPITAL), letters), share(many(quality.DIGIT), solid),
        share(many(quality.MARK), solid), share(many(quality.STOP), n), math.log((len({*words}) + 1) / (n + 1)), share(sum(a == b for a, b in zip(words, words[1:])), n),
        share(len(lines) - len({*lines}), len(lines)), share(sum(core(w) in common for w in words), n), share(sum(core(w) is None for w in words), n), share(sum(len(w) > 20 for w in words), n),
    ]


def test_statistics_equal_plain_python():
    rng = random.Random(4)
    texts = [None, "", " ", "\n\n", "a", "The the THE", "x" * 50, "😀 é 漢字 12.5% a|b", "same\nsame\n\nother", " lead and trail \n", "\ud800 lone", "İstanbul ǅ"]
    texts += ["".join(rng.choices("aAbé .,\n!12|the of", k=rng.randint(0, 80))) for _ in range(300)]
    got = quality.statistics(texts)
    assert np.allclose(got, [plain(t) for t in texts], atol=1e-12)
    assert np.array_equal(got[5:6], quality.statistics(texts[5:6]))  # a text's statistics do not depend on those beside it
    assert quality.statistics([]).shape == (0, len(quality.NAMES))


def test_difference_is_that_of_the_log_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(0, 1, (400, 5)) @ rng.normal(0, 1, (5, 5)) + 3 * k for k in (0, 1)]
    p = quality.Params(pool=0.2, ridge=0.1)
    m = quality.discriminant(np.array([400.0, 400.0]), np.array([a.sum(axis=0) for a in x]), np.array([a.T @ a for a in x]), p)
    both = np.concatenate(x)
    z = (both - both.mean(axis=0)) / both.std(axis=0)
    cov = [np.cov(z[400 * k : 400 * k + 400].T, bias=True) for k in (0, 1)]
    want = []
    for k in (0, 1):
        c = 0.9 * (0.8 * cov[k] + 0.2 * (cov[0] + cov[1]) / 2) + 0.1 * np.eye(5)
        gap = z - z[400 * k : 400 * k + 400].mean(axis=0)
        want.append(-0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(c), gap) - 0.5 * np.linalg.slogdet(c)[1])
    assert np.allclose(quality.difference(both, m), want[1] - want[0])
    assert ((quality.difference(both, m) > 0) == (np.arange(800) >= 400)).mean() > 0.9


def test_op13_held_out_accuracy(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.op13_quality(d, labels).collect()
    assert len(rows) == d.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    out = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in out) >= 0.97 * len(out) and sum(b == 0 for a, b in out if a == 0) >= 0.9 * sum(a == 0 for a, _ in out)
    # labels of the held-out third, lang and source change nothing
    from pyspark.sql import functions as F

    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.op13_quality(d.withColumn("source", F.lit("x")).withColumn("lang", F.lit(None).cast("string")), other).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in rows)


def test_op13_cases(spark):
    d = spark.createDataFrame([(1, "a b", "own"), (1, "c d", "own"), (None, "a b", "own"), (2, None, "own"), (3, "", "own"), (4, "X!! " * 5, "own"), (4, "X!! " * 5, "own")] + [(i, f"p{i} q", "own") for i in range(5, 30)], "doc_id long, text string, score string")
    no = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.op13_quality(d, no).collect()} == {0.5}
    for y in (0, 1):
        of_one = spark.createDataFrame([(i, y, 0) for i in range(2, 30)] + [(None, 1 - y, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
        assert {r["score"] for r in quality.op13_quality(d, of_one).collect()} == {float(y)}
    mixed = spark.createDataFrame([(i, i % 2, 0) for i in range(2, 30)] + [(4, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.op13_quality(d, mixed).collect()
    assert len(rows) == 32 and len({r["score"] for r in rows if r["doc_id"] == 4}) == 1 and len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    assert quality.op13_quality(d.where("false"), mixed).count() == 0
    model = quality.fit(quality.measured(d), mixed)
    kept = quality.score(d, model)
    assert kept.columns == ["doc_id", "text", "score"] and sorted(str(r["score"]) for r in kept.collect()) == sorted(str(r["score"]) for r in rows)
    long = spark.createDataFrame([(1, "the cat of the house " * 100_000)], "doc_id long, text string")
    assert quality.op13_quality(long, no).count() == 1
