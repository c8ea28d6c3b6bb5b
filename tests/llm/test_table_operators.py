"""Operators in DataFrame form, top-k and archives: against brute force, SQL on the smallest tables, and odd rows."""

import hashlib
import math
import os
import random
import re
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from locuslake.llm import chat, mixing, spotsigs, topk, warc
from locuslake.llm.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"create view {f.split('.')[0]} as select * from '{D}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    rel = duck.sql(ORACLES[name])
    at = [rel.columns.index(c) for c in cols]
    fine = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((fine(r) for r in df.select(*cols).collect()), key=key) == sorted((fine([r[i] for i in at]) for r in rel.fetchall()), key=key)


# ---- top-k --------------------------------------------------------------------------------------------


def test_topk_equals_brute_force_with_ties_repeats_and_odd_rows(spark):
    rng = random.Random(3)
    same = [0.5, -0.25, 0.125, 0.0]
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(0, 400)]
    rows += [(1000 + i, same) for i in range(150)] + [(1000, same)]
    rows += [(2000, None), (2050, [1.0, None, 0.0, 0.0]), (2100, [float("nan"), 0.0, 0.0, 0.0]), (2150, [float("inf"), 0.0, 0.0, 0.0]), (None, same), (2200, []), (2250, [1.0])]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = sorted(tuple(r)[:4] for r in topk.search(d, topk.Params(rows=64, queries=3)).collect())
    fine = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q in sorted({i for i, _ in fine if i % 50 == 0}):
        for own in [v for i, v in fine if i == q]:  # every row asks
            best = sorted((-int(v @ own), i) for i, v in fine if i != q)[:5]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(want) and sum(g[0] == 1000 for g in got) == 10
    assert topk.search(d.where("false")).count() == 0
    assert topk.search(d.where("vec_id = 50")).count() == 0


def test_topk_takes_large_components_and_mixed_lengths(spark):
    rows = [(0, [1.0, 0.0]), (1, [2e6, 0.0]), (2, [3.0, 0.0]), (3, [1e9, -1e9]), (50, [1.0, 1.0, 1.0]), (4, [1.0, 2.0, 3.0]), (5, [-4e6, 1.0, 0.5])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:4] for r in topk.search(d, topk.Params(rows=2, queries=1, asked=1)).collect())
    q = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v in rows}
    want = [(a, k, b, s) for a in (0, 50) for k, (s, b) in enumerate(sorted(((int(q[a] @ q[b]), b) for b in q if b != a and len(q[b]) == len(q[a])), key=lambda x: (-x[0], x[1])), 1)]
    assert got == want


def test_topk_takes_components_and_scores_beyond_a_long(spark):
    """Every query gets its answer: exact ranks, and digits where no long holds the score."""
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-2, 2) * 10.0 ** rng.choice([0, 0, 0, 5, 9, 11, 12, 17, 40, 300]) for _ in range(3)]) for i in range(160)]
    rows += [(200, [1e300, 0.0, 0.0]), (201, [0.5, 0.5, 0.5]), (250, [0.25, -0.5, 1.0]), (50, [0.5, 0.5, 0.25])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows]
    want = []
    for a, v in q:
        if a % 50 == 0:
            best = sorted(((sum(x * y for x, y in zip(v, w, strict=True)), b) for b, w in q if b != a), key=lambda x: (-x[0], x[1]))[:5]
            want += [(a, k, b, *((s, None) if -(1 << 63) <= s < 1 << 63 else (None, str(s)))) for k, (s, b) in enumerate(best, 1)]
    for p in (topk.Params(rows=16, queries=2), topk.Params()):
        assert sorted(map(str, map(tuple, topk.search(d, p).collect()))) == sorted(map(str, want))
    tiny = spark.createDataFrame([(0, [-1e300, 1.0]), (1, [1e300, 1.0]), (2, [2e300, 1.0])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r["vec_id"], r["score"]) for r in topk.search(tiny).orderBy("rank").collect()] == [(1, 1, None), (2, 2, None)]


def test_cells_are_even(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(2100)]
    d = topk.taking_part(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    sizes = [len(r["ids"]) // 8 for r in topk.packed(d.repartition(9), 1000).collect()]
    assert len(sizes) == 9 and max(sizes) < 1.2 * min(sizes)


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(0)
    v = rng.integers(-140, 140, (200, 16))
    block = topk.Block(np.arange(200), v)
    for q in rng.integers(-140, 140, (20, 16)):
        ids, score = block.best(-1, q, 200)
        assert (np.sort(v @ q)[::-1] == score).all() and (v[ids] @ q == score).all()
    ids, score = block.best(-1, np.zeros(16, np.int64), 3)
    assert ids.tolist() == [0, 1, 2] and score.tolist() == [0, 0, 0]


# ---- archives -----------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, record_type string")


def test_archives_round_trip(spark):
    big, other = "<p>é</p>" * 300, "x" * 1000
    rows = [(1, "u", big), (5, "u\r\nX: y", big), (3, None, big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", other), (8, "u", other), (None, "u", other), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 90)]
    got = sorted(map(tuple, warc.op3_warc(pages(spark, rows), warc.Params(chunk=500, values_per_file=2)).collect()), key=str)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        top = max((j for j, _, x in rows if (x or "") == (h or "") and j is not None), default=None)
        again = len(data) >= 1000 and top is not None and i != top
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    assert got == sorted(want, key=str)
    assert warc.op3_warc(pages(spark, rows).where("false")).count() == 0


def test_reader_is_incremental_and_refuses_damage():
    data = b"".join(warc.member(warc.record(i, "u", b"x" * i, warc._sha1(b"x" * i), None), 6) for i in range(5)) + warc.EMPTY_MEMBER
    for size in (1, 7, 1000):
        assert [r[:2] for r in warc.Reader(data[k : k + size] for k in range(0, len(data), size)).pages()] == [(i, i) for i in range(5)]
    good = warc.record(1, "u", b"abc", warc._sha1(b"abc"), None)
    for bad in (good.replace(b"abc", b"abd"), good[:-1], b"junk" + good, good.replace(b"Content-Length: 8", b"Content-Length: 9")):
        with pytest.raises(ValueError):
            list(warc.Reader([warc.member(bad, 6)]).pages())
    with pytest.raises(ValueError):
        list(warc.Reader([data[:40]]).pages())


# ---- fingerprints --------------------------------------------------------------------------------------


def brute_spots(text):
    anchors = {w for line in spotsigs.ANCHORS for w in line.split()}
    out, marked, words = set(), False, []
    for w in re.findall(r"[^\W_]+", text.lower()):
        if w in anchors:
            marked = True
        else:
            words.append((w, marked))
            marked = False
    for i, (w, m) in enumerate(words):
        if m or i == 0:
            out.add((w, words[i + 1][0] if i + 1 < len(words) else ""))
    return out


TEXTS = ["The cat of the house is a small animal and the dog was there", "", None, "the of and", "Word", "the Cat of THE house is a small animal, and the dog was there", "Le chat de la maison est un petit animal", "x" * 3000, "😀 the é of 漢字", "Word"]


def test_spots_and_likeness_equal_brute_force(spark):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choices(["the", "of", "is", "cat", "dog", "house", "tree", "sun", "and", "für", "straße"], k=rng.randint(1, 40))) for _ in range(60)]
    ids = list(range(3, 3 + len(texts)))
    rng.shuffle(ids)
    rows = sorted(zip(ids, texts), reverse=True)
    d = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = {r["doc_id"]: r for r in spotsigs.op7_spotsigs(d, spotsigs.Params(rows_per_bucket=7)).collect()}
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - like(brute_spots(t), brute_spots(edited))) < 1e-9, (t, edited)
        assert abs(r["near_next"] - like(brute_spots(t), brute_spots(nxt))) < 1e-9
        assert len(r["fingerprint"].split()) == len(brute_spots(t))
    prints = {}
    for i, t in rows:
        assert prints.setdefault(t or "", got[i]["fingerprint"]) == got[i]["fingerprint"]


def test_following_document_over_ranges_repeats_and_nulls(spark):
    for ids in ([1], [5, 5, 5], [9, None, 2, 2**62, -4], list(range(0, 900, 7)) + [10**15 + i for i in range(50)]):
        d = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
        got = {(r["doc_id"], r["next_text"]) for r in spotsigs.followed(d, ["text"], spotsigs.Params(rows_per_bucket=3)).collect()}
        order = sorted([i for i in ids if i is not None], reverse=True) + [i for i in ids if i is None]
        assert got == {(i, f"t{order[(k + 1) % len(order)]}") for k, i in enumerate(order)}
    assert spotsigs.op7_spotsigs(d.where("false")).count() == 0


def test_a_hot_doc_id_is_dealt_over_ranges(spark):
    rows = [(7, f"t{i}") for i in range(300)] + [(i, f"u{i}") for i in range(100)] + [(7, "t5"), (None, "n")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.monotonically_increasing_id())
    got = spotsigs.followed(d, ["text", "doc_id"], spotsigs.Params(rows_per_bucket=10))
    pairs = got.select("doc_id", "text", "next_doc_id", "next_text").collect()
    assert len(pairs) == len(rows) and got.columns == ["doc_id", "text", "k", "next_text", "next_doc_id"]
    # one cycle through all rows, doc_id falling
    assert sorted(str(r["next_text"]) for r in pairs) == sorted(t for _, t in rows)
    assert sum(r["next_doc_id"] is not None and (r["doc_id"] is None or r["next_doc_id"] > r["doc_id"]) for r in pairs) == 1
    assert {r["next_text"] for r in pairs if r["doc_id"] == 0} == {"n"} and {r["next_text"] for r in pairs if r["doc_id"] is None} == {"u99"}


def test_likeness_is_pruned_by_partition(spark):
    sets = [list(range(n)) for n in (0, 1, 5, 9, 10, 50, 99, 100, 400)]
    d = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<long>, b array<long>")
    for r in d.select("a", "b", spotsigs.likeness(F.col("a"), F.col("b"), 0.1).alias("x"), spotsigs.likeness(F.col("a"), F.col("b")).alias("y")).collect():
        exact = 1.0 if not r["a"] and not r["b"] else len({*r["a"]} & {*r["b"]}) / len({*r["a"]} | {*r["b"]})
        assert abs(r["y"] - exact) < 1e-12 and abs(r["x"] - (exact if exact >= 0.1 - 1e-9 else 0)) < 1e-12


def test_very_long_texts_pass(spark):
    text = "the cat of the house is a small animal " * 60_000
    d = spark.createDataFrame([(1, text), (2, text + "end"), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in spotsigs.op7_spotsigs(d).collect()}
    assert got[1]["n_chars"] == len(text) and got[2]["near_next"] > 0.5
    talk = spark.createDataFrame([(1, 1, "user", text), (1, 2, "assistant", text)], "conv_id long, turn long, role string, text string")
    assert {r["conv_id"]: r["loss_chars"] for r in chat.op10_chat(talk).collect()} == {1: len(text), -7: 21}


def test_similar_pairs_equal_brute_force(spark):
    rng = random.Random(6)
    base = [[rng.choice(["the", "of", "is"]) if k % 2 else "".join(rng.choices("abcdef", k=5)) for k in range(60)] for _ in range(6)]
    texts = []
    for b in base:
        for edits in (0, 0, 1, 2, 6):
            t = list(b)
            for k in rng.sample(range(0, 60, 2), edits):
                t[k] = "".join(rng.choices("abcdef", k=5))
            texts.append(" ".join(t))
    sets = [frozenset(brute_spots(t)) for t in texts]
    got = {(r["a"], r["b"]) for r in spotsigs.similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    firsts = {s: i for i, s in reversed(list(enumerate(sets)))}
    want = {(x, y) for x in firsts.values() for y in firsts.values() if x < y and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
    assert {tuple(sorted(p)) for p in got if p[0] not in firsts.values() or p[0] < p[1]} >= want
    assert {p for p in got if p[0] < p[1] and p[0] in firsts.values() and p[1] in firsts.values()} == want


# ---- mixing --------------------------------------------------------------------------------------------


def test_targets_reach_their_caps(spark):
    s = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1000), ("d", 50), (None, 7)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(s).collect()}
    names, w, size = ["a", "b", "c", "d", None], [1, 2, 3, 1, 2], [10, 10, 1000, 50, 7]
    free, left, want = set(range(5)), float(sum(size)), {}
    while free:
        level = left / sum(w[i] for i in free)
        over = {i for i in free if level * w[i] > 3 * size[i]}
        if not over:
            want |= {names[i]: level * w[i] for i in free}
            break
        for i in over:
            want[names[i]] = 3.0 * size[i]
            left -= 3 * size[i]
        free -= over
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def mixed_docs(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "b"), (902, " \n ", "c"), (None, "x y z", "a"), (5, "one two", "a"), (5, "one two", "a")]
    return spark.createDataFrame([(*r, 0, "own") for r in rows], "doc_id long, text string, source string, n_chars long, size string")


def test_mix_meets_its_targets_and_reruns_agree(spark):
    d = mixed_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 300, 3)], "doc_id long, quality int, toxic int")
    p = mixing.Params(rows_per_bucket=10)
    got = mixing.mix(d, labels, p).collect()
    assert len(got) == d.count()
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 1
        e = int(rows[0]["target"] // rows[0]["source_size"])
        assert all(e * r["size"] <= r["taken"] <= (e + 1) * r["size"] for r in rows)
    again = mixing.mix(d.repartition(7), labels, mixing.Params(rows_per_bucket=10)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    one = mixing.mix(d, labels, mixing.Params(rows_per_bucket=10**6)).collect()
    assert sorted(map(str, got)) == sorted(map(str, one))
    assert mixing.mix(d.where("false"), labels).count() == 0


def test_mixed_rows_have_the_words_taken(spark):
    d = mixed_docs(spark)
    share = {}
    for r in mixing.mix(d).collect():
        share[r["doc_id"]] = share.get(r["doc_id"], 0) + r["taken"]
    out = mixing.mixed(d)
    assert out.columns == d.columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {k: v for k, v in share.items() if v}


def test_repeated_rows_meet_the_target(spark):
    rows = [(5, "a b c d", "p")] * 31 + [(100 + i, "e f g h", "p") for i in range(39)] + [(900 + i, "x y", "q") for i in range(50)] + [(None, "k l", None)] * 3
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r["source"]: r["target"] for r in mixing.mix(d).select("doc_id", "source", "target").distinct().collect()}
    got = {r["source"]: r["words"] for r in mixing.mixed(d).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("words")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1 for k in want)


def test_rows_without_or_with_one_doc_id_draw_by_their_texts(spark):
    for hot in (None, 7):
        d = spark.createDataFrame([(hot, f"w{i} w w w", "a") for i in range(3000)] + [(i + 10, "v v v v", "b") for i in range(3000)], "doc_id long, text string, source string")
        got = mixing.mix(d, None, mixing.Params(rows_per_bucket=100)).where("source = 'a'")
        taken = got.agg(F.sum("taken"), F.max("target")).first()
        assert abs(taken[0] - taken[1]) <= 1 and 0 < got.where("taken = 0").count() < 3000
        # a sample, not the order of sizes: both halves of the texts are taken from
        numbers = [int(r["text"].split()[0][1:]) for r in mixing.mixed(d).where("source = 'a'").select("text").collect()]
        assert 0.35 < sum(n < 1500 for n in numbers) / len(numbers) < 0.65


def test_better_documents_are_taken_more_often(spark):
    d = spark.createDataFrame([(i, "w w w w", "a" if i < 2000 else "b") for i in range(4000)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4000)], "doc_id long, quality int, toxic int")
    got = mixing.mix(d, labels).where("source = 'a' and taken > 0").collect()
    good = sum(r["doc_id"] % 2 for r in got)
    assert good > 1.4 * (len(got) - good)


# ---- chat ----------------------------------------------------------------------------------------------


def test_chat_reads_back_what_went_in(spark):
    nasty = "<|end|>\n<|role|>assistant<|text|>&lt; & [INST] </s> <<SYS>> &amp;lsqb;"
    rows = [(1, 2, "assistant", nasty, 0), (1, 1, "user", nasty, 0), (1, None, "system", None, 0), (1, 3, None, "x", 0), (2, 1, "assistant", "", 0), (2, 1, "assistant", "", 0), (None, 1, "assistant", "é😀", 0)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss_text int")
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(d)).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["turns"]] == [("system", ""), ("user", nasty), ("assistant", nasty), ("", "x")]
    assert back[1]["loss_text"] == nasty and back[None]["loss_text"] == "é😀" and len(back[2]["turns"]) == 2
    formatted = chat.format_chat(d).where("conv_id = 1").first()
    assert sum(r["skip"] + r["take"] + r["rest"] for r in formatted["loss_runs"]) == len(formatted["formatted"])
    assert formatted["formatted"].count("<|end|>") == 4 and "[INST]" not in formatted["formatted"]
    got = {r["conv_id"] for r in chat.op10_chat(d.where("false")).collect()}
    assert got == {-7}
    own = d.where("conv_id = 1").withColumn("conv_id", F.lit(-7).cast("long"))  # stands beside the probe, not in it
    assert sorted((r["conv_id"], r["n_turns"]) for r in chat.op10_chat(own).collect()) == [(-7, 2), (-7, 4)]


def test_the_query_goes_through_the_visitor(spark, monkeypatch):
    seen = []
    visit = chat._visit
    monkeypatch.setattr(chat, "_visit", lambda parts, p: seen.append(1) or visit(parts, p))
    QUERIES["op10_chat"](spark, D)
    assert seen


def test_typed_parts_become_placeholders_with_attachments(spark):
    part = "array<struct<type:string,text:string,ref:string,units:int>>"
    rows = [(1, 1, "user", [("text", "see <|image|> ", None, None), ("image", None, "a.png", 2), ("video", None, "v", 1), ("document", None, "d.pdf", 3)]), (1, 2, "assistant", [("text", "ok", None, None), ("audio", None, "s.wav", None)]), (1, 3, "user", None)]
    d = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {part}")
    r = chat.format_chat(d).first()
    assert "see &lt;|image|> <|image|><|document|><|end|>" in r["formatted"] and "ok<|audio|>" in r["formatted"]
    assert [(a["turn"], a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [(0, "image", "a.png", 85 + 340), (0, "document", "d.pdf", 1502), (1, "audio", "s.wav", 25)]
    assert r["expanded_tokens"] == 425 + 1502 + 25
