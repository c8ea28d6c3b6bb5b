"""Operators that run on texts in tasks: against brute force, exact round trips and held-out accuracy; nulls, empties, ties."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locuslake.llm import bpe, bytewords, neardup, pii, tokencounts, toxicity
from locuslake.llm.graph import components
from locuslake.llm.queries import QUERIES

D = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts)], SCHEMA)


ODD = [None, "", "  ", "\n\t", "a", "é ß Σ", "x" * 5000, "漢字 😀", "a b c d e f", "a b c d e f"]


# ---- token counts -----------------------------------------------------------------------------------


def brute_count(word, pieces, reach):
    word, best = tokencounts.MARK + word, [(0.0, 0)]
    for e in range(1, len(word) + 1):
        size = len(word[e - 1].encode())
        options = [(-(best[e - 1][0] - 20.0 * size), best[e - 1][1] + size)]
        options += [(-(best[s][0] + pieces[word[s:e]]), best[s][1] + 1) for s in range(max(0, e - reach), e) if word[s:e] in pieces]
        score, n = min(options)
        best.append((-score, n))
    return best[-1][1]


def test_counts_equal_brute_force():
    pieces = tokencounts.zipf_pieces()
    count = tokencounts.TrieCounter(pieces, nodes=50)  # dropped again and again
    rng = random.Random(1)
    words = ["hello", "été", "漢字😀", "x" * 300, "The"] + ["".join(rng.choices("thinaréo_", k=rng.randint(1, 30))) for _ in range(200)]
    for w in words:
        assert count(w) == brute_count(w, pieces, count.reach)


def test_op1_cases(spark):
    got = {r["doc_id"]: r for r in tokencounts.op1_token_counts(docs(spark, ODD).withColumn("n_tokens", F.lit(9))).collect()}
    assert [got[i]["n_tokens"] for i in range(4)] == [0] * 4 and got[8]["n_tokens"] == got[9]["n_tokens"] > 0
    assert tokencounts.op1_token_counts(docs(spark, ODD).where("false")).count() == 0


# ---- BPE --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec()


PIECES = ["a", "aa", "th", "the", "é", "ß", "Σ", "ς", "İ", "1", "½", "漢", "😀", "'s", "'", " ", "\n", "\x1c", "\x85", " ", "_", "-", "!!", "é", "<|endoftext|>", "<|startoftext|>", "<|", "​", "K", "z"]


def test_bpe_equals_the_library(library, codec):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choices("abcdefghinrstoe", k=n)) for n in (127, 128, 129, 700, 20_000)] + ["ab" * 5000, "a" * 3001, "-" * 999, "é" * 777]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == want, t[:60]
        assert codec.surface(want) == library.decode(want, skip_special_tokens=False)


def test_streaming_keeps_a_constant_window(codec):
    run, out = bpe.Transducer(codec.t), []
    text = "".join(random.Random(5).choices("thinedabc", k=30_000))
    most = 0
    for k in range(0, len(text), 50):
        out += run.feed(text[k : k + 50])
        most = max(most, len(run.symbols))
    out += run.finish()
    assert [codec.t.ids[t] for t in out] == codec.encode(text) and most < 1000


def test_bytes_to_text_round_trip(codec):
    for t in ["hello wörld", "漢字 😀 x", "it ' s 1 2"]:
        assert codec.text(codec.encode(t)) == t
    run = bpe.ByteText(codec.t)
    ids = codec.encode("😀")
    assert "".join(run.feed([i]) for i in ids) + run.finish() == "😀"


def test_windows_change_nothing_and_digests_come_through_both_decoders(library):
    rng = random.Random(9)
    text = "".join(rng.choices([*PIECES, " ", "word", "\n"], k=4000))
    small, whole = bpe.Codec(window=50), bpe.Codec()
    want = library.encode(text, add_special_tokens=False).ids
    assert small.encode(text) == whole.encode(text) == want and len([*small.blocks(text)]) > 20
    n, ids, decoded, back = small.digests(text)
    assert n == len(want) and ids == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    assert decoded == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert back == hashlib.sha256(whole.text(want).encode()).hexdigest()


def test_very_long_text(library, codec):
    text = " ".join(random.Random(2).choices(["alpha", "beta", "Gamma42", "été"], k=300_000))
    n, ids, _, _ = codec.digests(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert n == len(want) and ids == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()


def test_op6_cases(spark, library):
    texts = [*ODD, "<|endoftext|>"]
    got = {r["doc_id"]: r for r in bpe.op6_bpe(docs(spark, texts).withColumn("ids", F.lit(1))).collect()}
    for i, t in enumerate(texts):
        e = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(e)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.op6_bpe(docs(spark, texts).where("false")).count() == 0
    assert bpe.encode(docs(spark, ["a b"]).withColumn("ids", F.lit("own"))).first()["ids"] == library.encode("a b", add_special_tokens=False).ids


# ---- near duplicates ----------------------------------------------------------------------------------


def shingle_set(t):
    w = re.findall(r"\w+", (t or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(texts):
    sets, up = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return [find(i) for i in range(len(texts))]


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    texts = [None, "", " . ", "one two", "One, two!", "one two three"]
    for size in (8, 60, 200):
        base = [word() for _ in range(size)]
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 3, 5, 8, 12, 20):
            t = list(base)
            for k in rng.sample(range(size), min(edits, size // 2)):
                t[k] = word()
            texts.append(" ".join(t))
    line = " ".join(word() for _ in range(9))
    texts += [line * 1, (line + "\n") * 30, (line + "\n") * 31, (line + "\n") * 30 + "end"]
    return texts


def test_classes_equal_brute_force(spark):
    texts = corpus()
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, texts)).collect()}
    want = brute_classes(texts)
    for i, t in enumerate(texts):
        assert got[i] == (want[i] if shingle_set(t) else i), (i, t)


def test_large_group_of_near_copies(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base, texts = [word() for _ in range(120)], []
    for _ in range(150):
        t = list(base)
        for k in rng.sample(range(120), rng.randint(0, 9)):
            t[k] = word()
        texts.append(" ".join(t))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_copies_that_repeat_lines_are_found(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    texts, like = [], []
    for _ in range(200):
        base = [word() for _ in range(100)]
        t = [word() if k == 95 else w for k, w in enumerate(base)]
        texts += [" ".join(base), " ".join(t[:40] * 30 + t[40:])]  # one side repeats its first 40 words 30 times
        a, b = map(shingle_set, texts[-2:])
        like.append(len(a & b) >= 0.8 * len(a | b))
    assert all(like)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [i - i % 2 for i in range(len(texts))]


@pytest.mark.parametrize("times", [1, 6, 40])
def test_recall_of_pairs_at_the_threshold(spark, times):
    """Pairs of plain Jaccard 0.8 to 0.85 of which one side repeats a passage: at least 0.9 must be linked."""
    rng = random.Random(times)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    texts, want = [], 0
    while want < 150:
        base = [word() for _ in range(120)]
        t = list(base)
        for k in rng.sample(range(30, 120), 2):
            t[k] = word()
        pair = [" ".join(base), " ".join(t[:20] * times + t[20:])]
        a, b = map(shingle_set, pair)
        if 0.8 <= len(a & b) / len(a | b) <= 0.88:
            texts += pair
            want += 1
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, texts)).collect()}
    found = sum(got[i] == got[i + 1] for i in range(0, len(texts), 2))
    assert found >= 0.98 * want


def test_components_that_share_a_bucket_are_joined_without_loss(spark):
    """Chains of near copies around several bases that share most of their words: pivots alone leave them apart."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base, texts = [word() for _ in range(150)], []
    for _ in range(12):
        one = list(base)
        for k in rng.sample(range(150), 4):
            one[k] = word()
        for _ in range(15):
            t = list(one)
            for k in rng.sample(range(150), rng.randint(0, 3)):
                t[k] = word()
            texts.append(" ".join(t))
            one = t if rng.random() < 0.5 else one
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_postings_find_every_pair_across_components(spark):
    rng = random.Random(22)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([5, 30, 90]))]
        for _ in range(6):
            t = list(base)
            for k in rng.sample(range(len(t)), rng.randint(0, max(1, len(t) // 20))):
                t[k] = word()
            texts.append(" ".join(t[: len(t) - rng.randint(0, len(t) // 12)]))
    p = neardup.Params()
    d = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    posts = neardup.postings(d, neardup.frequencies(d, p), p).withColumn("component", F.col("node") % 3)
    got = {tuple(sorted(r)) for r in neardup.across(posts, p).collect()}
    sets = [shingle_set(t) for t in texts]
    want = {(a, b) for b in range(len(texts)) for a in range(b) if a % 3 != b % 3 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert want <= got and len(got) < 2 * len(want) + 50


def test_op4_on_the_smallest_tables_equals_brute_force(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect())
    words = re.compile("[0-9a-z_\x80-\U0010ffff]+")
    sets = []
    for _, t in rows:
        w = words.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))
    find = lambda x: x if up[x] == x else find(up[x])
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op4_prob_minhash"](spark, D).collect()}
    assert got == {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_rows_without_id_are_linked_and_reduced(spark):
    a = "one two three four five six seven eight nine ten " * 3
    b = "red blue green gold grey pink black white brown teal " * 3
    d = docs(spark, [a, a, a, b, b, b + "more", None, ""], [4, None, None, None, None, None, None, None])
    got = sorted((str(r["doc_id"]), str(r["class_id"])) for r in neardup.classes(d).collect())
    assert got.count(("None", "4")) == 2 and got.count(("4", "4")) == 1 and len(got) == 8
    out = [(r["doc_id"], r["text"]) for r in neardup.dedup(d).collect()]
    assert sum(t == a for _, t in out) == 1 and sum(t in (b, b + "more") for _, t in out) == 1 and len(out) == 4


def test_very_long_texts_and_one_id_for_many_rows(spark):
    rng = random.Random(1)
    long = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(200_000))
    d = docs(spark, [long, long + " end", "other words stand in this text here", *["same id and another text " + c for c in "abcdefgh"]], [1, 2, 3, *[7] * 8])
    got = collections.defaultdict(set)
    for r in neardup.classes(d).collect():
        got[r["doc_id"]].add(r["class_id"])
    assert got[1] == got[2] == {1} and got[3] == {3} and got[7] == {7}
    labels = spark.createDataFrame([(1, 0, 1), (3, 0, 0)], "doc_id long, quality long, toxic long")
    assert toxicity.op5_toxicity(d, labels).count() == 11 and pii.op9_pii(d).count() == 11


def test_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    a, b = {k: rng.uniform(0.5, 4) for k in range(0, 160)}, {k: rng.uniform(0.5, 4) for k in range(60, 220)}
    for k in range(60, 130):
        b[k] = a[k]
    jp = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in {*a, *b}) for i in a.keys() & b.keys())
    agree = []
    for seed in range(6):
        sets = [(d, e, w) for d, s in enumerate((a, b)) for e, w in s.items()]
        sig = neardup.prob_minhash(np.array([x[0] for x in sets]), bytewords.mix(np.array([x[1] + 1 for x in sets], np.uint64)), np.array([x[2] for x in sets]), 2, 512, seed)
        agree.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agree) - jp) < 0.03


def test_words_and_shingles_equal_plain_python():
    texts = ["Hello world, the  quick brown Fox", None, "", "a b", "é漢 x_1 y"]
    w = bytewords.words(texts)
    assert np.diff(w.bounds).tolist() == [len(re.findall(r"\w+", (t or "").lower())) for t in texts]
    doc, h = bytewords.shingles(w)
    assert collections.Counter(doc.tolist()) == {0: 2, 3: 1, 4: 1} and len(set(h.tolist())) == 4


def test_dedup_keeps_one_and_all_columns(spark):
    d = docs(spark, ["a b c d e f", "A b c d e f", None, "", "x y", "x y"], [5, 3, 7, 8, None, None]).withColumn("class_id", F.lit("own"))
    d = d.unionAll(d.where("doc_id = 3"))
    out = neardup.dedup(d)
    assert out.columns == d.columns
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == [3, 7, 8]
    assert neardup.dedup(d.where("false")).count() == 0


def test_components_of_chains_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in (100, 101, 102))


# ---- toxicity ------------------------------------------------------------------------------------------


def test_held_out_accuracy_and_unseen_misspellings():
    rng = random.Random(4)
    clean = lambda n: ["".join(rng.choices("abdehinorst", k=rng.randint(2, 9))) for _ in range(n)]
    bad = ["worthless", "pathetic", "disgusting", "stupid"]
    texts, labels = [], []
    for k in range(700):
        w = clean(rng.randint(5, 120))
        if k % 3 == 0:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append(" ".join(w)), labels.append(int(k % 3 == 0))
    m = toxicity.train(texts[:500], labels[:500])
    hit = (toxicity.scores(texts[500:], m) >= 0.5) == np.array(labels[500:])
    assert hit.mean() > 0.97
    odd = [" ".join([*clean(30), w, *clean(30)]) for w in ("worthlesss", "patheticc", "disgustingg", "sstupid")]
    assert (toxicity.scores(odd, m) > np.median(toxicity.scores([" ".join(clean(60)) for _ in range(50)], m))).all()


def test_op5_on_the_smallest_tables_and_cases(spark):
    d, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    got = toxicity.op5_toxicity(d.unionByName(docs(spark, ODD, [None] * len(ODD))), labels.withColumn("text", F.lit("clash"))).collect()
    assert len(got) == d.count() + len(ODD)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    none = toxicity.op5_toxicity(docs(spark, ODD), labels.where("false")).collect()
    assert all(r["score"] == 0 for r in none)
    assert toxicity.op5_toxicity(d.where("false"), labels).count() == 0
    assert toxicity.reject(docs(spark, ODD), labels.where("false")).columns == docs(spark, ODD).columns


def plain_logit(text, m):
    """The score's logit in plain Python: words, n-grams, their hashes, the mean of each window of words, the largest."""
    odd, whole = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & whole
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & whole
        return x ^ x >> 31

    def bucket(b, tag):
        return mix((sum((c + 1) * pow(odd, k, 1 << 64) for k, c in enumerate(b)) + tag) & whole) % m.params.buckets

    pulls = []
    for word in re.findall(rb"[0-9a-z_\x80-\xff]+", text.lower().encode()):
        w = b" " + word + b" "
        grams = [bucket(w, 99)] + [bucket(w[i : i + n], n) for n in range(m.params.low, m.params.high + 1) for i in range(len(w) - n + 1)]
        pulls.append(float(np.mean([float(m.pull[g]) for g in grams])))
    size = min(m.params.span, len(pulls))
    return max(float(np.mean(pulls[i : i + size])) for i in range(len(pulls) - size + 1)) + float(m.bias[1] - m.bias[0])


@pytest.mark.parametrize("p", [toxicity.Params(epochs=1), toxicity.Params(window=None, epochs=1)])
def test_scores_equal_plain_python(p):
    texts = ["you are an idiot", "a fine day é", "Worthless, pathetic! x", "some other_words 42 here and there"]
    m = toxicity.train(texts, [1, 0, 1, 0], p)
    got, some = toxicity.text_logits(texts, m)
    assert some.all() and np.allclose(got, [plain_logit(t, m) for t in texts], atol=1e-9)


def test_op5_held_out_accuracy(spark):
    """On rows that were not learned from; labels are noisy: about a quarter of the toxic ones hold no such word."""
    at = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{at}/labels.parquet").where("toxic is not null").collect()}
    got = [r for r in QUERIES["op5_toxicity"](spark, at).collect() if r["held_out"] and r["doc_id"] in labels]
    y, score = np.array([labels[r["doc_id"]] for r in got]), np.array([r["score"] for r in got])
    assert len(got) > 50 and ((score >= 0.5) == y).mean() >= 0.9
    order = np.argsort(np.argsort(score)) + 1
    assert (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (y == 0).sum()) >= 0.8


def test_plain_average_learns_too():
    rng = random.Random(4)
    clean = lambda n: ["".join(rng.choices("abdehinorst", k=rng.randint(2, 9))) for _ in range(n)]
    texts = [" ".join([*clean(6), *(["worthless"] * (k % 2)), *clean(6)]) for k in range(1000)]
    m = toxicity.train(texts[:800], [k % 2 for k in range(800)], toxicity.AVERAGED)
    hit = (toxicity.scores(texts[800:], m) >= 0.5) == np.array([k % 2 for k in range(200)], bool)
    assert hit.mean() > 0.9


def labelled(spark, rows):
    """(docs, labels) of (text, toxic) rows."""
    return docs(spark, [t for t, _ in rows]), spark.createDataFrame([(i, None, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality long, toxic long")


def test_scores_answer_to_the_shares_of_the_whole_input(spark):
    rows = [("grey", int(i % 10 == 0)) for i in range(1000)]  # one text, toxic in a tenth of its rows
    for most in (2000, 50):  # all rows, and 50 of each label
        d, labels = labelled(spark, rows)
        m = toxicity.fit(d, labels, toxicity.Params(max_per_label=most))
        assert 0.05 < toxicity.scores(["grey"], m)[0] < 0.2, most


def test_long_texts_are_learned_from(spark):
    rng = random.Random(6)
    line = lambda n: " ".join("".join(rng.choices("abdehinorst", k=4)) for _ in range(n))
    rows = [(f"{line(1500)} worthless pathetic {line(1500)}", 1) if i % 4 == 0 else (line(30), 0) for i in range(200)]
    assert all(len(t) > 12_000 for t, y in rows if y)
    for p in (toxicity.Params(), toxicity.Params(max_chars=100_000), toxicity.Params(max_chars=1)):
        got = toxicity.fit(*labelled(spark, rows), p)
        assert got.scale[0] > 0
    m = toxicity.fit(*labelled(spark, rows))
    score = toxicity.scores([t for t, _ in rows], m)
    assert score[::4].mean() > np.delete(score, np.s_[::4]).mean()


# ---- PII ----------------------------------------------------------------------------------------------

RULES = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(t):
    out = []
    for k, rule in enumerate(RULES):
        for m in rule.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 2 and not (16 <= len(d) <= 19 and pii.luhn(d)) or k == 3 and not 8 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(6000):
        t = "".join(rng.choices(["1", "2", ".", "@", "a", "-", " ", "+", "(", ")", "255", "0300", "4539578763621486", "b.c", "%", "x@y.zz", "1.2.3.4", "é"], k=rng.randint(0, 25)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_parts_of_thousands_of_zeros(spark):
    """Leading zeros count for nothing, however many: 0...01.2.3.4 is an address."""
    rows = [(k, ".".join("0" * 5000 * (j == k) + str(j + 1) for j in range(4))) for k in range(4)] + [(9, "0" * 5000 + ".0.0." + "0" * 5000), (10, "0" * 5000 + "256.1.1.1")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_ip"], r["settled"]) for r in pii.op9_pii(d).collect()}
    assert got == {**{k: (1, True) for k in (0, 1, 2, 3, 9)}, 10: (0, True)}
    assert {r["text"] for r in pii.redact(d).collect()} >= {"<IP>"}


def test_documents_whose_messages_have_not_settled_say_so():
    text = "card 4111 1111 1111 1111 call +1 415 555 0100 or 415 555 0100 or 5550100 and 4111111111111111"
    weights = (np.random.default_rng(0).normal(0, 1, (pii.N_FEATURES, pii.LABELS)), np.zeros((pii.LABELS,) * 2), np.eye(pii.LABELS) * 3)
    assert [s for _, _, s in pii.find([text, "", "no digits"], weights, pii.Params(rounds=1))] == [False, True, True]
    assert [s for _, _, s in pii.find([text], weights, pii.Params())] == [True]


def test_long_runs_take_linear_time():
    for t in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "@" * 100_000):
        pii.base_spans(t)


def test_repeats_take_the_kind_of_their_match(spark):
    rng, texts = random.Random(2), []
    for i in range(300):
        n = f"{rng.randint(200, 999)} {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        texts.append(f"call +1 {n} now or mail u{i}@example.com; order {rng.randint(10**8, 10**9)}")
    texts.append("call +1 415 555-2671 today. later again 415 555-2671 please")
    rows = {r["doc_id"]: r for r in pii.op9_pii(docs(spark, [*texts, *ODD])).collect()}
    last = rows[len(texts) - 1]
    at = texts[-1].rindex("415")
    assert f"phone:{at}:{at + 12}" in last["spans"].split(",") and last["n_phone"] == 1
    assert sum(len(r["spans"].split(",")) for i, r in rows.items() if i < 300) <= 620  # order numbers stay clean
    for i, t in enumerate([*texts, *ODD]):
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in plain_spans(t or ""))
        assert rows[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert not base or set(base.split(",")) <= set(rows[i]["spans"].split(","))
    assert pii.op9_pii(docs(spark, ODD).where("false")).count() == 0


def test_fifty_repeats_take_the_kind_of_their_match(spark):
    rng, texts = random.Random(3), []
    for i in range(300):
        texts.append(f"call +1 {rng.randint(200, 999)} {rng.randint(200, 999)}-{rng.randint(1000, 9999)} now or mail u{i}@example.com; order {rng.randint(10**8, 10**9)}")
    again = "order 415 555-2671 came\n" * 50
    texts += ["call +1 415 555-2671 now\n" + again, again + "call +1 415 555-2671 now\n"]
    rows = {r["doc_id"]: r for r in pii.op9_pii(docs(spark, texts)).collect()}
    for i in (300, 301):
        want = {f"phone:{m.start()}:{m.end()}" for m in re.finditer("(?<=order )415 555-2671", texts[i])}
        assert len(want) == 50 and want <= set(rows[i]["spans"].split(",")), i
    g = pii.Graph.empty()
    g.add(0, texts[300])
    assert len(g.skip) < 2 * len(g.doc)


@pytest.mark.parametrize("text, spans", [
    ("mail bob[at]x.org", [(5, 17)]), ("id 12, mail bob[at]x.org", [(12, 24)]), ("BOB (AT) X.ORG", [(0, 14)]),
    ("a" * 200 + "(at)" + "b" * 100 + "." + "c" * 100, [(0, 405)]), ("jo at site dot org ok", [(0, 18)]), ("meet at noon. at all", []), ("(at)x.y", []),
])
def test_spelt_addresses(text, spans):
    assert [s[1:] for s in pii.mentions(text)[1]] == spans


def test_messages_against_exact_marginals():
    """Trees are exact; loops of up to 8 nodes come near."""
    rng = np.random.default_rng(5)
    for trial in range(60):
        n = int(rng.integers(2, 9))
        tree = [(int(rng.integers(0, k)), k) for k in range(1, n)]
        loops = [tuple(sorted(map(int, rng.choice(n, 2, replace=False)))) for _ in range(trial % 3)]
        cut = len(tree) // 2
        chain, skip = tree[:cut], tree[cut:] + [e for e in dict.fromkeys(loops) if e not in tree]
        label = [int(rng.integers(0, pii.NONE)) if rng.random() < 0.3 else pii.NONE for _ in range(n)]
        g = pii.Graph([0] * n, [0] * n, [0] * n, label, [[k] for k in range(n)], chain, skip)
        unary, pair = np.zeros((pii.N_FEATURES, pii.LABELS)), [rng.normal(0, 0.5, (pii.LABELS, pii.LABELS)) for _ in range(2)]
        unary[:n] = rng.normal(0, 1, (n, pii.LABELS))
        pair = [(w + w.T) / 2 for w in pair]
        state = np.stack(np.meshgrid(*[range(pii.LABELS)] * min(n, 8), indexing="ij"), -1).reshape(-1, n)
        if n > 6:  # 5^n states: keep the free nodes' and the clamped ones' labels only
            free = [range(pii.LABELS) if y == pii.NONE else [y] for y in label]
            state = np.stack(np.meshgrid(*free, indexing="ij"), -1).reshape(-1, n)
        score = np.zeros(len(state))
        for k, y in enumerate(label):
            score += unary[k][state[:, k]] if y == pii.NONE else np.where(state[:, k] == y, 0.0, -50.0)
        for edges, w in ((chain, pair[0]), (skip, pair[1])):
            for a, b in edges:
                score += w[state[:, a], state[:, b]]
        weight = np.exp(score - score.max())
        exact = np.stack([np.bincount(state[:, k], weight, pii.LABELS) for k in range(n)]) / weight.sum()
        got, moving = pii.beliefs(g, (unary, *pair))
        off = np.abs(got - exact).max()
        assert off < (2e-3 if not loops else 0.12), (trial, n, off)


def test_a_document_gets_the_same_beside_any_other():
    texts = ["call +1 415 555-2671 or 415 555-2671, 415.555.2671", "mail a@b.cc " * 40, "7 4155552671 " * 30]
    rng = np.random.default_rng(1)
    weights = (rng.normal(0, 1, (pii.N_FEATURES, pii.LABELS)), np.eye(pii.LABELS), np.eye(pii.LABELS) * 2)
    alone = [pii.find([t], weights, pii.Params())[0] for t in texts]
    assert pii.find(texts, weights, pii.Params()) == alone


def test_op9_ignores_clashing_columns_and_keeps_repeats(spark):
    d = docs(spark, ["mail a@b.cc", "mail a@b.cc", None], [1, 1, None]).withColumns({"spans": F.lit(1), "n_email": F.lit("x"), "draw": F.lit(0.5)})
    rows = pii.op9_pii(d).collect()
    assert sorted((r["n_email"], r["spans"]) for r in rows) == [(0, ""), (1, "email:5:11"), (1, "email:5:11")]


def test_redaction(spark):
    d = docs(spark, ["mail a@b.cc or +1 415 555-2671", None, ""]).withColumn("spans", F.lit(1))
    out = {r["doc_id"]: r for r in pii.redact(d).collect()}
    assert out[0]["text"] == "mail <EMAIL> or <PHONE>" and out[0]["n_chars"] == len(out[0]["text"])
    assert out[1]["text"] is None and out[2]["text"] == "" and pii.redact(d).columns == d.columns
