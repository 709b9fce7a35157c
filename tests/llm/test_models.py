"""Language model, classifier and decontamination."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetrail.llm import decontaminate, lm_scoring, quality_classifier

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(text):
    return [w.decode() for w in (text or "").translate(LOWER).encode().split()] + ["</s>"]


def plain_model(texts, order):
    """p(context, word) of an interpolated modified Kneser-Ney model, by dictionaries."""
    counts = {order: Counter()}
    for t in texts:
        ws = ["<s>"] * (order - 1) + toks(t)
        counts[order].update(tuple(ws[i : i + order]) for i in range(len(ws) - order + 1))
    for k in range(order - 1, 0, -1):  # below the highest order: different words before
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: lm_scoring.discounts([Counter(x.values())[n] for n in (1, 2, 3, 4)]) for k, x in counts.items()}
    after = {k: defaultdict(list) for k in counts}
    for k, x in counts.items():
        for g, n in x.items():
            after[k][g[:-1]].append(n)

    def p(context, w):
        k = len(context) + 1
        ns = after[k].get(context)
        if k == 1:
            total, base = sum(ns), 1 / (len(counts[1]) + 1)
        else:
            base = p(context[1:], w)
            if ns is None:
                return base
            total = sum(ns)
        n = counts[k][(*context, w)]
        return (n - d[k][min(n, 3)]) / total + sum(d[k][min(x, 3)] for x in ns) / total * base

    return p


@pytest.mark.parametrize("order", [2, 3, 4])
def test_ngram_model(spark, order, monkeypatch):
    monkeypatch.setattr(lm_scoring, "_SHARD", 20)  # many shards
    random.seed(8)
    words = ["The", "the", "cat", "SAT", "on", "é", "mat", "a b"]
    texts = [" ".join(random.choice(words[: random.randint(2, 8)]) for _ in range(random.randint(0, 30))) for _ in range(60)] + [None, "", "unseen words only", "the " * 3000, "cat sat", "cat sat"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string").repartition(3)
    train = [i for i in range(len(texts)) if i % 4 and i != 62]
    model = lm_scoring.fit(docs, F.col("doc_id").isin(train), order=order)
    got = {r.doc_id: r for r in lm_scoring.score(docs, model, keep=("doc_id", "score")).collect()}
    uni = Counter(w for i in train for w in toks(texts[i]))
    n, v = sum(uni.values()), len(uni)
    p = plain_model([texts[i] for i in train], order)
    for context in ((), ("the",), ("the", "cat"), ("<s>", "the")):
        if len(context) < order:
            assert sum(p(context, w) for w in uni) + p(context, "never seen") == pytest.approx(1)
    for i, t in enumerate(texts):
        ws = ["<s>"] * (order - 1) + toks(t)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(toks(t)), sum(w in uni for w in toks(t)), n)
        assert r.base_score == pytest.approx(sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in toks(t)))
        assert r.score == pytest.approx(sum(math.log10(p(tuple(ws[j - order + 1 : j]), ws[j])) for j in range(order - 1, len(ws))))


def test_counts_beyond_four_bytes():
    big = np.array([1, 2**40], np.int64)
    assert lm_scoring._unpacked(lm_scoring._packed(big)).tolist() == big.tolist()
    assert [lm_scoring._small(np.array([1, x])).itemsize for x in (255, 256, 2**16, 2**32 - 1, 2**32)] == [1, 2, 4, 4, 8]


def test_model_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = lm_scoring.fit(docs, F.lit(None).cast("boolean"))
    got = {r.doc_id: r.score for r in lm_scoring.score(docs, model).collect()}
    assert got == {1: 0.0, 2: 0.0}
    assert lm_scoring.score(docs.limit(0), model).count() == 0


def test_classifier_learns(spark):
    random.seed(6)

    def good():
        return " ".join(random.choice(["river", "house", "walks", "slowly", "green", "with"]) for _ in range(random.randint(5, 60)))

    rows = [(i, good() if i % 2 else good().upper().replace(" ", "!! "), i % 2) for i in range(400)] + [(1000, None, 1), (1001, "", 0), (1002, "river", None)]
    docs = spark.createDataFrame([(i, t, 5) for i, t, _ in rows], "doc_id long, text string, predicted int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in quality_classifier.score(docs, model).collect()}
    held = [i for i in range(400) if i % 5 == 0]
    assert sum(got[i].predicted == i % 2 for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[1000].score == got[1001].score
    none = quality_classifier.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}


def normal(text):
    out, word = [], ""
    for ch in text or "":
        if ch.isascii() and not ch.isalnum():
            out.append(word)
            word = ""
        else:
            word += ch.lower() if ch.isascii() or "À" <= ch <= "Þ" else ch
    return [w for w in [*out, word] if w]


def test_leaks(spark):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(40)] + ["the", "of", "été"]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(n))) for i, n in enumerate((3, 8, 12, 20, 20, 31))]
    items += [(90, None), (91, ""), (None, "x y z"), (92, "the the the the the the")]
    texts = [None, "", "the of the of the of the the the the the the"]
    for k, (_, t) in enumerate(items[:6]):
        for edits in range(0, 8):
            words = t.split()
            for _ in range(edits):
                place, kind = random.randrange(len(words)), random.randrange(3)
                if kind == 0:
                    words[place] = f"n{random.randint(0, 99)}"
                elif kind == 1:
                    words.insert(place, f"n{random.randint(0, 99)}")
                elif len(words) > 1:
                    del words[place]
            around = [" ".join(random.choice(vocabulary) for _ in range(random.randint(0, 15))) for _ in range(2)]
            texts.append(f"{around[0]} {' '.join(words).upper() if k % 2 else ', '.join(words)} {around[1]}")
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, leaks string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(texts, items)
    for block in (10**6, 20):
        policy = decontaminate.LeakPolicy(block_words=block)
        got = {(r.doc_id, r.item_id): (r.edits, r.start_word, r.n_words) for r in decontaminate.leaks(docs, bench, policy=policy).collect()}
        assert got == want
    named = bench.selectExpr("concat('item ', item_id) AS item_id", "text")  # ids of another type
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, named).collect()} == {(i, f"item {k}") for i, k in want}
    twice = decontaminate.leaks(docs.unionByName(docs), bench).groupBy("doc_id", "item_id").count().collect()
    assert {(r.doc_id, r.item_id): r["count"] for r in twice} == dict.fromkeys(want, 2)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({i for i, _ in want})
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), bench).count() == 0


def test_leaks_of_other_lengths(spark):
    """Windows of all lengths count: words put in or left out, and texts shorter than the item."""
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of"]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(n))) for i, n in enumerate((4, 10, 25, 50, 50))]
    texts = [None, "", "the of"]
    for _, t in items:
        for edits in (1, 2, 4, 6, 8, 10):
            for kind in (0, 1):
                words = t.split()
                for _ in range(edits):
                    if kind:
                        words.insert(random.randrange(1, len(words)), f"n{random.randint(0, 99)}")
                    elif len(words) > 1:
                        del words[random.randrange(len(words))]
                around = [" ".join(random.choice(vocabulary) for _ in range(random.randint(0, 12))) for _ in range(2)]
                texts += [" ".join(words), f"{around[0]} {' '.join(words)} {around[1]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame([*items, (9, None)], "item_id long, text string")
    want = plain_leaks(texts, items)
    got = {(r.doc_id, r.item_id): (r.edits, r.start_word, r.n_words) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == want
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == set(range(len(texts))) - {i for i, _ in want}


def plain_leaks(texts, items, share=0.2):
    """(document, item) and the least (edits, start, words) over all windows."""
    want = {}
    for i, t in enumerate(texts):
        words = normal(t)
        for k, item in items:
            wanted = normal(item)
            n, e = len(wanted), int(share * len(wanted) + 1e-9)
            if k is None or not n:
                continue
            found = []
            for s in range(len(words)):
                ends = prefix_row(wanted, words[s : s + n + e])
                found += [(ends[m], s, m) for m in range(max(1, n - e), len(ends))]
            if found and min(found)[0] <= e:
                want[i, k] = min(found)
    return want


def prefix_row(a, b):
    """Distances of a to all prefixes of b."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row


def test_prefix_distances():
    random.seed(1)
    rows = [[random.randint(0, 3) for _ in range(11)] for _ in range(50)]
    item = [random.randint(0, 3) for _ in range(9)]
    assert decontaminate.prefix_distances(np.array(rows), np.array(item)).tolist() == [prefix_row(item, x) for x in rows]


@pytest.mark.parametrize("n", [10, 50, 200, 500, 800])
def test_recall_of_the_default_policy(n):
    """Passages with the full number of edits, of mixed kinds or of one kind, inside other text; items that others look like."""
    rng = np.random.default_rng(n)
    policy, trials = decontaminate.LeakPolicy(), 60 if n <= 200 else 24
    items = [rng.integers(1, 3000, n).astype(np.uint64) for _ in range(8)]
    items += [np.where(rng.random(n) < 0.5, x, rng.integers(1, 3000, n).astype(np.uint64)) for x in items[:4]]
    index = decontaminate.ItemIndex(list(range(len(items))), items, policy)
    found = 0
    for i in range(trials):
        body = decontaminate.edited(items[i % 8], policy.edits(n), i % 4, rng)
        text = np.concatenate([rng.integers(1, 3000, 30), body, rng.integers(1, 3000, 30)]).astype(np.uint64)
        hits = index.find(text, np.array([0, len(text)]))
        found += any(k == i % 8 and edits <= policy.edits(n) for _, k, edits, _, _ in hits)
    assert found >= 0.97 * trials
