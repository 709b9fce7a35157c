"""Suffix sorting, exact substring dedup and near duplicates against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from kinetrail.llm import common, external_sais, graph, minhash_dedup, suffix_dedup

TABLES = Path("/root/testdata/sf0.01")


def plain_suffixes(text, cap):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and a + k < len(text) and b + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        common.append(k)
    return order, common


@pytest.mark.parametrize("seed", range(60))
def test_suffix_arrays(seed):
    random.seed(seed)
    text = [random.randint(1, random.choice([1, 2, 4, 200])) for _ in range(random.randint(0, 150))]
    if seed % 3 == 0:
        text = (text[:20] * 9)[:200]
    text.append(0)
    cap = random.choice([3, 20, 200])
    order, common = plain_suffixes(text, cap)
    a, b = external_sais.suffix_lcp(np.array(text, np.uint8), 201, cap, memory=1 << 12)
    assert a.tolist() == order and b.tolist() == common
    assert external_sais.order_wide(np.array(text, np.int64), 201, memory=1 << 12).tolist() == order


def test_wide_alphabets():
    random.seed(1)
    block = [random.randint(1, 3000) for _ in range(700)]
    text = []
    for _ in range(40):
        part = list(block)
        for _ in range(5):
            part[random.randrange(len(part))] = random.randint(1, 3000)
        text += part
    text += [5, 6] * 500 + [0]
    got = external_sais.order_wide(np.array(text, np.int64), 3001)
    ranks = np.array(text)
    # prefix doubling as the plain way
    n, h = len(text), 1
    while True:
        after = np.full(n, -1)
        after[: n - h] = ranks[h:]
        order = np.lexsort((after, ranks))
        new = np.zeros(n, int)
        new[order[1:]] = np.cumsum((ranks[order[1:]] != ranks[order[:-1]]) | (after[order[1:]] != after[order[:-1]]))
        ranks = new
        if ranks.max() == n - 1:
            break
        h *= 2
    assert got.tolist() == np.argsort(ranks).tolist()


def test_runs_go_to_disk():
    run = external_sais.Run(np.int64, 100)
    for i in range(50):
        run.push(np.arange(i, i + 7))
    assert run.file is not None
    assert run.take().tolist() == [x for i in range(50) for x in range(i, i + 7)] and run.take().size == 0


def plain_removal(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone.update(range(i, i + length))
        runs = sum(1 for i in gone if i - 1 not in gone)
        out.append((len(t), len(gone), runs, hashlib.sha256(bytes(x for i, x in enumerate(t) if i not in gone)).hexdigest()))
    return out


def test_repeated_substrings(spark):
    random.seed(11)

    def words(n):
        return "".join(random.choice(["é", "ab ", "the ", "x", "漢", "\n"]) for _ in range(n))

    shared, base = words(120), words(300)
    texts = [None, "", "short", base, base, base[:150] + "!" + base[150:], words(50) + shared + words(50), shared, words(40) + shared[30:] + words(40), "ab" * 400, "z" * 1000, "q" * 250, "q" * 199]
    for _ in range(12):
        cut = random.randrange(len(base))
        texts.append(base[:cut] + words(2) + base[cut:])
    rows = [(i if i != 4 else 3, t, "x") for i, t in enumerate(texts)]  # the two equal rows share their id
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_spans string")
    want = plain_removal([(t or "").encode() for t in texts], 200)
    for limit in (10, 100_000):
        policy = suffix_dedup.SubstringPolicy(shard_bytes=4000, anchor_bytes=700, broadcast_ids=limit, run_memory=1 << 14)
        got = suffix_dedup.remove_repeats(docs, digests=True, policy=policy).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter((rows[i][0], *want[i]) for i in range(len(rows)))
    whole = suffix_dedup.remove_repeats(docs).collect()
    assert Counter(hashlib.sha256(bytes(r.kept)).hexdigest() for r in whole) == Counter(w[3] for w in want)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_anchors_with_many_surroundings(spark):
    """A phrase of less than 200 bytes in many surroundings is one anchor; its parts come out bounded and lose no repeat."""
    random.seed(31)

    def noise(n):
        return "".join(random.choice("abcdefghijklmnop ") for _ in range(n))

    texts = []
    for n in (45, 110, 199):
        phrase = noise(n)
        texts += [noise(200) + phrase + noise(200) for _ in range(40)]
        texts += [noise(150) + x[100 + k : 230 + n + k] + noise(150) for k, x in enumerate(texts[-12:])]
        texts += [texts[-1][20:]] * 3
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    want = plain_removal([x.encode() for x in [*texts, texts[0]]], 200)
    policy = suffix_dedup.SubstringPolicy(shard_bytes=8000, anchor_bytes=4000)
    got = suffix_dedup.remove_repeats(docs, digests=True, policy=policy).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter((i, *w) for i, w in zip([*range(len(texts)), 0], want))

    rows = []
    for i, text in enumerate(texts):
        buf = np.frombuffer(text.encode(), np.uint8)
        _, begin, stop, anchor, content = suffix_dedup.stretches(buf, np.array([0, len(buf)]), 200, 40)
        rows += [(int(a), int(k), bytes(buf[x:y])) for x, y, a, k in zip(begin, stop, anchor.view(np.int64), content.view(np.int64))]
    hot = Counter(a for a, _, _ in rows).most_common(1)[0][0]
    crowd = {(a, k): x for a, k, x in rows if a == hot}
    assert sum(map(len, crowd.values())) > policy.anchor_bytes
    contents = spark.createDataFrame([(*key, x) for key, x in crowd.items()], "a long, c long, content binary")
    levels = 0
    for _, small in suffix_dedup.divided(contents, policy):
        levels += 1
        sizes = Counter()
        for r in small.collect():
            sizes[r.k] += len(r.content)
            assert bytes(r.content) == crowd[r.a, r.c][r.at : r.at + len(r.content)]
        assert all(x <= policy.anchor_bytes for x in sizes.values())
    assert 1 <= levels <= 8


@pytest.mark.parametrize("low, high", [(0, 160), (0, 80), (81, 160), (41, 80), (7, 8), (9, 9)])
def test_equal_strings_share_a_group(low, high):
    random.seed(low)
    body = bytes(random.choice(b"abcdefgh") for _ in range(350))
    other = bytes(random.choice(b"ij") for _ in range(30)) + body[30:]

    def groups(content):
        return {part[j : j + 200]: group for _, _, _, _, group, _, part in suffix_dedup.halves(content, 150, low, high, 200) for j in range(len(part) - 199)}

    one, two = groups(body), groups(other)
    inside = {body[i : i + 200] for i in range(30, 151) if low <= 150 - i <= high}
    assert inside <= set(one) and inside == set(one) & set(two)
    assert all(one[x] == two[x] for x in inside)


def test_repeats_in_rows_without_id(spark):
    """Rows with a null id lose repeated strings and are the other place of strings in rows with an id."""
    random.seed(21)
    made = ["".join(random.choice("abcdefgh ") for _ in range(320)) for _ in range(8)]
    texts = [made[0], made[0], made[1] + made[2], made[3] + made[2][40:300], made[4], made[4] + "!", made[5] + made[6], made[6][:250] + made[7], None, "short"]
    ids = [None, 1, None, 2, None, None, 3, None, None, 4]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    want = plain_removal([(t or "").encode() for t in texts], 200)
    for limit in (0, 100_000):
        policy = suffix_dedup.SubstringPolicy(shard_bytes=4000, broadcast_ids=limit)
        got = suffix_dedup.remove_repeats(docs, digests=True, policy=policy).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter((i, *w) for i, w in zip(ids, want))


def test_no_local_folder_on_a_cluster():
    class Named:
        sparkContext = property(lambda self: self)
        conf = property(lambda self: self)
        master = "spark://host:7077"
        there = None

        def get(self, name, default=None):
            return self.there

        def getConf(self):
            return self

        def getCheckpointDir(self):
            return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Named())
    named = Named()
    named.there = "hdfs://all/shared/"
    assert common.shared_dir(named) == "hdfs://all/shared"


def shingle_set(text):
    words = (text or "").encode().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def plain_classes(rows, share=0.01, limit=0.8):
    """Classes by comparing all pairs, weights by count and inverse document frequency."""
    sets = [shingle_set(t) for _, t in rows]
    df = Counter(x for one in sets for x in one)
    n = len(rows)
    sets = [{x: k * np.log1p(n / max(df[x], share * n)) for x, k in one.items()} for one in sets]
    total = [sum(one.values()) for one in sets]
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            both = sum(min(w, sets[j].get(x, 0)) for x, w in sets[i].items()) if min(total[i], total[j]) >= limit * max(total[i], total[j]) else 0
            if (rows[i][1] or "") == (rows[j][1] or "") or (both and both / (total[i] + total[j] - both) >= limit - 1e-12):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: least[top(i)] for i, (d, _) in enumerate(rows)}


def near_rows():
    random.seed(3)

    def text(n):
        return [f"w{random.randint(0, 99999)}" for _ in range(n)]

    rows, base = [(0, None), (1, ""), (2, "a b"), (3, "a  b"), (4, "a b c"), (5, " ".join(text(100)))], text(200)
    chain = list(base)
    for i in range(40):  # a chain of edits: neighbours are near, ends are not
        chain = list(chain)
        for _ in range(2):
            chain[random.randrange(200)] = f"e{random.randint(0, 10**6)}"
        rows.append((100 + i, " ".join(chain)))
    for i in range(30):
        other = list(base)
        for _ in range(i):
            other[random.randrange(200)] = f"o{random.randint(0, 10**6)}"
        rows.append((200 + i, " ".join(other)))
    rows += [(300 + i, "same words here again and again " * 3) for i in range(20)]
    return rows


SMALL = minhash_dedup.NearPolicy(bucket_size=9, group_shingles=1500, hubs=1)


@pytest.mark.parametrize("policy", [minhash_dedup.NearPolicy(), minhash_dedup.NearPolicy(bucket_size=12, group_shingles=4000), SMALL])
def test_near_classes(spark, policy):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, class_id string")
    got = {r.doc_id: r.class_id for r in minhash_dedup.classify(docs, policy=policy).collect()}
    assert got == plain_classes(rows)


@pytest.mark.parametrize("size", [8, 30, 1500])
def test_near_pairs_in_a_large_template_group(spark, size):
    """Texts of one template, too far from each other, each with one near text: over-full groups must not part the two."""
    random.seed(5)
    base, rows = [f"w{random.randint(0, 99999)}" for _ in range(200)], []
    for i in range(50):
        one = list(base)
        for at in random.sample(range(10, 190), 4):
            one[at] = f"e{random.randint(0, 10**6)}"
        two = list(one)
        for at in random.sample(range(10, 190), 3):
            two[at] = f"o{random.randint(0, 10**6)}"
        rows += [(2 * i, " ".join(one)), (2 * i + 1, " ".join(two))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    policy = minhash_dedup.NearPolicy(bucket_size=size, group_shingles=200 * size, hubs=2)
    got = {r.doc_id: r.class_id for r in minhash_dedup.classify(docs, policy=policy).collect()}
    assert got == plain_classes(rows)


def test_classes_of_a_table_against_all_pairs(spark):
    """More than 500 documents, with shingles common enough to weigh less: a table of copies, near copies and shared passages."""
    if not TABLES.exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    random.seed(8)
    footer = " ".join(f"f{random.randint(0, 99)}" for _ in range(60))
    rows += [(10_000 + i, footer + " " + " ".join(f"x{random.randint(0, 10**6)}" for _ in range(random.randint(0, 25)))) for i in range(60)]
    assert len(rows) > 500
    want = plain_classes(rows)
    assert want != plain_classes(rows, share=1.0)  # the weights decide
    got = {r.doc_id: r.class_id for r in minhash_dedup.classify(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_spanning_forest_keeps_every_link(seed):
    """The forest has the components of all pairs, n - 1 links at most, and honours labels and parts."""
    random.seed(seed)
    n = 60
    near = np.zeros((n, n), bool)
    for _ in range(55):
        i, j = random.sample(range(n), 2)
        near[i, j] = near[j, i] = True
    label, part = np.array([random.randrange(50) for _ in range(n)]), np.array([random.randrange(2) for _ in range(n)])

    def parted(pairs):
        up = list(range(n))
        for a, b in pairs:
            x, y = {up[a]}, up[b]
            up = [y if u in x else u for u in up]
        return {frozenset(i for i in range(n) if up[i] == u) for u in set(up)}

    every = [(i, j) for i in range(n) for j in range(n) if near[i, j]]
    found = minhash_dedup.spanning(n, lambda i, others: near[i, others])
    assert parted(found) == parted(every) and len(found) == n - len(parted(every))
    same = [(i, j) for i in range(n) for j in range(n) if label[i] == label[j]]
    found = minhash_dedup.spanning(n, lambda i, others: near[i, others], label, part)
    assert parted(found + same) == parted([(i, j) for i, j in every if part[i] != part[j]] + same)


@pytest.mark.parametrize("seed", range(4))
def test_similarity_of_a_member_with_all_others(seed):
    rng = np.random.default_rng(seed)
    values = [np.sort(rng.choice(120, rng.integers(1, 60), replace=False)).astype(np.uint64) for _ in range(40)]
    values += [values[0], values[1][1:] if len(values[1]) > 1 else values[1]]
    weights = [rng.uniform(0.5, 2, len(x)) for x in values]
    weights[40] = weights[0]
    near = minhash_dedup.near_sets(values, weights, 0.3)
    for i in range(42):
        for others in (np.delete(np.arange(42), i), np.array([x for x in (3, 30, 41) if x != i])):
            want = []
            for j in others:
                a, b = dict(zip(values[i], weights[i])), dict(zip(values[j], weights[j]))
                both = sum(min(a[x], b[x]) for x in a if x in b)
                want.append(both / (sum(a.values()) + sum(b.values()) - both) >= 0.3)
            assert near(i, others).tolist() == want


def test_all_pairs_of_an_over_full_group_meet(spark):
    members = spark.range(70).selectExpr("7L AS group", "cast(cast(id AS string) AS binary) AS v", "70L AS total")
    found = defaultdict(dict)
    for r in minhash_dedup._blocks(members, 16).collect():
        found[r.group][int(bytes(r.v))] = r.part
    met = {frozenset((a, b)) for x in found.values() for a in x for b in x if x[a] != x[b]}
    own = {v: p for x in found.values() for v, p in x.items()}
    assert met == {frozenset((a, b)) for a in range(70) for b in range(a) if own[a] != own[b]} and max(map(len, found.values())) < 40


def test_representatives(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows] + [(5, "tie one", 2), (5, "tie one", 2)], "doc_id long, text string, row int")
    kept = minhash_dedup.representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert set(ids) >= set(plain_classes(rows).values())
    assert minhash_dedup.classify(docs.limit(0)).count() == 0


def test_weights_of_common_shingles(spark):
    """A shingle in most documents counts less; its frequency is exact over all tasks."""
    policy = minhash_dedup.NearPolicy(smooth_share=0.2, block=64, block_docs=4)
    docs = spark.createDataFrame([(i, f"all of these words are common {i} a{i} b{i} c{i} d{i} e{i}") for i in range(60)] + [(99, None)], "doc_id long, text string").repartition(5)
    found = minhash_dedup.common_shingles(docs, "text", policy)
    assert len(found.shingles) == 2 and np.allclose(found.factors, np.log1p(61 / 60) / np.log1p(5))


def test_empty_and_long_texts(spark):
    schema = "doc_id long, text string"
    for few in ([], [(1, None)], [(1, ""), (2, None), (None, "  ")]):
        got = minhash_dedup.classify(spark.createDataFrame(few, schema)).collect()
        assert len(got) == len(few)
    random.seed(4)
    long = [f"w{random.randint(0, 9999)}" for _ in range(200_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-9])), (3, " ".join(long[: len(long) // 2])), (None, " ".join(long[9:]))]
    got = {r.doc_id: r.class_id for r in minhash_dedup.classify(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, None: 1}


def test_sampling_has_the_probability_of_similarity():
    sampler = minhash_dedup.Sampler(3000)
    rng = np.random.default_rng(1)
    shingles = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64))
    w1, w2 = rng.uniform(0.2, 3, 60), rng.uniform(0.2, 3, 60)
    w1[:10], w2[10:20] = 1.0, 1.0
    a, b = (sampler(np.zeros(60, int), shingles, w, 1)[0] for w in (w1, w2))
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs((a == b).mean() - want) < 0.04


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(50, 40), (41, 40), (60, 60), (None, 3)]
    got = {r.v: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 50: 40, 60: 60}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
