"""Chat formatting and byte-level BPE."""

import hashlib
import random

import pytest

from kinetrail.llm import byte_bpe, chat_format


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escapes_are_reversible():
    for text in ["", "&lt;<|turn|>&amp;", "</s>[INST] ok [/INST]", "[INST][INST]", "&lsqb;INST]", "<|end|><|body|>", "[ INST]"]:
        shown, a, b = chat_format.render("us<er", text)
        assert chat_format.parse(shown) == [("us<er", text)]
        assert chat_format.unescape(shown[a:b]) == text
        assert "<|" not in shown[a:b] and "[INST]" not in shown[a:b] and "</s>" not in shown[a:b]


ROWS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "hello é"),
    (2, 0, "user", "hi"),
    (2, 1, "assistant", "hello é"),
    (2, 2, "user", "more"),
    (3, 0, "user", "hi"),
    (3, 1, "assistant", "other"),
    (4, 5, "user", None),
    (4, None, "system", "first"),
    (4, 5, "assistant", ""),
    (5, 0, "assistant", "tie"),
    (5, 0, "assistant", "tie"),
    (None, 0, None, "nobody"),
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


@pytest.fixture
def forest(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, node_id string")
    return chat_format.build(df)


def test_read_back(forest):
    got = {r.conv_id: r for r in chat_format.read_back(forest).collect()}
    convs = {}
    for c, t, role, text in ROWS:
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        said = "".join(x[3] for x in turns if x[2] == "assistant")
        r = got[c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == digest("".join(f"{x[2]}\n{x[3]}\n" for x in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(said), digest(said))
        assert r.formatted_chars == sum(len(chat_format.render(x[2], x[3])[0]) for x in turns)


def test_stream_is_a_depth_first_forest(forest):
    nodes = {bytes(r.node_id): r for r in forest.nodes.collect()}
    members = [[bytes(x) for x in r.node_ids] for r in forest.members.collect()]
    assert {x for m in members for x in m} == set(nodes)
    assert len(nodes) == 12  # shared first turns are there once
    order = sorted(nodes.values(), key=lambda r: r.stream_start)
    at = 0
    for r in order:
        assert r.stream_start == at
        at += r.n_tokens
        assert r.position_ids == list(range(r.position_start, r.position_start + r.n_tokens))
    for path in members:
        for depth, x in enumerate(path):
            r = nodes[x]
            assert r.depth == depth and bytes(r.tree_id) == path[0]
            assert (None if r.parent_id is None else bytes(r.parent_id)) == (path[depth - 1] if depth else None)
            above = [nodes[y] for y in path[:depth]]
            assert [(i.start, i.stop) for i in r.attends] == [(a.stream_start, a.stream_start + a.n_tokens) for a in above]
            assert r.position_start == sum(a.n_tokens for a in above)
    # depth first: what is below a node stands right behind it
    for r in order:
        below = [x for x in order if any(i.start == r.stream_start for i in x.attends)]
        if below:
            assert min(x.stream_start for x in below) == r.stream_start + r.n_tokens
            assert max(x.stream_start + x.n_tokens for x in below) - r.stream_start - r.n_tokens == sum(x.n_tokens for x in below)


def test_no_turns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    forest = chat_format.build(none)
    assert chat_format.read_back(forest).count() == 0 and forest.nodes.count() == 0


def test_round_trip(spark):
    random.seed(9)
    path, pattern = byte_bpe.default_vocabulary()
    encoder = byte_bpe.encoding(path, pattern)
    marks = ["word", "don't", "  ", "\n\n ", "é漢字", "\U0001f600", "123", "\t", "x" * 300, "<|endoftext|>", " ", "\x00"]
    texts = [None, "", " ", "".join(random.choice(marks) + random.choice(["", " ", "\n"]) for _ in range(40000)), "a" * 70000] + [random.choice(marks) * 3 for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in byte_bpe.round_trip(docs, ("doc_id",), with_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = encoder.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == digest(",".join(map(str, ids)))
        assert got[i].decoded_sha256 == digest(t or "")
    back = byte_bpe.decode(byte_bpe.encode(docs, into="n_tokens"), ids="n_tokens").collect()
    assert all(bytes(r.bytes).decode() == (r.text or "") for r in back)


def test_made_columns_win_over_kept_ones(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "t"), (1, "a b", 7, "t"), (2, None, 8, None)], "doc_id long, text string, n_tokens long, __text__ string")
    got = byte_bpe.round_trip(docs, ("doc_id", "n_tokens", "__text__", "text"))
    assert got.columns == ["doc_id", "__text__", "text", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = got.collect()
    assert len(rows) == 3 and {r.decoded_sha256 for r in rows} == {digest("a b"), digest("")}
    assert byte_bpe.round_trip(docs.limit(0), ("doc_id",)).count() == 0
