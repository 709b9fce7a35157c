"""Line dedup, quality rules and licence scans."""

import random
import re
from collections import Counter

import pytest

from kinetrail.llm import license_scan, line_dedup, quality_rules


def pages(spark):
    rows = [(i, "a" if i < 12 else "b", f"menu\nown {i}\n\nfooter\nown {i}") for i in range(20)]
    rows += [(20, "a", None), (21, None, "menu"), (22, "a", ""), (23, "a", "menu\nmenu")]
    return spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, source string, text string, n_removed int")


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_boilerplate_goes_by_host(spark, broadcast):
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(pages(spark), ratio=0.5, min_pages=5, broadcast_rows=broadcast).collect()}
    assert got[0].text == "own 0\n\nown 0" and (got[0].n_lines, got[0].n_removed) == (5, 2)
    assert got[12].text == "own 12\n\nown 12"
    assert got[20].text is None and got[20].n_lines == 0
    assert got[21].text == "menu"  # a host of its own with one page
    assert got[22].text == "" and got[23].text == ""
    assert len(got) == 24


def test_empty_tables(spark):
    none = pages(spark).limit(0)
    assert line_dedup.drop_boilerplate(none).count() == 0
    assert quality_rules.assess(none).count() == 0
    assert license_scan.scan(none, license_scan.catalogue(spark)).count() == 0


def plain_measures(text):
    words = [w.decode() for w in (text or "").encode().split()]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_quality_measures(spark):
    random.seed(5)
    words = ["é", "the", "x y", "#a", "<b>", "\U0001f600", "word"]
    texts = [None, "", " ", "\n\n", "a b c d e a b c d e", "a b\na b\n a b\n\x0b\n", "long " * 400000]
    texts += [random.choice([" ", "\n", "\t"]).join(random.choice(words) for _ in range(random.randint(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    rows = {r.doc_id: r for r in quality_rules.assess(docs).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        n, chars, symbols, dup, repeat = plain_measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (r.kept and r.base_failed)


def test_clean_texts_are_kept(spark):
    random.seed(2)
    clean = " ".join(f"w{random.randint(0, 5000)}" for _ in range(300))
    docs = spark.createDataFrame([(1, clean, 9), (2, clean[:200] + " " + clean[:200] * 5, 9), (3, None, 9)], "doc_id long, text string, kept int")
    got = quality_rules.accepted(docs)
    assert got.columns == docs.columns and got.collect()[0] == (1, clean, 9) and got.count() == 1


def test_licence_texts(spark):
    mit = dict(license_scan.KNOWN_TEXTS)["MIT"]
    other = "Copyright (c) 2020 Some One\n" + mit.upper().replace("LICENSE", "LICENCE").replace(".", " .")
    texts = [mit, other, "/* Released under the MIT Licence! */", mit + " more", None, "", mit]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license_id string")
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.catalogue(spark)).collect()}
    assert [got[i].license_id for i in range(7)] == ["MIT", "MIT", "MIT", None, None, None, "MIT"]
    assert got[5].n_canonical_words == 0


def test_licence_sql_agrees(spark):
    import duckdb

    texts = [t for _, t in license_scan.KNOWN_TEXTS] + ["Ünïcode “quotes” – http www\n© me\nCOPYRIGHT x\nper cent", "", "  \n "]
    rows = [(i, t) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE d (i INT, t VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", rows)
    want = dict(con.execute(f"SELECT i, {license_scan.canonical_sql('t')} FROM d").fetchall())
    df = spark.createDataFrame(rows, "i int, t string")
    assert {r.i: r.c for r in df.select("i", license_scan.canonical(df.t).alias("c")).collect()} == want


def test_other_spellings_are_found(spark):
    """Every known text with a copyright line, capitals, other spellings and punctuation; phrases inside words stay."""
    known = license_scan.KNOWN_TEXTS
    rows = [(i, license_scan.other_spelling(text)) for i, (_, text) in enumerate(known)] + [(99, "super century"), (98, known[0][1] + " more"), (97, known[0][1]), (97, known[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_scan.scan(docs, license_scan.catalogue(spark)).collect()
    found = {r.doc_id: r.license_id for r in got}
    assert len(got) == len(rows) and [found[i] for i in range(len(known))] == [k for k, _ in known]
    assert found[99] is None and found[98] is None and found[97] == "MIT"
    shown = docs.where("doc_id = 99").select(license_scan.canonical(docs.text).alias("c")).first().c
    assert shown == "super century"
