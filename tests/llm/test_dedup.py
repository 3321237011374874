"""MinHash and suffix dedup against brute force."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerlight.llm import components, minhash_dedup, suffix_dedup
from ledgerlight.llm.hashing import shingles


def near_components(rows):
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    root[i] = root[j] = min(root[i], root[j])
        if all(root[root[i]] == root[i] for i in root):
            break
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def test_near_duplicates_equal_brute_force(docs, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == near_components(corpus)
    kept = sorted(r.doc_id for r in minhash_dedup.keep_first(docs).collect())
    assert kept == sorted(i for i, v in got.items() if v[2])


def test_near_duplicates_of_odd_rows(odd, none):
    found = minhash_dedup.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    assert minhash_dedup.near_duplicates(none).collect() == []
    assert minhash_dedup.keep_first(odd).columns == odd.columns


def test_a_crowd_of_near_copies_loses_no_link(spark, words):
    """Copies so edited that many are not close to the smallest id of their bucket."""
    import random

    rng = random.Random(2)
    base = rng.choices(words, k=80)
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(80)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: v[1] for i, v in near_components(rows).items()}


def test_shingles_are_those_of_the_words():
    texts = [b"A b c d e f", b"a  b\tc\nd e f ", b"a b", b"B A", b"", b"a b c d e x f"]
    sets = [set(s.tolist()) for s in shingles(texts, 5)]
    assert sets[0] == sets[1] and len(sets[0]) == 2
    assert len(sets[2]) == 1 and sets[2] != sets[3] and not sets[4]
    assert len(sets[5]) == 3 and len(sets[5] & sets[0]) == 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 3), (None, 1), (20, 21), (21, 22), (22, 23), (23, 20)]
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")
    assert {r.node: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 1, 7: 1, 4: 4, 5: 4, 20: 20, 21: 20, 22: 20, 23: 20}
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component_id for r in components.components(chain, "a", "b").collect()} == {0}


def removals(rows):
    first = defaultdict(lambda: 2**63)
    for i, text, *_ in rows:
        data = (text or "").encode()
        i = 2**63 - 1 if i is None else i
        for k in range(len(data) - 49):
            first[data[k : k + 50]] = min(first[data[k : k + 50]], i)
    found = []
    for i, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < (2**63 - 1 if i is None else i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        found.append((2**63 - 1 if i is None else i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def removed(frame):
    rows = frame.selectExpr("row.doc_id", "n_bytes", "spans", "sha2(kept, 256) AS sha").collect()
    return sorted(((2**63 - 1 if r[0] is None else r[0], r[1], sum(s["end"] - s["start"] for s in r[2]), len(r[2]), r[3]) for r in rows), key=str)


@pytest.mark.parametrize("chunk", [1 << 21, 2000])
def test_removed_bytes_equal_brute_force(docs, corpus, odd, chunk):
    assert removed(suffix_dedup.remove_repeats(docs, chunk)) == removals(corpus)
    if chunk == 2000:
        assert removed(suffix_dedup.remove_repeats(odd, chunk)) == removals([tuple(r)[:2] for r in odd.collect()])


def test_texts_without_repeats(odd, none):
    rest = suffix_dedup.without_repeats(odd)
    assert rest.columns == odd.columns and rest.count() == odd.count()
    assert suffix_dedup.remove_repeats(none).collect() == []


def test_cut_texts_keep_whole_characters(spark):
    import random

    rng = random.Random(3)
    shared = "".join(rng.choices("éèêëàâ日本語abc ", k=80))
    rows = [(k, "".join(rng.choices("éèêëàâ日本", k=20)) + shared[k % 3 : 60 + k] + "".join(rng.choices("éèêëàâ日本", k=20))) for k in range(20)]
    rows += [(30, None), (31, ""), (32, rows[4][1])]
    rest = {r.doc_id: r.text for r in suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            first.setdefault(data[k : k + 50], i)
    for i, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        want, at = "", 0
        for c in text or "":
            size = len(c.encode())
            want += "" if any(gone[at : at + size]) else c
            at += size
        assert rest[i] == want
    assert "\ufffd" not in "".join(rest.values()) and rest[32] == ""


def test_rows_of_one_id_are_one_node(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b), (4, "other words that are in no other text")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(rows).collect())
    assert got == [(3, 3, True), (4, 4, True), (5, 3, False), (5, 3, False), (9, 3, False)]


def test_equal_strings_choose_alike():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 101, 50, dtype=np.uint8)
    one = np.concatenate((rng.integers(97, 101, 40, dtype=np.uint8), shared, rng.integers(97, 101, 40, dtype=np.uint8)))
    two = np.concatenate((rng.integers(97, 101, 7, dtype=np.uint8), shared))
    picks = [set((suffix_dedup.chosen(t, np.array([len(t)]))[0] - start).tolist()) for t, start in ((one, 40), (two, 7))]
    assert picks[0] & picks[1] & set(range(suffix_dedup.AROUND + 1))
