"""The stages one by one, and the registered queries of this part."""

import random
from collections import Counter

import compare
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from casebook import SMALL
from tokenizers import Tokenizer

import __spark_entry__ as contract
from ledgerlight.llm import minhash_dedup, mixing, packing, quality_rules, suffix_dedup
from ledgerlight.llm import oracle, queries


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in queries.registered()] == list(range(1, 14))
    assert {*queries.registered(), "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", list(oracle.statements()))
def test_query_equals_sql(spark, name):
    assert compare.differs(queries.registered()[name](spark, SMALL), compare.connect(SMALL), name) is None


def test_stages_take_effect(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = rows.columns, []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, rows, SMALL)
        if name == "quality":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            kept = quality_rules.quality_verdicts(rows, labels).where("kept").select("doc_id")
            assert sorted(kept.collect()) == sorted(made.select("doc_id").collect())
        if name == "near_duplicates":
            kept = minhash_dedup.near_duplicates(rows).where("kept").select("doc_id")
            assert sorted(kept.collect()) == sorted(made.select("doc_id").collect())
        if name == "repeats":
            left = suffix_dedup.remove_repeats(rows, characters=True).selectExpr("row.doc_id", "octet_length(kept) AS n")
            assert sorted(map(tuple, left.collect())) == sorted(map(tuple, made.selectExpr("doc_id", "octet_length(text)").collect()))
        if name == "mix":
            taken = [r for r in mixing.taken(rows).collect() for _ in range(r.epochs + (r.rest > 0 and 2 * r.rest >= r["size"]))]
            assert sorted(r.doc_id for r in taken) == sorted(r.doc_id for r in made.select("doc_id").collect())
        seen.append(name)
        if name != "pack":
            assert made.columns == columns
            rows = mixing.stored(made)
    assert seen == ["quality", "near_duplicates", "repeats", "mix", "pack"]
    docs = rows.count()
    assert made.where("start = 0").count() == docs
    lengths = [r[0] for r in made.groupBy("sequence_id").sum("length").select("sum(length)").collect()]
    assert all(n == packing.WINDOW or n & (n - 1) == 0 for n in lengths)


def plain_run(rows):
    """What quality, near-duplicates and repeats leave of (doc_id, text): without labels the floor alone rejects."""
    kept = []
    for i, text in rows:
        words = (text or "").encode().split()
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        if len(words) >= 50 and 100 * len(covered) <= 50 * len(words):
            kept.append((i, text))

    def shingles(text):
        words = text.encode().lower().split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    sets = [shingles(t) for _, t in kept]
    root = {i: i for i, _ in kept}
    for _ in kept:
        for (i, _), a in zip(kept, sets, strict=True):
            for (j, _), b in zip(kept, sets, strict=True):
                if 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    kept = [(i, t) for i, t in kept if root[i] == i]

    first = {}
    for i, text in kept:
        data = text.encode()
        for k in range(len(data) - 49):
            first[data[k : k + 50]] = min(first.get(data[k : k + 50], i), i)
    rest = []
    for i, text in kept:
        data, at, left = text.encode(), 0, ""
        gone = [False] * len(data)
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        for c in text:
            left += "" if any(gone[at : at + len(c.encode())]) else c
            at += len(c.encode())
        rest.append((i, left))
    return rest


def test_run_equals_plain_python(spark, tmp_path):
    """The whole pipeline over texts with accents, copies, near copies, shared passages and equal rows."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdeéèßñ日", k=rng.randint(2, 7))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(40, 150))) for _ in range(40)]
    passage = " ".join(rng.choices(words, k=30))
    texts += [texts[2], texts[2] + " more", f"{texts[5]} {passage} {texts[6]}", f"é{passage[1:]} {texts[7][:40]} " + " ".join(rng.choices(words, k=60))]
    texts += ["short", None, "", "again and again " * 40, " ".join(rng.choices(words, k=3000))]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[9]] * 3
    folder = str(tmp_path)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    rest = plain_run([(r[0], r[1]) for r in rows])
    assert 30 < len(rest) < len(rows)
    by_id = {r[0]: r for r in rows}
    frame = spark.createDataFrame([(i, t, "en", by_id[i][3], len(t)) for i, t in rest], docs.schema)
    copies = Counter()
    for r in mixing.mixed(frame).collect():  # the draw is tested by itself
        copies[r.doc_id] += r.epochs + (r.rest > 0 and 2 * r.rest >= r["size"])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    seen = {}
    for piece in corpus_pipeline.run(spark, folder).collect():
        ids = np.frombuffer(piece.ids, "<u4").tolist()
        assert len(ids) == piece.length
        for k, token in enumerate(ids):
            seen.setdefault(piece.doc_id, Counter())[piece.start + k, token] += 1
    texts = dict(rest)
    assert set(seen) == {i for i, n in copies.items() if n}
    for i, counts in seen.items():
        want = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, packing.END]
        assert counts == {(k, token): copies[i] for k, token in enumerate(want)}


def test_stages_take_odd_rows_and_none(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).collect() == [], name
        made = stage(spark, odd, SMALL)
        assert made.count() > 0, name
        if name != "pack":
            assert made.columns == odd.columns
