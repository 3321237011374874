"""Quality rules, the class model and token counts against brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from ledgerlight.llm import class_lm, quality_rules, token_counts


def stats(text):
    text = text or ""
    words = text.encode().split()
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_equal_brute_force(docs, corpus, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = quality_rules.quality_verdicts(docs, labels).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    want = {i: stats(text) for i, text, *_ in corpus}
    assert got == want
    for r in rows:  # without labels the floor alone decides
        assert r.base_failed == (want[r.doc_id][0] < 50 or 100 * want[r.doc_id][4] > 50 * want[r.doc_id][0])
        assert r.kept == (not r.base_failed)


def test_cutoffs_reject_junk_and_keep_their_bound(spark, words):
    import random

    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1600):
        text = rng.choices(words, k=60)
        bad = i % 4 == 0
        if bad:
            text = [w + "###" for w in text]
        elif i % 100 == 1:
            text[0] += "#"
        rows.append((i, " ".join(text), "en" if i % 3 else None))
        labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, None), (5, 1, 1)], "doc_id bigint, quality int, toxic int")
    verdicts = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs, marks, risk=0.2).collect()}
    good = [i for i, q, _ in labels if q]
    assert not any(verdicts[i] for i, q, _ in labels if not q)
    assert sum(not verdicts[i] for i in good) <= 0.2 * len(good)
    kept = quality_rules.quality_filter(docs, marks, risk=0.2)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in verdicts.items() if k) and kept.columns == docs.columns


def test_binomial_bounds():
    for n, k, p in ((50, 3, 0.2), (400, 0, 0.01), (400, 1, 0.01), (30, 30, 0.5), (10, 2, 0.2)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        found = quality_rules.binomial_tail(k, n, p)
        assert abs(found - exact) < 1e-9 or (k > n * p and found == 1.0)
    assert quality_rules.binomial_tail(0, 0, 0.1) == 1.0
    assert quality_rules.chosen_step([300, 0, 0, 9], [0, 40, 0, 5], 0.02, 0.0125, 5.0) == 1
    assert quality_rules.chosen_step([230, 1, 60, 9], [0, 40, 5, 5], 0.02, 0.0125, 5.0) == 0  # one of 300 cannot be told from 2 %
    assert quality_rules.chosen_step([3000, 1, 60, 9], [0, 40, 5, 5], 0.02, 0.0125, 5.0) == 1
    assert quality_rules.chosen_step([216, 0], [0, 40], 0.02, 0.0125, 5.0) == 0  # too few to bound anything
    assert quality_rules.chosen_step([217, 0], [0, 40], 0.02, 0.0125, 5.0) == 1


def test_a_ladder_lowers_the_rule_that_tells_bad_from_others():
    levels = quality_rules.LEVELS
    zero = {rule: [0] * (levels + 1) for rule in quality_rules.RULES}
    assert all(cuts == [levels] for cuts in quality_rules.ladder(zero, zero).values())
    bad, others = {r: list(v) for r, v in zero.items()}, {r: list(v) for r, v in zero.items()}
    bad["symbol_rate"][30], bad["symbol_rate"][2], others["symbol_rate"][2] = 50, 50, 4000
    bad["upper_rate"][10], others["upper_rate"][10] = 100, 500
    steps = quality_rules.ladder(bad, others)
    assert [c[:4] for c in (steps["symbol_rate"], steps["upper_rate"])] == [[levels, 29, 29, 1], [levels, levels, 9, 9]]
    for cuts in steps.values():
        assert cuts == sorted(cuts, reverse=True) and len(cuts) == len(steps["upper_rate"])


def test_every_stratum_with_enough_holdouts_has_cutoffs_at_the_risk_of_production(spark, words):
    import random

    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1500):
        lang = "en" if i < 900 else "fr" if i < 1400 else "de"
        bad = i % 5 == 0
        text = [w + "###" * bad for w in rng.choices(words, k=60)]
        rows.append((i, " ".join(text), lang))
        if i % 2 or lang == "fr":
            labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    cuts = {r.stratum: r for r in quality_rules.choose_cutoffs(quality_rules.with_rates(quality_rules.document_stats(docs)), marks).collect()}
    assert set(cuts) == {"en", "fr", "de"} and cuts["de"].symbol_rate == 1.0  # 40 good holdouts
    kept = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs, marks).collect()}
    assert all(kept[i] for i, _, lang in rows if i % 5 or lang == "de")
    assert not any(kept[i] for i, good, _ in labels if not good and i < 1400)
    gone = [not kept[i] for i, _, lang in rows if i % 5 == 0 and lang != "de"]
    assert sum(gone) >= 0.95 * len(gone)


def test_quality_of_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_rules.quality_verdicts(odd, labels).count() == odd.count()
    assert quality_rules.quality_filter(odd, labels).columns == odd.columns
    assert quality_rules.quality_verdicts(none, labels).collect() == []


def test_scores_equal_their_formula(docs, corpus):
    counts = Counter()
    for i, text, *_ in corpus:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update([*(text or "").encode().lower().split(), b""])
    total, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in class_lm.scored(docs).collect()}
    assert len(got) == len(corpus)
    for i, text, *_ in corpus:
        tokens = [*(text or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        row = got[i]
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert row.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert row.score < 0


@pytest.mark.parametrize("known", [50_000, 40])
def test_scores_follow_from_the_classes(docs, corpus, monkeypatch, known):
    """score of every document, worked out token by token from the class of every word."""
    monkeypatch.setattr(class_lm, "KNOWN", known)
    monkeypatch.setattr(class_lm, "CORE", known // 2)
    kept = {}
    whole = class_lm.word_classes

    def word_classes(coded, size):
        kept["of"], rest = whole(coded, size)
        kept["rest"] = {r["word"]: r for r in rest.collect()}
        return kept["of"], rest

    monkeypatch.setattr(class_lm, "word_classes", word_classes)
    got = {r.doc_id: r.score for r in class_lm.scored(docs).collect()}

    texts = {i: [*(text or "").encode().lower().split(), b""] for i, text, *_ in corpus}
    trained = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for i in trained for w in texts[i])
    prints = {w: int(class_lm._hashed([w])[0][0]) for w in set().union(*texts.values()) if w}
    ranked = sorted((w for w in counts if w), key=lambda w: (-counts[w], prints[w]))
    of = {b"": 0}
    classes = class_lm.CLASSES
    size = len(kept["of"]) - 2
    if size == len(ranked):
        of |= {w: int(kept["of"][k + 1]) for k, w in enumerate(ranked)}
    else:  # of the words with the least count, some have an index: the ones without a row of the rest
        some = [w for w in ranked if prints[w] not in kept["rest"]]
        assert len(some) == size
        of |= {w: int(kept["of"][k + 1]) for k, w in enumerate(some)}
    votes = {}
    for w in ranked:
        row = kept["rest"].get(prints[w])
        if row is not None:
            of[w] = row["class"]
            assert row["n"] == counts[w] and row["spelling"] == class_lm._spellings([w])[0]
            votes.setdefault(row["spelling"], Counter())[row["class"]] += 1
    everywhere = sum(votes.values(), Counter()) if votes else Counter(c for w, c in of.items() if w)

    def class_of(w):
        if w in of:
            return of[w]
        found = votes.get(class_lm._spellings([w])[0], everywhere)
        return max(range(classes), key=lambda c: (found[c], -c))

    steps, tokens, members = Counter(), Counter(), Counter()
    for w, c in of.items():
        tokens[c] += counts[w]
        members[c] += 1
    for i in trained:
        path = [0, *map(class_of, texts[i])]
        steps.update(zip(path, path[1:], strict=False))
    out = Counter()
    for (a, _), n in steps.items():
        out[a] += n
    for i, text in texts.items():
        path = [0, *map(class_of, text)]
        score = sum(
            math.log10((steps[a, b] + 0.5) / (out[a] + 0.5 * classes)) + math.log10((counts[w] + 0.1) / (tokens[b] + 0.1 * (members[b] + 1)))
            for a, b, w in zip(path, path[1:], text, strict=False)
        )
        assert math.isclose(got[i], score, rel_tol=1e-9), i


def test_class_model_beats_word_counts_on_held_out_text(spark):
    import random

    rng = random.Random(3)
    nouns, verbs = [f"n{k}" for k in range(40)], [f"v{k}" for k in range(40)]
    rows = [(i, " ".join(rng.choice(nouns) + " " + rng.choice(verbs) for _ in range(60))) for i in range(300)]
    scored = class_lm.scored(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").collect()
    assert scored and all(r.score > r.base_score for r in scored)


@pytest.mark.parametrize(("core", "known"), [(4096, 50_000), (4096, 100), (200, 400), (200, 800)])
def test_rare_words_of_one_ending_go_by_their_neighbours(spark, monkeypatch, core, known):
    import random

    monkeypatch.setattr(class_lm, "CORE", core)
    monkeypatch.setattr(class_lm, "KNOWN", known)
    rng = random.Random(3)
    nouns, verbs = [f"n{k}end" for k in range(400)], [f"v{k}end" for k in range(400)]
    rows = [(i, " ".join(rng.choice(nouns) + " " + rng.choice(verbs) for _ in range(60))) for i in range(600)]
    scored = class_lm.scored(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in scored) / sum(r.n_tokens for r in scored)
    assert gain > 0.2  # half of the words can follow: log10 2 is 0.3


def test_rare_words_travel_once_a_slice(spark, words, monkeypatch, tmp_path):
    """Bytes that come back to the documents for each token that is not known."""
    import random
    from uuid import uuid4

    monkeypatch.setattr(class_lm, "KNOWN", 40)
    monkeypatch.setattr(class_lm, "CORE", 20)
    whole = class_lm._filled

    def filled(batches):
        sizes = []
        yield from whole(sizes.append(batch.nbytes) or batch for batch in batches)
        (tmp_path / uuid4().hex).write_text(str(sum(sizes)))

    monkeypatch.setattr(class_lm, "_filled", filled)
    rng = random.Random(9)
    many = [f"{a}{b}" for a in words for b in words[:30]]
    rows = [(i, " ".join(rng.choices(many, k=1500))) for i in range(200)]
    assert class_lm.scored(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)).count() == len(rows)
    moved = sum(int(path.read_text()) for path in tmp_path.iterdir())
    assert 0 < moved < 10 * 1500 * len(rows)  # one row a token took 53


@pytest.mark.parametrize("buckets", [1, 7])
def test_ranges_of_words_leave_scores_alone(docs, monkeypatch, buckets):
    monkeypatch.setattr(class_lm, "KNOWN", 40)
    monkeypatch.setattr(class_lm, "CORE", 20)
    want = sorted(map(tuple, class_lm.scored(docs).collect()))
    monkeypatch.setattr(class_lm, "BUCKETS", buckets)
    assert sorted(map(tuple, class_lm.scored(docs).collect())) == want


def test_counts_of_more_rare_words_than_16_bits_tell(spark, monkeypatch):
    """One slice has 80,000 distinct words, and others that training has not seen."""
    monkeypatch.setattr(class_lm, "KNOWN", 40)
    monkeypatch.setattr(class_lm, "CORE", 20)
    texts = {i: " ".join(f"{k:x}" for k in range(i, 80_000 + 1000 * i, 1 + i)) for i in range(12)}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    assert True in held.values()
    counts = Counter(w for i, t in texts.items() if not held[i] for w in [*t.split(), ""])
    norm = math.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    for r in class_lm.scored(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1)).collect():
        tokens = [*texts[r.doc_id].split(), ""]
        assert (r.n_tokens, r.n_known, r.held_out) == (len(tokens), sum(counts[w] > 0 for w in tokens), held[r.doc_id])
        assert math.isclose(r.base_score, sum(math.log10(counts[w] + 0.1) - norm for w in tokens), rel_tol=1e-9)


def test_without_training_documents_no_word_is_known(spark):
    held = [i for i in range(100) if class_lm.held_out(i)]
    rows = class_lm.scored(spark.createDataFrame([(i, "a b a") for i in held] + [(None, None)], "doc_id bigint, text string")).collect()
    assert len(rows) == len(held) + 1
    assert all(r.held_out and (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score) for r in rows)


def likelihood(steps, of, classes):
    member = np.eye(classes)[of]
    table = member.T @ steps @ member
    return (class_lm._xlogx(table).sum() - class_lm._xlogx(table.sum(axis=0)).sum() - class_lm._xlogx(table.sum(axis=1)).sum())


def test_exchange_ends_where_no_move_helps():
    rng = np.random.default_rng(0)
    group = rng.integers(0, 3, 25)
    steps = rng.poisson(np.where((group[:, None] + 1) % 3 == group[None, :], 30, 2)).astype(float)
    of = class_lm.exchange(steps, classes=4, rounds=50)
    best = likelihood(steps, of, 4)
    start = np.concatenate(([0], 1 + np.arange(24) % 3))
    assert of[0] == 0 and best > likelihood(steps, start, 4)
    for unit in range(1, 25):
        for other in range(1, 4):
            moved = of.copy()
            moved[unit] = other
            assert likelihood(steps, moved, 4) <= best + 1e-6


def test_scores_of_odd_rows(odd, none):
    rows = class_lm.scored(odd).collect()
    assert len(rows) == odd.count() and all(r.n_tokens >= 1 for r in rows)
    assert class_lm.scored(none).collect() == []


def best_count(pieces, text):
    """Tokens of the most likely segmentation, by trying all ends of every prefix."""
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        size = len(text[end - 1].encode())
        options = [(best[end - 1][0] + size * pieces.byte, -(-best[end - 1][1] + size))]
        for start in range(end):
            if text[start:end] in pieces.score:
                options.append((best[start][0] + pieces.score[text[start:end]], best[start][1] - 1))
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_equal_word_by_word(docs, corpus, odd, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = token_counts.Pieces(path)
    known = {}
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.counted(docs, path).collect()}
    for i, text, *_ in corpus:
        words = (text or "").encode().split()
        for w in words:
            known.setdefault(w, best_count(pieces, token_counts.LEAD + w.decode()))
        assert got[i] == (len(words), sum(known[w] for w in words))
    assert token_counts.counted(odd, path).count() == odd.count()
    assert token_counts.counted(none, path).collect() == []


def test_a_trie_forgets_and_counts_the_same(monkeypatch):
    pieces = token_counts.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [[b"internationalisation", b"international", b"inter"], [b"\xff\xfe", "日本語".encode()], [b"inter"] * 3]
    want = token_counts.Trie(pieces).count(texts)
    monkeypatch.setattr(token_counts, "MOST_WORDS", 2)
    small = token_counts.Trie(pieces)
    assert [small.count([t])[0] for t in texts] == want
