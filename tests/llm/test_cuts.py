"""Fill-in-the-middle, clusters by a vantage-point tree and the ledger of secrets against brute force."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import fill_middle as fim
from ledgerlight.llm import secret_ledger as ledger
from ledgerlight.llm import vantage_kmeans as vk


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cut(doc_id, text, units=list):
    text, digest = text or "", sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    parts = units(text)
    a, b = sorted((h[0] % (len(parts) + 1), h[1] % (len(parts) + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(parts), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(parts), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(parts), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ODD_TEXTS = [
    None, "", " ", "a", "<", "<P", "<P>", "x<M>y", "<S", ">", "P>", "é", "日本語テキスト", "á‍👩‍👩‍👧",
    "\x00nul\x00", "line\n\nline\r\n", "\n", "  two  words ", "M>" * 30, "<<" * 30,
]


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(2)
    texts = ODD_TEXTS + ["".join(rng.choices("aé日👩 \n<>PSM", k=rng.randint(0, 80))) for _ in range(400)]
    rows = [(i, t, i % 3) for i, t in enumerate(texts)]
    return rows + rows[:30] + [(None, "no id", 1), (None, None, 1), (-7, "minus", 2)]


UNITS = {
    "char": list,
    "line": lambda t: re.findall(r"[^\n]*\n|[^\n]+\Z", t),
    "word": lambda t: re.findall(r"\A[ \t-\r]+|[^ \t-\r]+[ \t-\r]*", t),
}


@pytest.mark.parametrize("unit", list(UNITS))
def test_forms_equal_brute_force_and_come_back(spark, cases, unit):
    docs = spark.createDataFrame(cases, "doc_id bigint, text string, form int").repartition(3)
    made = fim.fill_middle(docs, unit=unit)
    got = sorted(map(tuple, made.collect()), key=str)
    assert got == sorted((cut(i, t, UNITS[unit]) for i, t, _ in cases), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = made.select(fim.restored(F.col("form"), F.col("output"))).collect()
    assert sorted(r[0] for r in back) == sorted(t or "" for _, t, _ in cases)


def test_long_texts_are_laid_out_in_parts(spark, monkeypatch):
    import pyarrow as pa

    rng = random.Random(6)
    texts = ["".join(rng.choices("aé日👩 ", k=n)) for n in (0, 3, 900, 40, 5, 0, 2000, 1)]
    monkeypatch.setattr(fim, "AT_ONCE", 64)
    draws = [[int(sha(f"1:{i}")[8 * k : 8 * k + 8], 16) for i in range(len(texts))] for k in range(4)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts), *map(pa.array, draws)], names=["doc_id", "text", "h1", "h2", "h3", "h4"]
    )
    for part in (batch, batch.slice(2, 5)):
        got = [tuple(r.values()) for b in fim._transformed("char", 90, 20)(iter([part])) for r in b.to_pylist()]
        assert got == [cut(r["doc_id"], r["text"]) for r in part.to_pylist()]
    monkeypatch.undo()
    long = spark.createDataFrame([(4, "aé日" * 400_000), (5, "x")], "doc_id bigint, text string")
    assert sorted(map(tuple, fim.fill_middle(long).collect())) == [cut(4, "aé日" * 400_000), cut(5, "x")]


def test_no_documents_have_no_forms(none, odd):
    assert fim.fill_middle(none).collect() == []
    assert fim.fill_middle(odd).count() == odd.count()
    with pytest.raises(ValueError, match="no such unit"):
        fim.fill_middle(none, unit="page")


# -- clusters ----------------------------------------------------------------------------


def lloyd(rows, k, rounds, width=4, scale=1024):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and abs(x) < float("inf") for x in v):
            kept.append((i, tuple(int(max(min(Fraction(x) * scale, vk.MOST), -vk.MOST) // 1) for x in v)))
    ordered = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else sha(f"3:{r[0]}"), r[1]))
    centroids = [v for _, v in ordered[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), f in zip(kept, found, strict=True) if f == j]
            if own:
                centroids[j] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(k)}
    digests = [sha(",".join(map(str, c))) for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia.values()), digests[c]) for i, c, d in found]


def test_clusters_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(rng.choice([-1, 0, 2]), 0.3) for _ in range(4)]) for i in range(300)]
    rows += [(i, [round(x) / 4 for x in rng.choices(range(-3, 4), k=4)]) for i in range(300, 600)]  # ties
    rows += [(700 + i, [0.5, 0.5, -0.5, 0.25]) for i in range(150)] + rows[:20]
    rows += [(None, [0.1] * 4), (None, None), (1, None), (2, []), (3, [1.0] * 3), (4, [1.0] * 5), (5, [None, 1.0, 1.0, 1.0])]
    rows += [(6, [float("nan"), 1.0, 1.0, 1.0]), (7, [float("inf"), 0.0, 0.0, 0.0]), (8, [-0.0] * 4), (9, [1e300, -1e300, 1e20, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, cluster int, distance int").repartition(3)
    for k, rounds in ((8, 10), (1, 2), (23, 4)):
        got = vk.clustered(df, k=k, rounds=rounds, width=4).collect()
        assert sorted(map(tuple, got), key=str) == sorted(lloyd(rows, k, rounds), key=str), k
    few = df.where("vec_id < 5 AND embedding IS NOT NULL")
    assert sorted(map(tuple, vk.clustered(few, width=4).collect()), key=str) == sorted(
        lloyd([r for r in rows if r[0] is not None and r[0] < 5 and r[1] is not None], 8, 10), key=str
    )


def test_no_vectors_have_no_clusters(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vk.clustered(none).collect() == []
    assert vk.clustered(spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")).collect() == []


def test_the_tree_finds_the_nearest_with_the_smaller_number():
    rng = np.random.default_rng(1)
    for size, width, span in ((1, 3, 5), (2, 1, 1), (9, 2, 3), (200, 3, 4), (300, 16, 1000), (64, 2, vk.MOST)):
        centroids = rng.integers(-span, span + 1, (size, width))
        vectors = rng.integers(-span, span + 1, (500, width))
        number, gap = vk.VantageTree(centroids).nearest(vectors)
        every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert np.array_equal(gap, every.min(axis=1)) and np.array_equal(number, every.argmin(axis=1))


def test_the_tree_leaves_far_centroids_out(monkeypatch):
    rng = np.random.default_rng(4)
    centroids = rng.integers(-100_000, 100_000, (256, 2))
    vectors = centroids[rng.integers(0, 256, 400)] + rng.integers(-50, 50, (400, 2))
    taken = []
    whole = vk.squares
    monkeypatch.setattr(vk, "squares", lambda v, p: taken.append(len(v)) or whole(v, p))
    tree = vk.VantageTree(centroids)
    taken.clear()
    tree.nearest(vectors)
    assert sum(taken) < 400 * 256 / 8


# -- secrets -----------------------------------------------------------------------------

WORDS = ["password", "PassWD", "secret", "toKen", "apikey", "API_KEY", "ſecret", "toKen"]


def told(text):
    text = text or ""
    found = []
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for k, (kind, pattern, least, group) in enumerate(
        [
            ("assign", rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
            ("access", "AKIA[A-Z0-9]+", 16, 0),
            ("hex", "[0-9a-f]+", 32, 0),
            ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/= \t-\r]*", 64, 0),
            ("bearer", r"[Bb]earer [A-Za-z0-9._~+/=-]+", 32, 0),
            ("forge", "gh[pousr]_[A-Za-z0-9]+", 40, 0),
        ]
    ):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)

    def value(n):
        return "".join(rng.choices("abcdef0123456789", k=n))

    def one():
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(
                rng.choice(
                    [
                        rng.choice(WORDS) + rng.choice(["", '"', "'"]) + " " * rng.randint(0, 2) + rng.choice(":= ") + rng.choice(["", " ", " '", '"']) + value(rng.randint(4, 40)),
                        "AKIA" + value(rng.randint(8, 20)).upper() + rng.choice(["", "AKIA"]),
                        value(rng.randint(28, 70)),
                        "é日👩 " * rng.randint(0, 3),
                        "Bearer " + value(rng.randint(20, 40)),
                        "ghp_" + value(rng.randint(34, 38)),
                        "-----BEGIN RSA PRIVATE KEY-----\n" + value(64) + "\n" + value(10) + "-",
                        "secret: token: " + value(12),
                    ]
                )
            )
        return rng.choice([" ", "", "\n"]).join(parts)

    return [None, "", "plain", *(one() for _ in range(300)), "x" * 3000 + " token=" + "é" * 3000 + value(40)]


def versions_of(spark, texts):
    rows = [(i, t, 1, 2) for i, t in enumerate(texts)] + [(i, texts[i % 40], 1, 2) for i in range(1000, 1200)]
    rows += [(None, texts[5], 1, 2), (3, texts[3], 1, 2), (3, texts[9], 1, 2)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, blob int, findings int").repartition(5), rows


def findings(df):
    return sorted(((r.row.doc_id, [tuple(f) for f in r.findings]) for r in df.collect()), key=str)


def test_findings_equal_brute_force(spark, texts, tmp_path, monkeypatch):
    versions, rows = versions_of(spark, texts)
    want = sorted(((i, told(t)) for i, t, *_ in rows), key=str)
    assert len({f[0] for _, found in want for f in found}) == 6
    made = ledger.scan_history(versions, str(tmp_path / "one"))
    assert findings(made) == want and made.columns == ["row", "blob", "findings"]
    monkeypatch.setattr(ledger, "ROWS_A_PART", 3)  # each text that is hot in so small a table is split
    assert findings(ledger.scan_history(versions, str(tmp_path / "two"))) == want


def scans(spark, path):
    return sorted((r.blob.hex(), tuple(r.rules), r.load) for r in ledger.read_ledger(spark, path).collect())


def test_only_unseen_texts_and_rule_versions_are_scanned(spark, texts, tmp_path):
    path, rules = str(tmp_path / "ledger"), ledger.BASE
    versions, rows = versions_of(spark, texts)
    early, late = versions.where("doc_id < 200"), versions.where("doc_id >= 200 OR doc_id IS NULL")
    ledger.scan_history(early, path, rules, load=0)
    first = scans(spark, path)
    assert len(first) == len({t or "" for i, t, *_ in rows if i is not None and i < 200})
    assert findings(ledger.scan_history(late, path, rules, load=1)) == sorted(
        ((i, [f for f in told(t) if f[0] in ("assign", "access", "hex")]) for i, t, *_ in rows if i is None or i >= 200), key=str
    )
    both = scans(spark, path)
    assert [s for s in both if s[2] == 0] == first and len({s[0] for s in both}) == len(both) == len({t or "" for _, t, *_ in rows})

    # the same versions again: nothing to scan; the load that brought texts, repeated: the same rows
    ledger.scan_history(versions, path, rules, load=2)
    assert scans(spark, path) == both
    ledger.scan_history(late, path, rules, load=1)
    assert scans(spark, path) == both

    # a new version of one rule: all texts by that rule alone, and the old findings of it go
    newer = (*ledger.BASE[:2], ledger.Rule("hex", 2, rb"[0-9a-f]{40,}", 40))
    made = ledger.scan_history(versions, path, newer, load=3)
    assert {s[1] for s in scans(spark, path) if s[2] == 3} == {("hex@2",)}
    assert findings(made) == sorted(
        ((i, [f for f in told(t) if f[0] in ("assign", "access") or f[0] == "hex" and f[2] - f[1] >= 40]) for i, t, *_ in rows), key=str
    )


def test_no_versions_have_no_findings(spark, none, odd, tmp_path):
    assert ledger.scan_history(none, str(tmp_path / "a")).collect() == []
    assert ledger.scan_history(odd, str(tmp_path / "b")).count() == odd.count()
    # an empty load can be read and added to
    assert ledger.scan_history(odd, str(tmp_path / "a"), load=1).count() == odd.count()


@pytest.mark.parametrize("text", ["password" * 20_000, "token" + " " * 100_000, "AKIA" * 25_000, "-----BEGIN " + "A " * 50_000, "gh" * 50_000, "abcdef0" * 4 * 10_000])
def test_long_odd_texts_take_linear_time(text):
    import time

    start = time.time()
    for rule in ledger.BASE + ledger.MORE:
        rule.spans(text.encode())
    assert time.time() - start < 2
