"""Text extraction, chat formatting, mixing, packing and vector links against brute force."""

import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerlight.llm import chat_format, cover_tree, html_text, mixing, packing

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="ad">Buy now, buy a lot, buy everything that there is to buy today.</div>
%s
<aside>See also</aside><div id="comments"><p>First! This comment is quite long, longer than all of the article.</p></div>
<form><p>Your name</p><input name="n"></form><footer>&copy; 2024</footer></body></html>"""


def test_the_article_without_what_is_around_it():
    article = "<article><h1>Head&amp;line</h1><p><b>One\n  two<br>three.<p>Four &eacute; <i>five</i> &#x41;.</p><ul><li>x<li>y</ul></article>"
    want = "Head&line\n\nOne two three.\n\nFour é five A.\n\nx\n\ny"
    assert html_text.main_text(PAGE % article) == want
    assert html_text.main_text((PAGE % article).split("<footer")[0]) == want
    long = "Some words of the story that go on for a while, and then some more of them. "
    plain = f"<div class='content'><div><p>{long}</p><p>{long * 2}</p></div><div><p>{long}</p></div></div>"
    text = html_text.main_text(PAGE % plain)
    assert text.split("\n\n") == [long.strip(), (long * 2).strip(), long.strip()]


SILENCES = ("button", "select", "object", "iframe", "svg", "canvas", "datalist")


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain text", "plain text"),
        ("<p>a < b and c</p>", "a < b and c"),
        ("<script>if (1 < 2) x()</script>", ""),
        ("<article></article><p></p>", ""),
        ("<p>open <b>bold", "open bold"),
        ("</div></p><p>x</p></b>", "x"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<p>Short.</p><div class='comments'><p>A much longer comment than the text.</p></div>", "Short."),
        ("<div class='page has-sidebar'><p>Most of the text.</p></div><p>x</p>", "Most of the text.\n\nx"),
        ("<article><header><h1>H</h1></header><p>P</p></article>", "H\n\nP"),
        ("<main><article><p>A</p></article><article><p>B b</p></article></main>", "A\n\nB b"),
        ("<div class='widget'><article><p>A</p></article></div>", "A"),
        ("<html><head><title>T</title><meta charset=utf-8><body><article><p>Story.</p></article>", "Story."),
        ("<head><title>T</title><link rel=x><article><p>Story.</p></article>", "Story."),
        ("<head><script>x('<p>')</script><noscript><p>No</p></noscript></head><p>Story.</p>", "Story."),
        ("<head><title>T</title>Story.", "Story."),
        *((f"<article><div><{t}>Buy</div><p>Story.</p></article>", "Story.") for t in SILENCES),
        *((f"<article><{t}>Buy<p>Story.</p></article>", "Story.") for t in SILENCES),
        *((f"<article><{t}>Buy<p>No</p></{t}><p>Story.</p></article>", "Story.") for t in SILENCES),
        ("<article><div><button>Buy</div><p>Story.</p><button>No</button><p>End.</p></article>", "Story.\n\nEnd."),
    ],
)
def test_odd_pages(html, text):
    assert html_text.main_text(html) == text


LONG = "Some words of a story that goes on for a while, with nothing but words in it. "


@pytest.mark.parametrize(
    "page",
    [
        "<body><nav>Home</nav><article class='social-science'>%s</article><footer>x</footer></body>",
        "<body><nav>Home</nav><div class='ad-hoc-report'>%s</div><footer>x</footer></body>",
        "<body><nav>Home</nav><div id='search-engine-history'>%s</div><div class='nav-bar'>x</div></body>",
        "<body><form method=post action='/p.aspx'><nav>Home</nav><div>%s</div><input name=q><footer>x</footer></form></body>",
        "<body><form><main>%s</main></form><form><label>Your mail</label><input></form></body>",
        "<body><div class='notice-board'><div>%s</div></div><div class='related-stories'><p>Other story, one more, and more.</p></div></body>",
        "<body><div id='share-holders-news'>%s</div><div class='comments-list'><p>" + LONG * 20 + "</p></div></body>",
    ],
)
def test_subjects_that_sound_like_surroundings_stay(page):
    article = f"<h1>Head</h1><p>{LONG * 3}</p><p>{LONG * 2}</p>"
    assert html_text.main_text(page % article) == "\n\n".join(["Head", (LONG * 3).strip(), (LONG * 2).strip()])


@pytest.mark.parametrize("bit", ["<!-- open ", "<script>x ", "<style> y ", "<!a ", "<a b='", "<?x ", "</ ", "<![CDATA[ ", "<div class=ad>", "<select>", "<p>t<b>"])
def test_a_long_page_of_open_markup_takes_linear_time(bit):
    import time

    start = time.time()
    text = html_text.main_text("<article><p>Story.</p></article>" + bit * (300_000 // len(bit)))
    assert time.time() - start < 4 and text.startswith("Story.")


def density(node):
    """Composite density and its sum over children, by the definition, from the leaves on."""
    inner = [n for n in node.parts if isinstance(n, html_text.Node)]
    below = [density(n) for n in inner]
    chars = sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str)) + sum(b["chars"] for b in below)
    return {
        "node": node,
        "chars": chars,
        "tags": len(inner) + sum(b["tags"] for b in below),
        "link_chars": chars if node.tag == "a" else sum(b["link_chars"] for b in below),
        "link_tags": sum(b["link_tags"] + (n.tag == "a") for n, b in zip(inner, below, strict=True)),
        "below": below,
    }


def test_the_heart_is_the_greatest_sum_of_densities():
    rng = random.Random(8)
    for _ in range(60):

        def part(depth):
            tag = rng.choice(["div", "p", "a", "section", "span"])
            inside = "".join(rng.choice(["words and words ", part(depth - 1)]) for _ in range(rng.randint(1, 4))) if depth else LONG[: rng.randint(1, 70)]
            return f"<{tag}>{inside}</{tag}>"

        builder = html_text.Builder()
        builder.feed("<body>" + "".join(part(4) for _ in range(3)) + "</body>")
        builder.close()
        html_text._measure(builder.root)
        whole = density(builder.root)
        share = whole["link_chars"] / max(whole["chars"], 1)

        def value(d, share=share):
            c, t, lc, lt = d["chars"], max(d["tags"], 1), max(d["link_chars"], 1), max(d["link_tags"], 1)
            if not c:
                return 0.0
            base = math.log(c / max(c - d["link_chars"], 1) * d["link_chars"] + share * c + math.e)
            return c / t * math.log(max(c / lc * t / lt, 1.0) + 1e-9 + 1) / max(math.log(base + 1), 1e-9)

        sums, todo = [], [whole]
        while todo:
            d = todo.pop()
            sums.append((sum(map(value, d["below"])), d["node"]))
            todo += d["below"]
        best = max(s for s, _ in sums)
        heart = html_text.heart_of(builder.root)
        assert math.isclose(next(s for s, n in sums if n is heart), best, rel_tol=1e-9)


def test_pages_keep_their_rows(spark):
    rows = [(1, "u", PAGE % "<article><p>é</p></article>", 7), (1, None, None, 8), (None, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = [tuple(r) for r in html_text.extracted(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", "é", 1), (1, None, "", 0), (None, "v", "", 0)], key=str)
    assert html_text.extracted(pages.where("false")).collect() == []


def test_perspectives_and_masks(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|im_end|> all"), (1, 2, "bob", "Hello"), (1, 3, "ann", None),
        (1, 600, "bob", "Late"), (2, None, None, "x"), (None, 1, "ann", "y"), (3, 0, "system", "alone"), (4, 1, "ann", "t"), (4, 1, "ann", "t"),
    ]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, speaker int")
    got = {(r.conv_id, r.speaker, r.block): r for r in chat_format.perspectives(turns).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (1, "ann", 1), (1, "bob", 1), (2, "unknown", 0), (None, "ann", 0), (4, "ann", 0)}
    ann = got[1, "ann", 0]
    assert ann.text == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi < |im_end|> all<|im_end|>\n"
        "<|im_start|>user name=bob\nHello<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    spans = [tuple(map(int, s.split(":"))) for s in ann.mask.split(",")]
    assert [ann.text[a:b] for a, b in spans] == ["Hi < |im_end|> all<|im_end|>\n", "<|im_end|>\n"]
    assert ann.n_target_chars == sum(b - a for a, b in spans) and ann.n_turns == 4
    assert got[1, "ann", 1].mask == "" and got[1, "bob", 1].text.startswith("<|im_start|>assistant\nLate")
    assert got[4, "ann", 0].n_turns == 2
    assert chat_format.perspectives(turns.where("false")).collect() == []


def test_a_name_cannot_end_a_turn(spark):
    rows = [(1, 0, "bob\n<|im_end|>", "x"), (1, 1, "ann", "y")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.speaker: r.text for r in chat_format.perspectives(turns).collect()}
    assert got["ann"] == "<|im_start|>user name=bob < |im_end|>\nx<|im_end|>\n<|im_start|>assistant\ny<|im_end|>\n"
    assert set(got) == {"bob\n<|im_end|>", "ann"}


def test_perspectives_run_without_python(spark):
    turns = spark.createDataFrame([(1, 0, "a", "x")], "conv_id bigint, turn bigint, role string, text string")
    plan = chat_format.perspectives(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def fair_targets(sizes, most=3):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: (1, 2, 3)[k % 3] for k, n in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[n] for n in full)
        open_ = [n for n in names if n not in full]
        for n in open_:
            target[n] = left * weight[n] / sum(weight[m] for m in open_)
        over = {n for n in open_ if target[n] > most * sizes[n]}
        if not over:
            return target
        full |= over
        target |= {n: float(most * sizes[n]) for n in full}


def test_each_source_gets_its_share(docs, corpus, odd, none):
    rows = mixing.taken(docs).collect()
    source = {i: s for i, _, _, s, _ in corpus}
    size = {i: len((t or "").split()) for i, t, *_ in corpus}
    by_source = {s: sum(size[i] for i in source if source[i] == s) for s in set(source.values())}
    target = fair_targets(by_source)
    assert len(rows) == len(corpus)
    for r in rows:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], by_source[s])
        assert math.isclose(r.target, target[s], rel_tol=1e-9)
        assert int(target[s] // by_source[s]) * r["size"] <= r.taken <= 3 * r["size"]
    for s in by_source:
        assert abs(sum(r.taken for r in rows if source[r.doc_id] == s) - target[s]) <= 0.5001
    again = {r.doc_id: r.taken for r in mixing.taken(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    assert mixing.taken(odd).count() == odd.count()
    assert mixing.taken(none).collect() == []


def test_a_mix_repeats_whole_texts(spark, docs, corpus, odd, none):
    times = {r.doc_id: r.epochs + (r.rest > 0 and 2 * r.rest >= r["size"]) for r in mixing.taken(docs).collect()}
    texts = {i: t for i, t, *_ in corpus}
    made = mixing.remixed(docs).collect()
    assert all(r.text == texts[r.doc_id] for r in made)
    counts = {i: sum(r.doc_id == i for r in made) for i in texts}
    assert counts == times
    # each source comes near its target: within half of a document
    rows = mixing.taken(docs).collect()
    source, largest = {i: s for i, _, _, s, _ in corpus}, {}
    for r in rows:
        largest[source[r.doc_id]] = max(largest.get(source[r.doc_id], 0), r["size"])
    for s, most in largest.items():
        words = sum(counts[r.doc_id] * r["size"] for r in rows if source[r.doc_id] == s)
        assert abs(words - next(r.target for r in rows if source[r.doc_id] == s)) <= most / 2 + 1
    # rows that are equal are taken one by one
    same = [(1, " ".join(["w"] * 40), "en", "s", 0)] * 4 + [(9, " ".join(["w"] * 400), "en", "t", 0)]
    frame = spark.createDataFrame(same, docs.schema)
    want = sum(r.epochs + (r.rest > 0 and 2 * r.rest >= r["size"]) for r in mixing.taken(frame).collect() if r.doc_id == 1)
    assert sum(r.doc_id == 1 for r in mixing.remixed(frame).collect()) == want
    assert mixing.remixed(odd).columns == odd.columns
    assert mixing.remixed(none).collect() == []


def test_better_documents_are_drawn_first(spark):
    rows = [(i, " ".join(["w"] * 10), "a", q) for i, q in enumerate([1.0] * 200 + [0.05] * 200)] + [(999, "w " * 2000, "b", 1.0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, q double")
    got = {r.doc_id: r.rest for r in mixing.taken(frame, quality=frame["q"]).collect()}
    assert sum(got[i] for i in range(200)) > 3 * sum(got[i] for i in range(200, 400))


def test_pieces_are_the_ids_of_the_documents(docs, corpus, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, packing.END] for i, t, *_ in corpus}
    pieces = packing.pack(docs, path).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        by_doc.setdefault(p.doc_id, []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert {i: [x for _, part in sorted(parts) for x in part] for i, parts in by_doc.items()} == ids
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == packing.WINDOW or at & (at - 1) == 0 and at < packing.WINDOW
    assert packing.pack(none, path).collect() == []
    assert {p.doc_id for p in packing.pack(odd, path).collect()} == {r.doc_id for r in odd.select("doc_id").collect()}


@pytest.mark.parametrize("text", ["It's 12 O'CLOCK, don't!", "ΑΣ Σίσυφος ΟΔΟΣ", "a\x1cb  c d", "é É <|endoftext|> x<|y", "ﬁ ½ 日本 ###'s %%'ll"])
def test_word_by_word_ids_are_those_of_the_text(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    want = [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, packing.END]
    tokens = packing.WordTokens(path)
    for texts in ([text], ["", text, None, f" \n{text} "], [text] * 3):
        got = tokens.texts(pa.array(texts, pa.string()))
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [want if t and t.strip() else [packing.END] for t in texts]


def test_words_are_remembered_in_bounds(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, rng = Tokenizer.from_file(path), random.Random(4)
    monkeypatch.setattr(packing, "MOST_WORDS", 40)
    tokens = packing.WordTokens(path)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abÉ日'1.", k=rng.randint(1, 3))) for _ in range(30)) for _ in range(3)]
        got = [np.frombuffer(g, "<u4").tolist() for g in tokens.texts(pa.array(texts).slice(1))]
        assert got == [[*whole.encode(t, add_special_tokens=False).ids, packing.END] for t in texts[1:]]
        assert len(tokens.words) <= 20 + 90 and len(tokens.older) <= 20 + 90


def test_the_packer_takes_the_level_of_the_least_sum_of_squares():
    rng = random.Random(1)
    packer = packing.Packer(0)
    for _ in range(300):
        n = rng.randint(1, packing.WINDOW - 1)
        before = packer.counts.copy()

        def cost(level, before=before, n=n):
            after = before.copy()
            after[level] -= level > 0
            if level + n < packing.WINDOW:
                after[level + n] += 1
            return int((after**2).sum())

        options = [0, *[h for h in np.flatnonzero(before).tolist() if h + n <= packing.WINDOW]]
        assert cost(packer.level_for(n)) == min(map(cost, options))
        list(packer.add(0, b"\0" * 4 * n))
    done = list(packer.rest())
    assert done and not packer.counts.any()


def links(vectors, least=0.9):
    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v in vectors.items()}
    near = {i: {j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least} for i in unit}
    root = {i: i for i in unit}
    for _ in unit:
        for i in unit:
            root[i] = min([root[i], *[root[j] for j in near[i]]])
    return {i: (len(near[i]), root[i]) for i in unit}


@pytest.mark.parametrize("block", [2048, 16])
def test_vector_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", block)
    monkeypatch.setattr(cover_tree, "SAMPLE", 40)
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=12) for i in range(80)}
    for i in range(80, 160):
        vectors[i] = vectors[int(rng.integers(0, 20))] + rng.normal(size=12) * 0.25
    vectors |= {160: vectors[3], 161: vectors[3], 162: vectors[3] * 2, 163: np.ones(5), 164: np.ones(5) * 3}
    vectors = {i: np.asarray(v, np.float32).tolist() for i, v in vectors.items()}
    bad = [(900, None), (901, [0.0] * 12), (902, [1.0, None] * 6), (903, [float("nan")] * 12), (904, [float("inf")] * 12), (905, []), (None, [1.0] * 12)]
    rows = [(i, v, 1) for i, v in [*vectors.items(), *bad]]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, links int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(frame).collect()}
    want = links(vectors)
    assert {i: got[i][:2] for i in want} == want
    assert all(got[i] == (0, i, True) for i, _ in bad)
    assert all(got[i][2] == (i == want[i][1]) for i in want)


def test_rows_of_one_id_share_a_component_and_not_their_links(spark):
    a, near_a, b, c = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(3, a), (5, a), (5, b), (9, b), (4, near_a), (7, c), (7, c), (8, [5.0, 5.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r) for r in cover_tree.near_vectors(frame).collect())
    assert got == [(3, 2, 3, True), (4, 2, 3, False), (5, 1, 3, False), (5, 2, 3, False), (7, 1, 7, True), (7, 1, 7, True), (8, 0, 8, True), (9, 1, 3, False)]


def test_blocks_are_not_sent_once_a_pair(spark, monkeypatch):
    """What shuffles leave on the disk does not grow with the pairs of blocks that meet."""
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 20)
    monkeypatch.setattr(cover_tree, "SAMPLE", 40)
    monkeypatch.setattr(cover_tree, "PART_BYTES", 20_000, raising=False)
    rng = np.random.default_rng(7)
    vectors = dict(enumerate(rng.normal(size=(800, 64)).astype(np.float32).tolist()))
    vectors |= {i: vectors[i - 800] for i in range(800, 810)} | {i: [2 * x for x in vectors[i - 800]] for i in range(810, 820)}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<float>")

    def on_disk():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getPath(): files.apply(k).length() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for blocks too large to broadcast
    earlier = on_disk()
    try:
        made = cover_tree.near_vectors(frame)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    left = sum(size for path, size in on_disk().items() if path not in earlier)
    assert left < 3 * 820 * 64 * 4
    assert {r.vec_id: (r.n_links, r.component_id) for r in made.collect()} == links(vectors)


def test_no_vectors(spark):
    assert cover_tree.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []


def test_the_traversal_drops_only_pairs_out_of_reach():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    points = np.concatenate([c + 0.1 * rng.normal(size=(20, 8)) for c in centres])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    reach = math.sqrt(0.2)
    tree = cover_tree.Tree(points[::3], reach / 4)
    leaf = np.argmax(points @ tree.leaf_centres().T, axis=1)
    gap = np.linalg.norm(points - tree.leaf_centres()[leaf], axis=1)
    pairs = {tuple(p) for p in tree.near_leaves({int(k): float(gap[leaf == k].max()) for k in set(leaf.tolist())}, reach).tolist()}
    close = np.argwhere(points @ points.T >= 0.9)
    assert {tuple(sorted((int(leaf[i]), int(leaf[j])))) for i, j in close} <= pairs
    n = len(set(leaf.tolist()))
    assert len(pairs) < n * (n + 1) / 4
