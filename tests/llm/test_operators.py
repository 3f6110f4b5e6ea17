"""The operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import html
import random
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from meterlens.llm import components, decontaminate, html_text, jaccard, langid, line_dedup, packing, paragraphs, passages, quality, queries, textbytes, token_counts, topk
from pyspark.sql import functions as F

TEXT = st.text(alphabet="aAbß€ \t\n\x0b.|1 ", max_size=40)


def rng_words(seed, n, vocabulary=5000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


# --- words and n-grams
@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_words_are_those_of_the_pattern(texts):
    data, rows = textbytes.buffers(pa.array(texts, pa.string()))
    for table, pattern in ((textbytes.NOT_SPACE, "[^\x20\x09-\x0d]+"), (textbytes.ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        hashes, offsets = textbytes.words(data, rows, table)
        want = [brute.words(t, pattern) for t in texts]
        assert list(np.diff(offsets)) == [len(w) for w in want]
        flat = [x for w in want for x in w]
        assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
        _, ends = textbytes.ngram_sets(hashes, offsets, 3)
        assert list(np.diff(ends)) == [len(brute.shingles(w, 3)) for w in want]


def test_words_across_chunks():
    text = "x" * (3 << 20) + " y " + "ab " * 500_000
    data, rows = textbytes.buffers(pa.array(["", text, None, "y"]))
    hashes, offsets = textbytes.words(data, rows, textbytes.NOT_SPACE)
    assert list(np.diff(offsets)) == [0, 500_002, 0, 1]
    assert hashes[1] == hashes[-1] and len(set(hashes[2:500_002].tolist())) == 1


# --- token counts
def test_ranks_agree_with_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.VOCABULARY)
    texts = ["", " ", "a  b\n\n c", "it's 12x <|endoftext|> é€　 z", "word " * 40_000, "x y\n" * 30_000 + " \n" * 9, "ab\n  cd\t\te"]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [list(x) for x in token_counts.token_ids(texts, queries.VOCABULARY)] == want
    assert token_counts.counts(texts, queries.VOCABULARY) == [len(x) for x in want]
    assert token_counts.encoder(queries.VOCABULARY)[1], "the fast path is taken"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    texts = ["", "Hello  world", "a " * 50_000]
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    else:
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    assert token_counts.counts(texts, path) == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n", max_size=200))
def test_parts_join_to_the_text(text):
    assert "".join(token_counts.parts(text, 10)) == text


def test_count_tokens_keeps_columns(docs):
    made = docs((1, None), (1, None), (2, "one two")).withColumn("n_tokens", F.lit("old")).withColumn("_0", F.lit(7))
    out = token_counts.count_tokens(made, queries.VOCABULARY)
    assert sorted((r.doc_id, r.n_tokens, r._0, r.lang) for r in out.collect()) == [(1, 0, 7, "en"), (1, 0, 7, "en"), (2, 2, 7, "en")]
    assert token_counts.count_tokens(made.where("false"), queries.VOCABULARY).count() == 0


# --- packing
@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_plan_holds_all(lengths):
    counts = np.bincount(lengths, minlength=65).astype(np.int64) if lengths else np.zeros(65, np.int64)
    used, sequences = np.zeros(65, np.int64), 0
    for config, n in packing.plan(counts, 64):
        assert n > 0 and sum(k * c for k, c in config.items()) <= 64
        for k, c in config.items():
            used[k] += c * n
        sequences += n
    assert (used == counts).all()
    assert sequences <= 11 / 9 * -(-sum(lengths) // 64) + max(1, (counts[33:] > 0).sum() + counts[33:].sum())


def test_plan_is_near_the_bound_and_small_for_many():
    counts = np.random.default_rng(3).integers(0, 10**7, 2049)
    counts[0] = counts[1200:2048] = 0
    plan = packing.plan(counts.astype(np.int64))
    assert sum(n for _, n in plan) <= 1.001 * (counts * np.arange(2049)).sum() / 2048
    assert len(plan) < 30_000


def test_the_program_places_nearly_all_pieces():
    lengths = np.random.default_rng(5).lognormal(6.2, 0.8, 10_000).astype(np.int64)
    for counts in (np.bincount(lengths[lengths < 2048], minlength=2049), 1000 * np.bincount(lengths[lengths < 2048], minlength=2049)):
        placed, left = packing.rounded(counts)
        assert left.sum() <= 0.1 * counts.sum()
        assert all(n > 0 and sum(k * c for k, c in config.items()) <= 2048 for config, n in placed)
        assert sum(n for _, n in packing.plan(counts)) <= 1.001 * -(-int(counts @ np.arange(2049)) // 2048)


def test_pack_and_assemble(spark, docs):
    long = " ".join(rng_words(1, 3000))
    made = docs((1, None), (2, ""), (3, long), (None, "a b c"), (3, long), (4, "x" * 5)).withColumn("sequence_id", F.lit("old")).withColumn("_task", F.lit(1))
    out = packing.pack(packing.pieces(made, queries.VOCABULARY))
    rows = out.collect()
    brute.check_packed([(r.sequence_id, r.offset, r.length) for r in rows])
    encode = lambda t: list(token_counts.token_ids([t], queries.VOCABULARY)[0])
    want = brute.pieces([(1, None), (2, ""), (3, long), (None, "a b c"), (3, long), (4, "x" * 5)], encode)
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    import zlib

    assert sorted(((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows), key=key) == sorted(want, key=key)
    whole = {r.sequence_id: r.tokens for r in packing.assemble(out).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert packing.pack(packing.pieces(made.where("false"), queries.VOCABULARY)).count() == 0


# --- line dedup
@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.uint64)
    perfect = line_dedup.PerfectHash.load(*line_dedup.PerfectHash.build(keys).dump())
    assert sorted(perfect.index(keys).tolist()) == list(range(len(keys)))


def test_lines(docs):
    hot = "The line that a third of all hold"
    rows = [(1, None), (2, ""), (5, f"{hot}\n short \n{hot}"), (3, f"  {hot.upper()}\t\nown line of three"), (3, f"  {hot.upper()}\t\nown line of three")]
    rows += [(4, "ßßßßßßßßßß\nßßßßßßßßß"), (6, "ßßßßßßßßßß\nßßßßßßßßß"), (None, hot), (7, "y" * 2_000_000), (8, "\n\n" + "y" * 2_000_000)]
    rows += [(100 + i, f"{hot}\nx{i}") for i in range(40)]
    made = docs(*rows).withColumn("n_lines", F.lit("old")).withColumn("_block", F.lit(1)).withColumn("h", F.lit(2))
    out = line_dedup.drop_repeated_lines(made)
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=key) == sorted(brute.kept_lines(rows), key=key)
    assert set(out.columns) == {*made.columns, "n_dropped"} and {r._block for r in out.collect()} == {1}
    assert line_dedup.drop_repeated_lines(made.where("false")).count() == 0


# --- search
def brute_search(items, asks, k):
    out = set()
    for q, a in asks:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in items if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize(("dim", "sparse"), [(64, 0.0), (40, 0.9), (3, 0.0)])
def test_search(spark, monkeypatch, dim, sparse):
    r = np.random.default_rng(dim)
    vectors = np.where(r.random((300, dim)) < sparse, 0, r.integers(-20, 21, (300, dim)))
    items = [(i, [int(x) for x in v]) for i, v in enumerate(vectors)] + [(1000, [0] * dim), (1001, [])]
    frame = spark.createDataFrame([(i, list(range(len(v))), v) for i, v in items], "id long, terms array<long>, weights array<long>")
    monkeypatch.setattr(topk, "SHARD", 100)
    monkeypatch.setattr(topk, "BLOCK", 7)
    got = topk.search(frame, frame.where("id % 20 = 0"), 20)
    assert {(x.query_id, x.rank, x.vec_id, x.score) for x in got.collect()} == brute_search(items, [x for x in items if x[0] % 20 == 0], 20)


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [-0.001, 3e4])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1)).withColumn("terms", F.lit(2))
    items = topk.vectors(frame, "vec_id", "embedding", 64)
    got = topk.search(items, items.where("id % 20 = 0"), 2).collect()
    assert {(x.rank, x.vec_id, x.score) for x in got} == {(1, 7, 32 * -1 + 32 * 64 * 30000), (2, 1, 2048)}
    assert topk.search(items.where("false"), items, 3).count() == 0


def test_repeated_queries(spark):
    frame = spark.createDataFrame([(i, [0, 1], [i, 1]) for i in range(10)], "id long, terms array<long>, weights array<long>")
    asks = frame.where("id = 0")
    got = topk.search(frame, asks.union(asks), 4).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(1, 1), (2, 2), (3, 3), (4, 4)]


# --- HTML
PAGES = [
    ("<p>a &amp;  b</p><script>x<y</script><p>c<p>d", "a & b\nc\nd"),
    (None, ""),
    ("", ""),
    ("<body class='with-sidebar'><nav>n</nav><div class='content'><article><h1>T</h1><p><b>x<br>y<p>z</article></div>", "T\nx y\nz"),
    ("<main><p>one</p><aside>no</aside><div id='comments'><p>no</p></div><ul><li>u<li>v</ul></main><footer>f</footer>", "one\nu\nv"),
    ("<article><header><p>by</p><h2>Head</h2></header><p>t&#x20AC;<!-- c --></p><form>f<p>g</p></form></article>", "Head\nt€"),
    ("<div hidden>h</div><div style='display: none'>s</div><p>v</p></div></div>w", "v\nw"),
    ("<table><tr><td>1<td>2<tr><td>3</table><pre>a\n  b</pre>", "1\n2\n3\na b"),
    ("<" * 50 + " a 1 < 2", "<" * 50 + " a 1 < 2"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert html_text.main_text(html_text.parse(page or "")) == text


def test_templates_go_and_copies_stay(spark):
    shell = "<div><p>Site name</p><p>All our offers</p></div>{}<div><p>Imprint and terms</p></div>"
    rows = [(i, "http://a.example/x", shell.format(f"<p>Story {i} of the day</p><p>It ends.</p>" * 1)) for i in range(6)]
    rows += [(100 + i, "http://b.example:80/y", "<div><p>The same article</p></div>") for i in range(9)]
    rows += [(200, None, "<p>alone</p>"), (201, "", None), (201, "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("inner", F.lit(1))
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got[3] == "Story 3 of the day"  # what all pages of the host end with is its template, too
    assert got[104] == "The same article"
    assert got[200] == "alone" and got[201] == ""
    assert html_text.extract(pages.where("false")).count() == 0
    assert set(html_text.extract(pages).columns) == {"page_id", "url", "host", "inner", "text"}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h2 id='search-methods'>S</h2><p id='comment-on-the-law'>c</p><section id='related-work'><p>r</p></section><div class='post-header'><h1>T</h1></div></article>", "S\nc\nr\nT"),
        ("<article><p>t and more</p><div class='x comment-list'>no</div><p class='related'>yes</p><div class='header'><h1>H</h1></div></article>", "t and more\nyes\nH"),
        ("<div><p>The main text of it</p></div><aside><article>one</article></aside><div class='related-posts'>x</div><div class='related'><article>two</article><article>a teaser of great length</article></div>", "The main text of it\nx"),
        ("<form><article><p>All of the page is a form</p></article></form>", "All of the page is a form"),
        ("<article><p>text</p><div class='related'><article>card</article><article>card</article></div></article>", "text"),
    ],
)
def test_marks_on_containers(page, text):
    assert html_text.main_text(html_text.parse(page)) == text


def test_templates_at_every_host_size(spark):
    side = "<div><p>Read all about our many offers of this week</p><p>Buy now</p></div>"
    note = "<p>Write to the editors of this paper with your own story</p>"
    story = lambda i: f"<p>{' '.join(rng_words(i, 20))}</p>" + "<p>So it goes</p>" * (i % 3 == 0)
    rows = [(i, "http://big.example/", f"{side if i < 20 else ''}<article><h1>t{i}</h1>{'<p>x</p>' * (i % 7)}{story(i)}{note if i % 5 == 0 else ''}<p>end {i}</p></article>") for i in range(300)]
    rows += [(1000 + i, "http://copies.example/", f"<article><p>{' '.join(rng_words(5, 20))}</p><p>{' '.join(rng_words(6, 20))}</p><p>{' '.join(rng_words(7, 21))}</p><p>{' '.join(rng_words(8, 22))}</p><p>on day {i}</p></article>") for i in range(30)]
    rows += [(2000 + i, "http://plain.example/", f"<div>{story(i)}</div>{side if i < 4 else ''}") for i in range(1, 200)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert not any("Write to" in t or "Read all" in t for t in got.values())
    assert all(len(got[1000 + i].split("\n")) == 5 for i in range(30))
    assert all(f"end {i}" in got[i] and rng_words(i, 20)[0] in got[i] for i in range(300))


def test_deep_pages():
    deep = html_text.parse("<div>" * 20_000 + "x" + "</p>" * 50 + "</div>" * 20_000 + "y")
    assert html_text.main_text(deep) == "x\ny" and len(list(html_text.subtrees(deep))) == 20_000


@pytest.mark.parametrize("n", [12, 300])
def test_templates_inside_of_articles(spark, n):
    """What the site puts at the end of each article goes on hosts of any size; a sentence that articles share stays, wherever it is."""
    shared, notice = "A sentence that very many of the articles here have.", "<div class='x7'>Read on at our other place <a href='/y'>here</a></div>"
    last = lambda i: [f"More of it, number {i}.", shared] if i % 3 else [shared, f"More of it, number {i}."]
    text = lambda i: [f"Article {i} has its own words {i * i}.", *last(i)]
    rows = [(i, f"http://h/{i}", f"<article><h1>T{i}</h1>{''.join(f'<p>{x}</p>' for x in text(i))}{notice}</article>") for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == {i: "\n".join([f"T{i}", *text(i)]) for i in range(n)}


def test_articles_at_scale_are_whole(spark):
    """No page of the largest test table loses a block of its marked article."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1|li|ul)>", inner)]
        assert got[p.page_id] == "\n".join(x for x in (re.sub(r"\s+", " ", b).strip() for b in blocks) if x)


# --- decontamination
def test_contamination(spark, docs):
    item = " ".join(rng_words(2, 30))
    w = item.split()
    rows = [(1, None), (2, ""), (3, "x " + " ".join(w[5:25]).upper() + ". y"), (4, " ".join(w[:12])), (4, " ".join(w[:12])), (5, "one-two " * 30)]
    rows += [(6, " ".join(w[i] for i in range(20) if i != 6)), (None, item), (7, ("z " * 400_000) + item), (8, " ".join(w[13:26]) + " q" * 300)]
    items = [("a", item), ("b", "two one"), ("b", "Two one"), ("c", None), ("d", "..."), (None, "z")]
    table = spark.createDataFrame(items, "item_id string, text string").withColumn("id", F.lit(1))
    made = docs(*rows).withColumn("segment", F.lit(1)).withColumn("_key", F.lit("k"))
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    want = sorted(brute.contamination(rows, items), key=key)
    got = decontaminate.contamination(made, table).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=key) == want
    left = decontaminate.decontaminate(made, table)
    assert left.columns == made.columns
    bad = {(d, n) for d, n, hit, _ in want if hit and 20 * hit >= n}
    assert sorted((r.doc_id or 0, r._key) for r in left.collect()) == sorted((d or 0, "k") for d, n, *_ in want if (d, n) not in bad)
    assert decontaminate.decontaminate(made, table.where("false")).count() == len(rows)
    assert decontaminate.contamination(made.where("false"), table).count() == 0


def test_blocks_of_items(spark, docs, monkeypatch):
    items = [(f"i{k}", " ".join(rng_words(k, 20))) for k in range(30)]
    rows = [(k, t + " more words") for k, (_, t) in enumerate(items)]
    table = spark.createDataFrame(items, "item_id string, text string")
    one = {(r.doc_id, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(docs(*rows), table).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(docs(*rows), table).collect()} == one


def test_proximity(spark, docs):
    index = decontaminate.build_index(docs((1, "a b c x d"), (2, "d c b a"), (3, "a b c d"), (4, "a y y y y y y y b c d")))
    items = spark.createDataFrame([("i", "a b c d")], "item_id string, text string")
    place = {(r.segment, r.ordinal): r.doc_id for r in decontaminate.documents(index).collect()}
    found = decontaminate.search(index, items, near=5).collect()
    assert {place[r.segment, r.ordinal] for r in found if r.kind == "phrase"} == {3}
    assert {place[r.segment, r.ordinal] for r in found if r.kind == "proximity"} == {1, 2, 3}


# --- language
def test_language_edges(spark, docs):
    r = random.Random(4)
    speak = lambda letters: " ".join("".join(r.choices(letters, k=5)) for _ in range(30))
    rows = [(i, speak("abcde") if i % 2 else speak("vwxyz"), "aa" if i % 2 else "zz") for i in range(300)]
    rows += [(1000, None, "aa"), (1001, "", "zz"), (1002, "12 34 ..", None), (None, speak("abcde"), None), (1003, "é", "aa"), (1004, speak("xyz") * 5000, None)]
    made = docs(*rows).withColumn("score", F.lit("old")).withColumn("order", F.lit(1)).withColumn("_known", F.lit(1))
    net = langid.fit(made)
    assert net.languages == ["aa", "zz"]
    got = {x.doc_id: x for x in langid.identify(made.withColumn("held", langid.held_out()), net).collect()}
    assert all(got[i].lang_pred == ("aa" if i % 2 else "zz") for i in range(300))
    assert [got[i].lang_pred for i in (1000, 1001, 1002, None, 1004)] == ["und", "und", "und", "aa", "zz"]
    assert got[1000].score == 0 and got[None].held is False
    assert langid.fit(made.where("lang is null")) is None
    assert {x.lang_pred for x in langid.identify(made, None).collect()} == {"und"}
    assert langid.identify(made.where("false"), net).count() == 0


# --- similar sets
def near_copies(seed, n, words, edits):
    r, base = random.Random(seed), rng_words(seed, words)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(words)] = f"n{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture
def corpus():
    shared = " ".join(rng_words(77, 60))
    texts = near_copies(1, 60, 80, 4) + near_copies(2, 25, 30, 3) + near_copies(3, 10, 200, 14)
    texts += [f"{shared} {' '.join(rng_words(1000 + i, 15 + i))}" for i in range(40)] + ["one two", "two one", "ONE two", "a b c d e f", "a b c d e g"]
    rows = [(10 * i + 3, t) for i, t in enumerate(texts)]
    return rows + [(rows[0][0] - 2, rows[0][1]), (rows[7][0] + 1, rows[7][1]), (9001, None), (9002, " \t"), (9003, " ".join(rng_words(5, 60_000)))]


@pytest.mark.parametrize("block", [256, 8])
def test_similar_documents(docs, corpus, monkeypatch, block):
    """Small blocks make the groups large ones, so that each path is taken."""
    monkeypatch.setattr(components, "BLOCK_SETS", block)
    sets = {d: brute.shingles(brute.words(t)) for d, t in corpus}
    want = brute.groups(sets)
    assert len(set(want.values())) < len(want) - 30
    got = jaccard.similar(docs(*corpus)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {d: (len(s), want[d]) for d, s in sets.items()}


def test_keep_one(docs):
    copies = near_copies(9, 5, 50, 1)
    rows = [(5, copies[0]), (4, copies[1]), (None, copies[2]), (6, copies[3]), (6, copies[3]), (7, None), (8, ""), (None, "lone words"), (4, copies[1])]
    made = docs(*rows).withColumn("_key", F.lit(1)).withColumn("cls", F.lit(2))
    left = jaccard.keep_one(made)
    assert left.columns == made.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 4, 4, 7, 8]
    assert jaccard.keep_one(made.where("false")).count() == 0


def test_components(spark):
    r = random.Random(6)
    pairs = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(30)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)] + [(7, 7), (900, 900)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    got = {x.node: x.component for x in components.components(spark.createDataFrame(pairs * 2, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}


# --- paragraphs
def test_bands_have_the_recall():
    bands, rows = paragraphs.tune_bands(0.8, 0.999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert (1 - (1 - 0.3**rows) ** bands) < 0.06
    assert paragraphs.tune_bands(1.0) [0] == 1


@pytest.mark.parametrize("most", [None, 20])
def test_alike_sets_always_meet(most):
    rng = np.random.default_rng(5)
    sets = []
    for n in range(1, 21 if most else 61):
        for _ in range(40):
            one = rng.integers(0, 2**63, n, dtype=np.uint64)
            common = -(-8 * n // 10)
            more = n - common if rng.random() < 0.5 else 0
            sets += [one, np.concatenate((one[:common], rng.integers(0, 2**63, more, dtype=np.uint64)))]
    sets = [np.sort(x) for x in sets]
    keys, owner = paragraphs.sure_keys(np.concatenate(sets), np.concatenate(([0], np.cumsum([len(x) for x in sets]))), most)
    of = [set(keys[owner == i].tolist()) for i in range(len(sets))]
    alike = [i for i in range(0, len(sets), 2) if 100 * len(np.intersect1d(sets[i], sets[i + 1])) >= 80 * len(np.union1d(sets[i], sets[i + 1]))]
    assert len(alike) > 300 and all(of[i] & of[i + 1] for i in alike)
    parity = paragraphs.parities(np.concatenate(sets), np.concatenate(([0], np.cumsum([len(x) for x in sets]))))
    assert not most or all(np.bitwise_count(parity[i] ^ parity[i + 1]) <= paragraphs.most_different(most) for i in alike)


@pytest.mark.parametrize(("least", "grouped"), [(1, 250), (20, 20)])
def test_many_sets_with_a_common_key(least, grouped):
    """Of sets that share some elements only those that can be alike are candidates; small sets differ in few."""
    rng = np.random.default_rng(8)
    common, made = rng.integers(0, 2**63, 8, dtype=np.uint64), {}
    for _ in range(900):
        n = int(rng.integers(least, 21))
        one = np.unique(np.concatenate((common[: min(n, 8)], rng.integers(0, 2**63, max(n - 8, 0), dtype=np.uint64))))
        for x in (one, np.unique(np.append(one[1:], rng.integers(0, 2**63, dtype=np.uint64)))) if rng.random() < 0.1 else (one,):
            made[x.tobytes()] = x
    sets = list(made.values())
    grams, at = np.concatenate(sets), np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    key, whose = np.zeros(len(sets), np.uint32), np.arange(len(sets), dtype=np.int64)
    packed = {"sure": key, "whose": whose, "parity": paragraphs.parities(grams, at), "size": np.diff(at).astype(np.uint16)}
    table = pa.table({x: pa.array([packed[x].tobytes() if x in packed else None], pa.binary()) for x in paragraphs._PACKED})
    edges = paragraphs._meetings(paragraphs.most_different(20))(table)

    label = whose.copy()
    for a, b in zip(edges["a"].to_pylist(), edges["b"].to_pylist(), strict=True):
        label[label == label[a]] = label[b]
    alike = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(found := np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - len(found))]
    assert len(alike) > 30 and all(label[i] == label[j] for i, j in alike)
    assert np.bincount(label).max() < grouped < len(sets) // 2  # all were one group of candidates


def test_windows_at_the_least_similarity(docs):
    """Pairs of texts that differ in their second word: 8 bands of 7 leave out one of ten."""
    rows = []
    for k in range(80):
        words = rng_words(700 + k, 26)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([words[0], f"other{k}", *words[2:]]))]
    sets = {d: [set(at.tolist()) for *_, grams, offsets in passages.windows(pa.array([t]), 25) for at in np.split(grams, offsets[1:-1])] for d, t in rows}
    want = {x for k in range(0, len(rows), 2) if any(100 * len(a & b) >= 80 * len(a | b) for a in sets[k] for b in sets[k + 1]) for x in (k, k + 1)}
    found = paragraphs.repeated(paragraphs.keyed(docs(*rows), "doc_id", "text"), passages.windows, 25, most=20).collect()
    assert len(want) > 60 and {r.doc_id for r in found} == want


def test_paragraphs(docs):
    hot = " ".join(rng_words(50, 60))
    near = near_copies(51, 6, 60, 1)
    rows = [(30 - i, f"own {i}\n{hot}\nend {' '.join(rng_words(i, 30))}") for i in range(20)]
    rows += [(100 + i, f"{t}\nshort line\n") for i, t in enumerate(near)] + [(200, None), (201, ""), (202, f"{near[0]}x y\n" * 3), (None, hot), (203, "q r s " * 20 + "\n" + "q r s " * 20)]
    made = docs(*rows).withColumn("paragraph", F.lit(1)).withColumn("_gone", F.lit(2))
    sets, texts = {}, {}
    for d, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            if len(w := brute.words(line)) >= 25:
                sets[10**6 if d is None else d, k], texts[d, k] = brute.shingles(w), line
    root = brute.groups(sets)
    spread = {}
    for (d, _), r in root.items():
        spread.setdefault(r, set()).add(d)
    want = {(None if k[0] == 10**6 else k[0], k[1]): (r[0], k != r) for k, r in root.items() if len(spread[r]) > 1}
    got = paragraphs.repeats(made).collect()
    assert {(r.doc_id, r.paragraph): (r.component_id, r.removed) for r in got} == want
    whole = dict(rows)
    assert all(whole[r.doc_id][r.start : r.start + r.length] == texts[r.doc_id, r.paragraph] for r in got)
    left = paragraphs.remove_repeats(made)
    assert left.columns == made.columns
    for r in left.collect():
        lines = None if whole[r.doc_id] is None else whole[r.doc_id].split("\n")
        assert r.text == (None if lines is None else "\n".join(x for k, x in enumerate(lines) if not want.get((r.doc_id, k), (0, False))[1]))
    assert paragraphs.repeats(made.where("false")).count() == 0


# --- quality
def test_estimate_finds_planted_accuracies():
    r = np.random.default_rng(8)
    kinds = (0, 0, 1, 1)
    kind = r.choice([-1, 0, 1], 20_000, p=[0.8, 0.12, 0.08])
    votes = []
    for k in kinds:
        hit = np.where(kind == k, r.random(20_000) < 0.85, r.random(20_000) < 0.01)
        votes.append(np.where(hit, quality.BAD, np.where(r.random(20_000) < 0.6, quality.GOOD, 0)))
    code, counts = np.unique(quality.code(np.stack(votes)), return_counts=True)
    found = quality.estimate(quality.patterns(4)[:, code], counts.astype(float), kinds)
    assert abs(found.share[0] - 0.8) < 0.02
    verdict = found.posterior(np.stack(votes)) >= 0.5
    assert (verdict == (kind < 0)).mean() > 0.96  # of texts with one bad vote, some are good


def test_quality_edges(docs):
    letters = str.maketrans("0123456789", "aeioutrnsl")
    some = lambda seed, n: [x.translate(letters) for x in rng_words(seed, n)]
    good = [(i, ". ".join(" ".join(some(i * 50 + k, 12)) for k in range(8)) + ".") for i in range(60)]
    bad = [(100 + i, " | ".join(some(i, 50)) if i % 2 else "%%% " * 40 + " ".join(x + "&&&$$$" for x in some(i, 40))) for i in range(20)]
    rows = [*good, *bad, (200, None), (201, ""), (202, " \n"), (203, good[0][1] + " You stupid IDIOT."), (None, good[1][1]), (204, "word " * 300_000)]
    made = docs(*rows).withColumn("score", F.lit("old")).withColumn("_text", F.lit(1))
    got = {r.doc_id: r for r in quality.classify(made, quality.fit(made)).collect()}
    assert all(got[i].keep and got[i].quality == 1 for i in range(60))
    assert all(got[100 + i].quality == 0 for i in range(20))
    assert [got[i].score for i in (200, 201, 202)] == [0, 0, 0] and not got[200].keep
    assert got[203].toxic and not got[203].keep and got[None].keep
    assert got[204].quality == 0
    assert quality.fit(made.where("false")) is None and quality.classify(made.where("false"), None).count() == 0


WINDOW_STEP = 8


def covered(rows, n=50):
    """By document, the words in runs of ``n`` words that another document holds too."""
    holders, out = {}, {}
    for d, t in rows:
        w = brute.words(t)
        for i in range(len(w) - n + 1):
            holders.setdefault(tuple(w[i : i + n]), set()).add(d)
    for d, t in rows:
        w = brute.words(t)
        for i in range(len(w) - n + 1):
            if len(holders[tuple(w[i : i + n])]) > 1:
                out.setdefault(d, set()).update(range(i, i + n))
    return out


def test_spans_across_lines(docs):
    passage = rng_words(60, 55)
    lines = lambda n: "\n".join(" ".join(passage[i : i + n]) for i in range(0, 55, n))
    long = " ".join(rng_words(61, 40))
    rows = [(1, f"{long} {' '.join(passage)} {' '.join(rng_words(62, 45))}"), (2, f"é {' '.join(rng_words(63, 39))}\n{lines(7)}\n{' '.join(rng_words(65, 40))}"), (3, lines(20)), (4, " ".join(passage[:49]))]
    rows += [(5, "a " * 120), (6, "b a" + " a" * 60), (7, None), (8, ""), (None, lines(11)), (3, lines(20)), (9, " ".join(rng_words(64, 200)))]
    made = docs(*rows).withColumn("_cut", F.lit(2))
    got = passages.spans(made).collect()
    want = covered(rows)
    words = {}
    for r in got:
        words.setdefault(r.doc_id, set()).update(range(r.word, r.word + r.n_words))
        whole = dict(rows)[r.doc_id]
        assert brute.words(whole[r.start : r.start + r.length]) == brute.words(whole)[r.word : r.word + r.n_words]
    assert {d for d in want} == {1, 2, 3, 5, 6, None}
    missed = {d: sorted(w - words.get(d, set())) for d, w in want.items() if not words.get(d, set()) >= w}
    assert set(missed) <= {6} and len(missed.get(6, ())) < WINDOW_STEP, missed  # one word over and over: paragraphs start at each eighth
    assert not {7, 8, 9} & set(words)
    assert {r.removed for r in got if r.doc_id == 1} == {False} and {r.removed for r in got if r.doc_id in (2, 3)} == {True}
    left = {r.doc_id: r.text for r in passages.remove_spans(made).collect()}
    assert left[1] == rows[0][1] and brute.words(left[2]) == brute.words(rows[1][1])[:40] + rng_words(65, 40) and left[3].strip() == "" and left[7] is None
    assert passages.spans(made.where("false")).count() == 0
