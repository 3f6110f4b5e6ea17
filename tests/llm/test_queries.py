"""Every registered query of the subpackage over the smallest test tables: against SQL, brute force or held-out labels."""

import hashlib
import html
import re

import __spark_entry__ as contract
import brute
import compare
import corpus_pipeline
import pytest
from meterlens.llm import paragraphs, passages, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.VOCABULARY)


@pytest.fixture
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet").collect()


@pytest.fixture
def run(spark):
    return lambda name: contract.queries()[name](spark, SF).collect()


def test_all_registered():
    names = contract.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_sql(spark, name):
    df = contract.queries()[name](spark, SF)
    cursor = compare.duck(SF).execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert compare.rows_of(df.columns, df.collect()) == compare.rows_of(columns, cursor.fetchall())


def test_token_counts(run, table, tokenizer):
    want = {d.doc_id: (len((d.text or "").encode()), len(tokenizer.encode(d.text or "", add_special_tokens=False))) for d in table("documents")}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in run("op8_token_counts")}
    assert got == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in run("op8_token_counts"))


def test_language(run, table):
    truth = {d.doc_id: d.lang for d in table("documents")}
    rows = [r for r in run("op7_language_id") if r.held_out and truth[r.doc_id] is not None]
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.95 * len(rows) > 0


def test_packing(run, table, tokenizer):
    rows = run("op2_best_fit_packing")
    want = brute.pieces([(d.doc_id, d.text) for d in table("documents")], lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    n = brute.check_packed([(r.sequence_id, r.offset, r.length) for r in rows])
    assert n <= 1.01 * sum(r.length for r in rows) / 2048 + 1


def test_jaccard(run, table):
    sets = {d.doc_id: brute.shingles(brute.words(d.text)) for d in table("documents")}
    want = brute.groups(sets)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run("op10_ngram_jaccard_join")} == {k: (len(s), want[k]) for k, s in sets.items()}


def test_paragraphs(spark, table):
    sets = {}
    for d in table("documents"):
        for k, line in enumerate((d.text or "").split("\n")):
            if len(w := brute.words(line)) >= 25:
                sets[d.doc_id, k] = brute.shingles(w)
    root = brute.groups(sets)
    spread = {}
    for key, r in root.items():
        spread.setdefault(r, set()).add(key[0])
    want = {k: (r[0], k != r) for k, r in root.items() if len(spread[r]) > 1}
    assert want
    made = spark.read.parquet(f"{SF}/documents.parquet")
    assert {(r.doc_id, r.paragraph): (r.component_id, r.removed) for r in paragraphs.repeats(made.select("doc_id", "text")).collect()} == want


def test_html(run, table):
    got = {r.page_id: (r.text, r.n_chars) for r in run("op5_html_extraction")}
    for p in table("pages"):
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1|li|ul)>", inner)]
        text = "\n".join(x for x in (re.sub(r"\s+", " ", b).strip() for b in blocks) if x)
        assert got[p.page_id] == (text, len(text))


def test_quality(run, table):
    truth = {r.doc_id: (r.quality, r.toxic) for r in table("labels")}
    rows = [r for r in run("op1_quality_classifier") if r.doc_id in truth]
    assert sum(r.quality == truth[r.doc_id][0] for r in rows) >= 0.95 * len(rows) > 0
    assert all(r.keep == (r.quality == 1 and not r.toxic) for r in rows)
    clean = [r for r in rows if truth[r.doc_id] == (1, 0)]
    assert sum(r.keep for r in clean) >= 0.97 * len(clean)


def test_pipeline(spark, run, table, tokenizer):
    docs = [(d.doc_id, d.text) for d in table("documents") if any(c.isalpha() for c in d.text or "")]
    docs = [(doc, text) for doc, _, _, text in brute.kept_lines(docs)]
    root = brute.groups({doc: brute.shingles(brute.words(text)) for doc, text in docs})
    docs = [(doc, text) for doc, text in docs if root[doc] == doc]
    bad = {d for d, n, hit, _ in brute.contamination(docs, [(r.item_id, r.text) for r in table("benchmark")]) if hit and 20 * hit >= n}
    want = brute.pieces([x for x in docs if x[0] not in bad], lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    rows = run("pipeline")
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    brute.check_packed([(r.sequence_id, r.offset, r.length) for r in rows])


def test_stages_keep_the_columns(spark, docs):
    made = docs((1, "a good line of text\nand another"), (2, None), (3, "12 34"), (4, "a good line of text\nand another"), (4, "x y"))
    made = made.withColumnsRenamed({"source": "lang_pred"}).selectExpr("*", "1 as _key", "'k' as n_lines", "2 as shard", "3 as _0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, made, SF)
        assert out.columns == made.columns
        made = out
    rows = made.collect()
    assert {r.doc_id for r in rows} == {1, 4}
    assert all((r.lang_pred, r._key, r.n_lines, r.shard, r._0) == ("s", 1, "k", 2, 3) for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows)
    last = corpus_pipeline.STAGES[-1][1](spark, made.where("false"), SF)
    assert last.count() == 0 and "sequence_id" in last.columns


def test_digest_of_empty(run):
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.n_items > 0) or r.items_sha256 == empty for r in run("op6_decontamination"))


def recurring(tokens, n):
    """By document, the first words of the runs of ``n`` words that another document holds word for word."""
    holders = {}
    for d, w in tokens.items():
        for i in range(len(w) - n + 1):
            holders.setdefault(tuple(w[i : i + n]), set()).add(d)
    return {d: [i for i in range(len(w) - n + 1) if len(holders[tuple(w[i : i + n])]) > 1] for d, w in tokens.items()}


def test_spans(spark):
    """Recall on the recurring runs of 50 words, and how many words of spans recur in no run of 12."""
    made = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    tokens = {r.doc_id: brute.words(r.text) for r in made.collect()}
    words = {}
    for r in passages.spans(made).collect():
        words.setdefault(r.doc_id, set()).update(range(r.word, r.word + r.n_words))
    runs = [(d, i) for d, at in recurring(tokens, 50).items() for i in at]
    found = sum(words.get(d, set()) >= set(range(i, i + 50)) for d, i in runs)
    assert len(runs) > 10_000 and found >= 0.99 * len(runs)
    shared = {d: {k for i in at for k in range(i, i + 12)} for d, at in recurring(tokens, 12).items()}
    assert sum(len(x - shared[d]) for d, x in words.items()) <= 0.05 * sum(len(x) for x in words.values())


def test_language_stage_without_labels(spark, docs):
    made = docs((1, "a text", None), (2, None, None), (3, "12 34", None), (4, "é", None))
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, made, SF).collect()} == {1, 4}
