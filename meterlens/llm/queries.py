"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.llm import decontaminate, exact, html_text, jaccard, langid, line_dedup, packing, passages, periodic, prefix_trie, quality, topk
from meterlens.llm.hot_keys import join_groups
from meterlens.llm.store import ship, stored, table
from meterlens.llm.token_counts import count_tokens

#: Where the vocabulary of the token queries is.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: A document of more tokens is over the limit.
TOKEN_LIMIT = 1024

#: crc32 of ``conv_id`` or ``doc_id`` in decimal, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast({} as varchar), ''), lambda x: ascii(x)::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    return count_tokens(docs, VOCABULARY).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@_query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document."""
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs)
    rows = docs.select("doc_id", "text", langid.held_out().alias("held_out"))
    return langid.identify(rows, net)


@_query
def op4_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of each vector whose id is divisible by 20."""
    items = topk.vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    return topk.search(items, items.where(F.col("id") % 20 == 0), 20)


ORACLE["op4_top_k_search"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""


@_query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many of them are dropped, and a hash of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op3_line_dedup"] = r"""
with l as (
  select doc_id, rid, unnest(string_split(coalesce(text, ''), chr(10))) line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) n
  from (select *, row_number() over () rid from documents)
), k as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l
), r as (
  select key, min(doc_id) first from k where doc_id is not null and length(key) >= 10 group by key having min(doc_id) < max(doc_id)
)
select k.doc_id, count(*) n_lines, count(*) filter (where r.first < k.doc_id) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (where not coalesce(r.first < k.doc_id, false)), '')) kept_sha256
from k left join r using (key) group by rid, k.doc_id
"""


@_query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and these items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


ORACLE["op6_decontamination"] = r"""
with dw as (
  select row_number() over () rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents
), bw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark
), iw as (
  select distinct item_id, n, array_to_string(w[s : s + n - 1], ' ') win
  from (select *, unnest(range(1, len(w) - n + 2)) s from (select *, least(13, len(w)) n from bw where len(w) > 0))
), ww as (
  select rid, n, s, array_to_string(w[s : s + n - 1], ' ') win
  from (select rid, w, n, unnest(range(1, len(w) - n + 2)) s from dw cross join (select distinct n from iw) where len(w) >= n)
), m as (select rid, s, ww.n, item_id from ww join iw on ww.n = iw.n and ww.win = iw.win
), h as (select rid, count(distinct p) n_hit from (select rid, unnest(range(s, s + n)) p from m) group by rid
), t as (select rid, count(*) n_items, string_agg(i, ',' order by i) items from (select distinct rid, cast(item_id as varchar) i from m where item_id is not null) group by rid)
select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(items, '')) items_sha256,
  coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) contaminated
from dw left join h using (rid) left join t using (rid)
"""


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    cut = packing.pieces(docs.select("doc_id", "text"), VOCABULARY)
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@_query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of similar 5-word shingle sets."""
    return jaccard.similar(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@_query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))


@_query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span of words that is repeated in another document, wherever lines end, and whether it is a copy that goes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.spans(docs).drop("row_key")


@_query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label posterior, score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, quality.fit(docs))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of ``conversations``, each rebuilt on the head of another."""
    return prefix_trie.nodes(_rebuilt(prefix_trie.turns(table(spark, sf_dir, "conversations"))))


def _rebuilt(given: prefix_trie.Turns) -> prefix_trie.Turns:
    """Conversation c as the first h turns of c - c % 5, then its own after its first h; h is crc32(c) % 9."""
    convs = given.members.select("conv", "n", (F.col("conv") - F.col("conv") % 5).alias("base"), (F.crc32(F.col("conv").cast("string")) % 9).alias("h"))
    bases = given.members.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    head = F.least("h", F.coalesce("base_n", F.lit(0)))
    whole = head + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = stored(convs.join(bases, "base", "left").select("conv", "base", "h", "n", head.alias("head"), whole.alias("whole")), "rebuilt-conversations")
    out = ["conv", "depth", "h1", "h2", "bytes", F.col("whole").alias("n")]
    items = stored(given.items.drop("n"), "numbered-turns")
    tails = join_groups(items, convs, ["conv"], "n").where(F.col("depth") > F.col("h"))
    tails = tails.withColumn("depth", F.col("depth") - F.col("h") + F.col("head")).select(*out)
    heads = items.where((F.col("conv") % 5 == 0) & (F.col("depth") <= 8)).withColumnRenamed("conv", "base")  # h is 8 at most
    heads = heads.join(convs, "base").where(F.col("depth") <= F.col("h")).select(*out)
    return prefix_trie.Turns(heads.unionByName(tails), convs.select("conv", F.col("whole").alias("n")))


ORACLE["op11_prefix_trie"] = f"""
with t as (
  select conv_id c, row_number() over (partition by conv_id order by turn nulls first, role, text) i, coalesce(role, '') r, coalesce(text, '') x
  from conversations where conv_id is not null
), n as (select c, count(*) n, {_CRC32.format("c")} % 9 h from t group by c
), b as (select n.c, n.n, n.h, least(n.h, coalesce(o.n, 0)) head from n left join n o on o.c = n.c - n.c % 5
), w as (
  select b.c, i d, r, x from b join t on t.c = b.c - b.c % 5 and i <= h
  union all select b.c, i - h + head, r, x from b join t on t.c = b.c and i > h
), m as (select c, head + greatest(n - h, 0) m from b
), p as (
  select c, d, list({{'r': r, 'x': x}}) over (partition by c order by d) k, strlen(x) bytes from w
  union all select c, 0, [], 0 from m
), g as (
  select d, k, min(c) conv_id, count(*) n_convs, any_value(bytes) bytes,
    sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where m = d), '')) ends_sha256
  from p join m using (c) group by d, k
), s as (select *, (select count(*) from g o where o.d = g.d + 1 and o.k[1 : g.d] = g.k) n_children from g
), a as (
  select up d, k[1 : up] k, sum((n_convs - 1) * bytes) saved_tokens, count(*) filter (where n_children = 0) n_leaves
  from (select *, unnest(range(d + 1)) up from s) group by all
)
select s.conv_id, cast(s.d as bigint) as depth, o.conv_id parent_conv_id, s.n_convs, s.n_children, n_leaves, cast(saved_tokens as bigint) saved_tokens, s.ends_sha256
from s join a using (d, k) left join g o on o.d = s.d - 1 and o.k = s.k[1 : s.d - 1]
"""


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and what stays without their repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.collapse(_cycled(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    length, period = longest["length"], -longest["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["start"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def _cycled(docs: DataFrame) -> DataFrame:
    """``docs`` with every tenth document, by crc32 of its id, made periodic from one of its words on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    n, g = F.col("n"), F.col("g")
    rows = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumns({"n": F.size("words"), "g": F.floor(h / 10)})
    rows = rows.withColumn("a", F.when(n > 0, g % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    # The first a + p words, then the last p of these over and over.
    place = lambda i: F.when(i < F.col("a") + F.col("p"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    made = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get("words", place(i).cast("int")))
    return rows.select("doc_id", F.when(n > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


ORACLE["op12_periodic_runs"] = rf"""
with o as (
  select row_number() over () rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w, {_CRC32.format("doc_id")} h from documents
), e as (select rid, doc_id, w, len(w) n, h, h // 10 % len(w) a, 1 + (len(w) - h // 10 % len(w)) // (3 + h // 10 % 8) p from o
), d as (
  select rid, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) else w end w from e
), t as (select rid, n, unnest(w) x, generate_subscripts(w, 1) - 1 i from d
), m as (select t.rid, t.i, t.i - b.i q from t join t b on t.rid = b.rid and t.x = b.x and b.i < t.i and 4 * (t.i - b.i) <= t.n
), s as (
  select rid, q, min(i) - q start, count(*) + q length from (select *, i - row_number() over (partition by rid, q order by i) k from m)
  group by rid, q, k having count(*) >= greatest(3 * q, 6 - q)
), r as (
  select * from s where not exists (select 1 from s o where o.rid = s.rid and o.q < s.q and o.start <= s.start and o.start + o.length >= s.start + s.length)
), l as (
  select rid, count(*) n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) listed,
    min({{'l': -length, 's': start, 'q': q}}) longest from r group by rid
), x as (select distinct rid, unnest(range(start + q, start + length)) i from r
), k as (select rid, string_agg(t.x, ' ' order by i) kept from t anti join x using (rid, i) group by rid)
select doc_id, coalesce(n_runs, 0) n_runs, longest.s start, -longest.l length, longest.q period, -1000 * longest.l // longest.q exponent_milli,
  sha256(coalesce(listed, '')) runs_sha256, sha256(coalesce(kept, '')) collapsed_sha256
from d left join l using (rid) left join k using (rid)
"""


@_query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, the one of equal texts that stays, and how many are equal."""
    found = exact.copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op13_exact_dedup"] = """
select doc_id, max(doc_id) over (partition by t) keep_id, count(*) over (partition by t) group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 kept, sha256(t) text_sha256
from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents)
"""
