"""The queries of the operators, over whole tables, and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import (
    alignment,
    decontamination,
    exact,
    fingerprint,
    language,
    licences,
    lines,
    ngram_join,
    packing,
    prefix_trie,
    sharding,
    toxicity,
    url_filter,
)
from rowtide.llm.frames import kept, looked_up
from rowtide.session import utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(utc(spark), sf_dir)
    return run


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark, sf_dir):
    return decontamination.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("items", "spans")


@query
def op2_language(spark, sf_dir):
    return language.identified(read(spark, sf_dir, "documents"))


@query
def op3_lines(spark, sf_dir):
    """Every line with a word, with the first occurrence of its group."""
    found = lines.line_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "line", "keep_doc", "keep_line", "group_lines", "kept")


@query
def op4_packing(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"))


#: Documents that name a licence are the licence files: the English ones in the folder of their source, the
#: others in that of their language below it. All others are in a folder for each thousand of doc_id below.
SPEAKS = "coalesce(text, '') RLIKE '(?i)licen[sc]e'"


@query
def op5_licences(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    source, lang = F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))
    thousand = F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit(""))
    speaks = F.expr(SPEAKS)
    path = F.concat_ws(
        "/",
        source,
        F.when(~speaks | (lang != "en"), lang),
        F.when(~speaks, thousand),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
    )
    return licences.scanned(documents.withColumn("path", path), speaks)


@query
def op6_ngram_join(spark, sf_dir):
    found = ngram_join.classes(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_rows", "n_links")


@query
def op7_toxicity(spark, sf_dir):
    found = toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.withColumn("n_passages", F.size("passages")).drop("passages")


@query
def op8_exact(spark, sf_dir):
    return exact.report(read(spark, sf_dir, "documents"))


@query
def op9_sharding(spark, sf_dir):
    return sharding.sharded(read(spark, sf_dir, "documents"))


#: The rules of the contract.
RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]
#: Pages with less markup than this are thin; their urls are the block list.
THIN = 1000


@query
def op10_url_filter(spark, sf_dir):
    return url_filter.judged(read(spark, sf_dir, "pages"), RULES, F.length("html") < THIN)


def forked(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The contract's conversations: the first turns of conversation c - c % 20, then c's own turns after as many."""
    forks = conversations.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % 20).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h"),
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    first = turns.filter("conv_id % 20 = 0 AND place < 3").withColumnRenamed("conv_id", "base")
    first = first.join(forks, "base").filter("place < h").select(*turns.columns)
    # Where the other conversation has fewer than h turns, or is not there, the own turns move up.
    short = forks.join(first.groupBy("conv_id").agg(F.count("*").alias("had")), "conv_id", "left")
    short = short.select("conv_id", (F.col("h") - F.coalesce("had", F.lit(0))).alias("missing")).filter("missing > 0")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = looked_up(turns.filter(F.col("place") >= h), short, ["conv_id"], sizes, turns.count())
    own = own.withColumn("place", F.col("place") - F.coalesce("missing", F.lit(0)))
    return first.unionByName(own.select(*turns.columns))


@query
def op11_prefix_trie(spark, sf_dir):
    conversations = read(spark, sf_dir, "conversations")
    turns, _ = prefix_trie.placed(conversations)
    ids, _ = kept(turns.select("conv_id").distinct(), "conversations")
    return prefix_trie.prefix_trie(forked(turns, ids), ids).drop("k1", "k2")


#: Vocabulary files of the contract's two tokenizers.
BYTE_BPE, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


@query
def op12_alignment(spark, sf_dir):
    found = alignment.aligned(read(spark, sf_dir, "documents"), BYTE_BPE, PIECES)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    found, _ = kept(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.weighed(found, alignment.pair_counts(found, alignment.n_pieces(spark, PIECES)))


@query
def op13_fingerprints(spark, sf_dir):
    found = fingerprint.fingerprinted(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.fingerprint(F.col("numbers")).alias("fingerprint"),
        fingerprint.fingerprint(F.col("edited_numbers")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


ORACLE: dict[str, str] = {}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op1_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, list_slice(w, i, i + least(len(w), 13) - 1) AS win
    FROM b, unnest(range(1, greatest(least(len(w), 1), len(w) - 12) + 1)) AS t(i)),
sizes AS (SELECT DISTINCT len(win) AS size FROM windows),
places AS (
    SELECT r, i, list_slice(w, i, i + size - 1) AS win
    FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
found AS (SELECT r, i, win, item FROM places JOIN windows USING (win)),
hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + len(win))) AS t(p) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

ORACLE["op8_exact"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
p AS (
    SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id NULLS LAST, r))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM p
"""

ORACLE["op10_url_filter"] = rf"""
WITH p AS (
    SELECT page_id, html,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
listed AS (SELECT DISTINCT host, path FROM p WHERE length(html) < {THIN}),
rules(verdict, h, s) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}),
keys AS (SELECT DISTINCT host, path FROM p),
best AS (
    SELECT host, path, arg_max(h || s, length(h || s)) AS rule, arg_max(verdict, length(h || s)) AS ruled
    FROM keys JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY host, path)
SELECT page_id, p.host, p.path, rule,
    coalesce(ruled, CASE WHEN listed.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path
LEFT JOIN listed ON p.host = listed.host AND p.path = listed.path
"""

_CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')],
    lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

ORACLE["op11_prefix_trie"] = rf"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (
    SELECT conv_id, {{'role': role, 'text': text}} AS said,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) - 1 AS p FROM given),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM given)),
first_turns AS (SELECT c.conv_id, p, said FROM c JOIN t ON t.conv_id = base WHERE p < h),
had AS (SELECT conv_id, count(*) AS had FROM first_turns GROUP BY conv_id),
turns AS (
    SELECT * FROM first_turns UNION ALL
    SELECT conv_id, p - h + coalesce(had, 0), said FROM t JOIN c USING (conv_id) LEFT JOIN had USING (conv_id) WHERE p >= h),
said AS (
    SELECT c.conv_id, coalesce(s, []) AS s
    FROM c LEFT JOIN (SELECT conv_id, list(said ORDER BY p) AS s FROM turns GROUP BY conv_id) USING (conv_id)),
nodes AS (
    SELECT s[1:d] AS k, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        string_agg(CASE WHEN len(s) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
    FROM said, unnest(range(0, len(s) + 1)) AS r(d) GROUP BY ALL),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(k[d].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes LEFT JOIN kids USING (k)),
sums AS (
    SELECT k[1:a] AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM own, unnest(range(0, d + 1)) AS r(a) GROUP BY ALL)
SELECT own.conv_id, own.d AS depth, above.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(own.ends, '')) AS ends_sha256
FROM own JOIN sums USING (k) LEFT JOIN nodes above ON own.d > 0 AND above.k = own.k[1:own.d - 1]
"""

_VALUES = ", ".join(f"('{name}', {n}, '{text}')" for n, (name, text) in enumerate(licences.TEMPLATES))

ORACLE["op5_licences"] = rf"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source,
        coalesce(lang, '') AS lang, coalesce(CAST(CAST(floor(doc_id / 1000) AS BIGINT) AS VARCHAR), '') AS thousand,
        regexp_matches(coalesce(text, ''), '(?i)licen[sc]e') AS speaks FROM documents),
d AS (
    SELECT *, CASE WHEN NOT speaks THEN source || '/' || lang || '/' || thousand
        WHEN lang <> 'en' THEN source || '/' || lang ELSE source END AS folder FROM t),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS text FROM d),
cut AS (SELECT r, {_WORDS} AS w FROM lines),
templates(licence, template, text) AS (VALUES {_VALUES}),
tterms AS (SELECT licence, template, unnest({_WORDS}) AS term FROM templates),
vocabulary AS (SELECT DISTINCT term FROM tterms),
n AS (SELECT count(*) AS n FROM cut),
seen AS (
    SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS term FROM cut)
    WHERE term IN (SELECT term FROM vocabulary) GROUP BY term),
idf AS (SELECT term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM vocabulary LEFT JOIN seen USING (term), n),
tw AS (SELECT licence, template, term, count(*) * any_value(idf) AS w FROM tterms JOIN idf USING (term) GROUP BY ALL),
tn AS (SELECT template, sqrt(sum(w * w)) AS length FROM tw GROUP BY template),
few AS (SELECT DISTINCT w AS line FROM cut WHERE list_has_any(w, (SELECT list(term) FROM vocabulary))),
tf AS (SELECT line, term, count(*) AS tf FROM (SELECT line, unnest(line) AS term FROM few) GROUP BY ALL),
lw AS (SELECT line, term, tf * coalesce(idf, ln(1 + n) + 1) AS w FROM tf LEFT JOIN idf USING (term), n),
ln_ AS (SELECT line, sqrt(sum(w * w)) AS length FROM lw GROUP BY line),
cos AS (
    SELECT line, licence, template, round(sum(lw.w * tw.w) / any_value(ln_.length) / any_value(tn.length), {licences.DIGITS}) AS cosine
    FROM lw JOIN tw USING (term) JOIN ln_ USING (line) JOIN tn USING (template) GROUP BY ALL),
best AS (SELECT line, max({{'cosine': cosine, 'licence': licence}}) AS b FROM cos WHERE cosine >= {licences.THRESHOLD} GROUP BY line),
own AS (SELECT r, max(b) AS b FROM cut JOIN best ON w = line GROUP BY r),
f AS (SELECT d.*, b.licence AS own, b.cosine AS cosine FROM d LEFT JOIN own USING (r)),
given AS (SELECT folder, max({{'cosine': cosine, 'own': own}}).own AS given FROM f WHERE speaks AND own IS NOT NULL GROUP BY folder)
SELECT doc_id, f.folder || '/' || coalesce(CAST(doc_id AS VARCHAR), '') AS path, own, cosine,
    coalesce(own, c.given, b.given, a.given) AS licence,
    CASE WHEN own IS NULL THEN coalesce(c.folder, b.folder, a.folder) END AS origin
FROM f LEFT JOIN given c ON f.folder = c.folder
LEFT JOIN given b ON f.source || '/' || lang = b.folder
LEFT JOIN given a ON f.source = a.folder
"""
