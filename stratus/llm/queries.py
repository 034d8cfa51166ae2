"""Queries of the subpackage: one ``opN_<name>`` per operator, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import (
    brown, chat, decontaminate, embeddings, jaccard, mixing, resample, secrets, suffixes, toxicity, trie, urls,
    wavelet,
)
from stratus.llm.scratch import Scratch, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


#: Words of a text in DuckDB: A-Z lower-cased, split at ASCII white space.
_SQL_WORDS = """
list_filter(regexp_split_to_array(translate(coalesce({t}, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"""


@register("op10_ngram_jaccard", f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SQL_WORDS.format(t='text')} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM common JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
  WHERE 100 * k >= 75 * (a.n + b.n - k)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
""")
def op10_ngram_jaccard(spark, sf_dir):
    """Near-duplicate components of all documents by 5-word shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


@register("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    """Toxicity scores of all documents; fold 0 is held out of the training."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(toxicity.fold("doc_id") != 0))
    return (docs.select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"),
                        toxicity.score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


#: (host, path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@register("op3_url_rules", """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT page_id, host, path, h || p AS rule, v,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC) AS k
  FROM h JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p))
SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.v, 'allow') AS verdict
FROM h LEFT JOIN f ON f.page_id = h.page_id AND f.k = 1
""")
def op3_url_rules(spark, sf_dir):
    """Block and allow rules over all pages."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@register("op7_source_mixing", r"""
WITH d AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
    ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / w, source) AS k FROM s),
c AS (SELECT *, sum(source_size) OVER () AS t, sum(w) OVER () AS tw,
    coalesce(sum(source_size) OVER b, 0) AS cut, coalesce(sum(w) OVER b, 0) AS cut_w
  FROM o WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (t - 3 * cut)::DOUBLE / (tw - cut_w)::DOUBLE AS level FROM c
  WHERE (t - 3 * cut)::DOUBLE / (tw - cut_w)::DOUBLE * w <= 3 * source_size ORDER BY k LIMIT 1),
g AS (SELECT source, source_size, least(level * w, 3.0::DOUBLE * source_size) AS target FROM s, l),
m AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m
""")
def op7_source_mixing(spark, sf_dir):
    """How many words of each document the mix takes."""
    mixed = mixing.with_copies(table(spark, sf_dir, "documents"), Scratch(spark, "op7"))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"),
                        (F.col("_size") * F.col("_copies")).alias("taken"))



_SQL_ESCAPED = r"""(length({x}) + length({x}) - length(replace({x}, '\', ''))
  + coalesce(list_sum(list_transform(regexp_extract_all({x}, '#{{3,}}'), lambda r: length(r) - 2)), 0)
  + (length({x}) - length(replace({x}, '</turn>', ''))) // 7)"""


@register("op8_chat_formatting", rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  sum(CASE WHEN r = 'assistant' THEN length(t) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN r = 'assistant' THEN t ELSE '' END, '' ORDER BY turn, r, t)) AS loss_sha256,
  sum(14 + {_SQL_ESCAPED.format(x='r')} + {_SQL_ESCAPED.format(x='t')})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
""")
def op8_chat_formatting(spark, sf_dir):
    """Digests of all conversations, read back from the formatted output."""
    scratch = Scratch(spark, "op8")
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)
    segs = scratch.save(chat.segments(turns), "segments")
    exs = scratch.save(chat.examples(segs), "examples")
    return chat.digests(chat.parsed(segs, exs))


#: Tokenizer file of the installed vocabularies, and the id that ends a document.
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@register("op1_wavelet_tokens")
def op1_wavelet_tokens(spark, sf_dir):
    """Token offsets and checksums of all documents, read back from the shards."""
    shards = wavelet.write_shards(table(spark, sf_dir, "documents"), Scratch(spark, "op1"),
                                  tokenizer_path(), END_ID)
    return wavelet.read_documents(shards)


@register("op5_decontamination")
def op5_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                               Scratch(spark, "op5"))


@register("op6_embedding_dedup", """
WITH RECURSIVE g AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
link AS (SELECT a.vec_id AS u, b.vec_id AS v FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
c AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT c.vec_id, (SELECT count(*) FROM link WHERE u = c.vec_id) AS n_links, component_id,
  c.vec_id = component_id AS kept FROM c
""")
def op6_embedding_dedup(spark, sf_dir):
    """Links and components of all vectors."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark, "op6"))


@register("op9_brown_lm")
def op9_brown_lm(spark, sf_dir):
    """Scores of all documents; fold 1 is held out of the training."""
    fold = toxicity.fold("doc_id")
    scores = brown.score(table(spark, sf_dir, "documents"), fold != 1, Scratch(spark, "op9"))
    return scores.select("doc_id", (toxicity.fold("doc_id") == 1).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@register("op4_repeated_passages")
def op4_repeated_passages(spark, sf_dir):
    """Passages of 50 words or more that several documents hold."""
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"), Scratch(spark, "op4"))


#: CRC-32 of a string's UTF-8 bytes in DuckDB, with the byte table ``tab``.
_SQL_CRC_TABLE = """(SELECT list_transform(range(256), lambda v: list_reduce(range(8),
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, v::BIGINT)) AS tab)"""
_SQL_CRC = """xor(list_reduce(list_transform(range(octet_length(encode({x}))),
    lambda i: ('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::BIGINT),
  lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""


@register("op13_target_resampling", rf"""
WITH c AS {_SQL_CRC_TABLE},
w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
f AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM w),
fb AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM b),
k AS (SELECT g, {_SQL_CRC.format(x='g')} % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM f UNION SELECT DISTINCT g FROM fb), c),
s AS (SELECT bucket, count(*) AS n FROM f JOIN k USING (g) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM fb JOIN k USING (g) GROUP BY 1),
a AS (SELECT (SELECT count(*) FROM f)::DOUBLE AS sa, (SELECT count(*) FROM fb)::DOUBLE AS ta),
gain AS (SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (sa + 10000))
    / ((s.n + 1)::DOUBLE * (ta + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), a),
d AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM f JOIN k USING (g) JOIN gain USING (bucket) GROUP BY r),
v AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
    coalesce(floor(total / n), 0)::BIGINT AS weight,
    ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h
  FROM w LEFT JOIN d USING (r)),
x AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM v),
p AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20
    ORDER BY score DESC, doc_id NULLS FIRST, weight DESC, n_features) AS place,
  count(*) OVER (PARTITION BY n_words >= 20) AS able FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= able * 25 // 100 THEN place END AS rank
FROM p
""")
def op13_target_resampling(spark, sf_dir):
    """Weights, scores and ranks of all documents, drawn towards the benchmark."""
    found = resample.ranked(resample.scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op13")))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@register("op12_conversation_trie", f"""
WITH c AS {_SQL_CRC_TABLE},
t AS (SELECT conv_id::BIGINT AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
h AS (SELECT n.c, n.c - n.c % 5 AS b, {_SQL_CRC.format(x='n.c::VARCHAR')} % 9 AS h FROM n, c),
re AS (SELECT h.c, t.p AS d, r, x FROM h JOIN t ON t.c = h.b AND t.p <= h.h
  UNION ALL SELECT h.c, t.p - h.h + least(h.h, coalesce(n.n, 0)), r, x
  FROM h JOIN t ON t.c = h.c AND t.p > h.h LEFT JOIN n ON n.c = h.b),
k AS (SELECT c, d, string_agg(sha256(strlen(r) || ':' || r || x), '') OVER (PARTITION BY c ORDER BY d) AS k,
    strlen(x) AS z FROM re UNION ALL SELECT c, 0, '', 0 FROM n),
l AS (SELECT c, max(d) AS l FROM k GROUP BY c),
g AS (SELECT d, k, min(c) AS m, count(*) AS n, max(z) AS z FROM k GROUP BY d, k),
i AS (SELECT k.c, k.d, g.m FROM k JOIN g USING (d, k)),
o AS (SELECT g.*, i.m AS pm FROM g LEFT JOIN i ON i.c = g.m AND i.d = g.d - 1),
kids AS (SELECT d - 1 AS d, pm AS m, count(*) AS n FROM o WHERE d > 0 GROUP BY 1, 2),
s AS (SELECT i.d, i.m, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END)::BIGINT AS leaves,
    sum((o.n - 1) * o.z)::BIGINT AS saved
  FROM o LEFT JOIN kids ON kids.d = o.d AND kids.m = o.m JOIN i ON i.c = o.m AND i.d <= o.d GROUP BY 1, 2),
e AS (SELECT i.d, i.m, string_agg(i.c::VARCHAR, ',' ORDER BY i.c) AS e FROM i JOIN l ON l.c = i.c AND l.l = i.d GROUP BY 1, 2)
SELECT o.m AS conv_id, o.d::BIGINT AS depth, o.pm AS parent_conv_id, o.n AS n_convs, coalesce(kids.n, 0) AS n_children,
  s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(coalesce(e.e, '')) AS ends_sha256
FROM o JOIN s ON s.d = o.d AND s.m = o.m LEFT JOIN kids ON kids.d = o.d AND kids.m = o.m
LEFT JOIN e ON e.d = o.d AND e.m = o.m
""")
def op12_conversation_trie(spark, sf_dir):
    """Prefix nodes of all conversations, rebuilt on their group's first turns."""
    scratch = Scratch(spark, "op12")
    seqs = trie.regrafted(trie.encoded(table(spark, sf_dir, "conversations"), scratch))
    return trie.prefix_trie(seqs, scratch)


@register("op11_secret_scan")
def op11_secret_scan(spark, sf_dir):
    """Spans of secrets in all documents."""
    found = secrets.findings(table(spark, sf_dir, "documents"), Scratch(spark, "op11"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.joined(F.col("spans"), fixed_only=True), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))
