"""Registered queries of the training-data operators, over whole tables, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from funnelspark.llm import ann, decontaminate, langid, merkle, mixing, ngram_join, pii, quality, simhash, spelling, suffix_dedup, token_counts, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_components(table(spark, folder, "documents").select("doc_id", "text"))


def op1_ngram_links(spark: SparkSession, folder: str) -> DataFrame:
    members, _ = ngram_join.join_links(table(spark, folder, "documents").select("doc_id", "text"))
    return members.drop("key")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.toxicity(docs, model).select("doc_id", quality.held_out(3, 1), "score", "predicted")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, table(spark, folder, "benchmark")).drop("spans")


def op6_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.quality(docs, model).select("doc_id", quality.held_out(4, 2), "score", "predicted")


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.surrogates(table(spark, folder, "documents").select("doc_id", "text"))


def op8_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", quality.held_out(4, 2), "lang_pred", "score", "rejected")


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, folder, "documents").select("doc_id", "text")).drop("kept")


def _positions():
    """Training times of a row's passes, to nine places as the comparison has them."""
    return F.transform("positions", lambda p: F.round(p, 9)).alias("positions")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", _positions())


def op10_mixing_positions(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "taken", _positions())


def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents").select("doc_id", "text"), spelling.altered)


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(*merkle.FIELDS)
    text = F.when(merkle.sampled(F.col("doc_id")), merkle.lowered(F.col("text"))).otherwise(F.col("text"))
    return merkle.prove(docs, {"text": text})


# Overlaps of all pairs that share a shingle, then reachability.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[p : p + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS MATERIALIZED (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 75 * (p.n + q.n - i)
), r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""
# The same with the number of links of each document.
OP1_LINKS_SQL = OP1_SQL[: OP1_SQL.rindex("SELECT w.doc_id")] + r"""
SELECT w.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, c.component_id, coalesce(k.k, 0)::bigint AS n_links
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM l GROUP BY a) k USING (doc_id)
"""

# Windows of ten item words met with windows of document words, one length at a time.
OP4_SQL = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), il AS (SELECT item_id, w, least(len(w), 10) AS size FROM iw WHERE len(w) > 0
), ip AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p : p + size - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM il)
), dw AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), dp AS (
  SELECT r, size, p, array_to_string(w[p : p + size - 1], ' ') AS phrase
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM dw, (SELECT DISTINCT size FROM il) WHERE len(w) >= size)
), m AS (SELECT r, p, size, item_id FROM dp JOIN ip USING (size, phrase)
), h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS k FROM (SELECT DISTINCT r, p, size FROM m)) GROUP BY r
), i AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, item_id::varchar AS i FROM m) GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h USING (r) LEFT JOIN i USING (r)
"""


# Every 50-byte string with its smallest document; hits of a document merge to spans, and what lies between is hashed.
OP9_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), g AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(0, greatest(len(x) // 2 - 49, 0))) AS i FROM d)
), f AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s HAVING min(doc_id) < max(doc_id)
), h AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) + 50 AS new FROM g JOIN f USING (s) WHERE doc_id > least
), r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(new::int) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM h) GROUP BY doc_id, k
), e AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail, string_agg(piece, '' ORDER BY a) AS kept
  FROM (SELECT doc_id, a, b, substr(x, 2 * coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS piece
        FROM r JOIN d USING (doc_id)) GROUP BY doc_id
)
SELECT doc_id, (len(x) // 2)::bigint AS n_bytes, coalesce(n_removed, 0)::bigint AS n_removed, coalesce(n_spans, 0)::bigint AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN e USING (doc_id)
"""


# Water-filling over the sources in order of cap / weight; then each source's documents in keyed order fill its target.
# One training time a pass: the default schedules have one segment each, so their integral is inverted in closed form.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('7|' || coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')) AS h FROM documents
), s AS (
  SELECT source, sum(size)::double AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (
  SELECT *, (rank % 3 + 1)::double AS weight, 3 * source_size AS cap, 3 * source_size / (rank % 3 + 1) AS turn FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY turn, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, rank, CASE WHEN source_size = 0 THEN 0 ELSE least(cap, weight * (SELECT arg_min(level, turn) FROM l WHERE level <= turn)) END AS target FROM l
), r AS (
  SELECT d.*, t.source_size, t.target, t.rank, floor(t.target / greatest(t.source_size, 1)) AS passes,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS placed
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, (passes * size + greatest(0, least(size, round(target - passes * source_size) - placed)))::bigint AS taken,
         [1.6, 1.0, 0.4][(rank % 3 + 1)::int]::double AS w0, [0.4, 1.0, 1.6][(rank % 3 + 1)::int]::double AS w1 FROM r
)
SELECT doc_id, size::bigint AS size, source_size::bigint AS source_size, target, taken, CASE WHEN taken = 0 THEN [] ELSE list_transform(range(0, ceil(taken / size)::bigint),
         lambda e: round(least(1.0, 2 * ((placed + e * source_size) / target) / (w0 + sqrt(greatest(w0 * w0 + 2 * (w1 - w0) * ((placed + e * source_size) / target), 0)))), 9)) END AS positions FROM k
"""
OP10_POSITIONS_SQL = OP10_SQL.replace("SELECT doc_id, size::bigint AS size, source_size::bigint AS source_size, target, taken,", "SELECT doc_id, taken,")

# crc32 by a table of 256 steps: {bytes} is a list of whole numbers.
CRC_TABLE = """crc_steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8
), crc_table AS MATERIALIZED (SELECT list(c::bigint ORDER BY i) AS t FROM crc_steps WHERE k = 8
)"""
CRC = "xor(list_reduce(list_prepend(4294967295::bigint, {bytes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"

# Words one edit apart by what is left when one letter is taken out of each (replaced) or of the longer one.
OP12_SQL = r"""
WITH RECURSIVE """ + CRC_TABLE + r""", runs AS (
  SELECT run, hex(encode(concat(coalesce(doc_id::varchar, ''), ':', run))) AS x
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7
), hashed AS (
  SELECT run, """ + CRC.format(bytes="list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)") + r""" AS h FROM runs, crc_table
), w AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), less AS MATERIALIZED (
  SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM less x JOIN w y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM less x JOIN w y ON x.rest = y.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS most FROM near GROUP BY word
), f AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN other END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n FROM w LEFT JOIN best USING (word)
), r(word, last) AS (SELECT word, word FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.last AS root, f.n::bigint AS n, f.n_near::bigint AS n_near, f.form_n::bigint AS form_n
FROM f JOIN r USING (word) JOIN f e ON e.word = r.last WHERE e.form IS NULL
"""

# Levels by recursion on the runs of 16; then every leaf climbs them, one recursive step a level.
OP13_SQL = r"""
WITH RECURSIVE """ + CRC_TABLE + r""", d AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
         """ + CRC.format(bytes="list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)") + r""" % 5 = 0 AS tamper
  FROM documents, crc_table
), f AS (
  SELECT r, doc_id, source, tamper, text, concat(coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
         coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-')) AS head FROM d
), leaf AS MATERIALIZED (
  SELECT r, doc_id, source, sha256(concat(head, coalesce(octet_length(encode(text)) || ':' || text, '-'))) AS leaf,
         sha256(concat(head, coalesce(octet_length(encode(text)) || ':' || CASE WHEN tamper THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-'))) AS tampered FROM f
), placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaf
), low(tree, level, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, level, pos // 16, n
), high(level, pos, n, h) AS (
  SELECT 0, tree, count(*) OVER (), h FROM low WHERE n = 1
  UNION ALL SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 16, n
), nodes AS MATERIALIZED (
  SELECT tree, level, pos, n, h FROM low UNION ALL SELECT -1, level, pos, n, h FROM high
), linked AS MATERIALIZED (
  SELECT tree, level, pos, n, coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes
), climb(r, own, tree, level, pos, h, passed, done) AS (
  SELECT r, tree, tree, 0, pos, tampered, '', false FROM placed
  UNION ALL
  SELECT c.r, c.own, CASE WHEN k.n = 1 THEN -1 ELSE c.tree END, CASE WHEN k.n = 1 THEN 0 ELSE c.level + 1 END, CASE WHEN k.n > 1 THEN c.pos // 16 ELSE c.own END,
         CASE WHEN k.n = 1 THEN c.h ELSE sha256(concat(k.before, c.h, k.after)) END, CASE WHEN k.n = 1 THEN c.passed ELSE concat(c.passed, k.before, k.after) END, k.n = 1 AND c.tree = -1
  FROM climb c JOIN linked k ON k.tree = c.tree AND k.level = c.level AND k.pos = c.pos WHERE NOT c.done
)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(c.passed) AS proof_sha256, c.h AS folded_root, c.h = t.h AS verified
FROM climb c JOIN placed p USING (r) JOIN low s ON s.tree = p.tree AND s.n = 1 JOIN high t ON t.n = 1 WHERE c.done
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_ngram_jaccard, op1_ngram_links, op2_toxicity, op3_token_counts, op4_decontaminate, op5_quality, op6_ann, op7_pii, op8_langid, op9_suffix_dedup, op10_mixing, op10_mixing_positions, op11_simhash, op12_spelling, op13_merkle)}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": OP1_SQL, "op1_ngram_links": OP1_LINKS_SQL, "op4_decontaminate": OP4_SQL, "op9_suffix_dedup": OP9_SQL, "op10_mixing": OP10_SQL, "op10_mixing_positions": OP10_POSITIONS_SQL, "op12_spelling": OP12_SQL, "op13_merkle": OP13_SQL}
