"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, jaccard_join, language, licences, nearest, packing, pseudonyms, toxicity, warc

#: The key of the pseudonyms; a deployment passes its own secret.
DEMO_KEY = "weirgate demonstration key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return nearest.search(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a tree of files four levels deep: a quarter are licence files, at one of the upper three levels."""
    docs, doc = _table(spark, sf_dir, "documents"), F.col("doc_id")
    named, level = F.pmod(F.floor(doc / 20), F.lit(4)) == 0, F.pmod(F.floor(doc / 80), F.lit(3))
    dirs = [F.concat_ws("/", F.col("source"), *(F.floor(doc / n).cast("string") for n in sizes)) for sizes in ((), (2000,), (2000, 200), (2000, 200, 40))]
    above = F.when(level == 0, dirs[0]).when(level == 1, dirs[1]).otherwise(dirs[2])
    path = F.when(named, F.concat(above, F.lit("/LICENSE-"), doc.cast("string"))).otherwise(F.concat(dirs[3], F.lit("/"), doc.cast("string"), F.lit(".txt")))
    found = licences.scan(docs.withColumn("path", path), named)
    return found.withColumn("score", F.round("score", 6))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), k=3, threshold=0.9)


def op3_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents each one is linked to; op3_ngram_jaccard_join has the columns of its SQL."""
    return jaccard_join.jaccard_links(_table(spark, sf_dir, "documents"), k=3, threshold=0.9)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs, "doc_id", "text", "lang"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated")
    )


def op7_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return warc.lookup(warc.write(pages), pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = chat.perspectives(_table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return shown.withColumn("mask", F.array_join(spans, ","))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(_table(spark, sf_dir, "documents"), DEMO_KEY)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERM = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"


def _template_rows() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = [(name, text) for name, texts in sorted(licences.TEMPLATES.items()) for text in texts]
    return ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(rows))


#: Brute force: every line against every template, no prefix bound.
OP2_SQL = rf"""
WITH tpl(t, licence, text) AS (VALUES {_template_rows()}),
tt AS (SELECT t, licence, unnest(regexp_extract_all(lower(text), '{_TERM}')) AS term FROM tpl),
tw AS (SELECT t, licence, term, count(*) AS tf FROM tt GROUP BY ALL),
vocab AS (SELECT DISTINCT term FROM tt),
files AS (
  SELECT doc_id, text, doc_id // 20 % 4 = 0 AS named, dirs[1 : CASE WHEN doc_id // 20 % 4 = 0 THEN doc_id // 80 % 3 + 1 ELSE 4 END] AS dirs
  FROM (SELECT *, [source, source || '/' || (doc_id // 2000), source || '/' || (doc_id // 2000) || '/' || (doc_id // 200), source || '/' || (doc_id // 2000) || '/' || (doc_id // 200) || '/' || (doc_id // 40)] AS dirs FROM documents)),
ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, unnest(range(len(string_split(text, chr(10))))) AS line FROM files WHERE text <> ''),
ps AS (SELECT doc_id, unnest(string_split_regex(text, '\n(?:[^\p{{L}}\p{{N}}\n]*\n)+')) AS unit, unnest(range(len(string_split_regex(text, '\n(?:[^\p{{L}}\p{{N}}\n]*\n)+')))) AS place FROM files WHERE text <> ''),
lt AS (SELECT doc_id, line, regexp_extract_all(lower(unit), '{_TERM}') AS terms FROM ls),
lines AS (SELECT * FROM lt WHERE len(terms) > 0),
n AS (SELECT count(*) AS n FROM lines),
df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(terms)) AS term FROM lines) JOIN vocab USING (term) GROUP BY term),
idf AS (SELECT v.term, ln((1 + n.n) / (1.0 + coalesce(df.df, 0))) + 1 AS idf FROM vocab v CROSS JOIN n LEFT JOIN df USING (term)),
w AS (SELECT t, licence, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY t)) AS w FROM tw JOIN idf USING (term)),
units AS (SELECT doc_id, line, terms FROM lines UNION ALL SELECT doc_id, -1073741824, regexp_extract_all(lower(text), '{_TERM}') FROM files WHERE named AND text <> ''
  UNION ALL SELECT doc_id, place - 536870912, regexp_extract_all(lower(unit), '{_TERM}') FROM ps WHERE contains(unit, chr(10))),
close AS (SELECT * FROM units WHERE list_has_any(terms, (SELECT list(term) FROM vocab))),
tf AS (SELECT doc_id, line, term, count(*) AS tf FROM (SELECT doc_id, line, unnest(terms) AS term FROM close) GROUP BY ALL),
x AS (SELECT doc_id, line, term, tf.tf * coalesce(idf.idf, (SELECT ln((1 + n) / 2.0) + 1 FROM n)) AS x FROM tf LEFT JOIN idf USING (term)),
norm AS (SELECT doc_id, line, sqrt(sum(x * x)) AS norm FROM x GROUP BY ALL),
dot AS (SELECT doc_id, line, t, licence, sum(x * w) AS d FROM x JOIN w USING (term) GROUP BY ALL),
best AS (SELECT doc_id, licence, line, round(d / norm, 9) AS score FROM dot JOIN norm USING (doc_id, line) WHERE round(d / norm, 9) >= 0.75),
own AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line, licence) AS k FROM best) WHERE k = 1),
found AS (SELECT f.doc_id, dirs[-1] || CASE WHEN named THEN '/LICENSE-' || f.doc_id ELSE '/' || f.doc_id || '.txt' END AS path, named, dirs, o.licence, o.score FROM files f LEFT JOIN own o USING (doc_id)),
given AS (SELECT dir, licence FROM (SELECT dirs[-1] AS dir, licence, row_number() OVER (PARTITION BY dirs[-1] ORDER BY score DESC, licence) AS k FROM found WHERE named AND licence IS NOT NULL) WHERE k = 1),
above AS (SELECT a.doc_id, arg_max(g.licence, a.depth) AS licence, arg_max(g.dir, a.depth) AS dir
  FROM (SELECT doc_id, unnest(dirs) AS dir, unnest(range(len(dirs))) AS depth FROM found WHERE licence IS NULL) a JOIN given g USING (dir) GROUP BY a.doc_id)
SELECT f.doc_id, f.path, coalesce(f.licence, a.licence) AS licence, CASE WHEN f.licence IS NOT NULL THEN 'own' WHEN a.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
  round(f.score, 6) AS score, a.dir AS from_dir
FROM found f LEFT JOIN above a USING (doc_id)
"""

OP3_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
items AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM items GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same
  FROM items a JOIN items b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * same >= 90 * (p.n + q.n - same)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""

OP3_LINKS_SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
items AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM items GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same
  FROM items a JOIN items b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, count(*) AS n FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * same >= 90 * (p.n + q.n - same) GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.n, 0) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN links l ON l.x = d.doc_id
"""

OP6_SQL = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.i, p.n, x.item FROM places p JOIN windows x ON x.n = p.n AND x.s = p.s),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
  sha256(coalesce(m.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= coalesce(len(d.w), 0) AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

OP7_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN f.first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

OP8_SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
rows AS (
  SELECT *, (n - 1) // 1024 AS chunk FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, sha256(text)) AS n FROM said)),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM rows WHERE speaker <> 'system'),
parts AS (
  SELECT r.conv_id, p.perspective, r.chunk, r.speaker = p.perspective AS own,
    '<|im_start|>' || CASE WHEN r.speaker = p.perspective THEN 'assistant' WHEN r.speaker = 'system' THEN 'system'
      ELSE 'user name=' || r.speaker END || chr(10) AS head, r.text || '<|im_end|>' AS body,
    r.n AS place
  FROM rows r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, chunk ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS s FROM parts)
SELECT conv_id, perspective, chunk, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg(CASE WHEN own THEN s || '-' || (s + length(body)) END, ',' ORDER BY place), '') AS mask
FROM placed GROUP BY conv_id, perspective, chunk
"""


def queries() -> dict:
    return {
        f.__name__: f
        for f in (op1_nearest_neighbours, op2_license_scan, op3_ngram_jaccard_join, op3_ngram_jaccard_links, op4_language_id, op5_toxicity, op6_decontamination, op7_warc_capture_index, op8_chat_perspectives, op9_pii_pseudonyms, op10_best_fit_packing)
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": OP2_SQL, "op3_ngram_jaccard_join": OP3_SQL, "op3_ngram_jaccard_links": OP3_LINKS_SQL, "op6_decontamination": OP6_SQL, "op7_warc_capture_index": OP7_SQL, "op8_chat_perspectives": OP8_SQL}
