"""One query per operator over its whole table: name -> function of (spark, folder); SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bitslice, bpe, epsilon, langid, lm_score, mixing, negatives, pagetext, resampling, simhash, substrings, urls, warc

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("key").alias("doc_id"), shown.alias("fingerprint"), F.col("component").alias("component_id"))


@_query
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document, how many of them lie in repeated passages, and a digest of the rest."""
    found = substrings.cut_repeats(_table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s.stop - s.begin)
    return found.select(
        "row.doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


LLM_ORACLES["op6_substring_dedup"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
spread AS (SELECT place, unnest(range(1, len(words) + 1)) AS pos, len(words) AS n, unnest(words) AS word FROM texts),
starts AS (
  SELECT place, pos, word, CASE WHEN pos + 34 <= n THEN
           md5(string_agg(word, ' ') OVER (PARTITION BY place ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS win
  FROM spread),
repeats AS (SELECT win FROM starts WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
covered AS (
  SELECT place, pos, word, count(r.win) OVER (PARTITION BY place ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 0 AS goes
  FROM starts LEFT JOIN repeats r USING (win)),
cut AS (
  SELECT place, count(*) FILTER (goes) AS gone, string_agg(word, ' ' ORDER BY pos) FILTER (NOT goes) AS kept
  FROM covered GROUP BY place)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN cut USING (place)
"""


@_query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    found = langid.identify_all(_table(spark, folder, "documents"))
    return found.select("row.doc_id", "row", "lang_pred", "score").select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


def token_digests(documents: DataFrame) -> DataFrame:
    """Tokens of every document, and what they decode to, as counts and digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(documents.select("doc_id", "text"), path, public_tokenizers.PATTERN, back=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@_query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, decoded again."""
    return token_digests(_table(spark, folder, "documents"))


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@_query
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    judged = urls.judge(_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


LLM_ORACLES["op9_url_filters"] = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(coalesce(url, ''), '://')
              THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(coalesce(url, ''), '://')
              THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
matched AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN '.' || host LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN '.' || host LIKE '%.com' AND path LIKE '/%' THEN 'com/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM matched
"""


@_query
def op5_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Block, slot and place of every document in a mix of sources weighted by their size to the power 0.7."""
    documents = _table(spark, folder, "documents").select("doc_id", "source")
    placed = mixing.interleave(documents, mixing.tempered_parts(documents))
    return placed.select("row.doc_id", "row.source", "block", "slot", "place")


@_query
def op4_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and conversion record of every page."""
    made = warc.derivatives(warc.responses(_table(spark, folder, "pages")))
    return made.select(
        "row.page_id", "record_type", "record_id", "refers_to", "block_digest", "n_bytes", "source_payload_digest", "n_links",
        F.sha2(F.col("record").cast("binary"), 256).alias("record_sha256"),
    )


def _duck_replace(value: str, pattern: str, by: str) -> str:
    return f"regexp_replace({value}, '{pattern}', {by}, 'g')"


def _duck_unescaped(value: str) -> str:
    for entity, character in [("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")]:
        value = f"replace({value}, '&{entity};', '{character}')"
    return value


def _warc_oracle() -> str:
    """Patterns of its own: elements and attributes as this SQL understands them."""
    eol, spaces = "chr(13) || chr(10)", r"[ \t\r\n\f\x0B]+"
    blocks = "p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|section|article|header|footer|nav|main|aside|pre|blockquote|head|body|html"
    elements = "|".join(rf"<{name}\b.*?</{name}\s*>" for name in ("script", "style", "title"))
    seen = _duck_replace("payload", f"(?is)<!--.*?-->|{elements}", "' '")
    one_line = lambda v: f"trim({_duck_replace(v, spaces, repr(' '))})"
    tags = "<[/!?A-Za-z][^>]*>"
    lines = _duck_replace(_duck_replace(seen, spaces, "' '"), rf"(?i)</?({blocks})\b[^>]*>", "chr(10)")
    text = _duck_unescaped(_duck_replace(lines, tags, "''"))
    text = f"trim({_duck_replace(_duck_replace(text, ' +', repr(' ')), ' ?[\n][ \n]*', 'chr(10)')}, ' ' || chr(10))"
    title = _duck_replace(r"regexp_extract(payload, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)", tags, "''")
    links = rf"""regexp_extract_all({seen}, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"''>]*)', 1)"""
    urn = lambda v: (
        f"(SELECT '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-3' || h[14:16] || '-8' || h[18:20] || '-' || h[21:32] || '>' "
        f"FROM (SELECT md5({v}) AS h))"
    )
    return f"""
WITH pages_read AS (
  SELECT page_id, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS target, coalesce(url, '') AS raw,
         coalesce(html, '') AS payload, '2024-01-01T00:00:00Z' AS captured, 'sha256:' || sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
captures AS (
  SELECT *, {urn("'response|' || raw || '|' || captured || '|' || payload_digest")} AS refers_to,
         list_transform({links}, lambda x: {one_line(_duck_unescaped('x'))}) AS links
  FROM pages_read),
made AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS type,
         'title: ' || {one_line(_duck_unescaped(title))} || {eol}
         || 'language: ' || regexp_extract(payload, '(?is)<html\\b[^>]*?\\blang\\s*=\\s*["'']?([A-Za-z-]+)', 1) || {eol}
         || 'source-payload-digest: ' || payload_digest || {eol}
         || 'source-header: HTTP/1.1 200 OK' || {eol} || 'source-header: Content-Type: text/html; charset=utf-8' || {eol}
         || 'source-header: Content-Length: ' || strlen(payload) || {eol}
         || coalesce(list_aggregate(list_transform(links, lambda x: 'outlink: ' || x || {eol}), 'string_agg', ''), '') AS content
  FROM captures
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', {text} FROM captures),
named AS (
  SELECT *, 'sha256:' || sha256(content) AS block_digest, strlen(content) AS size FROM made),
numbered AS (
  SELECT *, {urn("record_type || '|' || refers_to || '|' || block_digest")} AS record_id FROM named)
SELECT page_id, record_type, record_id, refers_to, block_digest, size AS n_bytes, payload_digest AS source_payload_digest,
       len(links)::BIGINT AS n_links,
       sha256(array_to_string(['WARC/1.1', 'WARC-Type: ' || record_type, 'WARC-Record-ID: ' || record_id, 'WARC-Date: ' || captured,
              'WARC-Target-URI: ' || target, 'WARC-Refers-To: ' || refers_to, 'WARC-Refers-To-Target-URI: ' || target,
              'WARC-Refers-To-Date: ' || captured, 'WARC-Block-Digest: ' || block_digest, 'Content-Type: ' || type,
              'Content-Length: ' || size, ''], {eol}) || {eol} || content) AS record_sha256
FROM numbered
"""


LLM_ORACLES["op4_warc_derivatives"] = _warc_oracle()


@_query
def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document; the target is what labels call good."""
    good = _table(spark, folder, "labels").where("quality = 1").select("doc_id")
    scored = lm_score.score(_table(spark, folder, "documents").select("doc_id", "text"), good)
    return scored.select("row.doc_id", "n_tokens", "loss_target", "loss_all", "score")


@_query
def op7_bit_sliced_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    vectors = _table(spark, folder, "embeddings")
    found = bitslice.search(vectors, vectors.where("vec_id % 50 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


LLM_ORACLES["op7_bit_sliced_topk"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_query
def op8_epsilon_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    found = epsilon.near_duplicates(_table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


LLM_ORACLES["op8_epsilon_grid"] = """
WITH RECURSIVE
sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION
  SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.other),
roots AS (SELECT vec_id, min(other) AS root FROM reached GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN degrees USING (vec_id) LEFT JOIN roots USING (vec_id)
"""


@_query
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank in the draw of every document, towards the benchmark's texts."""
    weighed = resampling.weigh(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    return resampling.draw(weighed).select("row.doc_id", "n_features", "weight", "score", "rank")


# CRC-32 of every distinct word, byte by byte, over the table of its 256 one-byte remainders.
LLM_ORACLES["op11_importance_resampling"] = r"""
WITH RECURSIVE
remainders AS (
  SELECT list(r ORDER BY b) AS table_of FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END) AS r
    FROM range(256) AS bytes(b)) t),
listed AS (
  SELECT 'd' AS kind, row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words
  FROM documents
  UNION ALL
  SELECT 't', 0, NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')
  FROM benchmark),
used AS (SELECT kind, place, word, count(*) AS n FROM (SELECT kind, place, unnest(words) AS word FROM listed) u GROUP BY ALL),
codes AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(word)), lambda i:
             ('0x' || substr(hex(encode(word)), 2 * i::INTEGER + 1, 2))::BIGINT)),
           lambda c, b: xor(c // 256, table_of[(xor(c % 256, b) + 1)::INTEGER]))) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM used) w, remainders),
spread AS (SELECT kind, place, bucket, sum(n) AS n FROM used JOIN codes USING (word) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 't'), 0)::DOUBLE AS t
  FROM (SELECT * FROM spread UNION ALL SELECT 'none', 0, unnest(range(10000)), 0) e GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain
  FROM sums),
weights AS (SELECT place, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM spread JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY place),
scored AS (
  SELECT doc_id, place, coalesce(n_features, 0) AS n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
         floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM (SELECT * FROM listed WHERE kind = 'd') l LEFT JOIN weights USING (place)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS rank,
         (10 * count(*) FILTER (n_features >= 20) OVER ()) // 100 AS wanted
  FROM scored)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN n_features >= 20 AND rank <= wanted THEN rank END AS rank FROM ranked
"""


@_query
def op12_page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = pagetext.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("bigint").alias("n_chars"))


# For pages like those of the table: one article each, whose blocks are paragraphs and headings.
LLM_ORACLES["op12_page_text"] = r"""
WITH articles AS (
  SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '</?(?:p|h1)>') AS blocks
  FROM pages),
shown AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda x:
    trim(regexp_replace(regexp_replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))),
    lambda x: x <> ''), chr(10)) AS text
  FROM articles)
SELECT page_id, url, text, length(text) AS n_chars FROM shown
"""


@_query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector; every seventh vector has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mine(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label=label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


LLM_ORACLES["op13_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM pairs WHERE alike),
windows AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.alike
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
  WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 3
"""


@_query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Language ID, near-dedup, substring dedup, mixing and encoding, one after the other."""
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
