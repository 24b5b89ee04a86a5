"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (chat_bytes, dartminhash, decontaminate, exact_dedup, feast_whitening, ga_packing, ngram_jaccard, pii_crf,
               substring, taat_search, text_cnn, url_redirects, warc_index)
from .common import table


def op1_decontaminate(spark, sf_dir):
    """A row per document and test item of which it holds a copy."""
    return decontaminate.benchmark_copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_pii_crf(spark, sf_dir):
    return pii_crf.personal_data_digests(table(spark, sf_dir, "documents"))


def op4_url_redirects(spark, sf_dir):
    return url_redirects.redirect_verdicts(table(spark, sf_dir, "pages"), url_redirects.rules_table(spark))


def op5_ga_packing(spark, sf_dir):
    return ga_packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_warc_index(spark, sf_dir):
    return warc_index.warc_round_trip(table(spark, sf_dir, "pages"))


def op7_dartminhash(spark, sf_dir):
    """A row per document with its class, class size and whether it stays."""
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("tkey")


def op8_toxicity_cnn(spark, sf_dir):
    return text_cnn.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_bytes(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    return chat_bytes.chat_round_trip(turns.unionByName(extra))


def op10_substring(spark, sf_dir):
    return substring.substring_digests(table(spark, sf_dir, "documents"))


def op11_feast_whitening(spark, sf_dir):
    """A row per vector and leading component."""
    return feast_whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_ngram_jaccard(spark, sf_dir):
    """A row per document with its component."""
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op13_taat_search(spark, sf_dir):
    """The ten best documents of each test item."""
    return taat_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_exact_dedup, op3_pii_crf, op4_url_redirects, op5_ga_packing,
                                   op6_warc_index, op7_dartminhash, op8_toxicity_cnn, op9_chat_bytes, op10_substring,
                                   op11_feast_whitening, op12_ngram_jaccard, op13_taat_search, pipeline)}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

OP2 = f"""
WITH d AS (SELECT doc_id, {_NORM} AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

# Aliases are named by the pages' own canonical links and refresh targets; their nodes leave out scheme and fragment.
_HOST = "translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_REST = "regexp_extract({u}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"


def _node(u: str) -> str:
    host, rest = _HOST.format(u=u), _REST.format(u=u)
    return (f"CASE WHEN contains({u}, '://') THEN {host} || CASE WHEN {rest} = '' THEN '/' "
            f"WHEN starts_with({rest}, '?') THEN '/' || {rest} ELSE {rest} END END")


OP4 = f"""
WITH RECURSIVE p AS (
  SELECT page_id, coalesce({_HOST.format(u='url')}, '') AS host, coalesce({_PATH.format(u='url')}, '') AS path,
         {_node('url')} AS node, url, html FROM pages),
found AS (
  SELECT host, node, unnest([
    regexp_extract(list_filter(regexp_extract_all(html, '(?is)<link\\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\\brel\\s*=\\s*["'']?canonical\\b'))[1],
                   '(?is)\\bhref\\s*=\\s*["'']?([^"''>\\s]+)', 1),
    regexp_extract(html, '(?is)<meta\\b[^>]*?http-equiv\\s*=\\s*["'']?refresh[^>]*?url\\s*=\\s*["'']?([^"''>\\s]+)', 1)]) AS t
  FROM p WHERE node IS NOT NULL),
target AS (
  SELECT node AS a, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
                         WHEN starts_with(t, '/') THEN 'http://' || host || t END AS t FROM found),
e AS (SELECT DISTINCT a, {_node('t')} AS b FROM target WHERE t IS NOT NULL),
both_ways AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
rules(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
places AS (SELECT DISTINCT host, path FROM p UNION
           SELECT regexp_extract(b, '^[^/?#]*'), regexp_extract(b, '^[^/?#]*([^?#]*)', 1) FROM reach),
fit AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS ruled
  FROM places JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
spread AS (
  SELECT a AS node, max(CASE WHEN ruled = 'allow' THEN 1 ELSE 0 END) AS allowed
  FROM reach JOIN fit ON fit.host = regexp_extract(b, '^[^/?#]*') AND fit.path = regexp_extract(b, '^[^/?#]*([^?#]*)', 1) GROUP BY a)
SELECT p.page_id, p.host, p.path, fit.rule,
       coalesce(fit.ruled, CASE WHEN spread.allowed = 0 THEN 'block' ELSE 'allow' END) AS verdict, p.url
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path LEFT JOIN spread ON p.node = spread.node
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""

OP9 = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(regexp_replace(regexp_replace(replace(text, '\\', '\\\\'), '<(/?s>|</?SYS>>|\\|)', '\\\\l\\1', 'g'),
            '\\[(/?INST\\])', '\\\\b\\1', 'g'), '|>', '\\p>') AS shown,
         replace(regexp_replace(regexp_replace(replace(role, '\\', '\\\\'), '<(/?s>|</?SYS>>|\\|)', '\\\\l\\1', 'g'),
            '\\[(/?INST\\])', '\\\\b\\1', 'g'), '|>', '\\p>') AS shown_role
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(shown) + length(shown_role) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP10 = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w WHERE len(words) >= 13),
h AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS t FROM win),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS low FROM h) WHERE doc_id > low),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(i, i + 13)) AS k FROM m) GROUP BY doc_id),
parts AS (
  SELECT w.doc_id, words, coalesce(ks, []) AS ks FROM w LEFT JOIN gone USING (doc_id)),
runs AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before
           FROM (SELECT doc_id, unnest(ks) AS k FROM gone)) WHERE before IS NULL OR k > before + 1 GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(ks) AS n_removed,
       sha256(array_to_string([x FOR x, k IN words IF NOT list_contains(ks, k)], ' ')) AS kept_sha256,
       coalesce(runs.n, 0) AS n_repeats
FROM parts LEFT JOIN runs USING (doc_id)
"""

_FOLD = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({_FOLD.format(t="coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS grams FROM w),
g AS (SELECT r, len(grams) AS n, unnest(grams) AS gram FROM s),
both_ways AS (
  SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.gram = b.gram AND a.r <> b.r
  WHERE 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT r, r FROM s UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT s.doc_id, len(s.grams) AS n_shingles, min(o.doc_id) AS component_id
FROM s JOIN reach ON reach.a = s.r JOIN s o ON o.r = reach.b GROUP BY s.r, s.doc_id, s.grams
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLD.format(t="text")}, '{_TERM}') AS terms
           FROM documents WHERE text IS NOT NULL),
size AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM size),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM tf, totals GROUP BY term, docs),
q AS (SELECT i, item_id, term, count(*) AS times FROM (
        SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all({_FOLD.format(t="text")}, '{_TERM}')) AS term FROM benchmark)
      GROUP BY i, item_id, term),
scored AS (
  SELECT i, item_id, r, size.doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN weights USING (term) JOIN tf USING (term) JOIN size USING (r), totals GROUP BY i, item_id, r, size.doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

SQL = {"op12_ngram_jaccard": OP12, "op13_taat_search": OP13, "op2_exact_dedup": OP2, "op4_url_redirects": OP4, "op6_warc_index": OP6, "op9_chat_bytes": OP9, "op10_substring": OP10}
