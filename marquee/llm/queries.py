"""The registered queries of these operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import (
    backoff_lm, bloom_dedup, byte_bpe, decontaminate, hard_negatives, merkle, mixing, perspectives, pii_tagger,
    quality_cnn, simhash, token_planes, warc)
from marquee.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_planes.read_tokens(
        token_planes.write_tokens(docs, token_planes.shard_folder(spark), tokenizer_path()))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (simhash.near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "fingerprint", "component_id"))


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_cnn.fit(docs, table(spark, sf_dir, "labels"))
    return quality_cnn.add_score(docs, model).select(
        "doc_id", F.coalesce(quality_cnn.remainder("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality_cnn.KEEP_FROM).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.schedule(docs, mixing.tempered_weights(docs))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_windows(docs, table(spark, sf_dir, "benchmark"))
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def op7_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff_lm.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_shared", F.round("log_score", 4).alias("log_score"))


def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_tagger.find_personal_data(docs, pii_tagger.fit(docs))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.verify(table(spark, sf_dir, "documents"),
                         {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    made = byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_RANKS), public_tokenizers.PATTERN)
    return made.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_warc_derivatives, op2_token_planes, op3_simhash, op4_quality_cnn, op5_mixing, op6_decontaminate,
    op7_bloom_dedup, op8_backoff_lm, op9_perspectives, op10_personal_data, op11_merkle, op12_byte_bpe,
    op13_hard_negatives)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _pattern(pattern: str) -> str:
    """In quotes of SQL; its matcher never goes back, so it knows no possessive repeats."""
    return pattern.replace("*+", "*").replace("'", "''")


def _replaced(column: str, pattern: str, by: str) -> str:
    return f"regexp_replace({column}, '{_pattern(pattern)}', {by}, 'g')"


def _characters(column: str) -> str:
    """Named characters only; the pages have no numbered ones."""
    for name, char in warc.NAMED.items():
        column = f"replace({column}, '&{name};', '{char.replace("'", "''")}')"
    return column


def _blanks(column: str) -> str:
    column = _replaced(column, r"[\x20\t\r\f\x0B\x{A0}]{2,}|[\t\r\f\x0B\x{A0}]", "' '")
    return f"trim({_replaced(column, r' ?\n[ \n]*', 'chr(10)')}, ' ' || chr(10))"


def _plain_text(column: str) -> str:
    column = _replaced(_replaced(column, warc.DROPPED, "' '"), warc.LINE_TAGS, "chr(10)")
    return _blanks(_characters(_replaced(column, warc.OTHER_TAGS, "''")))


def _record_id(*parts: str) -> str:
    h = f"md5(concat_ws(chr(10), {', '.join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)}))"
    return (f"'<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-3' || {h}[14:16] || '-8' || {h}[18:20] || '-' "
            f"|| {h}[21:32] || '>'")


_LINKED = _pattern(warc.LINK)

_WARC = rf"""
WITH fetched AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS body,
         'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: '
         || strlen(coalesce(html, '')) AS source_headers,
         'sha256:' || sha256(coalesce(html, '')) AS source_payload_digest,
         {_record_id("'response'", "page_id", "url", "coalesce(html, '')")} AS refers_to FROM pages),
parsed AS (
  SELECT *, {_plain_text("body")} AS plain,
         replace({_blanks(_characters(f"regexp_extract(body, '{_pattern(warc.TITLE)}', 1)"))}, chr(10), ' ') AS title,
         regexp_extract_all(body, '{_LINKED}', 1) AS found FROM fetched),
made AS (
  SELECT *, {_record_id("'metadata'", "refers_to", "target_uri", "source_payload_digest")} AS m_id,
         {_record_id("'conversion'", "refers_to", "target_uri", "source_payload_digest")} AS c_id,
         array_to_string(list_filter(['source-status: HTTP/1.1 200 OK', 'source-payload-digest: ' || source_payload_digest,
           'source-header: ' || replace(source_headers, chr(13) || chr(10), chr(13) || chr(10) || 'source-header: '),
           'title: ' || title,
           array_to_string(list_transform(list_filter(found, lambda x, i: list_position(found, x) = i),
                           lambda u: 'outlink: ' || {_characters("u")}), chr(13) || chr(10))],
           lambda f: f <> ''), chr(13) || chr(10)) || chr(13) || chr(10) AS fields FROM parsed),
records AS (
  SELECT m_id AS record_id, 'metadata' AS warc_type, refers_to, c_id AS concurrent_to, target_uri,
         'application/warc-fields' AS content_type, source_headers, source_payload_digest, fields AS block FROM made
  UNION ALL
  SELECT c_id, 'conversion', refers_to, m_id, target_uri, 'text/plain; charset=utf-8', source_headers,
         source_payload_digest, plain FROM made)
SELECT record_id, warc_type, refers_to, concurrent_to, target_uri, '2024-01-01T00:00:00Z' AS warc_date, content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest,
       'HTTP/1.1 200 OK' AS source_status, source_headers, source_payload_digest, block FROM records"""

# One row per slot: earliest deadline first among the released blocks of sources that have any left.
_MIXING = f"""
WITH RECURSIVE
sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
whole AS (
  SELECT source, (n + {mixing.BLOCK_DOCS} - 1) // {mixing.BLOCK_DOCS} AS blocks,
         -- The digits of the weight as it is written, to sixteen places.
         CAST(replace(CAST(CAST(CAST(sqrt(n) AS VARCHAR) AS DECIMAL(38, 16)) AS VARCHAR), '.', '') AS HUGEINT) AS weight
  FROM sizes),
lists AS (
  SELECT list(source ORDER BY source NULLS FIRST) AS sources, list(blocks ORDER BY source NULLS FIRST) AS blocks,
         list(weight ORDER BY source NULLS FIRST) AS w FROM whole),
slots AS (
  SELECT CAST(-1 AS BIGINT) AS slot, CAST(0 AS BIGINT) AS pick, CAST(0 AS BIGINT) AS released,
         CAST(0 AS BIGINT) AS due, blocks AS remaining, list_transform(blocks, lambda b: CAST(0 AS BIGINT)) AS taken,
         CAST(0 AS BIGINT) AS start, w FROM lists
  UNION ALL
  SELECT slot + 1, p, CAST(start + taken[p] * total // w[p] AS BIGINT),
         CAST(start + ((taken[p] + 1) * total + w[p] - 1) // w[p] AS BIGINT),
         list_transform(remaining, lambda b, i: b - CAST(i = p AS BIGINT)),
         CASE WHEN remaining[p] = 1 THEN list_transform(taken, lambda t: CAST(0 AS BIGINT))
              ELSE list_transform(taken, lambda t, i: t + CAST(i = p AS BIGINT)) END,
         CASE WHEN remaining[p] = 1 THEN slot + 2 ELSE start END, w
  FROM (
    SELECT *, CAST(list_min(list_transform(list_filter(range(1, len(w) + 1),
                lambda i: remaining[i] > 0 AND taken[i] * total // w[i] <= slot + 1 - start),
              lambda i: (((taken[i] + 1) * total + w[i] - 1) // w[i]) * 1000000 + i)) % 1000000 AS BIGINT) AS p
    FROM (SELECT *, CAST(list_sum(list_transform(w, lambda x, i: CASE WHEN remaining[i] > 0 THEN x ELSE 0 END))
                         AS HUGEINT) AS total FROM slots WHERE list_sum(remaining) > 0))),
placed AS (
  SELECT (SELECT sources FROM lists)[pick] AS source, slot, released, due,
         row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS block FROM slots WHERE slot >= 0),
numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place
  FROM documents)
SELECT n.doc_id, n.source, p.block, place % {mixing.BLOCK_DOCS} AS "offset", slot, released AS "release",
       due AS deadline
FROM numbered n JOIN placed p ON n.source IS NOT DISTINCT FROM p.source AND place // {mixing.BLOCK_DOCS} = p.block"""

_PERSPECTIVES = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, replace(coalesce("text", ''), '<|', '< |') AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'),
                            replace(coalesce("text", ''), '<|', '< |')) - 1 AS number FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
segments AS (
  SELECT t.conv_id, perspective, number // {perspectives.PART_TURNS} AS part, number, role = perspective AS spoken,
         '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
             ELSE 'user name=' || regexp_replace(role, '[^0-9A-Za-z_-]', '_', 'g') END || chr(10) AS head,
         said || '<|im_end|>' || chr(10) AS said
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
spans AS (
  SELECT *, sum(length(head) + length(said)) OVER (PARTITION BY conv_id, perspective, part ORDER BY number) AS ends
  FROM segments)
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(head || said, '' ORDER BY number) AS "text",
       coalesce(string_agg(CAST(ends - length(said) AS VARCHAR) || ':' || CAST(ends AS VARCHAR), ',' ORDER BY number)
                FILTER (WHERE spoken), '') AS mask
FROM spans GROUP BY conv_id, perspective, part"""

_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(chars: str) -> str:
    return f"sha256({' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', chars, '"text"'))})"


def _nodes(leaves: str) -> str:
    """Level by level: every two neighbours, or a last one alone, until one node is left."""
    return f"""SELECT tree, 0 AS level, spot, hash, size FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, spot // 2, sha256(string_agg(hash, '' ORDER BY spot)), (any_value(size) + 1) // 2
  FROM {leaves}_nodes WHERE size > 1 GROUP BY tree, level, spot // 2"""


_MERKLE = f"""
WITH RECURSIVE
shifts AS (
  SELECT range AS n, range AS v, 0 AS k FROM range(256)
  UNION ALL
  SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM shifts WHERE k < 8),
crc AS (SELECT list(v ORDER BY n) AS t FROM shifts WHERE k = 8),
marked AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
                  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 7 = 0 AS tampered
  FROM documents, crc),
hashed AS (
  SELECT doc_id, {_leaf("n_chars")} AS hash,
         CASE WHEN tampered THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claimed,
         coalesce('=' || lang, '-') AS tree FROM marked),
leaves AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS spot,
         count(*) OVER (PARTITION BY tree) AS size FROM hashed),
leaves_nodes AS ({_nodes("leaves")}),
subroots AS (
  SELECT '' AS tree, tree AS own, level AS height, hash, row_number() OVER (ORDER BY tree) - 1 AS spot,
         count(*) OVER () AS size FROM leaves_nodes WHERE size = 1),
subroots_nodes AS ({_nodes("subroots")}),
nodes AS (SELECT * FROM leaves_nodes UNION ALL SELECT * FROM subroots_nodes),
levels AS (
  SELECT id, level AS step, l.tree, level, (l.spot >> level) AS spot
  FROM leaves l JOIN subroots s ON l.tree = s.own, LATERAL (SELECT unnest(range(height)) AS level)
  UNION ALL
  SELECT id, height + level, '', level, (s.spot >> level)
  FROM leaves l JOIN subroots s ON l.tree = s.own,
       LATERAL (SELECT unnest(range((SELECT max(level) FROM subroots_nodes))) AS level)),
siblings AS (
  SELECT id, step, coalesce(hash, '') AS hash, v.spot & 1 = 1 AS on_left
  FROM levels v LEFT JOIN nodes n ON v.tree = n.tree AND v.level = n.level AND xor(v.spot, 1) = n.spot),
folds AS (
  SELECT id, CAST(0 AS BIGINT) AS step, claimed AS hash FROM leaves
  UNION ALL
  SELECT id, f.step + 1, sha256(CASE WHEN on_left THEN s.hash || f.hash ELSE f.hash || s.hash END)
  FROM folds f JOIN siblings s USING (id, step)),
tops AS (SELECT id, max(step) AS step, max_by(hash, step) AS folded_root FROM folds GROUP BY id),
proofs AS (SELECT id, sha256(string_agg(hash, '' ORDER BY step)) AS proof_sha256 FROM siblings GROUP BY id)
SELECT doc_id, l.hash AS leaf, s.hash AS subroot, r.hash AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.hash AS verified
FROM leaves l JOIN subroots s ON l.tree = s.own JOIN tops USING (id) LEFT JOIN proofs USING (id),
     (SELECT hash FROM subroots_nodes WHERE size = 1) r"""

_HARD_NEGATIVES = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS row
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id, b.row, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM given a JOIN given b ON a.row <> b.row WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, vec_id AS positive_id, score AS positive_score, row AS positive FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id, row) AS INT) AS rank
  FROM positives JOIN scored USING (anchor)
  WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10"""

ORACLES: dict[str, str] = {
    "op11_merkle": _MERKLE,
    "op13_hard_negatives": _HARD_NEGATIVES,
    "op1_warc_derivatives": _WARC,
    "op5_mixing": _MIXING,
    "op9_perspectives": _PERSPECTIVES,
    "op6_decontaminate": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce("text", ''), '{_UPPER}', '{_LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
at_all AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, n FROM at_all JOIN windows USING (n, phrase)),
hit_words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    # Every n-gram is in the tables, so the rule's first case always holds.
    "op8_backoff_lm": rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, len(w) AS size, w
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), '{_UPPER}', '{_LOWER}'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents)),
tokens AS (SELECT row, size, w, unnest(range(1, size + 1)) AS i FROM d),
grams AS (
  SELECT row, size, i, n, array_to_string(w[i - n + 1:i], ' ') AS phrase
  FROM tokens, (SELECT unnest(range(1, {backoff_lm.ORDER} + 1)) AS n) WHERE i >= n),
tables AS (SELECT n, phrase, count(*) AS c FROM grams GROUP BY n, phrase),
longest AS (
  SELECT row, i, n, phrase, array_to_string(w[i - n + 1:i - 1], ' ') AS context
  FROM (SELECT row, w, i, least(i, {backoff_lm.ORDER}) AS n FROM tokens)
       , LATERAL (SELECT array_to_string(w[i - n + 1:i], ' ') AS phrase)),
scored AS (
  SELECT row, sum(ln(t.c / coalesce(b.c, (SELECT count(*) FROM tokens)))) AS log_score
  FROM longest l JOIN tables t ON l.n = t.n AND l.phrase = t.phrase
  LEFT JOIN tables b ON l.n > 1 AND l.n - 1 = b.n AND l.context = b.phrase GROUP BY row),
elsewhere AS (
  SELECT row, CAST(sum(own) AS BIGINT) AS n_shared
  FROM (SELECT row, n, phrase, count(*) AS own FROM grams WHERE n = least(size, {backoff_lm.ORDER}) GROUP BY row, n, phrase)
       JOIN tables USING (n, phrase) WHERE c > own GROUP BY row)
SELECT doc_id, CAST(size AS BIGINT) AS n_words, coalesce(n_shared, 0) AS n_shared,
       round(coalesce(log_score, 0), 4) AS log_score
FROM d LEFT JOIN scored USING (row) LEFT JOIN elsewhere USING (row)""",
    "op7_bloom_dedup": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce("text", ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM t WINDOW same AS (PARTITION BY text_sha256)""",
}
