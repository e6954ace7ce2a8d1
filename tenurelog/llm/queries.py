"""One query per operator, over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_shards import byte_shards
from .chunked_bpe import bpe_round_trip
from .decontaminate import find_benchmark_windows
from .imatch import edited_fingerprints
from .interpolated_lm import score_texts
from .language import identify_language
from .line_dedup import remove_repeated_lines
from .merkle import fold_proof, leaf_digest, merkle_proofs, proof_text
from .packing import pack, token_pieces
from .quality import fit_quality, score_quality
from .url_reputation import REGISTRY_LABELS, TWO_LABEL_SUFFIXES, judge_urls, url_path
from .weighted_minhash import near_duplicates
from .whitening import fit_whitening, whiten

# The rules of the URL query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
KEEP = 0.3  # the score from which a document counts as good


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's url ends with the number of its document, whose labels are the outcome."""
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract(url_path(F.coalesce("url", F.lit(""))), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("number"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good")
    )
    labelled = pages.select("url", F.when(number != "", number).cast("long").alias("number"))
    return judge_urls(pages, labelled.join(labels, "number").select("url", "good"), RULES)


def op2_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "keeper")


def op3_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    found = identify_language(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 5) == 0
    net = fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out))
    return score_quality(docs, net).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted")
    )


def op5_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 10) == 0
    scored = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


def op8_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeated_lines(table(spark, sf_dir, "documents"))
    spans = F.transform("_removed", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return cleaned.select(
        "doc_id",
        "text",
        F.col("_n_lines").cast("long").alias("n_lines"),
        F.col("_n_removed").cast("long").alias("n_removed"),
        F.array_join(spans, ",").alias("removed"),
    )


END_ID = 2  # fixed value: what ends a document in a packed sequence


def op11_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(slim).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# The columns that make a document's leaf, in this order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tampered text loses its line feeds; its leaf, with the siblings of the true one, no longer folds to the root."""
    docs = table(spark, sf_dir, "documents")
    bare = F.when(F.col("text").contains("\n"), F.replace("text", F.lit("\n"), F.lit("")))
    tampered = F.when((fold("doc_id", 2) == 0) & bare.isNotNull(), leaf_digest(*[F.col(c) for c in LEAF[:-1]], bare))
    found = merkle_proofs(docs.withColumn("tampered", tampered), LEAF, "source", "doc_id", keep=["doc_id", "tampered"])
    folded = found.withColumn("folded_root", fold_proof(F.coalesce("tampered", "leaf"), "proof"))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof_text("proof"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = fit_whitening(rows)
    return whiten(rows, model).select(
        "vec_id",
        "component",
        F.lit(model.n if model else None).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        "explained",
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_url_reputation,
        op2_weighted_minhash,
        op3_byte_gru,
        op4_random_indexing,
        op5_chunked_bpe,
        op6_deleted_interpolation,
        op7_decontaminate,
        op8_byte_shards,
        op9_imatch,
        op10_line_dedup,
        op11_bin_completion,
        op12_merkle_manifest,
        op13_refined_whitening,
    )
}

# Strength of a level's prior: method of moments over its units with outcomes.
_STRENGTH = """(SELECT CASE WHEN count(*) = 0 OR sum(n) <= count(*) THEN 1.0 ELSE
  1.0 / least(0.99, greatest(0.001, (sum(n * (k / n - greatest(0.001, least(0.999, {m}))) ** 2
    / (greatest(0.001, least(0.999, {m})) * (1 - greatest(0.001, least(0.999, {m}))))) - count(*)) / (sum(n) - count(*)))) - 1 END
  FROM {units} WHERE n > 0)"""

_OP1 = r"""
WITH page AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM page
), named AS (
  SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name,
    try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})(?:\.html)?/?$', 1), '') AS BIGINT) AS doc_id FROM split
), trial AS (
  SELECT name, CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END AS good
  FROM named JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL
), tally AS (
  SELECT name, count(*)::DOUBLE AS n, sum(good)::DOUBLE AS k FROM trial GROUP BY name
), host AS (
  SELECT name, n, k, string_split(name, '.') AS part FROM (SELECT DISTINCT name FROM named) LEFT JOIN tally USING (name)
), placed AS (
  SELECT name, coalesce(n, 0) AS n, coalesce(k, 0) AS k, CASE WHEN long THEN array_to_string(part[-2:], '.') ELSE part[-1] END AS suffix,
    array_to_string(part[-least(CASE WHEN long THEN 3 ELSE 2 END, len(part)):], '.') AS domain
  FROM (SELECT *, len(part) > 1 AND (length(part[-1]) = 2 AND part[-2] IN ({registry}) OR array_to_string(part[-2:], '.') IN ({two})) AS long FROM host)
), suffix0 AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT CASE WHEN sum(n) > 0 THEN (sum(k) + 1) / (sum(n) + 2) ELSE 0.5 END FROM placed) AS m0
  FROM placed GROUP BY suffix
), suffix1 AS (
  SELECT suffix, (s * m0 + k) / (s + n) AS m1 FROM suffix0, (SELECT {s0} AS s)
), domain0 AS (
  SELECT domain, any_value(m1) AS m1, sum(n) AS n, sum(k) AS k FROM placed JOIN suffix1 USING (suffix) GROUP BY domain
), domain1 AS (
  SELECT domain, (s * m1 + k) / (s + n) AS m2 FROM domain0, (SELECT {s1} AS s)
), host0 AS (
  SELECT name, n, k, m2 FROM placed JOIN domain1 USING (domain)
), beta AS (
  SELECT name, n, s * m2 + k AS a, s * (1 - m2) + n - k AS b FROM host0, (SELECT {s2} AS s)
), posterior AS (
  SELECT name, n::BIGINT AS n_labelled, round(a / (a + b), 6) AS posterior_mean,
    round(a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 6) AS posterior_upper FROM beta
), rules(said, rule, rule_host, rule_path) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
    ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
), ruled AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(said, length(rule)) AS said
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN posterior_upper < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  n_labelled, posterior_mean, posterior_upper
FROM named LEFT JOIN ruled USING (page_id) LEFT JOIN posterior USING (name)
"""
_OP1 = _OP1.replace("{registry}", str(REGISTRY_LABELS)[1:-1]).replace("{two}", str(TWO_LABEL_SUFFIXES)[1:-1])
_OP1 = _OP1.replace("{s0}", _STRENGTH.format(m="m0", units="suffix0"))
_OP1 = _OP1.replace("{s1}", _STRENGTH.format(m="m1", units="domain0")).replace("{s2}", _STRENGTH.format(m="m2", units="host0"))

# A line starts behind all lines before it and their line feeds, a sentence behind those before it in its line.
_PLAIN = r"""trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\x0B\f\r]+', ' ', 'g'))"""
_OP10 = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS whole, generate_subscripts(string_split(text, chr(10)), 1) AS line
  FROM documents WHERE text IS NOT NULL
), placed AS (
  SELECT *, coalesce(sum(length(whole) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    CASE WHEN whole = '' THEN [''] ELSE regexp_extract_all(whole, '[^.!?。！？]+[.!?。！？]*|[.!?。！？]+') END AS part FROM line
), sentence AS (
  SELECT doc_id, line, start, whole, unnest(part) AS unit, generate_subscripts(part, 1) AS s FROM placed
), plain AS (
  SELECT *, {plain} AS plain,
    start + coalesce(sum(length(unit)) OVER (PARTITION BY doc_id, line ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM sentence
), counted AS (
  SELECT *, CASE WHEN plain = '' THEN 0 ELSE length(plain) - length(replace(plain, ' ', '')) + 1 END AS n,
    coalesce(lead(plain) OVER (PARTITION BY doc_id, line ORDER BY s), '') AS after FROM plain
), paired AS (
  SELECT *, n > 0 AND after <> '' AND (n < 8 OR length(after) - length(replace(after, ' ', '')) < 7) AS pair FROM counted
), ranked AS (
  SELECT *, n >= 8 AND row_number() OVER (PARTITION BY n >= 8, plain ORDER BY doc_id, line, s) > 1 AS long_again,
    pair AND row_number() OVER (PARTITION BY pair, plain, after ORDER BY doc_id, line, s) > 1 AS pair_again FROM paired
), judged AS (
  SELECT *, CASE WHEN n >= 8 THEN long_again
    ELSE n > 0 AND (pair_again OR coalesce(lag(pair_again) OVER (PARTITION BY doc_id, line ORDER BY s), FALSE)) END AS gone FROM ranked
), lines AS (
  SELECT doc_id, line, coalesce(bool_and(gone) FILTER (WHERE n > 0), FALSE) AS line_gone, any_value(start) AS start, any_value(length(whole)) AS size,
    string_agg(unit, '' ORDER BY s) FILTER (WHERE NOT gone) AS kept, count(*) FILTER (WHERE gone) AS n_gone,
    string_agg(begins || '-' || (begins + length(unit)), ',' ORDER BY s) FILTER (WHERE gone) AS spans
  FROM judged GROUP BY doc_id, line
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN line_gone THEN 1 ELSE n_gone END)::BIGINT AS n_removed,
    string_agg(kept, chr(10) ORDER BY line) FILTER (WHERE NOT line_gone) AS text,
    string_agg(CASE WHEN line_gone THEN start || '-' || (start + size) ELSE spans END, ',' ORDER BY line) FILTER (WHERE line_gone OR n_gone > 0) AS removed
  FROM lines GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(c.text, '') END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN cleaned c USING (doc_id)
""".replace("{plain}", _PLAIN)

_OP7 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), item_window AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS shown
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item WHERE len(w) > 0)
), doc_window AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS shown
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, item_id, p, n FROM doc_window JOIN item_window USING (n, shown)
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS word FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# The checksum CRC-32 of a number's digits, bit by bit: -1 stands for a shift by one bit.
_CRC = """xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: [ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END, 4294967295::BIGINT), 4294967295)"""

# Level 0 are the leaves; a source that is down to one node stops, and so does the tree over the sources.
_OP12 = r"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank,
    (octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id) || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents
), hashed AS (
  SELECT *, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(shown)) || ':' || shown, '-')) AS tampered
  FROM (SELECT *, CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown FROM leaf)
), node(level, source, rank, h, n) AS (
  SELECT 0, source, rank, leaf, count(*) OVER (PARTITION BY source) FROM hashed
  UNION ALL
  SELECT any_value(level) + 1, source, rank // 3, sha256(string_agg(h, '' ORDER BY rank)), any_value((n + 2) // 3)
  FROM node WHERE n > 1 GROUP BY source, rank // 3
), head AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM node WHERE n = 1
), over_node(level, rank, h, n) AS (
  SELECT 0, rank, subroot, n FROM head
  UNION ALL
  SELECT any_value(level) + 1, rank // 3, sha256(string_agg(h, '' ORDER BY rank)), any_value((n + 2) // 3) FROM over_node WHERE n > 1 GROUP BY rank // 3
), step AS (
  SELECT doc_id, level, string_agg(s.h, '' ORDER BY s.rank) FILTER (WHERE s.rank < spot) AS before, string_agg(s.h, '' ORDER BY s.rank) FILTER (WHERE s.rank > spot) AS after
  FROM (SELECT doc_id, l.source, level, l.rank // (3 ** level)::BIGINT AS spot FROM hashed l JOIN (SELECT DISTINCT source, level FROM node WHERE n > 1) v ON l.source IS NOT DISTINCT FROM v.source)
    p JOIN node s USING (level) WHERE s.source IS NOT DISTINCT FROM p.source AND s.rank // 3 = spot // 3 GROUP BY doc_id, level
), over_step AS (
  SELECT source, 100 + level AS level, string_agg(s.h, '' ORDER BY s.rank) FILTER (WHERE s.rank < spot) AS before, string_agg(s.h, '' ORDER BY s.rank) FILTER (WHERE s.rank > spot) AS after
  FROM (SELECT source, level, rank // (3 ** level)::BIGINT AS spot FROM head, (SELECT DISTINCT level FROM over_node WHERE n > 1))
    p JOIN over_node s USING (level) WHERE s.rank // 3 = spot // 3 GROUP BY source, level
), proof AS (
  SELECT doc_id, list({before: coalesce(before, ''), after: coalesce(after, '')} ORDER BY level) AS steps FROM (
    SELECT * FROM step UNION ALL SELECT doc_id, level, before, after FROM over_step o JOIN hashed l ON l.source IS NOT DISTINCT FROM o.source
  ) GROUP BY doc_id
), folded(doc_id, spot, h) AS (
  SELECT doc_id, 1, tampered FROM hashed
  UNION ALL
  SELECT doc_id, spot + 1, sha256(steps[spot].before || h || steps[spot].after) FROM folded JOIN proof USING (doc_id) WHERE spot <= len(steps)
), done AS (
  SELECT doc_id, max_by(h, spot) AS folded_root FROM folded GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda s: s.before || s.after), ''), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM hashed l JOIN head ON l.source IS NOT DISTINCT FROM head.source JOIN done USING (doc_id) LEFT JOIN proof USING (doc_id),
  (SELECT h AS root FROM over_node WHERE n = 1)
"""

_OP12 = _OP12.replace("{crc}", _CRC)

ORACLE = {"op1_url_reputation": _OP1, "op7_decontaminate": _OP7, "op10_line_dedup": _OP10, "op12_merkle_manifest": _OP12}
