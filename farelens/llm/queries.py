"""Named queries of the corpus operators, and the SQL of those that SQL can express.

Each query applies its operator with production parameters to its whole
table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm import alignment, bwt_dedup, hnsw, langid, licences, merkle, minmax, mixing, packing, pii, sharding, spelling, url_filter
from farelens.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER_PATH = None  # None: the installed public tokenizer files


def tokenizer_path() -> str:
    return TOKENIZER_PATH or public_file(packing.TOKENIZER)


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.taken_words(mix).select("doc_id", "size", "source_size", "target", "taken", "blocks",
                                       "shard_blocks")


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs).select("doc_id", "text", "pii_found", "pii_masked")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict",
                                               "strict_hits", "soft_hits")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify_languages(docs).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), 24)


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = bwt_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), keep_text=False)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(read_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return alignment.align_documents(docs, public_file(alignment.BYTE_FILE), public_file(alignment.PIECE_FILE), whole=False)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(read_table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        *[F.concat_ws(",", c).alias(c) for c in ("base_labels", "labels")], "score",
                        F.size("spans").cast("long").alias("n_spans"))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_mix_sources, op2_pii_pseudonyms, op3_url_filter, op4_language_id, op5_embedding_near_dedup, op6_pack_tokens,
    op7_shuffle_shards, op8_repeated_passages, op9_document_fingerprints, op10_near_duplicates,
    op11_token_alignment, op12_spelling_variants, op13_license_scan)}


def _url_filter_sql() -> str:
    host_fits = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    longest_first = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {host_fits.format(h=h, p=p)} THEN '{h}{p}'" for _, h, p in longest_first)
    verdict = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in longest_first)

    def hits(terms):
        return " + ".join(f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INTEGER)" for t in terms)

    return f"""
WITH rest AS (SELECT page_id, lower(coalesce(url, '')) AS low,
                     CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r
              FROM pages),
parts AS (SELECT page_id, low,
                 translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT page_id, host, path, CASE {rule} END AS rule,
                 {hits(url_filter.STRICT_TERMS)} AS strict_hits, {hits(url_filter.SOFT_TERMS)} AS soft_hits FROM parts)
SELECT page_id, host, path, rule, strict_hits, soft_hits,
       CASE {verdict} WHEN strict_hits > 0 OR soft_hits >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


# Smallest node reachable over the links (a, b) from every row of ``nodes`` (node).
_REACHED = """
linked AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT node, node AS other FROM nodes
          UNION SELECT reach.node, linked.b FROM reach JOIN linked ON reach.other = linked.a),
components AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

_NEAR_VECTORS_SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id < b.vec_id
          WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
nodes AS (SELECT vec_id AS node FROM embeddings),{_REACHED}
SELECT node AS vec_id, (SELECT count(*) FROM linked WHERE linked.a = node) AS n_links, component_id,
       node = component_id AS kept
FROM components"""

_NEAR_DUPLICATES_SQL = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                             ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - {minmax.SHINGLE} + 1, 1) + 1),
                                  lambda i: array_to_string(w[i:i + {minmax.SHINGLE - 1}], ' ')))) END AS shingles FROM split),
keyed AS (SELECT doc_id, len(shingles) AS n, shingles, md5(array_to_string(shingles, chr(10))) AS class FROM sets),
classes AS (SELECT class, min(doc_id) AS rep, any_value(n) AS n, any_value(shingles) AS shingles FROM keyed WHERE n > 0 GROUP BY class),
cells AS (SELECT rep, n, unnest(shingles) AS shingle FROM classes),
shared AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS met
           FROM cells a JOIN cells b ON a.shingle = b.shingle AND a.rep < b.rep GROUP BY a.rep, b.rep),
links AS (SELECT a, b FROM shared WHERE 100 * met >= {minmax.PERCENT} * (n + m - met)),
nodes AS (SELECT rep AS node FROM classes),{_REACHED}
SELECT doc_id, keyed.n AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM keyed LEFT JOIN classes ON keyed.class = classes.class AND keyed.n > 0 LEFT JOIN components ON classes.rep = components.node"""

ORACLE_SQL: dict[str, str] = {
    "op3_url_filter": _url_filter_sql(), "op5_embedding_near_dedup": _NEAR_VECTORS_SQL,
    "op10_near_duplicates": _NEAR_DUPLICATES_SQL, "op12_spelling_variants": spelling.SQL}
