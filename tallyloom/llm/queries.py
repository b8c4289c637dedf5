"""The registered corpus queries, each over its whole tables, and their checking SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import alignment, line_dedup, near, order_fingerprint, packing, repeats, site_quality, token_files, toxicity, turns, url_rules, warc, winnowing
from tallyloom.sources import scratch_path, table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: The rules that the URL query applies.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_payloads(warc.read_archives(spark, path))


#: Fixed value: documents of this remainder are held out.
HELD_OUT = 2


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select("row.doc_id", "score", "predicted").withColumn("held_out", held_out)


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return url_rules.apply_rules(table(spark, sf_dir, "pages"), rules)


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), 4096)


def op6_order_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repeats.without_repeats(table(spark, sf_dir, "documents"), 100)
    return judged.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the host; documents of one language are a section of it, as ``/fr/`` is of a web site."""
    return site_quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_files.read_token_files(spark, path)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations, _ = turns.repair(turns.damaged(table(spark, sf_dir, "conversations")))
    return conversations


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    return judged.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = [public_tokenizers.path(name) for name in (BYTE_BPE, PIECE_BPE)]
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), *vocabularies)


QUERIES = {f.__name__: f for f in (op1_warc, op2_toxicity, op3_url_rules, op4_winnowing, op5_best_fit_packing, op6_order_fingerprints, op7_suffix_repeats, op8_near_duplicates, op9_site_quality, op10_token_files, op11_turn_repair, op12_line_dedup, op13_alignment)}
_RULE_ROWS = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)
ORACLES: dict[str, str] = {
    "op3_url_rules": f"""WITH rules(rule, verdict) AS (VALUES {_RULE_ROWS}), urls AS (
        SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
        fits AS (SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, verdict DESC, rule) AS place
        FROM urls, rules WHERE starts_with(path, substr(rule, strpos(rule, '/')))
        AND (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)""",
    "op4_winnowing": r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
        i AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
        iw AS (SELECT DISTINCT item_id, span, array_to_string(words[pos:pos + span - 1], ' ') AS window_text FROM (
            SELECT *, unnest(range(1, len(words) - span + 2)) AS pos FROM (SELECT *, least(len(words), 10) AS span FROM i WHERE len(words) > 0))),
        dw AS (SELECT doc_id, span, pos, array_to_string(words[pos:pos + span - 1], ' ') AS window_text FROM (
            SELECT *, unnest(range(1, len(words) - span + 2)) AS pos FROM d, (SELECT DISTINCT span FROM iw) WHERE len(words) >= span)),
        hits AS (SELECT * FROM dw WHERE window_text IN (SELECT window_text FROM iw)),
        covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + span)) FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
            SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits JOIN iw USING (window_text)) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0, false) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op12_line_dedup": r"""WITH lines AS (SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(own) AS line, unnest(range(len(own))) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS own FROM documents))),
        shared AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
        SELECT doc_id, count(*) AS n_lines, count(keeper) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL), '')) AS kept_sha256
        FROM (SELECT lines.*, CASE WHEN doc_id <> keeper THEN keeper END AS keeper FROM lines LEFT JOIN shared USING (key)) GROUP BY doc_id""",
}
