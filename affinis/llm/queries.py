"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from affinis.llm import ann, decontaminate, html_text, packing, secrets, sharding, simhash, token_count, toxicity, warc
from affinis.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of their links."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the benchmark."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th, against all."""
    return ann.search(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop("redacted")


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to a content-addressed archive and read back."""
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


def op10_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of nearly equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries by name."""
    return {f.__name__: f for f in (op1_best_fit_packing, op2_simhash_near_dedup, op3_toxicity, op4_html_extraction, op5_decontamination, op6_token_counts, op7_nearest_neighbours, op8_secret_scans, op9_warc_archive, op10_minimax_sharding)}


#: The archive's records: digests by SHA-1 of the bytes, base 32 from groups of 40 bits.
_OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
d AS (SELECT *, sha1(html) AS h FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || h[(i // 8) * 10 + 1:(i // 8) * 10 + 10])::BIGINT >> (35 - 5 * (i % 8))::BIGINT) & 31) + 1]), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM d"""


def _op5() -> str:
    """Windows of template words joined by their text; names need two passes, as this dialect cannot look behind."""
    name, number, unit = "chr(57345)", "chr(57346)", "chr(57347)"
    kept = "\\x{E001}-\\x{E003}"

    def spaced(x: str) -> str:
        return f"CASE WHEN regexp_matches({x}, '\\p{{N}}') THEN regexp_replace(regexp_replace({x}, '(\\p{{N}})[.,](\\p{{N}})', '\\1\\2', 'g'), '(\\p{{N}})(\\p{{L}})', '\\1 \\2', 'g') ELSE {x} END"

    def words(x: str, also: str = "") -> str:
        return f"list_filter(string_split(lower(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}{also}]+', ' ', 'g')), ' '), lambda w: w <> '')"

    def named(x: str) -> str:
        return f"regexp_replace({x}, '([\\p{{L}}\\p{{N}},;:\\x{{E001}}] )\\p{{Lu}}\\p{{Ll}}+', '\\1' || {name}, 'g')"

    template = f"regexp_replace(regexp_replace({named(named('s'))}, '(\\p{{N}} +)(?i:{decontaminate.UNITS})\\b', '\\1' || {unit}, 'g'), '\\p{{N}}+', {number}, 'g')"
    w, mark = decontaminate.WINDOW, f"'[{kept}]'"
    return f"""
WITH b AS (SELECT DISTINCT item_id, {words('s')} AS iw, {words(template, kept)} AS t FROM (SELECT item_id, {spaced("coalesce(text, '')")} AS s FROM benchmark)),
bw AS (SELECT item_id, i, t[i + 1:i + {w}] AS win FROM (SELECT item_id, t, unnest(range(len(t) - {w} + 1)) AS i FROM b)),
bk AS (SELECT DISTINCT item_id, i, array_to_string(win, ' ') AS k FROM bw WHERE len(list_filter(win, lambda x: NOT regexp_matches(x, {mark}))) >= {decontaminate.LITERALS}),
n AS (SELECT item_id, count(*) AS item_windows FROM bk GROUP BY 1),
d AS (SELECT doc_id, {words('s')} AS dw, {words(template, kept)} AS t FROM (SELECT doc_id, {spaced("coalesce(text, '')")} AS s FROM documents)),
dk AS (SELECT doc_id, i, array_to_string(t[i + 1:i + {w}], ' ') AS k FROM (SELECT doc_id, t, unnest(range(len(t) - {w} + 1)) AS i FROM d)),
h AS (SELECT doc_id, item_id, bk.i AS bi, min(dk.i) AS di FROM dk JOIN bk USING (k) GROUP BY ALL),
f AS (SELECT doc_id, item_id, count(*) AS matched_windows, item_windows FROM h JOIN n USING (item_id) GROUP BY doc_id, item_id, item_windows HAVING count(*) >= {decontaminate.COVERAGE} * item_windows),
sh AS (SELECT doc_id, item_id, di - bi AS shift FROM h GROUP BY doc_id, item_id, di - bi QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY count(*) DESC, di - bi) = 1),
sl AS (SELECT doc_id, item_id, f.matched_windows, f.item_windows, list_transform(list_filter(range(len(iw)), lambda p: regexp_matches(b.t[p + 1], {mark}) AND shift + p >= 0 AND b.t[p + 1] = coalesce(d.t[shift + p + 1], '')),
  lambda p: [iw[p + 1], dw[shift + p + 1]]) AS pairs FROM f JOIN sh USING (doc_id, item_id) JOIN b USING (item_id) JOIN d USING (doc_id))
SELECT doc_id, item_id, matched_windows, item_windows, matched_windows / item_windows AS coverage, len(pairs)::BIGINT AS n_slots, len(list_filter(pairs, lambda x: x[1] <> x[2])) > 0 AS reparameterised
FROM sl WHERE len(list_distinct(pairs)) = len(list_distinct(list_transform(pairs, lambda x: x[1])))"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express; the others are tested against brute force, a library or held-out labels."""
    return {"op5_decontamination": _op5(), "op9_warc_archive": _OP9}
