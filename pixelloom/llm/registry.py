"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.llm import language_id
from pixelloom.llm.collocations import collocations
from pixelloom.llm.common import scratch_path
from pixelloom.llm.decontaminate import decontaminate
from pixelloom.llm.mixing import schedule
from pixelloom.llm.permutation_index import nearest_neighbours
from pixelloom.llm.simhash import near_duplicate_classes
from pixelloom.llm.suffix_array import repeated_passages
from pixelloom.llm.token_counts import token_counts
from pixelloom.llm.token_shards import write_shards
from pixelloom.llm.toxicity import learn, sample_labelled, score_texts
from pixelloom.llm.url_filter import judge_urls
from pixelloom.llm.warc import read_archives, write_archives
from pixelloom.llm.whitening import whiten

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), min_words=50)


#: Labelled rows at most that the toxicity grammar is fitted on.
MAX_LABELLED = 12_000


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    grammar = learn(sample_labelled(docs, labels.where(fold != 1), MAX_LABELLED))
    return score_texts(docs, grammar).select("doc_id", (fold == 1).alias("held_out"), "score", "predicted")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(table(spark, sf_dir, "documents").select("doc_id", "source"), block_rows=64, temperature=0.5)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_shards(table(spark, sf_dir, "documents"), scratch_path(spark, "shards"))
    return written.select("slot", "shard", "offset", "n_tokens", "sha256")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (declared tag: lang, host: source) and pages (declared: the markup's language, host and suffix: those of the URL) in one call."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    none = F.lit(None).cast("long")
    one = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), none.alias("page_id")).alias("id"), "text", F.col("lang").alias("tag"), F.col("source").alias("at"))
    of_page = F.struct(none.alias("doc_id"), F.col("page_id").cast("long").alias("page_id")).alias("id")
    two = pages.select(of_page, language_id.markup_text(F.col("html")).alias("text"), language_id.markup_language(F.col("html")).alias("tag"), language_id.url_host(F.col("url")).alias("at"))
    found = language_id.identify(one.unionByName(two), language_id.learn(docs), declared=F.col("tag"), host=F.col("at"), id_col="id")
    return found.select("doc_id.doc_id", "doc_id.page_id", *found.columns[1:])


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = read_archives(spark, path)
    whole = F.col("warc_type") == "response"
    return records.select(
        "page_id", F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"), F.col("warc_type").alias("record_type"), "refers_to",
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), k=32)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), min_count=10, words=3, top=2000, share=50)


ORACLE = {
    "op10_warc": """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM p LEFT JOIN f USING (payload_digest)
""",
    "op13_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS gram, count(*) AS a FROM i, (VALUES (1), (2), (3)) v(m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, gram, a, string_split(gram, ' ') AS w FROM f WHERE m > 1 AND a >= 10),
longer AS (SELECT lang, array_to_string(w[k:k + 1], ' ') AS gram, max(a) AS most FROM c, (VALUES (1), (2)) v(k) WHERE m = 3 GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, gram) WHERE most IS NULL OR 100 * most < 50 * a),
cut AS (SELECT kept.lang, kept.gram, kept.a, k, l.a AS l, r.a AS r, CAST(1000000::HUGEINT * kept.a * kept.a // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM kept JOIN (VALUES (1), (2)) v(k) ON k < m JOIN f l ON l.lang = kept.lang AND l.gram = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = kept.lang AND r.gram = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1)
SELECT lang, CAST(row_number() OVER o AS INTEGER) AS rank, gram AS phrase, a, l, r, n, score FROM best JOIN n USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, gram) QUALIFY row_number() OVER o <= 2000
""",
    "op5_decontaminate": r"""
WITH d AS (SELECT doc_id, xxhash AS h, w FROM (SELECT doc_id, hash(text) AS xxhash,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT pos.doc_id, pos.i, pos.n, win.item_id FROM pos JOIN win ON pos.s = win.s AND pos.n = win.n),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS sha FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(cov.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
  coalesce(its.sha, sha256('')) AS items_sha256, coalesce(cov.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op6_url_filter": r"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (SELECT page_id, arg_max(h || p, length(h) * 1000 + length(p)) AS rule, arg_max(verdict, length(h) * 1000 + length(p)) AS v
  FROM s JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM s LEFT JOIN m USING (page_id)
""",
}


def queries() -> dict:
    """Every query op<N>_<name> of this module, and the pipeline."""
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
