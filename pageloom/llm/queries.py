"""The ten queries opN_<name>, and SQL for those that SQL can express.

Each takes (spark, folder of tables).  Numbers fixed here are the production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, dart_minhash, decontaminate, html_text, language_id, metric_tree, sharding, substring_dedup, url_rules, weak_quality

#: The rules of the URL filter.
RULES = [url_rules.Rule("net", "/", "block"), url_rules.Rule("example.net", "/en/", "allow"), url_rules.Rule("example.com", "/de/", "block"), url_rules.Rule("org", "/fr/", "allow")]
SHARDS, SLOTS = [f"shard-{i:03d}" for i in range(64)], 8191
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, folder, "documents"), keep=["doc_id"])
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    n_hit = decontaminate.n_hit(F.col("hits"))
    return out.select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, folder, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ids = byte_bpe.encode(table(spark, folder, "documents"), byte_bpe.read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(byte_bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = metric_tree.quantised(table(spark, folder, "embeddings"), "vec_id", "embedding", 1024)
    return metric_tree.top_k(vectors.where("id % 100 = 0"), vectors, 10)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = weak_quality.score(docs, weak_quality.train(docs), keep=["doc_id"])
    return out.select("row.doc_id", "n_words", "posterior", "score", ((F.col("n_words") > 0) & (F.col("score") >= 0.5)).alias("keep"))


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    out = html_text.main_text(table(spark, folder, "pages"), keep=["page_id", "url"])
    return out.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    found = language_id.predict(docs, model, keep=["doc_id"])
    id_ = F.col("row.doc_id")
    return found.select(id_.alias("doc_id"), F.coalesce(F.pmod(F.crc32(id_.cast("string")), F.lit(5)) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, folder, "documents")).select(F.col("doc").alias("doc_id"), "class_id")


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id")
    return sharding.assign_shards(docs, ["doc_id"], SHARDS, SLOTS).select("doc_id", "slot", "shard")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_url_filter": op3_url_filter,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_top_k": op5_top_k,
    "op6_quality": op6_quality,
    "op7_main_text": op7_main_text,
    "op8_language_id": op8_language_id,
    "op9_near_dedup": op9_near_dedup,
    "op10_sharding": op10_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
lead AS (SELECT s, min(CAST(doc_id AS HUGEINT) * 1000000000 + i) AS f FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM win JOIN lead USING (s) WHERE CAST(doc_id AS HUGEINT) * 1000000000 + i > f),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
""",
    "op2_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
target AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM target),
win AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, size)),
found AS (SELECT doc_id, n, i, item_id FROM win JOIN target USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS t FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
""",
    # The pages hold no canonical links or redirects; edges between different addresses are tested on fixtures.
    "op3_url_filter": r"""
WITH cut AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (SELECT p.*, r.rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC) AS k
  FROM part p LEFT JOIN (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'), ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')) r(h, p, rule, verdict)
  ON (p.host = r.h OR p.host LIKE '%.' || r.h) AND starts_with(p.path, r.p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE k = 1
""",
    "op5_top_k": r"""
WITH x AS (SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.no, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM x q JOIN x c ON q.no <> c.no AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
""",
    "op9_near_dedup": r"""
WITH RECURSIVE f AS (SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT doc_id, CASE WHEN len(w) > 0 THEN w ELSE regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') END AS w FROM f),
sh AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s, count(*) AS n FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0) GROUP BY ALL),
total AS (SELECT doc_id, sum(n) AS t FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN total x ON x.doc_id = a JOIN total y ON y.doc_id = b WHERE c / (x.t + y.t - c) >= 0.8),
pair AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM pair UNION SELECT r.a, e.b FROM reach r JOIN pair e ON r.b = e.a)
SELECT doc_id, least(doc_id, coalesce(min(b), doc_id)) AS class_id FROM documents LEFT JOIN reach ON a = doc_id GROUP BY doc_id
""",
    "op10_sharding": f"""
WITH place AS (SELECT [{", ".join(map(str, sharding.lookup_table(SHARDS, SLOTS)))}] AS owners),
slot AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(CAST(owners[slot + 1] AS VARCHAR), 3, '0') AS shard FROM slot, place
""",
}
