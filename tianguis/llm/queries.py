"""The registered queries of this folder: thin callers of its operators with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules that op1 judges by.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls, block decisions handed on to aliases."""
    from .urls import judge

    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and what they decode to."""
    import public_tokenizers

    from .bpe import round_trip

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = _table(spark, sf_dir, "documents").select("doc_id", round_trip(F.col("text"), path, pattern).alias("x"))
    return docs.select(
        "doc_id",
        (F.octet_length("x.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("x.ids", 256).alias("ids_sha256"),
        F.sha2("x.decoded", 256).alias("decoded_sha256"),
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of vectors of one label at cosine 0.93 or more."""
    from .ivfpq import near_duplicate_vectors

    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products for every 20th vector."""
    from .ivfpq import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 bits or fewer."""
    from .simhash import simhash_groups

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs, width=4, radius=4).select("doc_id", "fingerprint", "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    import public_tokenizers

    from .packing import pack

    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"
    )


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets: three patterns and the battery's additions."""
    from .secrets import joined, scan_secrets

    found = scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    count = lambda k: F.size(F.filter("base", lambda s: s["ord"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "random"))).alias("spans"),
    )


def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, read back from the Huffman-coded files."""
    import public_tokenizers

    from .huffman import round_trip

    docs = round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted, expanded to one example a reply, and read back."""
    from .chat import expanded, format_conversations, masked, parse

    turns = _table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    formatted = format_conversations(turns.unionByName(extra))
    back = parse(F.col("formatted"))
    whole = formatted.select(
        "conv_id",
        F.size(back).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    each = expanded(formatted).select("conv_id", F.struct("example", masked(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("text")).alias("x"))
    loss = each.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["text"]), "").alias("loss"))
    joined = whole.join(loss.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").withColumn("loss", F.coalesce("loss", F.lit("")))
    return joined.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of subword embeddings learned from two thirds of the labelled ids."""
    from .quality import fit, learning_rows, score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(~learning_rows(docs), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 centroids of all vectors of 64 components, five rounds."""
    from .clusters import cluster

    return cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, salt="2")[0]


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all their orders, by source."""
    from .audit import audit_documents

    return audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the windows of 35 words that start anywhere else too."""
    from .spans import drop_repeated_spans

    out = drop_repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"), words=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_packing": op6_packing,
    "op7_secret_scans": op7_secret_scans,
    "op8_token_id_output": op8_token_id_output,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_filter_audit": op12_filter_audit,
    "op13_substring_dedup": op13_substring_dedup,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _sql_url(url: str) -> dict[str, str]:
    """SQL of host, path and alias key of a url expression."""
    rest = f"(CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END)"
    host = f"coalesce(translate(regexp_extract({rest}, '^[^/?#]*'), {_AZ}), '')"
    path = f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"
    return {"host": host, "path": path, "key": f"{host} || {path} || coalesce(regexp_extract({rest}, '^[^?#]*(\\?[^#]*)', 1), '')"}


def _op1_sql() -> str:
    url, target = _sql_url("url"), _sql_url("target")
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return rf"""
WITH RECURSIVE rules(r_host, r_path, r_verdict) AS (VALUES {rules}),
p AS (SELECT page_id, url, html, {url['host']} AS host, {url['path']} AS path, {url['key']} AS key FROM pages),
tags AS (SELECT key, url, host, path, unnest(list_concat(regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), regexp_extract_all(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'))) AS t FROM p WHERE host <> ''),
refs AS (SELECT *, trim(replace(coalesce(nullif(regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1), ''), regexp_extract(t, '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)), '&amp;', '&')) AS h, regexp_extract(url, '^[^:/?#]+') AS scheme, regexp_extract(path, '^(.*/)?') AS folder FROM tags),
targets AS (SELECT key AS a, CASE WHEN contains(h, '://') THEN h WHEN starts_with(h, '//') THEN scheme || ':' || h WHEN starts_with(h, '/') THEN scheme || '://' || host || h WHEN h <> '' THEN scheme || '://' || host || (CASE WHEN folder = '' THEN '/' ELSE folder END) || h END AS target FROM refs),
edges AS (SELECT a, {target['key']} AS b, {target['host']} AS host, {target['path']} AS path FROM targets WHERE target IS NOT NULL AND {target['host']} <> ''),
nodes AS (SELECT key, host, path FROM p WHERE host <> '' UNION SELECT b, host, path FROM edges),
fits AS (SELECT key, r_host || r_path AS rule, r_verdict, row_number() OVER (PARTITION BY key ORDER BY length(r_host || r_path) DESC, r_verdict, r_host || r_path) AS n FROM nodes JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)),
ruled AS (SELECT key, rule, r_verdict FROM fits WHERE n = 1),
reached(key) AS (SELECT key FROM ruled WHERE r_verdict = 'block' UNION SELECT CASE WHEN e.a = r.key THEN e.b ELSE e.a END FROM reached r JOIN edges e ON e.a = r.key OR e.b = r.key)
SELECT page_id, host, path, rule, coalesce(r_verdict, CASE WHEN p.host <> '' AND p.key IN (SELECT key FROM reached) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN ruled ON p.host <> '' AND ruled.key = p.key"""


_OP3_SQL = """
WITH RECURSIVE links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.93),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) ON x = vec_id"""

_OP9_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
m AS (SELECT *, length(text) + len(regexp_extract_all(text, '[\[<]\\*(/?INST\]|/?s>|</?SYS>>|/?ROLE\]|TEXT\])'))
  + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17 ELSE 23 + length(role) + len(regexp_extract_all(role, '[\[<]\\*(/?INST\]|/?s>|</?SYS>>|/?ROLE\]|TEXT\])')) END AS chars FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '') AS loss, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""


def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    """Every round as two tables: nearest centroids, and means."""
    nearest = lambda c: (
        f"SELECT id, k, s FROM (SELECT id, k, s, row_number() OVER (PARTITION BY id ORDER BY s, k) AS n FROM (SELECT e.id, c.k, sum((e.x - c.x) * (e.x - c.x)) AS s FROM e JOIN {c} c USING (d) GROUP BY 1, 2)) WHERE n = 1"
    )
    out = f"""WITH v AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), embedding) AS id, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF isfinite(x)]) = 64),
e AS (SELECT id, unnest(range(64)) AS d, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v),
c0 AS (SELECT id AS k, d, x FROM e WHERE id <= {k})"""
    for i in range(rounds):
        out += f""",
n{i} AS MATERIALIZED ({nearest(f"c{i}")}),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.d, coalesce(CAST((t - ((t % n) + n) % n) // n AS BIGINT), c.x) AS x FROM c{i} c
  LEFT JOIN (SELECT k, d, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM e JOIN n{i} USING (id) GROUP BY 1, 2) m ON m.k = c.k AND m.d = c.d)"""
    return out + f""",
f AS ({nearest(f"c{rounds}")}),
h AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY 1)
SELECT vec_id, CAST(f.k - 1 AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance, CAST(sum(s) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia, CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM f JOIN v USING (id) JOIN h ON h.k = f.k"""


_OP12_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
m AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM w),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS bad FROM labels GROUP BY 1),
j AS (SELECT part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails,
  coalesce(good, false) AS good, coalesce(bad, false) AS bad FROM m LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad FROM j GROUP BY 1, 2),
o(filter_order) AS (SELECT '' UNION ALL SELECT filter_order || f FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS t(f) WHERE NOT contains(filter_order, f)),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i] AS f, [strpos('ABCDE', x) FOR x IN string_split(left(filter_order, i - 1), '') IF x <> ''] AS before FROM o, range(1, 6) AS t(i) WHERE length(filter_order) = 5),
x AS (SELECT part, filter_order, step, f, n, good, bad, fails[strpos('ABCDE', f)] AS fail, len([b FOR b IN before IF fails[b]]) > 0 AS gone, len([v FOR v IN fails IF v]) AS n_fails FROM g, s),
r AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT fail AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN fail AND gone THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN fail AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN fail AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fail AND NOT gone THEN bad ELSE 0 END) AS toxic_lost FROM x GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""

_OP13_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT r, unnest(range(len(words))) AS i, unnest(words) AS word FROM t),
s AS (SELECT *, CASE WHEN count(*) OVER ahead = 35 THEN string_agg(word, ' ') OVER ahead END AS run FROM w WINDOW ahead AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
c AS (SELECT r, i, word, run IS NOT NULL AND count(*) OVER (PARTITION BY run) > 1 AS again FROM s),
k AS (SELECT r, i, word, coalesce(max(CASE WHEN again THEN i END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) >= 0, false) AS gone FROM c),
a AS (SELECT r, count(*) FILTER (WHERE gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM k GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM t LEFT JOIN a USING (r)"""

#: For the others SQL has no such function (fingerprints, tokenizers, files, models) or the result is a method's own
#: (approximate search, randomness tests); the tests compare those with brute force.
ORACLES: dict[str, str] = {"op1_url_filters": _op1_sql(), "op3_embedding_near_dedup": _OP3_SQL, "op9_chat_formatting": _OP9_SQL} | {
    "op11_centroid_clustering": _op11_sql(),
    "op12_filter_audit": _OP12_SQL,
    "op13_substring_dedup": _OP13_SQL,
}
