"""Thin queries over the provided tables, one per operator, with DuckDB SQL
where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.store import ship_code

REGISTRY: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op6_token_counts")
def op6_token_counts(spark, d):
    from lakeloom.llm.token_count import count_tokens
    return count_tokens(table(spark, d, "documents"), "byte_bpe_50k.json", limit=1024)


# The rules of the page filter (host, path, verdict).
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@register("op7_url_filter", """
WITH rules(h, p, v) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + """),
parts AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
fits AS (SELECT page_id, host, path, h || p AS rule, v, row_number() OVER (PARTITION BY page_id, host, path
             ORDER BY length(h) + length(p) DESC, length(h) DESC, v DESC) AS k
         FROM (SELECT DISTINCT page_id, host, path FROM parts) u JOIN rules
           ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.v, 'allow') AS verdict
FROM parts p LEFT JOIN (SELECT * FROM fits WHERE k = 1) f
  ON p.page_id IS NOT DISTINCT FROM f.page_id AND p.host = f.host AND p.path = f.path""")
def op7_url_filter(spark, d):
    from lakeloom.llm.url_filter import judge_urls
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, d, "pages"), rules)


@register("op8_bpe_codec")
def op8_bpe_codec(spark, d):
    from lakeloom.llm.bpe_codec import encode_documents
    return encode_documents(table(spark, d, "documents"), "word_bpe_49k.json", digests=True)


#: DuckDB: the lower-cased words of a text (1-based list), as ``decontaminate`` and ``bagminhash`` read them.
SQL_WORDS = (r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')""")


@register("op5_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS} AS w FROM documents),
item AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
run AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s
              FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT r, run.n, s, item_id FROM run JOIN win USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""")
def op5_decontamination(spark, d):
    from lakeloom.llm.decontaminate import contamination
    found, _ = contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.selectExpr("id AS doc_id", "n_words", "n_hit", "n_items",
                            "sha2(array_join(items, ','), 256) AS items_sha256", "n_hit > 0 AS contaminated")


@register("op3_maxscore", """
WITH v AS (SELECT vec_id, row_number() OVER () AS r, [floor(64 * x::DOUBLE) for x in embedding] AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding
                 if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.r <> b.r)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score FROM s QUALIFY rank <= 20""")
def op3_maxscore(spark, d):
    from pyspark.sql import functions as F

    from lakeloom.llm.maxscore import integer_vectors, top_k
    vectors = integer_vectors(table(spark, d, "embeddings"), "vec_id", "embedding", 64)
    return top_k(vectors, F.col("id") % 20 == 0, 20)


def quality_training(docs, labels):
    """Labels of the documents that may teach: crc32 of the id, mod 4, is not 2."""
    from pyspark.sql import functions as F
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return labels.where(~held).select("doc_id", "quality")


@register("op2_quality")
def op2_quality(spark, d):
    from pyspark.sql import functions as F

    from lakeloom.llm.quality import learn, score_documents
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    scored = score_documents(docs, learn(docs, quality_training(docs, labels)))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op9_bagminhash", f"""
WITH RECURSIVE d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
node AS (SELECT k, w, id, greatest(1, len(w) - 4) AS size
         FROM (SELECT array_to_string(w, ' ') AS k, w, min(doc_id) AS id FROM d WHERE len(w) > 0 GROUP BY ALL)),
shingle AS (SELECT k, size, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT k, size, w, unnest(range(1, size + 1)) AS i FROM node)),
element AS (SELECT k, size, s, unnest(range(n)) AS nth
            FROM (SELECT k, size, s, count(*) AS n FROM shingle GROUP BY ALL)),
same AS (SELECT a.k AS a, b.k AS b, count(*) AS same, a.size + b.size AS total
         FROM element a JOIN element b ON a.s = b.s AND a.nth = b.nth AND a.k < b.k
              AND a.size >= 0.8 * b.size - 1e-6 AND b.size >= 0.8 * a.size - 1e-6
         GROUP BY a.k, b.k, a.size, b.size),
link AS (SELECT a, b FROM same WHERE same::DOUBLE / (total - same) >= 0.8),
ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT k, k AS other FROM node UNION SELECT reach.k, ways.b FROM reach JOIN ways ON ways.a = reach.other),
class AS (SELECT reach.k, min(id) AS class_id FROM reach JOIN node ON node.k = reach.other GROUP BY reach.k)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id
FROM d LEFT JOIN class ON class.k = array_to_string(w, ' ') AND len(w) > 0""")
def op9_bagminhash(spark, d):
    from lakeloom.llm.bagminhash import near_classes
    return near_classes(table(spark, d, "documents"))


@register("op1_context_tree")
def op1_context_tree(spark, d):
    from pyspark.sql import functions as F

    from lakeloom.llm.ctw import score_documents
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return score_documents(table(spark, d, "documents"), held)


@register("op4_pii")
def op4_pii(spark, d):
    from pyspark.sql import functions as F

    from lakeloom.llm.pii import KINDS, find_pii, listed
    found = find_pii(table(spark, d, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.expr(f"sha2({listed('base')}, 256)").alias("base_sha256"),
                        F.expr(listed("concat(base, added)")).alias("spans"))


# The rules of the one tool of plain conversations (tool, arg,
# type, required, least, most, enum).
CHAT_TOOLS = (("answer", "kind", "string", True, None, None, ['"question"', '"statement"']),
              ("answer", "shape", "object", True, None, None, None),
              ("answer", "shape.chars", "integer", True, 1.0, 2000.0, None),
              ("answer", "shape.lines", "integer", True, 1.0, 12.0, None),
              ("answer", "sizes", "array", True, 1.0, 12.0, None), ("answer", "sizes[]", "integer", False, 1.0, 400.0, None),
              ("answer", "text", "string", True, 1.0, None, None))


def chat_messages(conversations):
    """Plain conversations as tool messages: a user's turn calls ``answer`` (it
    follows the call two turns before; turns 4 and 6 also the one four turns
    before, a diamond), an assistant's turn is the result of the call one turn
    before; other roles hold neither."""
    from pyspark.sql import functions as F
    message = F.expr("""CASE
        WHEN role = 'user' THEN to_json(struct(array(struct(concat('c', turn) AS id, 'answer' AS name,
            CASE WHEN turn >= 2 THEN concat('c', turn - 2) END AS parent_id,
            CASE WHEN turn IN (4, 6) THEN array(concat('c', turn - 4)) END AS parent_ids,
            struct(CASE WHEN text LIKE '%?' THEN 'question' WHEN text LIKE '%.' THEN 'statement' ELSE 'fragment' END AS kind,
                   struct(length(text) AS chars, size(split(text, '\\n')) AS lines) AS shape,
                   transform(split(text, '\\n'), x -> length(x)) AS sizes, text) AS arguments)) AS tool_calls))
        WHEN role = 'assistant' THEN to_json(struct(concat('c', turn - 1) AS tool_call_id, text AS content)) END""")
    return conversations.select("conv_id", "turn", message.alias("message"))


@register("op10_tool_calls", """
WITH calls AS (SELECT conv_id, turn, min(text) AS text, count(*) AS n_calls FROM conversations
               WHERE role = 'user' AND turn IS NOT NULL AND conv_id IS NOT NULL GROUP BY ALL),
res AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results FROM conversations
        WHERE role = 'assistant' AND turn IS NOT NULL AND conv_id IS NOT NULL GROUP BY ALL),
runs AS (SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run,
                bool_or(turn = 0) OVER (PARTITION BY conv_id) AS has_0, bool_or(turn = 2) OVER (PARTITION BY conv_id) AS has_2,
                string_split(text, chr(10)) AS parts FROM calls),
places AS (SELECT *, row_number() OVER w - 1 AS place, min(turn) OVER w AS start FROM runs
           WINDOW w AS (PARTITION BY conv_id, turn % 2, run ORDER BY turn)),
deep AS (SELECT *, place + CASE WHEN start = 4 AND has_0 THEN 1 WHEN start = 6 AND has_2 THEN 1 + has_0::INT ELSE 0 END AS depth,
                (turn >= 2 AND place = 0) OR (turn = 4 AND NOT has_0) OR (turn = 6 AND NOT has_2) AS lost,
                length(text) AS chars, len(parts) AS lines, [length(x) for x in parts] AS sizes,
                CASE WHEN text LIKE '%?' THEN 'question' WHEN text LIKE '%.' THEN 'statement' ELSE 'fragment' END AS kind
         FROM places),
wrong AS (SELECT *, array_to_string(list_concat(list_sort([e for e in [
    CASE WHEN kind = 'fragment' THEN 'value of kind' END,
    CASE WHEN text IS NULL THEN 'missing shape.chars' WHEN chars < 1 OR chars > 2000 THEN 'range of shape.chars' END,
    CASE WHEN text IS NULL THEN 'missing shape.lines' WHEN lines < 1 OR lines > 12 THEN 'range of shape.lines' END,
    CASE WHEN text IS NULL THEN 'missing sizes' WHEN lines < 1 OR lines > 12 THEN 'range of sizes' END,
    CASE WHEN len([x for x in sizes if x < 1 OR x > 400]) > 0 THEN 'range of sizes[]' END,
    CASE WHEN text IS NULL THEN 'missing text' WHEN chars < 1 THEN 'range of text' END] if e IS NOT NULL]),
    CASE WHEN lost THEN ['unknown parent'] ELSE [] END), '; ') AS errors,
    CASE WHEN turn IN (4, 6) THEN '["c' || (turn - 4) || '","c' || (turn - 2) || '"]'
         WHEN turn >= 2 THEN '["c' || (turn - 2) || '"]' ELSE '[]' END AS parents FROM deep),
linked AS (SELECT coalesce(w.conv_id, r.conv_id) AS conv_id, coalesce(w.turn, r.turn) AS t, w.*  EXCLUDE (conv_id),
                  r.content, r.n_results, CASE WHEN r.turn IS NOT NULL THEN r.turn + 1 END AS result_turn,
                  CASE WHEN w.turn IS NULL THEN 'orphan_result' WHEN w.errors <> '' THEN 'invalid'
                       WHEN r.turn IS NULL THEN 'unanswered' ELSE 'ok' END AS status
           FROM wrong w FULL JOIN res r ON w.conv_id = r.conv_id AND w.turn = r.turn)
SELECT conv_id, 'c' || t AS call_id, turn, result_turn, depth, coalesce(n_calls, 0) AS n_calls,
       coalesce(n_results, 0) AS n_results, status, coalesce(errors, '') AS errors,
       '{"arguments":' || CASE WHEN turn IS NULL THEN 'null' WHEN text IS NULL THEN '{"kind":"fragment","shape":{}}' ELSE
           '{"kind":"' || kind || '","shape":{"chars":' || chars || ',"lines":' || lines || '},"sizes":' || to_json(sizes)
           || ',"text":' || to_json(text) || '}' END
       || ',"depth":' || coalesce(CAST(depth AS VARCHAR), 'null') || ',"id":"c' || t || '","name":'
       || CASE WHEN turn IS NULL THEN 'null' ELSE '"answer"' END || ',"parents":' || coalesce(parents, '[]') || ',"result":'
       || coalesce(to_json(content), 'null') || ',"status":"' || status || '"}' AS json
FROM linked""")
def op10_tool_calls(spark, d):
    from lakeloom.llm.tool_calls import link_tool_calls
    rules = spark.createDataFrame(list(CHAT_TOOLS), "tool string, arg string, type string, required boolean, "
                                                    "least double, most double, enum array<string>")
    return link_tool_calls(chat_messages(table(spark, d, "conversations")), rules)


@register("op11_vptree")
def op11_vptree(spark, d):
    from pyspark.sql import functions as F

    from lakeloom.llm.vptree import nearest, usable_vectors
    return nearest(usable_vectors(table(spark, d, "embeddings"), "vec_id", "embedding"), F.col("id") % 100 == 0, 10)


@register("op12_spelling")
def op12_spelling(spark, d):
    from lakeloom.llm.spelling import spelling_variants
    return spelling_variants(table(spark, d, "documents"))


@register("op13_resampling")
def op13_resampling(spark, d):
    from lakeloom.llm.resample import resample
    return resample(table(spark, d, "documents"), table(spark, d, "benchmark"))
