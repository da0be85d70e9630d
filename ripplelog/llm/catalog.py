"""Registered queries of the operators, each over its whole table, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog.llm import (
    centroids,
    chat,
    decontam,
    fingerprints,
    mixing,
    neardup,
    negatives,
    pii,
    records,
    repeats,
    secret_scan,
    toxicity,
    warc,
)
from ripplelog.llm.frames import count_words, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The public tokenizer that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, text))


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, folder, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda x: x["kind"] != "entropy")
    return found.select(
        F.col("id").alias("doc_id"),
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


OP2_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS key, source IS NULL AS no_source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS u
  FROM documents
), totals AS (
  SELECT no_source, key, sum(size)::BIGINT AS source_size FROM docs GROUP BY ALL
), weighted AS (
  SELECT *, row_number() OVER (ORDER BY no_source, key) - 1 AS place,
         (row_number() OVER (ORDER BY no_source, key) - 1) % 3 + 1 AS weight,
         3 * source_size AS cap
  FROM totals
), ranked AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS free,
         sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT free AS level_free, weights AS level_weights FROM ranked
  WHERE cap * weights > free * weight ORDER BY cap / weight, place LIMIT 1
), filled AS (
  SELECT no_source, key, source_size,
         CASE WHEN cap * weights <= free * weight THEN cap::DOUBLE
              ELSE (level_free * weight)::BIGINT / level_weights::BIGINT END AS target
  FROM ranked LEFT JOIN levels ON true
), ordered AS (
  SELECT doc_id, no_source, key, size,
         coalesce(sum(size) OVER (PARTITION BY no_source, key ORDER BY u, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM docs
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM ordered JOIN filled USING (no_source, key)
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, round(target)::BIGINT - whole * source_size - ahead)))::BIGINT AS taken
FROM shares
"""


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = fingerprints.compare_edits(table(spark, folder, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.toxic_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        toxicity.held_out("row.doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


#: What the tools of the derived calls take.
TOOLS = {
    "answer": {
        "prompt": {"type": "string", "required": True, "minLength": 1},
        "turn": {"type": "integer", "required": True, "minimum": 0},
        "words": {"type": "integer", "required": True, "maximum": 60},
    },
    "greet": {"prompt": {"type": "string", "required": True, "maxLength": 40}},
}


def tool_messages(turns: DataFrame) -> DataFrame:
    """Messages derived from conversations, which hold no tool calls of their own.

    A user's turn calls a tool, ``greet`` for up to three words and else ``answer``, after the user's
    turn before; an assistant's turn is the result of the call one turn earlier.
    """
    turn, words = F.col("turn"), count_words(F.col("text"))
    call, result = F.col("role") == "user", F.col("role") == "assistant"
    name = lambda back: F.concat_ws("-", F.col("conv_id").cast("string"), (turn - back).cast("string"))
    arguments = F.to_json(F.struct(words.alias("words"), turn.alias("turn"), F.col("text").alias("prompt")))
    return turns.select(
        F.col("conv_id").alias("conv"),
        turn.alias("turn"),
        F.when(call, "call").when(result, "result").otherwise(F.col("role")).alias("role"),
        F.when(call, name(0)).when(result, name(1)).alias("call_id"),
        F.when(call, F.when(words <= 3, "greet").otherwise("answer")).alias("tool"),
        F.when(call, arguments).alias("arguments"),
        F.when(call & (turn >= 2), name(2)).alias("after"),
        F.when(~F.coalesce(call, F.lit(False)), F.col("text")).alias("content"),
    )


def op5_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    linked = chat.link_tool_calls(tool_messages(table(spark, folder, "conversations")), TOOLS)
    return linked.withColumnRenamed("conv", "conv_id").withColumn("errors", F.concat_ws("; ", "errors"))


OP5_SQL = """
WITH RECURSIVE turns AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words FROM conversations
), calls AS (
  SELECT conv_id, turn, conv_id || '-' || turn AS call_id, text, words,
         CASE WHEN words <= 3 THEN 'greet' ELSE 'answer' END AS tool
  FROM turns WHERE role = 'user'
), results AS (
  SELECT conv_id, turn, conv_id || '-' || (turn - 1) AS call_id, text FROM turns WHERE role = 'assistant'
), chain AS (
  SELECT c.conv_id, c.turn, 0::BIGINT AS level FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, level + 1 FROM chain JOIN calls c ON c.conv_id = chain.conv_id AND c.turn = chain.turn + 2
)
SELECT c.conv_id, c.turn, level, c.call_id, CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       1::BIGINT AS copies,
       concat_ws('; ',
         CASE WHEN tool = 'answer' AND words > 60 THEN 'words: maximum' END,
         CASE WHEN tool = 'greet' AND length(c.text) > 40 THEN 'prompt: maxLength' END,
         CASE WHEN tool = 'greet' THEN 'turn: unknown; words: unknown' END,
         CASE WHEN c.turn >= 2 AND level = 0 THEN 'after: unknown' END) AS errors,
       CASE WHEN r.call_id IS NULL
         THEN json_object('arguments', json_object('prompt', c.text, 'turn', c.turn, 'words', words), 'call_id', c.call_id,
                          'role', 'call', 'tool', tool)
         ELSE json_object('arguments', json_object('prompt', c.text, 'turn', c.turn, 'words', words), 'call_id', c.call_id,
                          'result', r.text, 'role', 'call', 'tool', tool) END::VARCHAR AS json
FROM calls c JOIN chain USING (conv_id, turn) LEFT JOIN results r ON r.conv_id = c.conv_id AND r.call_id = c.call_id
UNION ALL
SELECT conv_id, turn, 0, call_id, 'orphan', 1, '', json_object('call_id', call_id, 'content', text, 'role', 'result')::VARCHAR
FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
UNION ALL
SELECT conv_id, turn, 0, NULL, 'message', 1, '', json_object('content', text, 'role', role)::VARCHAR
FROM turns WHERE role NOT IN ('user', 'assistant')
"""


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.find_test_text(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


OP6_SQL = """
WITH split AS (
  SELECT doc_id, rowid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents)
), tests AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark
), cuts AS (
  SELECT item, least(len(words), 10) AS n, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS j, words
  FROM tests WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(words[j:j + n - 1], ' ') AS part FROM cuts
), sizes AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT rowid, n, words, unnest(range(1, len(words) - n + 2)) AS p FROM split, sizes WHERE len(words) >= n
), found AS (
  SELECT rowid, item, p, n FROM (SELECT rowid, n, p, array_to_string(words[p:p + n - 1], ' ') AS part FROM places)
  JOIN windows USING (n, part)
), hit AS (
  SELECT rowid, count(DISTINCT w) AS n_hit
  FROM (SELECT rowid, unnest(range(p, p + n)) AS w FROM (SELECT DISTINCT rowid, p, n FROM found)) GROUP BY rowid
), named AS (
  SELECT rowid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rowid, item FROM found) GROUP BY rowid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit USING (rowid) LEFT JOIN named USING (rowid)
"""


def op7_token_records(spark: SparkSession, folder: str) -> DataFrame:
    tokens = records.token_table(table(spark, folder, "documents"), tokenizer_path())
    return tokens.withColumnRenamed("id", "doc_id")


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    groups = neardup.near_duplicates(table(spark, folder, "documents"))
    return groups.withColumnRenamed("id", "doc_id")


OP8_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 5, 0) + 2)) AS p FROM split WHERE len(words) > 0
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS gram FROM places
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y USING (gram)
  WHERE x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)
), ends AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, a AS other FROM ends UNION SELECT doc_id, b FROM reach JOIN ends ON a = other
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least_id, doc_id) AS component_id,
       doc_id = coalesce(least_id, doc_id) AS kept
FROM split LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.repeated_passages(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        F.col("other").alias("other_doc_id"),
    )


OP9_SQL = """
WITH split AS (
  SELECT DISTINCT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 50 + 2)) AS p FROM split WHERE len(words) >= 50
), passages AS (
  SELECT DISTINCT doc_id, p - 1 AS start, md5(array_to_string(words[p:p + 49], ' ')) AS passage FROM places
), ends AS (
  SELECT passage, min(doc_id) AS low, max(doc_id) AS high FROM passages GROUP BY passage
), shared AS (
  SELECT doc_id, start, min(CASE WHEN doc_id = low THEN high ELSE low END) AS other
  FROM passages JOIN ends USING (passage) WHERE low < high GROUP BY doc_id, start
), marked AS (
  SELECT *, CASE WHEN start > lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 50 THEN 1 ELSE 0 END AS new
  FROM shared
), numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY start ROWS UNBOUNDED PRECEDING) AS stretch FROM marked
)
SELECT doc_id, min(start)::BIGINT AS start_word, (max(start) + 50)::BIGINT AS end_word, min(other) AS other_doc_id
FROM numbered GROUP BY doc_id, stretch
"""


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_identifiers(table(spark, folder, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"),
        *[of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "learnt")).alias("spans"),
    )


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    rows, final = centroids.cluster(table(spark, folder, "embeddings"))
    digest = F.lit(None).cast("string")
    for number, text in enumerate(centroids.digests(final)):
        digest = F.when(F.col("cluster") == number, text).otherwise(digest)
    return rows.withColumnRenamed("id", "vec_id").withColumn("centroid_sha256", digest)


def _op11_sql() -> str:
    """The rounds written out one after the other."""
    away = "CAST(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    nearest = f"SELECT p.n, p.vec_id, arg_min(c.c, [{away}, c.c]) AS c, min({away}) AS d FROM kept p, c{{0}} c GROUP BY p.n, p.vec_id"
    steps = "".join(
        f""", a{i} AS MATERIALIZED ({nearest.format(i)}), s{i} AS (
  SELECT c, dim, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
    SELECT a.c, unnest(k.v)::HUGEINT AS x, unnest(range(1, 65)) AS dim FROM a{i} a JOIN kept k USING (n))
  GROUP BY c, dim
), m{i} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS v FROM s{i} GROUP BY c
), c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m USING (c)
)"""
        for i in range(10)
    )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS c, v FROM kept
  QUALIFY c < 8
){steps}, a AS MATERIALIZED ({nearest.format(10)})
SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
FROM a JOIN c10 USING (c)
"""


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    rows = warc.deduplicated_pages(table(spark, folder, "pages"))
    return rows.select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


OP12_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
         row_number() OVER same AS place, first_value(page_id) OVER same AS first_id
  FROM pages WINDOW same AS (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST, url)
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first_id END AS refers_to
FROM payloads
"""


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), label=label)


OP13_SQL = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), scored AS MATERIALIZED (
  SELECT a.n AS a, a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, o.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM kept a JOIN kept o ON a.n <> o.n WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS nth
  FROM scored WHERE same QUALIFY nth <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.nth ORDER BY o.score DESC, o.vec_id) AS INTEGER) AS rank,
       o.vec_id AS negative_id, p.score AS positive_score, o.score AS negative_score
FROM positives p JOIN scored o ON o.a = p.a AND NOT o.same
WHERE 50 * p.score <= 100 * o.score AND 100 * o.score <= 95 * p.score
QUALIFY rank <= 3
"""

QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mixing": op2_mixing,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_tool_calls": op5_tool_calls,
    "op6_decontamination": op6_decontamination,
    "op7_token_records": op7_token_records,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_repeats": op9_repeats,
    "op10_personal_data": op10_personal_data,
    "op11_centroids": op11_centroids,
    "op12_warc": op12_warc,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL: dict[str, str] = {
    "op2_mixing": OP2_SQL,
    "op5_tool_calls": OP5_SQL,
    "op6_decontamination": OP6_SQL,
    "op8_near_duplicates": OP8_SQL,
    "op9_repeats": OP9_SQL,
    "op11_centroids": _op11_sql(),
    "op12_warc": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # it uses this module

    return corpus_pipeline.run(spark, folder)


QUERIES["pipeline"] = pipeline
