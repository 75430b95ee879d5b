"""One registered query an operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.centroids import clustered
from starloom.llm.chat import digests, format_log
from starloom.llm.common import fresh_folder, table, tidy
from starloom.llm.importance import resampled
from starloom.llm.lattice import lattice_links
from starloom.llm.lines import line_dedup
from starloom.llm.packing import packed
from starloom.llm.secret_scan import BASE_KINDS, find_secrets
from starloom.llm.sentence_pieces import decoded, encoded
from starloom.llm.simhash import simhash_components
from starloom.llm.suffix import suffix_dedup
from starloom.llm.topk import top_k
from starloom.llm.tokens import read_tokens, write_tokens
from starloom.llm.toxicity import toxicity


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def q_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    given = F.xxhash64(F.coalesce("text", F.lit("")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", given.alias("given"))
    return decoded(encoded(docs, model, carry=("doc_id", "given")), model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("text").cast("long").alias("decoded_chars"),
        (F.xxhash64("text") == F.col("given")).alias("round_trip"),
    )


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    pieces = packed(table(spark, sf_dir, "documents"), vocabulary, "dropped", end_id=1, size=2048)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def q_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_links(table(spark, sf_dir, "embeddings"), cosine=0.93)


def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, folder = public_tokenizers.path("byte_bpe_50k.json"), fresh_folder(spark, "tokens")
    shards = write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary, "leading", end_id=2)
    return read_tokens(spark, shards, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), words=4, bits=4)


def q_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), width=3).select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("long").alias("n_removed"),
        F.md5(F.coalesce("kept", F.lit(""))).alias("kept_md5"),
    )


def q_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the table are ``message`` events; those of equal turn are turns of their own."""
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", F.coalesce("text", F.lit(""))))
    log = rows.withColumn("turn", place.cast("long")).withColumns({"seq": F.col("turn"), "kind": F.lit("message")})
    return digests(format_log(log))


def q_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20, scale=64.0)


def q_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), length=200).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def q_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"), k=8, dim=64, scale=1024.0, seed=3, rounds=10).drop("centroid")


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def q_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, least_words=20, longest=2, buckets=10_000, seed=7)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


Query = Callable[[SparkSession, str], DataFrame]


def _tidied(name: str, query: Query) -> Query:
    """``query`` with its result staged and all that it staged on the way removed."""
    return lambda spark, sf_dir: tidy(spark, lambda: query(spark, sf_dir), name)


#: Of these nothing is staged, so there is nothing to remove.
ONE_PASS: dict[str, Query] = {"op2_sentencepiece": q_sentencepiece, "op3_packing": q_packing, "op10_chat": q_chat, "op12_secrets": q_secrets}
STAGED: dict[str, Query] = {
    "op1_toxicity": q_toxicity,
    "op4_simhash": q_simhash,
    "op5_lattice": q_embeddings,
    "op6_tokens": q_tokens,
    "op7_lines": q_lines,
    "op8_suffix": q_suffix,
    "op9_topk": q_topk,
    "op11_centroids": q_centroids,
    "op13_importance": q_importance,
}
QUERIES: dict[str, Query] = {**ONE_PASS, **{name: _tidied(name, query) for name, query in STAGED.items()}}

LINES_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents
), windows AS (
    SELECT doc_id, pos, line AS l0, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
    SELECT doc_id, pos FROM (
        SELECT doc_id, pos, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, pos) AS nth
        FROM windows WHERE l2 IS NOT NULL AND trim(l0 || l1 || l2) <> ''
    ) WHERE nth > 1
), gone AS (
    SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) AS t(k)
)
SELECT d.doc_id, count(l.pos) AS n_lines, count(g.pos) AS n_removed,
       md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_md5
FROM documents d LEFT JOIN lines l ON l.doc_id = d.doc_id
LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
GROUP BY d.doc_id
"""

TOPK_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(p.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v p ON p.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

CHAT_SQL = """
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nth,
           length(replace(replace(replace(replace(replace(role, '~', '~0'), '<s>', '~1'), '[INST]', '~2'), '[/INST]', '~3'), '</s>', '~4'))
         + length(replace(replace(replace(replace(replace(text, '~', '~0'), '<s>', '~1'), '[INST]', '~2'), '[/INST]', '~3'), '</s>', '~4'))
         + length('<s>[INST][/INST]</s>') AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _centroids_sql(k: int = 8, rounds: int = 10) -> str:
    """One pair of steps a round: assign all vectors, then take floors of means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT n, vec_id, e, arg_min(c, (distance, c)) AS cluster, min(distance) AS distance FROM (
        SELECT v.n, v.vec_id, v.e, m.c, list_sum(list_transform(list_zip(v.e, m.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM v, m{r} m
    ) GROUP BY n, vec_id, e
)""")
        if r < rounds:
            steps.append(f"""m{r + 1} AS MATERIALIZED (
    SELECT m.c, coalesce(f.e, m.e) AS e FROM m{r} m LEFT JOIN (
        SELECT cluster, list(CAST(floor(total / times) AS BIGINT) ORDER BY d) AS e FROM (
            SELECT cluster, d, sum(x) AS total, count(*) AS times
            FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM a{r}) GROUP BY cluster, d
        ) GROUP BY cluster
    ) f ON f.cluster = m.c
)""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), m0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, e FROM v ORDER BY c LIMIT {k}
), {", ".join(steps)}
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN m{rounds} m ON m.c = a.cluster
"""


#: crc32 in SQL: the table of one byte's steps, and the digest of a list of bytes.
CRC_TABLE_SQL = """list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda acc, k: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END))"""


def _crc_sql(data: str, steps: str) -> str:
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), lambda c, b: xor(c >> 8, {steps}[(xor(c, b) & 255) + 1])), 4294967295)"


def _secrets_sql() -> str:
    """A kind's matches and the texts between them give its places."""
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    names = "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?" + either("key")
    assign = f"""(?:{names})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""".replace("\\\\", "\\")
    kinds = [("assign", assign, 1), ("access", "(AKIA[A-Z0-9]+)", 1), ("hex", "([0-9a-f]+)", 1), ("github", "gh[pousr]_([0-9A-Za-z]+)", 1), ("npm", "npm_([0-9A-Za-z]+)", 1)]
    parts = " UNION ALL ".join(
        f"SELECT n, {i} AS kind, '{name}' AS name, unnest(string_split_regex(text, '{p}')) AS before, unnest(regexp_extract_all(text, '{p}')) AS found, "
        f"unnest(regexp_extract_all(text, '{p}', {group})) AS body, generate_subscripts(string_split_regex(text, '{p}'), 1) AS nth FROM docs"
        for i, (name, p, group) in enumerate(kinds)
    )
    digit = lambda k: f"substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', CAST((crc // {62**k}) % 62 AS INTEGER) + 1, 1)"
    data = "list_transform(string_split(substr(body, 1, 30), ''), lambda c: CAST(ord(c) AS BIGINT))"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
), steps AS (SELECT {CRC_TABLE_SQL} AS t
), parts AS ({parts}
), placed AS (
    SELECT n, kind, name, found, body,
           sum(length(before)) OVER w + coalesce(sum(length(found)) OVER (PARTITION BY n, kind ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM parts WINDOW w AS (PARTITION BY n, kind ORDER BY nth)
), long_enough AS (
    SELECT n, kind, name, CAST(start AS BIGINT) AS start, CAST(start + length(found) AS BIGINT) AS stop, body FROM placed
    WHERE found IS NOT NULL AND length(body) >= CASE kind WHEN 0 THEN 6 WHEN 1 THEN 20 WHEN 2 THEN 24 ELSE 36 END AND (kind < 3 OR length(body) = 36)
), sealed AS (
    SELECT n, kind, name, start, stop, body, CASE WHEN kind > 2 THEN {_crc_sql(data, "t")} END AS crc FROM long_enough, steps
), good AS (
    SELECT n, kind, start, name || ':' || start || ':' || stop AS span FROM sealed
    WHERE kind < 3 OR substr(body, 31, 6) = {" || ".join(digit(k) for k in range(5, -1, -1))}
)
SELECT d.doc_id, count(*) FILTER (WHERE g.kind = 0) AS n_assign, count(*) FILTER (WHERE g.kind = 1) AS n_access, count(*) FILTER (WHERE g.kind = 2) AS n_hex,
       sha256(coalesce(string_agg(g.span, ',' ORDER BY g.start, g.kind) FILTER (WHERE g.kind < 3), '')) AS base_sha256,
       coalesce(string_agg(g.span, ',' ORDER BY g.start, g.kind), '') AS spans
FROM docs d LEFT JOIN good g ON g.n = d.n GROUP BY d.n, d.doc_id
"""


IMPORTANCE_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS n, doc_id, text, 0 AS side FROM documents UNION ALL SELECT -row_number() OVER (), NULL, text, 1 FROM benchmark
), words AS (
    SELECT n, side, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (
        SELECT n, side, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts)
), runs AS MATERIALIZED (
    SELECT n, side, word AS feature FROM words
    UNION ALL SELECT n, side, feature FROM (SELECT n, side, word || ' ' || lead(word) OVER (PARTITION BY n ORDER BY pos) AS feature FROM words) WHERE feature IS NOT NULL
), steps AS MATERIALIZED (SELECT {CRC_TABLE_SQL} AS t
), named AS MATERIALIZED (
    SELECT feature, {_crc_sql("list_transform(regexp_extract_all(hex(feature), '..'), lambda h: CAST('0x' || h AS BIGINT))", "t")} % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM runs), steps
), counted AS MATERIALIZED (
    SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM runs JOIN named USING (feature) GROUP BY bucket
), sums AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counted
), gains AS MATERIALIZED (
    SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counted, sums
), weights AS (
    SELECT n, count(*) AS n_features, sum(gain) AS total FROM runs JOIN named USING (feature) JOIN gains USING (bucket) WHERE side = 0 GROUP BY n
), scored AS (
    SELECT t.n, doc_id, coalesce(n_features, 0) AS n_features, coalesce(CAST(floor(CAST(total AS DOUBLE) / n_features) AS BIGINT), 0) AS weight,
           CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS luck
    FROM texts t LEFT JOIN weights w ON w.n = t.n WHERE side = 0
), eligible AS (
    SELECT n, row_number() OVER (ORDER BY weight + luck DESC, doc_id, n_features) AS rank, count(*) OVER () AS every FROM scored WHERE n_features >= 39 AND luck IS NOT NULL
)
SELECT doc_id, n_features, weight, weight + luck AS score, CASE WHEN rank <= 25 * every // 100 THEN rank END AS rank
FROM scored LEFT JOIN eligible USING (n)
"""

ORACLES: dict[str, str] = {
    "op7_lines": LINES_SQL,
    "op9_topk": TOPK_SQL,
    "op10_chat": CHAT_SQL,
    "op11_centroids": _centroids_sql(),
    "op12_secrets": _secrets_sql(),
    "op13_importance": IMPORTANCE_SQL,
}
