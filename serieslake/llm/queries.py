"""The operators as queries over the shared tables, with SQL oracles where SQL has them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake.llm import chat_format, exact_dedup, jaccard, lsh_forest, manifest, mixing
from serieslake.llm import neighbours, pieces, pii, quality, resampling, sharding, token_files
from serieslake.llm.common import light_batches, table
from serieslake.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PROBE = "</s>[INST] ok [/INST]"
END_ID = 2


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query(
    "op1_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
           sha256(body) AS text_sha256
    FROM (SELECT doc_id, coalesce("text", '') AS body FROM documents)""",
)
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query(
    "op2_chat_format",
    r"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS body
      FROM conversations
      UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                      (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
    n AS (
      SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
             sum(24 - 4 + length(role) + length(regexp_replace(body,
                 '([<\[])(\\*)(\|turn\|>|\|says\|>|/s>|s>|INST\]|/INST\]|\|im_start\|>|\|im_end\|>)',
                 '\1\\\2\3', 'g'))) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body))
    SELECT conv_id, max(n) AS n_turns,
           sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY place)) AS turns_sha256,
           CAST(coalesce(sum(length(body)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(body, '' ORDER BY place) FILTER (role = 'assistant'), ''))
             AS loss_sha256,
           CAST(sum(upto) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
    FROM n GROUP BY conv_id""",
)
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    kinds = "conv_id long, turn long, role string, text string"
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], kinds)
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    examples = chat_format.format_chats(turns.unionByName(probe))
    newline = F.lit("\n")
    told = F.transform(
        chat_format.read_turns(F.col("formatted")),
        lambda t: F.concat(t["role"], newline, t["text"], newline),
    )
    whole = F.struct(F.size(told).alias("n"), F.sha2(F.array_join(told, ""), 256).alias("sha"))
    parts = examples.select(
        "conv_id",
        "example",
        F.when(F.col("example") == F.col("of") - 1, whole).alias("whole"),
        chat_format.read_loss().alias("loss"),
        F.length("formatted").alias("chars"),
    )
    summed = parts.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return summed.select(
        "conv_id",
        F.col("whole")["n"].cast("long").alias("n_turns"),
        F.col("whole")["sha"].alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(
    "op3_mixing",
    r"""
    WITH d AS (
      SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
             len(regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+')) AS size,
             ('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT AS h
      FROM documents),
    q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 4.0 ELSE 1.0 END)::DOUBLE AS w
          FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    k AS (SELECT d.*, -ln((h + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / coalesce(q.w, 2.0::DOUBLE) AS sort_key
          FROM d LEFT JOIN q USING (doc_id)),
    s AS (SELECT sk, sum(size)::BIGINT AS source_size,
                 (row_number() OVER (ORDER BY sk) - 1) % 3 AS r FROM k GROUP BY sk),
    w AS (SELECT sk, source_size, 2.0::DOUBLE * source_size AS cap,
                 CASE r WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
    -- Sources meet their caps in the order of cap by weight; each place is one try of the level.
    o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, sk) AS place FROM w),
    t AS (SELECT o.*,
                 (1.5 * (SELECT sum(source_size) FROM w)::DOUBLE
                  - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM o),
    l AS (SELECT coalesce((SELECT level FROM t WHERE weight * level < cap ORDER BY place LIMIT 1),
                          'infinity'::DOUBLE) AS level),
    g AS (SELECT sk, source_size, least(cap, weight * l.level) AS target FROM w, l),
    b AS (SELECT k.*, source_size, target,
                 CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
                 coalesce(sum(size) OVER (PARTITION BY sk ORDER BY sort_key, doc_id, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM k JOIN g USING (sk))
    SELECT doc_id, size, source_size, target,
           CAST(CASE WHEN size > 0 THEN size * (epochs +
             CASE WHEN 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END)
             ELSE 0 END AS BIGINT) AS taken
    FROM b""",
)
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(
        table(spark, folder, "documents"), mixing.label_weights(table(spark, folder, "labels"))
    )
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


@query("op4_ngram_jaccard")
def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids), lossless (decoding gives
    the text back)."""
    path = vocabulary("piece_bpe_32k.model")
    encoded = pieces.encode_documents(table(spark, folder, "documents"), path)

    @F.arrow_udf("long")
    def summed(lists: pa.Array) -> pa.Array:
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        bounds = lists.offsets.to_numpy()
        return pa.array(
            [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64()
        )

    found = encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        summed("ids").alias("ids_crc32"),
        (F.sha2(pieces.decoded(F.col("ids"), path).cast("binary"), 256) == F.col("text_sha256")).alias(
            "lossless"
        ),
    )
    with light_batches(spark):
        return cut_lineage(found, "encoded")


@query("op6_quality")
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = docs.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        quality.score_column(docs, model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op7_sharding")
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = token_files.token_folder(spark)
    files = token_files.write_token_files(
        table(spark, folder, "documents"), path, vocabulary("word_bpe_49k.json"), END_ID
    )
    return token_files.read_token_files(files, path)


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


@query("op10_neighbours")
def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(
        table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0
    )


#: CRC-32 of a string's bytes as a DuckDB macro: the table by its rule, then one step a byte.
CRC32_SQL = """
    t AS MATERIALIZED (
      SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k:
               CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS steps
      FROM range(256) r(n))"""


def crc32_sql(name: str) -> str:
    """SQL for the unsigned CRC-32 of a string column, next to the table t of CRC32_SQL."""
    byte = f"('0x' || substr(hex(encode({name})), 2 * k + 1, 2))::BIGINT"
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(strlen({name})), lambda k: {byte})),
        lambda c, b: xor(c >> 8, t.steps[(xor(c, b) & 255) + 1])))"""


@query(
    "op11_resampling",
    rf"""
    WITH {CRC32_SQL},
    x AS (
      SELECT 0 AS kind, doc_id AS id, "text" AS body, row_number() OVER () AS r FROM documents
      UNION ALL SELECT 1, item_id, "text", -row_number() OVER () FROM benchmark),
    w AS (
      SELECT kind, id, r, regexp_extract_all(
               translate(coalesce(body, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM x),
    f AS (
      SELECT kind, r, unnest(words || list_transform(range(1, len(words)), lambda i:
               words[i] || ' ' || words[i + 1])) AS feature FROM w),
    c AS (SELECT kind, r, feature, count(*) AS times FROM f GROUP BY ALL),
    d AS (SELECT feature, {crc32_sql("feature")} % 10000 AS bucket
          FROM (SELECT DISTINCT feature FROM c), t),
    o AS (SELECT kind, r, bucket, sum(times)::BIGINT AS times FROM c JOIN d USING (feature) GROUP BY ALL),
    b AS (SELECT bucket, coalesce(sum(times) FILTER (kind = 0), 0)::DOUBLE AS s,
                 coalesce(sum(times) FILTER (kind = 1), 0)::DOUBLE AS t FROM o GROUP BY bucket),
    n AS (SELECT sum(s) + 10000 AS s_all, sum(t) + 10000 AS t_all FROM b),
    g AS (SELECT bucket, floor(1000 * ln((t + 1) * s_all / ((s + 1) * t_all)))::BIGINT AS gain FROM b, n),
    m AS (SELECT r, sum(times)::BIGINT AS n_features, sum(times * gain)::BIGINT AS gained
          FROM o JOIN g USING (bucket) WHERE kind = 0 GROUP BY r),
    s AS (SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, len(words) >= 20 AS eligible,
                 coalesce(floor(gained::DOUBLE / n_features), 0)::BIGINT AS weight,
                 ('0x' || substr(sha256('7:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8))::BIGINT AS h
          FROM w LEFT JOIN m USING (r) WHERE kind = 0),
    p AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
          FROM s),
    q AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST, n_features)
                 AS place, count(*) OVER (PARTITION BY eligible) AS members FROM p)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN eligible AND place <= 25 * members // 100 THEN place END AS rank
    FROM q""",
)
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample_to_target(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return drawn.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


@query("op12_near_duplicates")
def op12_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = lsh_forest.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(map(_field_sql, values))})"


@query(
    "op13_manifest",
    f"""
    WITH RECURSIVE {CRC32_SQL},
    d AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce('1' || lang, '0') AS tree,
             {_leaf_sql('"text"')} AS leaf,
             CASE WHEN coalesce({crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0, false)
                  THEN {_leaf_sql("translate(\"text\", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                  ELSE {_leaf_sql('"text"')} END AS probe
      FROM documents, t),
    o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, probe) - 1 AS pos,
                 count(*) OVER (PARTITION BY tree) AS size FROM d),
    -- Every node of every tree; size counts the nodes of its level.
    n AS (SELECT tree, 0 AS level, pos, leaf AS node, size FROM o
          UNION ALL
          SELECT tree, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (max(size) + 7) // 8
          FROM n WHERE size > 1 GROUP BY tree, level, pos // 8),
    b AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos,
                 count(*) OVER () AS size FROM n WHERE size = 1),
    u AS (SELECT 0 AS level, pos, subroot AS node, size FROM b
          UNION ALL
          SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (max(size) + 7) // 8
          FROM u WHERE size > 1 GROUP BY level, pos // 8),
    a AS (SELECT tree, level, pos, node, size FROM n WHERE size > 1
          UNION ALL SELECT NULL, level, pos, node, size FROM u WHERE size > 1),
    s AS (SELECT x.tree, x.level, x.pos,
                 coalesce(string_agg(y.node, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS lft,
                 coalesce(string_agg(y.node, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS rgt
          FROM a x JOIN a y ON x.tree IS NOT DISTINCT FROM y.tree AND x.level = y.level AND x.pos // 8 = y.pos // 8
          GROUP BY ALL),
    f AS (SELECT r, tree, 0 AS level, pos, probe AS held, '' AS path FROM o
          UNION ALL
          SELECT r, f.tree, f.level + 1, f.pos // 8, sha256(lft || held || rgt), path || lft || rgt
          FROM f JOIN s ON f.tree = s.tree AND f.level = s.level AND f.pos = s.pos),
    g AS (SELECT r, tree, max_by(held, level) AS held, max_by(path, level) AS path FROM f GROUP BY r, tree),
    h AS (SELECT r, 0 AS level, b.pos, held, path FROM g JOIN b USING (tree)
          UNION ALL
          SELECT r, h.level + 1, h.pos // 8, sha256(lft || held || rgt), path || lft || rgt
          FROM h JOIN s ON s.tree IS NULL AND h.level = s.level AND h.pos = s.pos),
    p AS (SELECT r, max_by(held, level) AS held, max_by(path, level) AS path FROM h GROUP BY r)
    SELECT doc_id, leaf, subroot, u.node AS root, sha256(path) AS proof_sha256, held AS folded_root,
           held = u.node AS verified
    FROM o JOIN b USING (tree) JOIN p USING (r), u WHERE u.size = 1""",
)
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.document_manifest(table(spark, folder, "documents"))
