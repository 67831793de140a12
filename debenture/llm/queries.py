"""One query per training-data operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, chat, clusters, decontam, jaccard, line_dedup, mixing, quality, sharding, substring, token_counts, token_store


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")))).alias("t"))
    rows = rows.unionByName(more.select("conv_id", "t.turn", "t.role", F.lit(hard).alias("text")))
    out = chat.format_chats(rows)
    turns = chat.parse(F.col("formatted"))
    out = out.select("conv_id", "formatted", turns.alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), "verified")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "verified",
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("row_at")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored(_table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    out = quality.judged(docs, model, columns=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.per_document(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_exact", "n_near", "n_links", F.array_join(F.transform("dropped", lambda x: x.cast("string")), ",").alias("dropped"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    digest = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    out = sharding.shard(digest)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clusters.clustered(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.decode_ids(bpe.encode_texts(_table(spark, sf_dir, "documents"), columns=["doc_id"]))
    n_tokens = F.floor(F.octet_length("ids") / 4).cast("long")
    return out.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_chat_formatting, op2_substring_dedup, op3_benchmark_decontamination, op4_token_counts, op5_ngram_jaccard_join, op6_token_id_output, op7_source_mixing, op8_quality_rules, op9_line_dedup, op10_sharding, op11_centroid_clustering, op12_filter_audit, op13_byte_level_bpe)}


_REST = r"(?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"

OP1_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
  SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS head,
    regexp_matches(text, '[<\[]\\*{_REST}') OR regexp_matches(role, '[<\[]\\*{_REST}') AS hard FROM t
), e AS (
  SELECT conv_id, turn, role, text,
    length(CASE WHEN hard THEN regexp_replace(head, '([<\[])(\\*)({_REST})', '\1\\\2\3', 'g') ELSE head END)
    + length(CASE WHEN hard THEN regexp_replace(text, '([<\[])(\\*)({_REST})', '\1\\\2\3', 'g') ELSE text END) + 24 AS chars FROM r
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) + 4)::BIGINT AS formatted_chars, true AS verified
FROM e GROUP BY conv_id"""

OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL
), c AS (
  SELECT w, min(doc_id) AS copy_id, count(*) AS n_copies FROM w WHERE len(w) > 0 GROUP BY w
), s AS (
  SELECT DISTINCT copy_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
    list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM c
), n AS (SELECT copy_id, count(*) AS n FROM s GROUP BY copy_id
), i AS (
  SELECT a.copy_id AS a, b.copy_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.copy_id <> b.copy_id GROUP BY ALL
), l AS (
  SELECT a, b FROM i JOIN n x ON x.copy_id = a JOIN n y ON y.copy_id = b WHERE i / (x.n + y.n - i) >= 0.8
), r AS (
  SELECT copy_id AS a, copy_id AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), k AS (SELECT a AS copy_id, min(b) AS class_id FROM r GROUP BY a
), f AS (
  SELECT c.w, c.copy_id, c.n_copies, k.class_id, (SELECT count(*) FROM l WHERE l.a = c.copy_id) AS n_links FROM c JOIN k USING (copy_id)
)
SELECT d.doc_id, coalesce(f.class_id, d.doc_id) AS class_id, coalesce(f.copy_id, d.doc_id) AS copy_id,
  coalesce(f.n_copies, 1)::BIGINT AS n_copies, coalesce(f.n_links, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN w ON w.doc_id = d.doc_id LEFT JOIN f ON f.w = w.w"""

OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), n AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 3.0 AS cap FROM d GROUP BY source
), w AS (
  SELECT *, ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM n
), l AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS whole,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS capped,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM w
), v AS (SELECT *, (whole - capped) / free AS level FROM l
), g AS (
  SELECT source, source_size,
    least(cap, coalesce((SELECT level FROM v WHERE level * weight <= cap ORDER BY cap / weight, level LIMIT 1), 'inf'::DOUBLE) * weight) AS target FROM v
), q AS (
  SELECT *, round(target)::BIGINT AS quota, greatest(1, least(1024, round(target)::BIGINT // 64)) AS block, row_number() OVER (ORDER BY source NULLS LAST) AS nr FROM g
), z AS (SELECT *, CASE WHEN quota > 0 THEN (quota + block - 1) // block ELSE 0 END AS need FROM q
), c AS (
  SELECT *, ((sum(need) OVER r) - need)::DOUBLE / sum(need) OVER () AS low, (sum(need) OVER r)::DOUBLE / sum(need) OVER () AS high FROM z WINDOW r AS (ORDER BY nr)
), i AS (SELECT unnest(range((SELECT sum(need)::BIGINT FROM c))) AS slot
), h AS (
  SELECT slot, c.nr, need, row_number() OVER (PARTITION BY c.nr ORDER BY slot) - 1 AS k
  FROM (SELECT slot, list_sum(list_transform(range(52), lambda b: ((slot >> b) & 1) * pow(2.0, -(b + 1)))) AS point FROM i) JOIN c ON point >= low AND point < high
), f AS (SELECT slot, row_number() OVER (ORDER BY slot) AS i FROM h WHERE k >= need
), m AS (
  SELECT nr, k, row_number() OVER (ORDER BY nr, k) AS i FROM (SELECT nr, unnest(range(need)) AS k FROM c) WHERE (nr, k) NOT IN (SELECT (nr, k) FROM h WHERE k < need)
), slots AS (SELECT nr, k, slot FROM h WHERE k < need UNION ALL SELECT nr, k, slot FROM m JOIN f USING (i)
), b AS (
  SELECT d.doc_id, d.size, c.nr, c.block, c.source_size, c.target, c.quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
), t AS (SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS rounds FROM b)
SELECT doc_id, size, source_size, target, (rounds * size + least(quota - rounds * source_size, begin + size) - least(quota - rounds * source_size, begin))::BIGINT AS taken,
  -- blocks lie in the mix by slots; a document that begins in its line's next round may be met there before it is met here
  (SELECT min(slot) FROM slots s WHERE s.nr = t.nr AND t.size > 0 AND list_contains(list_transform(list_filter(range(3), lambda w: w * t.source_size + t.begin < t.quota), lambda w: (w * t.source_size + t.begin) // t.block), s.k)) AS first_slot
FROM t"""

OP9_SQL = r"""
WITH RECURSIVE p AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents
), lines AS (SELECT * FROM p WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), u AS (SELECT line, length(line) AS n, row_number() OVER () AS id FROM (SELECT DISTINCT line FROM lines)
), e AS (
  SELECT *, CASE WHEN n >= 120 THEN 4 WHEN n >= 60 THEN 3 WHEN n >= 20 THEN 2 WHEN n >= 8 THEN 1 ELSE 0 END AS most FROM u
), s AS (
  -- the shorter line in most + 1 stretches: the longer one holds one of them
  SELECT *, list_transform(range(0, most + 1), lambda i: substring(line, (n * i // (most + 1) + 1)::INT, (n * (i + 1) // (most + 1) - n * i // (most + 1))::INT)) AS cut FROM e WHERE most > 0
), near AS (
  SELECT a.line AS a, b.line AS b FROM s a JOIN u b ON b.n BETWEEN a.n AND a.n + 4 AND a.id <> b.id
  WHERE b.n <= a.n + a.most AND (a.n < b.n OR a.id < b.id) AND abs(strlen(a.line) - strlen(b.line)) <= 4 * a.most
    AND (contains(b.line, a.cut[1]) OR contains(b.line, a.cut[2]) OR contains(b.line, a.cut[3]) OR contains(b.line, a.cut[4]) OR contains(b.line, a.cut[5]))
    AND levenshtein(a.line, b.line) <= 4 * a.most
    -- levenshtein counts bytes: the pair's other characters become control characters, of which there are 26
    AND levenshtein(translate(a.line, array_to_string(list_distinct(regexp_extract_all(a.line || b.line, '[^\x00-\x7F]')), ''), list_aggregate(list_transform(list_concat(range(1, 9), range(14, 32)), lambda i: chr(i::INT)), 'string_agg', '')), translate(b.line, array_to_string(list_distinct(regexp_extract_all(a.line || b.line, '[^\x00-\x7F]')), ''), list_aggregate(list_transform(list_concat(range(1, 9), range(14, 32)), lambda i: chr(i::INT)), 'string_agg', ''))) <= a.most
), l AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), r AS (SELECT a, a AS b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), k AS (SELECT a AS line, min(b) AS cls FROM r GROUP BY a
), m AS (
  SELECT lines.*, coalesce(k.cls, lines.line) AS cls, (SELECT count(*) FROM l WHERE l.a = lines.line) AS links FROM lines LEFT JOIN k ON k.line = lines.line
), f AS (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, n) > 1 AS exact, row_number() OVER (PARTITION BY cls ORDER BY doc_id, n) = 1 AS kept FROM m
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (exact) AS n_exact, count(*) FILTER (NOT kept AND NOT exact) AS n_near,
  sum(links)::BIGINT AS n_links, coalesce(string_agg(n::VARCHAR, ',' ORDER BY n) FILTER (NOT kept), '') AS dropped
FROM f GROUP BY doc_id"""


OP11_SQL = (
    """
WITH q AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('3:' || vec_id) AS h, v FROM q WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT 8)
)"""
    + "".join(
        f""", a{r} AS MATERIALIZED (
  SELECT vec_id, v, arg_min(c, d) AS c, min(d)[1] AS distance FROM (
    SELECT vec_id, v, c, [list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, c] AS d, row_nr FROM (SELECT *, row_number() OVER () AS row_nr FROM q) JOIN c{r} ON true
  ) GROUP BY row_nr, vec_id, v
)"""
        + (
            f""", s{r} AS (
  SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i
), c{r + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(g.m, o.m) AS m FROM c{r} o LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{r} GROUP BY c) g USING (c)
)"""
            if r < 10
            else ""
        )
        for r in range(11)
    )
    + """
SELECT vec_id, c::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a10 JOIN c10 USING (c)"""
)

OP12_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS fails
  FROM t LEFT JOIN l USING (doc_id)
), n AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails
), o AS (
  SELECT '' AS filter_order UNION ALL SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)
), s AS (
  SELECT filter_order, step, substring(filter_order, step, 1) AS filter, 1 << (ascii(substring(filter_order, step, 1)) - 65) AS bit,
    list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substring(filter_order, i::INT, 1)) - 65))) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5
), r AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (fails & (coalesce(before, 0)::INT | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & coalesce(before, 0)::INT = 0 AND fails & bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & coalesce(before, 0)::INT > 0 AND fails & bit > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & coalesce(before, 0)::INT = 0 AND fails & bit > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & coalesce(before, 0)::INT = 0 AND fails & bit > 0), 0)::BIGINT AS toxic_lost
  FROM n, s GROUP BY part, filter_order, step, filter
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r"""


def oracle_sql() -> dict:
    return {"op11_centroid_clustering": OP11_SQL, "op12_filter_audit": OP12_SQL, "op1_chat_formatting": OP1_SQL, "op5_ngram_jaccard_join": OP5_SQL, "op7_source_mixing": OP7_SQL, "op9_line_dedup": OP9_SQL}
