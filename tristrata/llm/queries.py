"""Queries over the synthetic corpus, one for each operator, and SQL where it can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tristrata.llm import (
    alignment, audit, bpe, chat, language, lines, mixing, neardocs, personal, spots, suffixes, urls, vectors,
)

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    marked = docs.select("doc_id", "text", "lang", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"))
    learned = language.profiles(marked.where(remainder != 1))
    return language.identify(marked, learned, ["doc_id", "held_out"])


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.drop_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"),
        F.octet_length("kept_bytes").cast("long").alias("n_kept"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary(), ["doc_id"])
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("bad")
    )
    judged = urls.judge(table(spark, sf_dir, "pages"), outcomes)
    return judged.select(
        F.col("page").alias("page_id"), "host", "path", "rule", "verdict", F.col("n").cast("long").alias("n_labelled"),
        F.col("bad").cast("long").alias("n_bad"), F.round("mean", 6).alias("mean"), F.round("bound", 6).alias("bound"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardocs.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op10_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.compare_edits(table(spark, sf_dir, "documents"), threshold=0.8)


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.scored(docs, vocabulary(), vocabulary(PIECE_BPE), ["doc_id"])


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find(table(spark, sf_dir, "documents"), ["doc_id"])
    return personal.digest(found, ["doc_id"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language, op2_chat, op3_lines, op4_vectors, op5_suffixes, op6_bpe, op7_urls, op8_mixing,
        op9_near_documents, op10_spots, op11_audit, op12_alignment, op13_personal, pipeline,
    )
}

# Rendered turns hold one more escape sign for each control string, escaped ones included, of a role or text.
OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), counted AS (
  SELECT *, regexp_matches(role || chr(10) || text, '<\\*/s>|\[\\*/?INST\]') AS escaped,
         len(regexp_extract_all(role || chr(10) || text, '<\\*/s>|\[\\*/?INST\]')) AS signs
  FROM turns
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(7 + length(role) + 8 + length(text) + 4 + CASE WHEN escaped THEN signs ELSE 0 END) AS BIGINT) AS formatted_chars,
  CAST(sum(CASE WHEN escaped THEN 1 ELSE 0 END) AS BIGINT) AS n_escaped, true AS identical
FROM counted GROUP BY conv_id
"""

_GOOD = "label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0"
OP4_SQL = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE {_GOOD}
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.a
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON e.vec_id = c.a
"""


def _url_sql() -> str:
    rest = "CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE '' END"
    cases = []
    for _, rule in sorted(urls.RULES, key=lambda r: (-len(r[1]), r[1])):
        name, _, tail = rule.partition("/")
        cases.append(
            f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{tail}') THEN '{rule}'"
        )
    verdicts = " ".join(f"WHEN rule = '{rule}' THEN '{verdict}'" for verdict, rule in urls.RULES)

    listed = ", ".join(f"'{x}'" for x in urls.SUFFIXES)

    def level(name: str, source: str) -> str:
        return f"""{name}_spread AS (
  SELECT greatest(0.001, least(0.999, coalesce(CASE WHEN sum(centre * (1 - centre) * (n - 1)) > 0 THEN
    (sum(n * pow(bad / n - centre, 2)) - sum(centre * (1 - centre))) / sum(centre * (1 - centre) * (n - 1)) END, 0.001))) AS rho
  FROM {source} WHERE n > 0
), {name}_mean AS (
  SELECT *, n + strength AS weight, (bad + strength * prior) / (n + strength) AS mean
  FROM (SELECT s.*, greatest(0.01, 1 / (rho + 1 / ("over" + 1)) - 1) AS strength FROM {source} s, {name}_spread)
)"""

    return f"""
WITH split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest
  FROM (SELECT page_id, {rest} AS rest FROM (SELECT page_id, coalesce(url, '') AS u FROM pages))
), parts AS (
  SELECT page_id, translate(raw, '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split
), known AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic = 0 AND quality = 1 THEN 0 END) AS bad
  FROM labels GROUP BY doc_id
), hosts AS (
  SELECT *, CASE WHEN two IN ({listed}) THEN two ELSE labels[-1] END AS suffix,
         CASE WHEN two IN ({listed}) THEN array_to_string(list_slice(labels, -3, -1), '.') ELSE two END AS domain
  FROM (
    SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad, string_split(host, '.') AS labels,
           array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two
    FROM parts LEFT JOIN known USING (page_id) GROUP BY host
  )
), s AS (
  SELECT suffix, n, bad, (((SELECT sum(bad) FROM hosts) - bad) + 0.5) / (((SELECT sum(n) FROM hosts) - n) + 1.0) AS prior,
         ((SELECT sum(n) FROM hosts) - n) + 1.0 AS "over", (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) FROM hosts) AS centre
  FROM (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix)
), {level("s", "s")}, d AS (
  SELECT c.*, (p.bad - c.bad + p.strength * p.prior) / (p.n - c.n + p.strength) AS prior, p.n - c.n + p.strength AS "over", p.mean AS centre
  FROM (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain) c JOIN s_mean p ON c.suffix = p.suffix
), {level("d", "d")}, h AS (
  SELECT c.host, c.n, c.bad, (p.bad - c.bad + p.strength * p.prior) / (p.n - c.n + p.strength) AS prior, p.n - c.n + p.strength AS "over", p.mean AS centre
  FROM hosts c JOIN d_mean p ON c.domain = p.domain
), {level("h", "h")}, ruled AS (
  SELECT page_id, host, path, n, bad, mean, mean - {urls.DEVIATIONS} * sqrt(mean * (1 - mean) / (weight + 1)) AS bound,
         CASE {" ".join(cases)} END AS rule
  FROM parts JOIN h_mean USING (host)
)
SELECT page_id, host, path, rule,
       CASE {verdicts} WHEN bound > {urls.LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
       CAST(n AS BIGINT) AS n_labelled, CAST(bad AS BIGINT) AS n_bad, round(mean, 6) AS mean, round(bound, 6) AS bound
FROM ruled
"""


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 9) AS BIGINT) AS place
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), named AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n, source_size * 2.0::DOUBLE AS cap FROM totals
), weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((n - 1) % 3 + 1 AS INTEGER)] AS w FROM named
), levels AS (
  SELECT *, row_number() OVER o AS pos,
    (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighted WINDOW o AS (ORDER BY cap / w, n)
), opened AS (
  SELECT *, min(CASE WHEN level * w <= cap THEN pos END) OVER () AS lead FROM levels
), goals AS (
  SELECT source, source_size,
    CASE WHEN pos >= lead THEN max(CASE WHEN pos = lead THEN level END) OVER () * w ELSE cap END AS target
  FROM opened
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 2) AS BIGINT) ELSE 0 END AS passes FROM goals
), placed AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, r.passes,
    CASE WHEN passes >= 2 THEN 0 ELSE target - passes * r.source_size END AS rest,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place) AS BIGINT) AS upto,
    CAST(sum(s.size) OVER (PARTITION BY s.source, s.place) AS BIGINT) AS own
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (passes + CASE WHEN passes < 2 AND (upto <= rest OR (upto - own <= rest AND upto - rest < rest - (upto - own)))
                             THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

# Orders are grown letter by letter; a step sees the failure sets that the letters before it leave.
OP11_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM texts
), failed AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM split
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), counted AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, fails
), grown AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || letter FROM grown, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(letter)
  WHERE NOT contains(filter_order, letter)
), steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, substr(filter_order, s, 1) AS letter, substr(filter_order, 1, s - 1) AS before
  FROM grown, (VALUES (1), (2), (3), (4), (5)) AS v(s) WHERE length(filter_order) = 5
), judged AS (
  SELECT *, contains(fails, letter) AS hit, translate(fails, before, '') = fails AS alive FROM steps, counted
), per_step AS (
  SELECT part, filter_order, step, letter,
    CAST(sum(CASE WHEN alive AND NOT hit THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN alive AND hit THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN NOT alive AND hit THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN alive AND hit THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN alive AND hit THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM per_step
"""

SQL: dict[str, str] = {"op11_audit": OP11_SQL, "op2_chat": OP2_SQL, "op4_vectors": OP4_SQL, "op7_urls": _url_sql(), "op8_mixing": OP8_SQL}
