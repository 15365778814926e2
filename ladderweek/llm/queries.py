"""One query per operator over its whole table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderweek.llm import (
    chat,
    codebooks,
    cotraining,
    divergence,
    fingerprints,
    mixing,
    near_dedup,
    packing,
    perplexity,
    projection_passes,
    revisits,
    token_files,
    url_rules,
)
from ladderweek.llm.common import table

VOCABULARY = "word_bpe_49k.json"
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def hex64(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def op1_balanced_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


def op2_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judge(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *base, "score", "spreads_away")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rule_table(spark, URL_RULES)
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_components(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), hex64(F.element_at("fp", 1)).alias("fingerprint"), "component_id"
    )


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def captures(pages: DataFrame) -> DataFrame:
    """Crawl records of the pages: a full response each, and a later revisit under another spelling of its address."""
    page, tag = F.col("page_id"), F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 12), F.lit('"'))
    when = F.pmod(page * 7919, F.lit(1_000_003)) * 60
    day = F.concat(F.lit("day "), F.floor(when / 86_400).cast("string"))
    full = pages.select(
        (page * 2).alias("record_id"),
        "url",
        when.alias("ts"),
        F.lit(200).alias("status"),
        F.create_map(
            F.lit("ETag"), F.when(page % 5 != 0, tag),
            F.lit("Last-Modified"), day,
            F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Cache-Control"), F.lit("no-store"),
        ).alias("headers"),
        F.col("html").alias("body"),
    )
    fresh = F.when(page % 5 == 0, None).when(page % 7 == 0, F.lit('"stale"')).otherwise(F.concat(F.lit("W/"), tag))
    again = pages.select(
        (page * 2 + 1).alias("record_id"),
        F.concat("url", F.when(page % 3 == 0, "#part").otherwise("")).alias("url"),
        (when + F.when(page % 11 == 0, -30).otherwise(page % 13 * 50_000 + 1)).alias("ts"),
        F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), fresh,
            F.lit("last-modified"), F.when(page % 10 != 0, day),
            F.lit("cache-control"), F.concat(F.lit("max-age="), (page % 9).cast("string")),
            F.lit("content-type"), F.lit("text/plain"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return full.unionByName(again)


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = revisits.resolve(captures(table(spark, sf_dir, "pages")))
    named = F.array_sort(F.map_entries("headers"))
    listed = F.array_join(F.transform(named, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ";")
    return resolved.select(
        "record_id", "canonical_url", "source_id", "verdict", listed.alias("headers"), F.md5("body").alias("body_md5")
    )


OP6_SQL = r"""
WITH records AS (
  SELECT page_id, url, md5(html) AS digest, '"' || substr(md5(html), 1, 12) || '"' AS tag,
         ((page_id * 7919) % 1000003) * 60 AS ts FROM pages),
named AS (
  SELECT *, 'day ' || CAST(ts // 86400 AS VARCHAR) AS day,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
      lambda f: f <> '' AND NOT starts_with(f, 'utm_'))), '&') AS query FROM records),
placed AS (
  SELECT *, regexp_replace(host, ':(80|443)$', '') || CASE WHEN path = '' THEN '/' ELSE path END ||
    CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical FROM named),
responses AS (
  SELECT canonical, ts, max(page_id) AS page_id FROM placed GROUP BY ALL),
revisits AS (
  SELECT page_id * 2 + 1 AS record_id, canonical,
    ts + CASE WHEN page_id % 11 = 0 THEN -30 ELSE page_id % 13 * 50000 + 1 END AS ts,
    CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"stale"' ELSE tag END AS etag,
    CASE WHEN page_id % 10 <> 0 THEN day END AS modified, 'max-age=' || (page_id % 9) AS cache FROM placed),
found AS (
  SELECT v.*, r.page_id AS source FROM revisits v ASOF LEFT JOIN responses r
    ON v.canonical = r.canonical AND v.ts > r.ts),
judged AS (
  SELECT f.record_id, f.canonical, f.source, f.etag, f.modified, f.cache, p.day, p.digest,
    CASE WHEN source % 5 <> 0 THEN p.tag END AS their_tag,
    CASE WHEN f.source IS NULL THEN 'no_earlier' WHEN f.etag IS NULL AND f.modified IS NULL THEN 'no_validator'
      WHEN f.etag IS NOT NULL AND f.etag = CASE WHEN source % 5 <> 0 THEN p.tag END THEN 'resolved'
      WHEN f.etag IS NULL AND f.modified = p.day THEN 'resolved' ELSE 'validator_mismatch' END AS verdict
  FROM found f LEFT JOIN placed p ON p.page_id = f.source)
SELECT record_id, canonical AS canonical_url, source * 2 AS source_id, verdict,
  CASE WHEN verdict = 'resolved' THEN concat_ws(';', 'cache-control=' || cache, 'content-type=text/html',
    'etag=' || CASE WHEN etag IS NULL THEN their_tag ELSE 'W/' || etag END, 'last-modified=' || coalesce(modified, day)) END AS headers,
  CASE WHEN verdict = 'resolved' THEN digest END AS body_md5
FROM judged
"""


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.fingerprint_pairs(table(spark, sf_dir, "documents"))
    near = fingerprints.near_counts(prints)
    rows = prints.join(near, "fp", "left")
    asked = F.when(F.col("doc_id") % 100 == 0, F.col("near"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex64("fp").alias("fingerprint"),
        hex64("edited_fp").alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        asked.alias("n_within_3"),
    )


CONTROL = "\\### Assistant: </turn> ok"


def typed_parts() -> Column:
    """A turn's text among other parts: user turns bring an image, an audio or a document by a hash of their place."""
    place = F.xxhash64("conv_id", "turn")
    of = lambda n: F.pmod(place, F.lit(n))
    ref = lambda kind: F.concat_ws("/", F.lit(kind), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    mine = F.col("role") == "user"
    image = chat.part("image", ref=ref("image"), width=64 + of(1900), height=64 + of(1301))
    audio = chat.part("audio", ref=ref("audio"), seconds=of(900) / 8)
    document = chat.part("document", ref=ref("document"), pages=of(40))
    return F.array_compact(
        F.array(
            F.when(mine & (of(3) == 0), image),
            chat.part("text", text=F.col("text")),
            F.when(mine & (of(5) == 0), audio),
            F.when(mine & (of(7) == 0), document),
        )
    )


def op8_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    turns = turns.unionByName(extra).withColumn("parts", typed_parts())
    made = chat.format_conversations(turns)
    read = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(told).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.flatten(F.transform("turns", lambda t: t["placeholders"])).alias("placeholders"),
        F.transform("attachments", lambda a: F.concat(a["type"], F.lit("#"), a["ordinal"].cast("string"))).alias("attached"),
        F.transform("attachments", lambda a: a["ref"]).alias("refs"),
        F.transform("attachments", lambda a: a["n_tokens"]).alias("expanded_tokens"),
    )


def op9_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_folder(spark)
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    return token_files.read_tokens(spark, path)



def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = codebooks.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op11_sql(rounds: int = 4) -> str:
    steps = [
        """kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
          list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
          WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))))""",
        """pieces AS MATERIALIZED (SELECT row, vec_id, label, part,
          list_slice(v, part * len(v) // 4 + 1, (part + 1) * len(v) // 4) AS x FROM kept, range(4) r(part))""",
        "book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x AS e FROM pieces WHERE row <= 256)",
    ]
    far = "list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e)"
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (SELECT row, part, any_value(vec_id) AS vec_id, any_value(label) AS label,
              any_value(x) AS x, min(struct_pack(d := {far}, entry := entry)) AS m
              FROM pieces JOIN book{k} USING (part) GROUP BY row, part)"""
        )
        if k < rounds:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(n.e, b.e) AS e FROM book{k} b LEFT JOIN
                  (SELECT part, entry, list(floor(total / n) ORDER BY place) AS e FROM
                    (SELECT part, m.entry AS entry, place, sum(x[place]) AS total, count(*) AS n FROM near{k},
                      range(1, 1 + (SELECT max(len(x)) FROM pieces)) r(place) GROUP BY ALL) GROUP BY part, entry) n
                  ON n.part = b.part AND n.entry = b.entry)"""
            )
    return f"""WITH {", ".join(steps)},
coded AS (SELECT any_value(vec_id) AS vec_id, any_value(label) AS label,
  string_agg(lower(printf('%02x', m.entry)), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda z: CAST(CAST(z AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, entry))
   FROM book{rounds}) AS codebooks_sha256 FROM coded"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
words AS (SELECT row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
seen AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, sum(c) AS n FROM seen GROUP BY ALL),
groups AS (SELECT g.lang, g.source, coalesce(n, 0) AS n, coalesce(v, 0) AS v FROM
    (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN n USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 5) // (n + 5 * v) AS BIGINT) AS p
    FROM groups g JOIN kept k ON k.lang = g.lang
    LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
q AS (SELECT s.lang, s.term, CAST(1 + CAST(1000000000 AS HUGEINT) * (sum(c) + 5) // (any_value(m.n) + 5 * any_value(v)) AS BIGINT) AS q
    FROM seen s JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM groups GROUP BY lang) m ON m.lang = s.lang
    GROUP BY s.lang, s.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT p.lang, source, 'term', p.term, abs(p - q) FROM p JOIN q ON q.lang = p.lang AND q.term = p.term
      WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 50
"""


def op13_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_passes.dedup(table(spark, sf_dir, "embeddings"), threshold=0.93)


# Links by comparing all vectors of a label, and each vector's reach along them.
OP13_SQL = """
WITH RECURSIVE given AS (SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fine AS (SELECT * FROM given WHERE label IS NOT NULL AND list_bool_and(list_transform(e, lambda x: coalesce(isfinite(x), false)))
  AND list_bool_or(list_transform(e, lambda x: x <> 0))),
links AS MATERIALIZED (SELECT a.row AS a, b.row AS b FROM fine a JOIN fine b ON a.label = b.label AND a.row <> b.row
  AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT row AS a, row AS b FROM given UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN given ON given.row = b GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM given JOIN least ON least.a = given.row LEFT JOIN n ON n.a = given.row
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_balanced_mix,
        op2_ngram_quality,
        op3_url_rules,
        op4_near_dedup,
        op5_cotraining,
        op6_revisits,
        op7_fingerprints,
        op8_chat_parts,
        op9_residual_packing,
        op10_token_files,
        op11_orchard_codes,
        op12_source_divergence,
        op13_projection_dedup,
    )
}

SQL: dict[str, str] = {"op6_revisits": OP6_SQL, "op11_orchard_codes": _op11_sql(), "op12_source_divergence": OP12_SQL, "op13_projection_dedup": OP13_SQL}
