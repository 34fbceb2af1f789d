"""The operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    collocations, exact_dedup, filter_audit, license_scan, lm_scoring, minhash_dedup, packing, quality_classifier, quality_rules,
    sentencepiece_codec, simhash_dedup, substring_dedup, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def held_out(modulus: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus == remainder


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    model = quality_classifier.fit(docs, labels)
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query("op2_sentencepiece")
def op2_sentencepiece(spark, sf_dir):
    model = tokenizer("piece_bpe_32k.model")
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(documents(spark, sf_dir), model), model)
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), "\u2581", " ")
    return coded.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), same.alias("round_trip"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    kept = substring_dedup.dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op4_license_scan")
def op4_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(documents(spark, sf_dir)).drop("text")


@query("op5_lm_scoring")
def op5_lm_scoring(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = lm_scoring.fit_and_score(docs, ~held_out(7, 2))
    return scored.select("doc_id", held_out(7, 2).alias("held_out"), *lm_scoring.RESULTS.replace(" long", "").replace(" double", "").split(", "))


@query("op6_packing")
def op6_packing(spark, sf_dir):
    packed = packing.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op7_minhash_dedup")
def op7_minhash_dedup(spark, sf_dir):
    return minhash_dedup.dedup(documents(spark, sf_dir))


@query("op8_exact_dedup", """SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM (
  SELECT doc_id, n, max(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size FROM (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n FROM documents))""")
def op8_exact_dedup(spark, sf_dir):
    rows = exact_dedup.dedup(documents(spark, sf_dir))
    return rows.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


@query("op9_warc_derivatives")
def op9_warc_derivatives(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    made = warc.derivatives(warc.responses(pages))
    return made.withColumn("block", F.decode("block", "utf-8"))


@query("op10_quality_rules")
def op10_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query("op11_collocations", r"""WITH w AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
runs AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
inner_ AS (SELECT DISTINCT lang, a AS b, array_to_string(ws[i:j], ' ') AS phrase FROM (
  SELECT lang, a, ws, k, i, unnest(range(i + 1, k + 1)) AS j FROM (SELECT lang, a, ws, k, unnest(range(1, k)) AS i FROM cand))
  WHERE j - i + 1 < k),
covered AS (SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_ i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE 100 * i.b::HUGEINT >= 80 * c.a::HUGEINT),
cuts AS (SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, cut, (2000000 * c.a::HUGEINT) // (x.f::HUGEINT + y.f) AS score FROM (
    SELECT lang, phrase, a, ws, k, unnest(range(1, k)) AS cut FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT b.*, t.n, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b JOIN totals t ON b.lang = t.lang ANTI JOIN covered v ON v.lang = b.lang AND v.phrase = b.phrase) WHERE rank <= 2000""")
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


@query("op12_filter_audit", r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
f AS (SELECT part, doc_id, len(ws) < 200 AS A, 100 * len(list_distinct(ws)) < 50 * len(ws) AS B,
  100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) AS C, regexp_matches(t, '[#$%&*|]') AS D,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS E FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN A THEN 'A' ELSE '' END, CASE WHEN B THEN 'B' ELSE '' END, CASE WHEN C THEN 'C' ELSE '' END,
    CASE WHEN D THEN 'D' ELSE '' END, CASE WHEN E THEN 'E' ELSE '' END) AS mask, count(*) AS n,
  sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT concat(c1.c, c2.c, c3.c, c4.c, c5.c) AS o FROM c c1, c c2, c c3, c c4, c c5
  WHERE len(list_distinct([c1.c, c2.c, c3.c, c4.c, c5.c])) = 5),
steps AS (SELECT part, o, s, o[s] AS x FROM (SELECT DISTINCT part FROM m), o, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
r AS (SELECT p.part, p.o, p.s, p.x,
  coalesce(sum(n) FILTER (strpos(mask, x) > 0 AND len(translate(mask, o[1:s - 1], '')) = len(mask)), 0) AS removed,
  coalesce(sum(n) FILTER (len(translate(mask, o[1:s], '')) = len(mask)), 0) AS kept,
  coalesce(sum(n) FILTER (strpos(mask, x) > 0 AND len(translate(mask, o[1:s - 1], '')) < len(mask)), 0) AS redundant,
  coalesce(sum(n) FILTER (mask = x), 0) AS unique_fails,
  coalesce(sum(good) FILTER (strpos(mask, x) > 0 AND len(translate(mask, o[1:s - 1], '')) = len(mask)), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (strpos(mask, x) > 0 AND len(translate(mask, o[1:s - 1], '')) = len(mask)), 0) AS toxic_lost
  FROM steps p JOIN m ON p.part = m.part GROUP BY ALL)
SELECT part, o AS filter_order, s::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM r""")
def op12_filter_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filter_audit.filter_audit(docs, table(spark, sf_dir, "labels"))


@query("op13_simhash_dedup")
def op13_simhash_dedup(spark, sf_dir):
    return simhash_dedup.dedup(documents(spark, sf_dir))
