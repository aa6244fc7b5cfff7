"""The registered queries of this package and the SQL of those that SQL can
express. Each applies its operator, with production parameters, to a whole
table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, brown, collocations, decontaminate, jaccard, linededup, periodic, preference, quality, scratch, topk, toxicity,
               urls, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scratch.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int, id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(n))


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.archive(_table(spark, sf_dir, "pages"), scratch.folder(spark, "warc"))
    segments = max(1, manifest.count())
    return warc.records(warc.read_chunks(manifest.repartition(segments, "archive", "start"), with_data=False))


def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_conversations(_table(spark, sf_dir, "conversations"))


def op3_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(_fold(5) != 0))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", "predicted", "spans")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op5_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op6_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op7_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(_table(spark, sf_dir, "documents"), _fold(7) != 2)


def op8_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op9_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return pairs.groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.repeats(_table(spark, sf_dir, "documents"), lines=True)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``documents`` with h = crc32(doc_id as text), g = floor(h / 10); where 10
    divides h, each word i >= a of the n becomes word a + (i - a) % p, with
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A null id counts as the
    empty string; a null or blank text stays as it is."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    made = (docs.select("doc_id", "text", h.alias("h")).where("h % 10 = 0")
            .select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), words.alias("w"))
            .withColumn("a", F.when(F.size("w") > 0, F.expr("g % nullif(size(w), 0)")).otherwise(0))
            .withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
            .withColumn("w", F.expr("transform(w, (x, i) -> IF(i < a, x, element_at(w, int(1 + a + (i - a) % p))))")))
    return docs.where(h % 10 != 0).select("doc_id", "text").unionAll(made.select("doc_id", F.when(F.size("w") > 0, F.array_join("w", " ")).otherwise(F.col("text"))))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(with_planted_runs(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (found.withColumn("best", periodic.longest()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words"))


def op12_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = "transform(CAST(embedding AS ARRAY<DOUBLE>), x -> IF(isnan(x) OR abs(x) = DOUBLE('Infinity'), x, DOUBLE(floor(1024 * x))))"
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.expr(scaled).alias("embedding"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents")).drop("doc_id", "word")


QUERIES = {f.__name__: f for f in (
    op1_warc_chunks, op2_preference_format, op3_toxic_spans, op4_url_rules, op5_jaccard_rtree, op6_bpe_tree,
    op7_brown_classes, op8_mcd_outliers, op9_minhash_containment, op10_line_dedup,
    op11_periodic_runs, op12_pivot_topk, op13_phrase_collocations)}

ORACLE = {
    "op1_warc_chunks": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first IS NULL OR f.first IS NOT DISTINCT FROM d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first IS NOT NULL AND f.first IS DISTINCT FROM d.page_id THEN f.first END AS refers_to,
       CASE WHEN f.first IS NOT NULL AND f.first IS DISTINCT FROM d.page_id THEN 1
            ELSE greatest(1, (d.payload_bytes + 65535) // 65536) END AS n_chunks,
       TRUE AS verified
FROM d LEFT JOIN f USING (payload_digest)
""",
    "op2_preference_format": """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(pos) FILTER (WHERE role = 'assistant') AS last FROM t GROUP BY conv_id),
c AS (SELECT t.*, coalesce(pos - last, -1) AS rel FROM t JOIN l USING (conv_id)),
p AS (SELECT conv_id, arg_max(text, pos) AS prior FROM c WHERE role = 'assistant' AND rel < 0 GROUP BY conv_id),
s AS (SELECT conv_id, pos, role, text, 'chosen' AS side FROM c WHERE rel <= 0
      UNION ALL SELECT conv_id, pos, role, CASE WHEN rel = 0 THEN prior ELSE text END, 'rejected'
      FROM c LEFT JOIN p USING (conv_id) WHERE rel < 0 OR rel = 0 AND prior IS NOT NULL),
d AS (SELECT conv_id, min(CASE WHEN n < 2 OR x > 1 THEN pos END) AS first
      FROM (SELECT conv_id, pos, count(*) AS n, count(DISTINCT role || chr(0) || text) AS x FROM s GROUP BY conv_id, pos) GROUP BY conv_id),
r AS (SELECT *, '<|start|>' || role || chr(10) || text || '<|end|>' || chr(10) AS rendered, length(role) + 10 AS head
      FROM (SELECT s.conv_id, CASE WHEN d.first IS NULL OR pos < d.first THEN 'prompt' ELSE side END AS part, pos, role, text
            FROM s JOIN d USING (conv_id) WHERE side = 'chosen' OR pos >= d.first
            UNION ALL SELECT conv_id, 'trailing', pos, role, text FROM c WHERE rel > 0)),
e AS (SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, part ORDER BY pos)::BIGINT AS "end" FROM r)
SELECT conv_id, part, pos::INTEGER AS pos, role, rendered, "end" - length(rendered) AS "start", "end",
       CASE WHEN part IN ('chosen', 'rejected') AND role = 'assistant' THEN "end" - length(rendered) + head END AS mask_start,
       CASE WHEN part IN ('chosen', 'rejected') AND role = 'assistant' THEN "end" - 1 END AS mask_end
FROM e
""",
    "op9_minhash_containment": r"""
WITH d AS (SELECT doc_id AS id, text AS t, list_filter(string_split_regex(lower(text), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id AS id, text AS t, list_filter(string_split_regex(lower(text), '[ \t-\r]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT id, t, array_to_string(list_slice(w, i, i + 4), ' ') AS sh FROM
       (SELECT id, t, w, unnest(range(1, greatest(len(w) - 3, 2)::BIGINT)) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT id, t, array_to_string(list_slice(w, i, i + 4), ' ') AS sh FROM
       (SELECT id, t, w, unnest(range(1, greatest(len(w) - 3, 2)::BIGINT)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT id, t, count(*) AS n_item FROM bs GROUP BY id, t),
j AS (SELECT ds.id AS doc_id, ds.t AS dt, bs.id AS item_id, bs.t AS bt, count(*) AS n_shared FROM ds JOIN bs USING (sh) GROUP BY ALL)
SELECT doc_id, item_id, n_item, max(n_shared) AS n_shared
FROM j JOIN n ON n.id IS NOT DISTINCT FROM j.item_id AND n.t = j.bt
WHERE 100 * n_shared >= 75 * n_item GROUP BY doc_id, item_id, n_item
""",
    "op12_pivot_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
""",
    "op13_phrase_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS p FROM documents),
o AS (SELECT lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT lang, m, array_to_string(list_slice(w, j, j + m - 1), ' ') AS phrase
      FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS j FROM o CROSS JOIN (VALUES (1), (2), (3), (4)) t(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
t AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
inner_ AS (SELECT lang, a, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase
           FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM c CROSS JOIN (VALUES (2), (3)) t(s) WHERE s < m)),
longer AS (SELECT lang, phrase, max(a) AS b FROM inner_ GROUP BY ALL),
k AS (SELECT c.*, unnest(range(1, m)) AS k FROM c LEFT JOIN longer USING (lang, phrase) WHERE b IS NULL OR 100 * b < 80 * a),
s AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * k.a) // (l.f + r.f))::BIGINT AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(list_slice(k.w, 1, k.k), ' ')
             JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(list_slice(k.w, k.k + 1, k.m), ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN t USING (lang) WHERE rank <= 2000
""",
}
