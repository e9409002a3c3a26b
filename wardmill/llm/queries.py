"""The dealt queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm import (
    arc_to_warc,
    decontaminate,
    embedding_dedup,
    language,
    main_text,
    merkle,
    mixing,
    preferences,
    quality,
    toxicity,
    url_filter,
    weighted_minhash,
    whitening,
)
from wardmill.llm.shared import importable_in_tasks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(build):
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable_in_tasks(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return run


def learned_from(id_: str = "doc_id"):
    """Four in five ids; the others are held out."""
    return F.crc32(F.col(id_).cast("string")) % 5 != 0


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    ids = F.transform("contamination.items", lambda x: x.cast("string"))
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"),
    )


@_query
def op5_weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = weighted_minhash.near_duplicates(_table(spark, folder, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def _classified(docs: DataFrame, model, threshold: float) -> DataFrame:
    scored = toxicity.with_scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (~learned_from()).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@_query
def op6_counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return _classified(docs, toxicity.train(docs, _table(spark, folder, "labels"), use=learned_from()), 0.5)


@_query
def op8_subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return _classified(docs, quality.train(docs, _table(spark, folder, "labels"), use=learned_from()), 0.3)


@_query
def op10_rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_dedup.near_duplicate_vectors(_table(spark, folder, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


#: The rules of the URL query.
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


@_query
def op1_arc_to_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = arc_to_warc.pages_through_archives(_table(spark, folder, "pages"))
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_key").cast("long").alias("refers_to"))


@_query
def op3_preferences(spark: SparkSession, folder: str) -> DataFrame:
    talks = preferences.conversations(_table(spark, folder, "conversations"))
    found = preferences.formatted(preferences.pairs(talks))
    spans = lambda side: F.array_join(F.transform(f"{side}_spans", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select("chosen_id", "rejected_id", F.col("n_common").cast("long").alias("n_common"), "prompt", "chosen_text", "rejected_text",
                        spans("chosen").alias("chosen_spans"), spans("rejected").alias("rejected_spans"))


@_query
def op4_url_words(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    counts = url_filter.count_table(main_text.whole_texts(pages), "text")
    found = url_filter.judged_by_table(pages.select("page_id", "url"), URL_RULES, counts)
    return found.select("page_id", "host", "path", "rule", "verdict")


@_query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixture = mixing.mix(_table(spark, folder, "documents"))
    own = lambda values, kind: mixing.pick(values, F.col("src"), kind)
    return mixture.taken().select(F.col("id").alias("doc_id"), "size", own([s.words for s in mixture.sources], "bigint").alias("source_size"),
                                  own([s.target for s in mixture.sources], "double").alias("target"), "taken")


@_query
def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = main_text.with_main_text(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op11_subword_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = language.with_language(docs.select("doc_id", "text"), language.train(docs, use=~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


@_query
def op12_midstate_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = merkle.leaf_digest(*own[:3], F.try_add("n_chars", F.lit(1)), own[4])
    leaves = docs.select(merkle.group_key(F.col("lang")).alias("grp"), F.col("doc_id").alias("id"), merkle.leaf_digest(*own).alias("digest"),
                         F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, tampered).alias("replaced"))
    found = merkle.manifest(leaves)
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return found.select(F.col("id").alias("doc_id"), text("leaf"), text("subroot"), text("root"), F.sha2("proof", 256).alias("proof_sha256"),
                        text("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


@_query
def op13_secular_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    error = None if model is None else whitening.identity_error(vectors, model)
    return whitening.whitened_rows(vectors, model).withColumnRenamed("id", "vec_id").withColumn("identity_error", F.lit(error).cast("double"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op1_arc_to_warc"] = """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN strlen(h) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(h) >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, MIN(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages) p
"""

SQL["op2_winnowing"] = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bi),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) x WHERE len(w) >= n),
m AS (SELECT di.doc_id, di.i, di.n, bw.item_id FROM di JOIN bw ON di.n = bw.n AND array_to_string(di.w[di.i:di.i + di.n - 1], ' ') = bw.g),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM m),
hit AS (SELECT doc_id, COUNT(*) AS n_hit FROM p GROUP BY 1),
ids AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list
  FROM (SELECT DISTINCT doc_id, item_id FROM m) u GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  sha256(COALESCE(list, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

SQL["op10_rotated_codes"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND list_count(embedding) = len(embedding) AND isfinite(list_sum(embedding))
  AND (list_max(embedding) > 0 OR list_min(embedding) < 0)),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
n AS (SELECT a, COUNT(*) AS n_links FROM l GROUP BY 1), c AS (SELECT a, MIN(b) AS component_id FROM reach GROUP BY 1)
SELECT e.vec_id, COALESCE(n_links, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""


_SIDE = """(SELECT chosen_id, string_agg(shown, '' ORDER BY k) FILTER (k > n_common) AS text,
  string_agg(CAST(before + length(role) + 5 AS VARCHAR) || '-' || CAST(before + length(shown) - 1 AS VARCHAR), ',' ORDER BY k)
    FILTER (k > n_common AND role = 'assistant') AS spans, string_agg(shown, '' ORDER BY k) FILTER (k <= n_common) AS prompt
  FROM (SELECT *, COALESCE(SUM(CASE WHEN k > n_common THEN length(shown) ELSE 0 END) OVER (PARTITION BY chosen_id ORDER BY k
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM (SELECT x.*, n_common, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown FROM {} x JOIN n USING (chosen_id)) s) r GROUP BY 1)"""

SQL["op3_preferences"] = f"""
WITH o AS (SELECT conv_id AS id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT id, MAX(k) AS last FROM o WHERE role = 'assistant' GROUP BY 1),
c AS (SELECT o.*, last FROM o JOIN l USING (id) WHERE k <= last),
f AS (SELECT role, text, MIN(id) AS first FROM c WHERE k = 1 GROUP BY 1, 2),
p AS (SELECT c.id AS chosen_id, CASE WHEN first <> c.id THEN first END AS rejected_id, last FROM c JOIN f USING (role, text) WHERE c.k = 1),
w AS (SELECT id, arg_max(text, k) AS worse FROM c WHERE role = 'assistant' AND k < last GROUP BY 1),
ch AS (SELECT chosen_id, k, role, text FROM p JOIN c ON c.id = chosen_id),
rj AS (SELECT chosen_id, k, role, text FROM p JOIN c ON c.id = rejected_id
  UNION ALL SELECT chosen_id, k, role, CASE WHEN k = p.last THEN coalesce(worse, '') ELSE text END
  FROM p JOIN c ON c.id = chosen_id LEFT JOIN w ON w.id = chosen_id WHERE rejected_id IS NULL),
n AS (SELECT chosen_id, COALESCE(MIN(k) FILTER (NOT same) - 1, MAX(k)) AS n_common
  FROM (SELECT chosen_id, k, a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS same
    FROM ch a FULL JOIN rj b USING (chosen_id, k)) j GROUP BY 1),
x AS {_SIDE.format("ch")}, y AS {_SIDE.format("rj")}
SELECT chosen_id, rejected_id, n_common, COALESCE(x.prompt, '') AS prompt, COALESCE(x.text, '') AS chosen_text, COALESCE(y.text, '') AS rejected_text,
  COALESCE(x.spans, '') AS chosen_spans, COALESCE(y.spans, '') AS rejected_spans
FROM p JOIN n USING (chosen_id) JOIN x USING (chosen_id) JOIN y USING (chosen_id)
"""

#: The subquery ``crc`` is the CRC-32 of an id's digits, bit by bit.
SQL["op12_midstate_manifest"] = """
WITH RECURSIVE d AS (SELECT doc_id, lang, n_chars, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
crc AS (SELECT doc_id, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) AS left_over FROM (SELECT DISTINCT doc_id FROM documents)),
h AS (SELECT d.doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN xor(left_over, 4294967295) % 7 = 0 THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS changed
  FROM d LEFT JOIN crc ON crc.doc_id = d.doc_id),
g AS (SELECT lang, ROW_NUMBER() OVER (ORDER BY lang NULLS FIRST) AS grp FROM (SELECT DISTINCT lang FROM d)),
l AS (SELECT h.*, grp, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY grp) AS n
  FROM h JOIN g ON g.lang IS NOT DISTINCT FROM h.lang),
t AS (SELECT 0 AS level, grp, pos, n, leaf AS node FROM l
  UNION ALL SELECT level + 1, grp, pos // 2, (MIN(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY level, grp, pos // 2),
s AS (SELECT grp, node AS subroot, MAX(grp) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, 0 AS grp, grp - 1 AS pos, n, subroot AS node FROM s
  UNION ALL SELECT level + 1, 0, pos // 2, (MIN(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 2),
f AS (SELECT doc_id, leaf, grp, 0 AS level, pos, n, coalesce(changed, leaf) AS value, '' AS proof FROM l
  UNION ALL SELECT f.doc_id, f.leaf, f.grp, f.level + 1, f.pos // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.pos % 2 = 1 THEN t.node || value ELSE value || coalesce(t.node, '') END), proof || coalesce(t.node, '')
  FROM f LEFT JOIN t ON t.grp = f.grp AND t.level = f.level AND t.pos = xor(f.pos, 1) WHERE f.n > 1),
e AS (SELECT f.doc_id, leaf, f.grp, subroot, 0 AS level, f.grp - 1 AS pos, s.n, value, proof FROM f JOIN s USING (grp) WHERE f.n = 1
  UNION ALL SELECT e.doc_id, leaf, e.grp, subroot, e.level + 1, e.pos // 2, (e.n + 1) // 2,
    sha256(CASE WHEN e.pos % 2 = 1 THEN u.node || value ELSE value || coalesce(u.node, '') END), proof || coalesce(u.node, '')
  FROM e LEFT JOIN u ON u.level = e.level AND u.pos = xor(e.pos, 1) WHERE e.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, value AS folded_root, value = root AS verified
FROM e CROSS JOIN (SELECT node AS root FROM u WHERE n = 1) r WHERE e.n = 1
"""
