"""The registered queries of the operators in this package, each beside its SQL if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from millrace.llm import arrow_files, prepared
from millrace.llm.bpe import decoded, encoded
from millrace.llm.covertree import top_products
from millrace.llm.html import extract
from millrace.llm.mixing import mix
from millrace.llm.packing import pack, pieces
from millrace.llm.quality import quality_scores
from millrace.llm.runs import periodic_runs
from millrace.llm.simhash import simhash_components
from millrace.llm.substrings import substring_dedup
from millrace.llm.toxicity import toxicity_scores
from millrace.llm.vectors import vector_components
from millrace.llm.whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash of 4-word shingles and its component at 4 bits or fewer."""
    docs = table(spark, sf_dir, "documents")
    found = simhash_components(docs, "doc_id", "text", words=4, max_bits=4, keep=["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("_sim_print"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenized and cut at 2048 tokens, packed into sequences of 2048."""
    cut = pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0, keep=["doc_id"])
    return pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=2048)


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of passages of 35 words that occur elsewhere too."""
    found = substring_dedup(table(spark, sf_dir, "documents"), "doc_id", "text", window=35, keep=["doc_id"])
    return found.select("doc_id", F.col("_sub_words").alias("n_words"), F.col("_sub_removed").alias("n_removed"), F.sha2("_sub_kept", 256).alias("kept_sha256"))


ORACLES["op4_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT r, unnest(range(1, greatest(len(w) - 33, 1))) AS i, w FROM d WHERE len(w) >= 35
), h AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM s
), twice AS (
  SELECT h FROM h GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT r, i + unnest(range(35)) AS p FROM h WHERE h IN (SELECT h FROM twice)
), kept AS (
  SELECT k.r, string_agg(k.x, ' ' ORDER BY k.p) AS t, count(*) AS n
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) k
  LEFT JOIN gone g ON g.r = k.r AND g.p = k.p WHERE g.r IS NULL GROUP BY k.r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.r = d.r
"""


@query
def op5_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as Arrow files of 2048-token sequences, and read back from them."""
    docs, folder = table(spark, sf_dir, "documents"), arrow_files.new_folder(spark)
    manifest = arrow_files.write_arrow(docs, public_tokenizers.path("byte_bpe_50k.json"), folder, length=2048, end_id=0)
    found = arrow_files.read_documents(manifest, folder, docs.schema["doc_id"].dataType)
    return found.select(F.col("id").alias("doc_id"), "start", F.col("tokens").alias("n_tokens"), "ids_crc32")


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents with weights 1, 2, 3 along the sources and a stop at 3 times a source."""
    taken = mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3.0, keep=["doc_id"])
    return taken.select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_times")).cast("bigint").alias("taken"),
    )


ORACLES["op7_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s
), k AS (
  SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS k FROM w
), c AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
    coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS stopped,
    sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS rest FROM k
), lvl AS (
  SELECT (total - stopped) / rest AS lvl FROM c WHERE (total - stopped) / rest * weight <= 3.0::DOUBLE * source_size ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, lvl * weight) AS target FROM k, lvl
), b AS (
  SELECT *, least(3, floor(target / greatest(source_size, 1))) AS whole FROM t
), h AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, b.target - b.whole * b.source_size AS part, b.source,
    substr(md5('mix/' || coalesce(d.doc_id::VARCHAR, '') || '/' || d.size::VARCHAR), 1, 15) AS h
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
), m AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY source, h) AS own FROM h
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN part > 0 AND 2 * upto - own < 2 * part THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m
"""


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"), "html", "url", keep=["page_id", "url"])


@query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings of equal label with a cosine of 0.93 or more, and their components."""
    found = vector_components(table(spark, sf_dir, "embeddings"), threshold=0.93, keep=["vec_id"])
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


ORACLES["op3_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_sum([abs(x) FOR x IN embedding]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), n AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), reach AS (
  SELECT a AS id, a AS root FROM n
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id
), c AS (
  SELECT id, min(root) AS root FROM reach GROUP BY id
)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.root, e.vec_id) AS component_id,
  coalesce(c.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.id = e.vec_id
"""


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of floor(256 x) for every 50th vector, against all others."""
    rows = table(spark, sf_dir, "embeddings")
    return top_products(rows, rows.where("vec_id % 50 = 0"), k=5, scale=256.0)


ORACLES["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of three quarters of the ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity_scores(docs, labels, divisor=4, held=2, keep=["doc_id"])


@query
def op8_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels of four fifths of the ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_scores(docs, labels, divisor=5, held=0, keep=["doc_id"])


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 32 components of all vectors, each with variance 1."""
    found = whitened(table(spark, sf_dir, "embeddings"), components=32, scale=64.0, offset=1_000_000)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "on")
    return found.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "on.whitened", "on.explained", "identity_error"
    )


def _planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words of a tenth of the documents repeat with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.expr("nullif(greatest(size(words), 0), 0)")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    chosen = chosen.withColumn("n", n).withColumn("a", a).withColumn("p", p)
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.flatten(F.array_repeat(block, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    changed = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), again), F.lit(1), F.col("n"))
    return chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of 4 periods and 6 words or more of every document, and its words without their repeats."""
    found = periodic_runs(_planted(table(spark, sf_dir, "documents")), least=6, repeats=4, keep=["doc_id"])
    best = F.array_max(F.transform("_run_found", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("_run_found", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("_run_found").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("_run_kept", 256).alias("collapsed_sha256"),
    )


@query
def op13_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and the text that they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = encoded(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    found = decoded(ids, path)
    size = (F.octet_length("_bpe_ids") / 4).cast("bigint")
    return found.select("doc_id", size.alias("n_tokens"), F.sha2("_bpe_ids", 256).alias("ids_sha256"), F.sha2("_bpe_decoded", 256).alias("decoded_sha256"))
