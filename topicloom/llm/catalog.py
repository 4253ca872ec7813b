"""Registered queries of the training-data operators, with DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import byte_bpe as T
from topicloom.llm import centroid_scan as C
from topicloom.llm import decontaminate as D
from topicloom.llm import hidden_markov as S
from topicloom.llm import kneser_ney as Q
from topicloom.llm import language_cnn as N
from topicloom.llm import line_runs as L
from topicloom.llm import max_sketch as R
from topicloom.llm import minhash_forest as H
from topicloom.llm import packing as P
from topicloom.llm import rans_tokens as A
from topicloom.llm import sparse_suffixes as X
from topicloom.llm import warc as W
from topicloom.llm.staging import folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op2_decontamination(spark, sf):
    found = D.find_contamination(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
        (c["n_hit"] > 0).alias("contaminated"),
    )


ORACLE["op2_decontamination"] = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id::VARCHAR AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'i', item_id::VARCHAR, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), listed AS (
  SELECT kind, id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lowered
), item_windows AS (
  SELECT DISTINCT id AS item, least(len(w), 10) AS size, array_to_string(w[pos : pos + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM listed WHERE kind = 'i' AND len(w) > 0)
), doc_windows AS (
  SELECT id, pos, size, array_to_string(w[pos : pos + size - 1], ' ') AS win
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS pos
        FROM listed, (SELECT DISTINCT size FROM item_windows) WHERE kind = 'd' AND len(w) >= size)
), found AS (
  SELECT d.id, d.pos, d.size, i.item FROM doc_windows d JOIN item_windows i USING (size, win)
), hits AS (
  SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(pos, pos + size)) AS p FROM found) GROUP BY id
), items AS (
  SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY id
)
SELECT doc_id, len(l.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents
JOIN listed l ON l.kind = 'd' AND l.id = doc_id::VARCHAR
LEFT JOIN hits ON hits.id = l.id LEFT JOIN items ON items.id = l.id
"""


@query
def op7_byte_bpe(spark, sf):
    return T.encode_documents(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "tokens.*")


@query
def op1_language_id(spark, sf):
    found = N.identify(table(spark, sf, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", N.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "language.*")


@query
def op5_line_dedup(spark, sf):
    kept = L.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "lines.n_lines", "lines.n_removed", F.size("lines.runs").cast("bigint").alias("n_runs"), F.sha2("text", 256).alias("text_sha256"))


ORACLE["op5_line_dedup"] = r"""
WITH listed AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), sized AS (
  SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM listed
), placed AS (
  SELECT *, sum(length(lines[pos]) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(lines[pos]) - 1 AS start,
         sum(length(lines[pos]) + 1) OVER (PARTITION BY doc_id) AS total
  FROM sized
), runs AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING) AS n FROM placed
), named AS (
  SELECT doc_id, pos, n, array_to_string(lines[pos : pos + n - 1], chr(10)) AS run FROM runs WHERE total - start >= 50
), copies AS (
  SELECT doc_id, pos, n, row_number() OVER (PARTITION BY n, run ORDER BY doc_id, pos) AS copy FROM named
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM copies WHERE copy > 1
), kept AS (
  SELECT s.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
         coalesce(string_agg(lines[s.pos], chr(10) ORDER BY s.pos) FILTER (WHERE g.pos IS NULL), '') AS text
  FROM sized s LEFT JOIN gone g USING (doc_id, pos) GROUP BY s.doc_id
), starts AS (
  SELECT doc_id, count(*) AS n_runs FROM gone g
  WHERE NOT EXISTS (SELECT 1 FROM gone h WHERE h.doc_id = g.doc_id AND h.pos = g.pos - 1) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_runs, 0)::BIGINT AS n_runs, sha256(k.text) AS text_sha256
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN starts USING (doc_id)
"""


@query
def op4_minhash_forest(spark, sf):
    found = H.find_groups(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE["op4_minhash_forest"] = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[pos : pos + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM listed WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS v, doc_id AS root FROM documents
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.v
), least AS (
  SELECT v, min(root) AS component_id FROM reach GROUP BY v
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least ON least.v = d.doc_id
"""


@query
def op8_kneser_ney(spark, sf):
    found = Q.judge(table(spark, sf, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity", "word_log_perplexity")


@query
def op6_hidden_markov(spark, sf):
    return S.score(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op3_rans_tokens(spark, sf):
    return A.round_trip(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op9_sparse_suffixes(spark, sf):
    found = X.find_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    words = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", words.alias("n_repeated"), F.size("spans").cast("bigint").alias("n_spans"))


ORACLE["op9_sparse_suffixes"] = r"""
WITH listed AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), passages AS (
  SELECT doc_id, pos, hash(array_to_string(w[pos : pos + 49], ' ')) AS a, md5_number_lower(array_to_string(w[pos : pos + 49], ' ')) AS b
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM listed WHERE len(w) >= 50)
), copies AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, pos) AS copy FROM passages
), hit AS (
  SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM copies WHERE copy > 1
), spans AS (
  SELECT doc_id, count(*) FILTER (WHERE before IS NULL OR pos > before + 50) AS n_spans,
         sum(CASE WHEN before IS NULL THEN 50 ELSE least(50, pos - before) END) AS n_repeated
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_repeated, 0)::BIGINT AS n_repeated, coalesce(n_spans, 0)::BIGINT AS n_spans
FROM listed LEFT JOIN spans USING (doc_id)
"""


@query
def op10_warc_derivatives(spark, sf):
    """Per page the ids that link its response, metadata and conversion records, from the files they were written to."""
    pages = table(spark, sf, "pages")
    path = folder(spark)
    W.write_files(W.derivatives(W.responses(pages)), path)
    read = W.read_files(spark, path)
    meta = F.from_json(
        "block",
        "source struct<warc:array<array<string>>>, payload struct<stated:string,computed:string,length:bigint>, conversion string, title string, links array<string>",
    )
    kinds = {k: F.col("kind") == k for k in ("metadata", "conversion")}
    own = read.withColumn("m", F.when(kinds["metadata"], meta))
    # a response has one record of each kind; rows that repeat a page repeat its records
    values = {
        "page_id": F.get(F.filter("m.source.warc", lambda h: h[0] == W.PAGE), 0)[1].cast("bigint"),
        "metadata_id": F.when(kinds["metadata"], F.col("record_id")),
        "conversion_id": F.when(kinds["conversion"], F.col("record_id")),
        "named": F.col("m.conversion"),
        "url": F.col("target_uri"),
        "payload_digest": F.col("m.payload.stated"),
        "computed": F.col("m.payload.computed"),
        "payload_bytes": F.col("m.payload.length"),
        "title": F.col("m.title"),
        "n_links": F.when(kinds["metadata"], F.size("m.links")).cast("bigint"),
        "text_chars": F.when(kinds["conversion"], F.length("block")).cast("bigint"),
        "text_sha256": F.when(kinds["conversion"], F.sha2("block", 256)),
    }
    flat = own.select("refers_to", *[v.alias(k) for k, v in values.items()])
    both = flat.groupBy(F.col("refers_to").alias("response_id")).agg(*[F.max(k).alias(k) for k in values], F.count("metadata_id").alias("rows"))
    return both.withColumn("row", F.explode(F.sequence(F.lit(1), "rows"))).select(
        "page_id",
        "response_id",
        "metadata_id",
        "conversion_id",
        (F.col("named") == F.col("conversion_id")).alias("linked"),
        "url",
        "payload_digest",
        (F.col("payload_digest") == F.col("computed")).alias("digest_agrees"),
        "payload_bytes",
        "title",
        "n_links",
        "text_chars",
        "text_sha256",
    )


@query
def op11_centroid_scan(spark, sf):
    found, centroids = C.cluster(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    digest = F.sha2(F.array_join(F.transform("centroid", lambda v: v.cast("string")), ","), 256)
    about = centroids.select("cluster", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds(rounds: int = 5) -> str:
    """Statement of the rounds of ``op11``: assign, then move; a common table for each."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, c, d FROM (
    SELECT vec_id, c, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS place
    FROM (SELECT vec_id, c, sum((p.v - q.v) * (p.v - q.v))::BIGINT AS d FROM parts p JOIN c{r} q USING (i) GROUP BY vec_id, c)
  ) WHERE place = 1
)""")
        if r < rounds:
            steps.append(f"""s{r} AS MATERIALIZED (SELECT c, i, sum(v)::BIGINT AS s, count(*) AS n FROM a{r} JOIN parts USING (vec_id) GROUP BY c, i),
c{r + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n + n) % n)) // n, v) AS v FROM c{r} LEFT JOIN s{r} USING (c, i)
)""")
    return ",\n".join(steps)


ORACLE["op11_centroid_scan"] = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x, sha256('2:' || vec_id) AS h FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
), parts AS MATERIALIZED (
  SELECT vec_id, unnest(range(64)) AS i, unnest(x) AS v FROM kept
), c0 AS MATERIALIZED (
  SELECT c, unnest(range(64)) AS i, unnest(x) AS v FROM (SELECT row_number() OVER (ORDER BY h) - 1 AS c, x FROM kept QUALIFY c < 40)
), {_rounds()}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a5 JOIN (SELECT c, sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY c) USING (c)
"""


@query
def op12_max_sketch(spark, sf):
    index = R.build_index(table(spark, sf, "documents").select("doc_id", "text"))
    return R.search(index, table(spark, sf, "benchmark").select("item_id", "text")).select("item_id", "rank", "doc_id", "score")


ORACLE["op12_max_sketch"] = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents
  UNION ALL
  SELECT 'i', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark
), counted AS MATERIALIZED (
  SELECT kind, id, t, count(*) AS tf FROM words GROUP BY ALL
), sizes AS MATERIALIZED (
  SELECT id, sum(tf)::BIGINT AS n FROM counted WHERE kind = 'd' GROUP BY id
), whole AS MATERIALIZED (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM sizes
), norms AS (
  SELECT id, 100 - 75 + (75 * n * docs) // length AS m FROM sizes, whole
), weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counted, whole WHERE kind = 'd' GROUP BY t, docs
), scored AS (
  SELECT i.id AS item_id, d.id AS doc_id, sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m)))::BIGINT AS score
  FROM counted i JOIN counted d ON i.kind = 'i' AND d.kind = 'd' AND i.t = d.t JOIN weights ON weights.t = i.t JOIN norms ON norms.id = d.id
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


@query
def op13_tier_packing(spark, sf):
    return P.pieces(P.pack(table(spark, sf, "documents").select("doc_id", "text")))
