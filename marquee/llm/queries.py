"""Queries over the operators of this package, each over its whole table, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import collocations, cuckoo, importance, lines, nbest, packing, parity, quality, records, secrets, simhash, surrogates, warc
from marquee.llm.common import UPPER, scratch_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), path, end_id=0)
    found = records.with_global_starts(records.read_records(spark, path), records.read_index(spark, path))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "intact")


@_query
def op2_pigeonhole_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


@_query
def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = warc.read_archive(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


_BITS = ", ".join(
    f"substr('{warc.BASE32}', 1 + ((('0x' || substr(d, {1 + 5 * i}, 5))::INTEGER >> {shift}) & 31), 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)
ORACLES["op3_warc_archive"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, body, sha1(body) AS d, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, strlen(body) AS payload_bytes, concat({_BITS}) AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to, true AS verified
FROM q"""


@_query
def op4_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), capacity=1024, end_id=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query
def op5_keyed_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(table(spark, sf_dir, "documents"), secret="a key that only its owner knows")


@_query
def op6_likelihood_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.verdicts(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@_query
def op10_secret_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = secrets.span_string(secrets.base_spans(F.col("spans")))
    return found.select(
        "doc_id",
        *(secrets.kind_count(F.col("spans"), kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(base, 256).alias("base_sha256"),
        secrets.span_string(F.col("spans")).alias("spans"),
    )


@_query
def op7_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cuckoo.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", F.col("live").alias("group_size"), "kept", F.lower(F.hex("key")).alias("text_sha256")
    )


ORACLES["op7_cuckoo_dedup"] = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g"""


@_query
def op8_nbest_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nbest.nbest_segments(table(spark, sf_dir, "documents"), n=4)
    return found.select("doc_id", "rank", "score", "n_pieces", F.crc32("ids").alias("ids_crc32"), "round_trip")


@_query
def op9_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"), "bitmap")


ORACLES["op9_line_bitmaps"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  '{UPPER}', '{UPPER.lower()}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keep_id AS lost
  FROM k LEFT JOIN c ON k.key = c.key),
r AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM m WHERE lost),
i AS (SELECT doc_id, island, min(pos) AS start, count(*) AS len FROM r GROUP BY doc_id, island),
b AS (SELECT doc_id, string_agg(start || '+' || len, ',' ORDER BY start) AS bitmap FROM i GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256 FROM m GROUP BY doc_id)
SELECT t.doc_id, n_lines, n_dropped, kept_sha256, coalesce(bitmap, '') AS bitmap FROM t LEFT JOIN b ON t.doc_id = b.doc_id"""


@_query
def op11_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.similar_documents(table(spark, sf_dir, "documents"), size=4, percent=85)


ORACLES["op11_parity_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM d),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS shingle FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
l AS MATERIALIZED (SELECT u, v FROM i JOIN n AS a ON a.doc_id = u JOIN n AS b ON b.doc_id = v WHERE 100 * common >= 85 * (a.n + b.n - common)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.v FROM r JOIN l ON l.u = r.reached)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""


@_query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), most=2000, least=30, longest=4, covered=80)


ORACLES["op12_phrase_collocations"] = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, list_slice(words, i, i + k - 1) AS ws, count(*) AS n FROM g GROUP BY ALL),
a AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE len(ws) = 1 GROUP BY lang),
c AS (SELECT lang, ws, n FROM f WHERE len(ws) > 1 AND n >= 30),
j AS (SELECT lang, ws, n, unnest(range(1, len(ws))) AS cut FROM c),
s AS (SELECT j.lang, j.ws, j.n, j.cut, l.n AS l, r.n AS r, 2000000::HUGEINT * j.n // (l.n + r.n) AS score
  FROM j JOIN f AS l ON l.lang = j.lang AND l.ws = list_slice(j.ws, 1, cut)
  JOIN f AS r ON r.lang = j.lang AND r.ws = list_slice(j.ws, cut + 1, len(j.ws))),
b AS (SELECT lang, ws, n AS a, l, r, score::BIGINT AS score FROM s
  QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, cut) = 1),
u AS (SELECT lang, ws, n, x, unnest(range(1, len(ws) - x + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS x) WHERE len(ws) > x),
m AS (SELECT lang, list_slice(ws, i, i + x - 1) AS ws, max(n) AS most FROM u GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN m ON m.lang = b.lang AND m.ws = b.ws WHERE most IS NULL OR 100 * most < 80 * a),
o AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, score FROM k)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, o.a DESC, phrase) AS rank, phrase, o.a, l, r, a.n, score
FROM o JOIN a ON a.lang = o.lang QUALIFY rank <= 2000"""


@_query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5, least_words=20)
    return found.select("doc_id", "n_features", "weight", "score", "rank")
