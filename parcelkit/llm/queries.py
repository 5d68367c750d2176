"""The registered queries of this package: thin contracts over the operators, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from corpus_pipeline import run as pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.llm import (ann, byte_bpe, collision_dedup, conversation_repair, lm_score, packing, quality, simhash, toxicity,
                           url_filter, warc, whitening)
from parcelkit.llm import exact_dedup as exact
from parcelkit.llm.common import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), width=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM cut),
parsed AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM split),
rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (SELECT p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS ruled
  FROM (SELECT DISTINCT host, path FROM parsed) p JOIN rules r ON ('.' || p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path) GROUP BY ALL),
urls AS (SELECT p.*, rule, ruled FROM (SELECT host, path, count(*)::double AS n, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs
  FROM parsed GROUP BY host, path) p LEFT JOIN fits USING (host, path)),
walk AS (
  SELECT host, path, n, segs, '' AS node, NULL::varchar AS parent, 0 AS k FROM urls
  UNION ALL
  SELECT host, path, n, CASE WHEN alone THEN segs[:k + 1] ELSE segs END, node || '/' || CASE WHEN alone THEN '**'
      WHEN own >= 2 AND own >= 0.02::double * every THEN seg WHEN regexp_full_match(seg, '[0-9]+([.][a-z]+)?') THEN '#' ELSE '*' END, node, k + 1
  FROM (SELECT *, segs[k + 1] AS seg, sum(n) OVER (PARTITION BY host, node, segs[k + 1]) AS own, sum(n) OVER (PARTITION BY host, node) AS every,
      count(*) OVER (PARTITION BY host, node) = 1 AS alone FROM walk WHERE len(segs) > k)),
counts AS (SELECT host, node, parent, k, sum(CASE WHEN ruled IS NULL THEN 0 ELSE n END) AS l, sum(CASE WHEN ruled = 'block' THEN n ELSE 0 END) AS b
  FROM walk JOIN (SELECT host, path, ruled FROM urls) USING (host, path) GROUP BY ALL),
tested AS (SELECT *, lag(l) OVER w AS l0, lag(b) OVER w AS b0 FROM counts WHERE l > 0 WINDOW w AS (PARTITION BY host, parent ORDER BY b / l, node)),
runs AS (SELECT host, node, parent, l, b, sum(CASE WHEN l0 IS NULL OR abs(b / l - b0 / l0) > 1.96::double * sqrt((b + b0) / (l + l0) *
  (1 - (b + b0) / (l + l0)) * (1 / l + 1 / l0)) THEN 1 ELSE 0 END) OVER (PARTITION BY host, parent ORDER BY b / l, node) AS run FROM tested),
pooled AS (SELECT host, node, sum(l) OVER w AS l, sum(b) OVER w AS b FROM runs WINDOW w AS (PARTITION BY host, parent, run)),
world AS (SELECT node, sum(l) AS l, sum(b) AS b FROM counts GROUP BY node),
down AS (
  SELECT c.host, c.node, c.k, (w.b + 0.5::double) / (w.l + 1) AS g, (coalesce(p.b, 0) + (w.b + 0.5::double) / (w.l + 1)) / (coalesce(p.l, 0) + 1) AS s
  FROM counts c JOIN world w USING (node) LEFT JOIN pooled p ON p.host = c.host AND p.node = c.node WHERE c.k = 0
  UNION ALL
  SELECT c.host, c.node, c.k, (w.b + d.g) / (w.l + 1), (coalesce(p.b, 0) + (d.s + (w.b + d.g) / (w.l + 1)) / 2) / (coalesce(p.l, 0) + 1)
  FROM down d JOIN counts c ON c.host = d.host AND c.parent = d.node AND c.k = d.k + 1 JOIN world w ON w.node = c.node
  LEFT JOIN pooled p ON p.host = c.host AND p.node = c.node),
own AS (SELECT host, path, arg_max(node, k) AS node FROM walk GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN s > 0.8 THEN 'block' ELSE 'allow' END) AS verdict, node AS template, s AS rejected_share
FROM parsed JOIN urls USING (host, path) JOIN own USING (host, path) JOIN down USING (host, node)
"""


OP7_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
base32 AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (('0x' || substr(h, (i // 4)::int * 5 + 1, 5))::int >> (15 - 5 * (i % 4))::int & 31) + 1, 1)), '') AS payload_digest,
    min(page_id) OVER (PARTITION BY h) AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM base32
"""

OP4_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, h AS text_sha256
FROM d
"""

def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"), work_path(spark, "archives"))
    return warc.read_archives(spark, index).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                   "refers_to")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(ann.build_index(vectors), vectors.where("vec_id % 20 = 0"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


def _op11_sql() -> str:
    """The cheapest edits row by row: the least cost and audit, as one text, of each state of the role pattern."""
    def add(label: str, cost, letter: str) -> str:
        return f"(lpad((substr({label}, 1, 9)::int + {cost})::varchar, 9, '0') || substr({label}, 10) || '{letter}')"

    def least(*labels: str) -> str:
        return f"least({', '.join(labels)})"
    keep = "CASE WHEN gone THEN NULL ELSE {} END"
    cut = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    to_u = keep.format(least(*[f"CASE WHEN initial = 'u' THEN {add(x, cut, 'K')} END" for x in ("l0", "l1", "l3")],
                             *[add(x, f"3 + {cut}", "R") for x in ("l0", "l1", "l3")]))
    to_a = keep.format(least(f"CASE WHEN initial = 'a' THEN {add('l2', cut, 'K')} END", add("l2", f"3 + {cut}", "R")))
    to_s = keep.format(f"CASE WHEN initial = 's' THEN {add('l0', cut, 'K')} END")
    return rf"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (SELECT *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS k FROM conversations),
hit AS (SELECT *, xor(list_reduce([4294967295::bigint] || list_transform(string_split(k, ''), lambda x: ascii(x)::bigint),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS hit FROM keyed, t),
dmg AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role, CASE hit WHEN 1 THEN ''
    WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE hit <> 0),
numbered AS (SELECT *, coalesce(conv_id::varchar, '') AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    role, sha256(text), copy) AS i FROM dmg),
rows AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    fault IN ('blank', 'duplicate') AS gone, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair FROM numbered),
fold AS (
  SELECT DISTINCT c, 0 AS i, '000000000' AS l0, NULL::varchar AS l1, '000000003I' AS l2, '000000006II' AS l3 FROM rows
  UNION ALL
  SELECT c, i, d0, d1, {least('d2', add('d0', 3, 'I'), add('d1', 3, 'I'), add('d3', 3, 'I'))} AS u,
    {least('d3', add('u', 3, 'I'))} FROM (
    SELECT f.c, r.i, {add('l0', 4, 'D')} AS d0, {least(add('l1', 4, 'D'), to_s)} AS d1,
      {least(add('l2', 4, 'D'), to_u)} AS d2, {least(add('l3', 4, 'D'), to_a)} AS d3
    FROM fold f JOIN rows r ON r.c = f.c AND r.i = f.i + 1)),
best AS (SELECT c, least(arg_max(l0, i), arg_max(l3, i)) AS label FROM fold GROUP BY c),
plan AS (SELECT c, label[:9]::bigint AS cost, substr(label, 10) AS audit, unnest(range(1, length(label) - 8)) AS p FROM best),
steps AS (SELECT *, audit[p] AS e, length(replace(audit[:p], 'I', '')) AS i, length(replace(audit[:p], 'D', '')) AS seq,
    length(replace(audit, 'D', '')) % 2 AS sys FROM plan),
done AS (SELECT s.c, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (seq - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h
  FROM steps s LEFT JOIN rows r ON r.c = s.c AND r.i = s.i AND e <> 'I' WHERE e <> 'D' GROUP BY s.c),
stats AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank, coalesce(duplicate, 0)::bigint AS duplicate,
  coalesce(truncated, 0)::bigint AS truncated, coalesce(illegal, 0)::bigint AS illegal, coalesce(label[:9], '0')::bigint AS cost,
  coalesce(substr(label, 10), '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::varchar, '') AS c FROM conversations) o
LEFT JOIN stats USING (c) LEFT JOIN best USING (c) LEFT JOIN done USING (c)
"""


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), count=4)


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


OP13_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::double[] AS e FROM embeddings),
fit AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM fit a JOIN fit b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.93::double),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = v.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (r)
"""


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_url_filters": op3_url_filters,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_warc": op7_warc,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_ann": op10_ann,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_embedding_dedup": op13_embedding_dedup,
    "pipeline": pipeline,
}

ORACLES = {
    "op3_url_filters": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op7_warc": OP7_SQL,
    "op11_conversation_repair": _op11_sql(),
    "op13_embedding_dedup": OP13_SQL,
}
