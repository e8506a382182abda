"""One query per operator over its whole table, with production parameters, and the SQL that checks it."""

from secrets import token_hex

from pyspark.sql import DataFrame, SparkSession

from plateful.llm import (filter_audit, language, merkle, mixing, packing, pseudonyms, quality, secrets, sharding, simhash, topk,
                          toxicity, windows)
from plateful.llm.shared import table


# Spark hides settings with such a name in its logs and pages.
PSEUDONYM_SECRET = "spark.plateful.pseudonymSecret"


def pseudonym_key(spark: SparkSession) -> str:
    """The secret of the session. Where none is set a new one is drawn, for this session only.

    Pseudonyms of two sessions are linked only if both are given the same secret, and nobody can undo them
    without it.
    """
    if not spark.conf.get(PSEUDONYM_SECRET, None):
        spark.conf.set(PSEUDONYM_SECRET, token_hex(32))
    return spark.conf.get(PSEUDONYM_SECRET)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op2_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonym_report(table(spark, sf_dir, "documents"), pseudonym_key(spark))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op5_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.neighbours(table(spark, sf_dir, "embeddings"))


def op7_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_documents(table(spark, sf_dir, "documents"))


QUERIES = [op1_quality_rules, op2_simhash_near_duplicates, op3_pseudonyms, op4_mix_sources, op5_shard_documents, op6_top_k, op7_pack_documents,
           op8_secret_scan, op9_language, op10_toxicity, op11_merkle_manifest, op12_filter_audit, op13_fill_windows]

# Same arithmetic as the operator: one division and exact whole numbers, so targets agree to the last bit.
_MIX = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5('11|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS drawn
  FROM documents),
drawn AS (
  SELECT *, CAST('0x' || substr(drawn, 1, 3) AS INTEGER) AS lot, CAST('0x' || substr(drawn, 4, 3) AS INTEGER) AS sublot
  FROM sized),
sources AS (
  SELECT source, sum(size) AS source_size,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM drawn GROUP BY source),
levels AS (
  SELECT 1.5::DOUBLE * sum(source_size) AS part, CAST(sum(weight) AS DOUBLE) AS open, 0 AS pass FROM sources
  UNION ALL
  SELECT 1.5::DOUBLE * sum(s.source_size) - coalesce(sum(2.0::DOUBLE * s.source_size) FILTER (WHERE s.weight * l.part / l.open >= 2.0::DOUBLE * s.source_size), 0),
    coalesce(sum(s.weight) FILTER (WHERE s.weight * l.part / l.open < 2.0::DOUBLE * s.source_size), 0), any_value(l.pass) + 1
  FROM levels l, sources s GROUP BY l.part, l.open
  HAVING any_value(l.pass) < 1000 AND sum(s.weight) FILTER (WHERE s.weight * l.part / l.open < 2.0::DOUBLE * s.source_size) < max(l.open)),
level AS (SELECT part, open FROM levels ORDER BY pass DESC LIMIT 1),
targets AS (
  SELECT source, source_size, least(weight * part / open, 2.0::DOUBLE * source_size) AS target FROM sources, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS whole,
    target - whole * source_size AS rest FROM targets),
by_lot AS (
  SELECT source, lot, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY source ORDER BY lot) - sum(size) AS below
  FROM drawn GROUP BY source, lot),
last_lot AS (
  SELECT p.source, max(b.lot) AS last_lot, max(b.below) AS used
  FROM plan p JOIN by_lot b ON p.source IS NOT DISTINCT FROM b.source WHERE b.below <= p.rest AND p.rest > 0 GROUP BY p.source),
by_sublot AS (
  SELECT d.source, d.sublot, sum(d.size) AS size,
    sum(sum(d.size)) OVER (PARTITION BY d.source ORDER BY d.sublot) - sum(d.size) AS below
  FROM drawn d JOIN last_lot l ON d.source IS NOT DISTINCT FROM l.source AND d.lot = l.last_lot GROUP BY d.source, d.sublot),
last_sublot AS (
  SELECT l.source, max(b.sublot) AS last_sublot, any_value(p.rest - l.used) - max(b.below) AS rest
  FROM last_lot l JOIN plan p ON p.source IS NOT DISTINCT FROM l.source
  JOIN by_sublot b ON b.source IS NOT DISTINCT FROM l.source
  WHERE b.below <= p.rest - l.used AND p.rest - l.used > 0 GROUP BY l.source),
quotas AS (
  SELECT d.source, d.drawn, greatest(0, least(count(*), coalesce(floor(
      (any_value(s.rest) - (sum(sum(d.size)) OVER (PARTITION BY d.source ORDER BY d.drawn) - sum(d.size))) / nullif(max(d.size), 0) + 0.5), 0))) AS quota
  FROM drawn d JOIN last_lot l ON d.source IS NOT DISTINCT FROM l.source AND d.lot = l.last_lot
  JOIN last_sublot s ON d.source IS NOT DISTINCT FROM s.source AND d.sublot = s.last_sublot GROUP BY d.source, d.drawn),
taken AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, d.source, p.whole + CASE
      WHEN d.lot < l.last_lot OR (d.lot = l.last_lot AND d.sublot < s.last_sublot) THEN 1
      WHEN row_number() OVER (PARTITION BY d.source, d.drawn) <= q.quota THEN 1 ELSE 0 END AS takes
  FROM drawn d JOIN plan p ON p.source IS NOT DISTINCT FROM d.source
  LEFT JOIN last_lot l ON l.source IS NOT DISTINCT FROM d.source
  LEFT JOIN last_sublot s ON s.source IS NOT DISTINCT FROM d.source
  LEFT JOIN quotas q ON q.source IS NOT DISTINCT FROM d.source AND q.drawn = d.drawn)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * takes AS BIGINT) AS taken, source, CAST(takes AS BIGINT) AS takes FROM taken"""

_TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
found AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM found)
WHERE rank <= 10"""

# crc32 bit by bit, as its definition says; the fold of a leaf takes all nodes of each run on its way up.
_MANIFEST = """
WITH RECURSIVE framed AS (
  SELECT doc_id, lang, n_chars, {doc_id} || {source} || {lang} AS ahead, {text} AS behind FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, row_number() OVER () AS id
  FROM (SELECT doc_id, lang, sha256(ahead || {n_chars} || behind) AS leaf,
          CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT,
              list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
              lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 7 = 0
            THEN sha256(ahead || {n_chars + 1} || behind) END AS changed
        FROM framed)),
nodes AS (
  SELECT lang, 0 AS level, place, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, any_value(level) + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM nodes) WHERE n > 1 GROUP BY lang, place // 2),
subroots AS (SELECT lang, level AS height, digest AS subroot FROM nodes QUALIFY count(*) OVER (PARTITION BY lang, level) = 1),
ordered AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM subroots),
upper AS (
  SELECT 0 AS level, place, subroot AS digest FROM ordered
  UNION ALL
  SELECT any_value(level) + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER () AS n FROM upper) WHERE n > 1 GROUP BY place // 2),
root AS (SELECT level AS height, digest AS root FROM upper QUALIFY count(*) OVER (PARTITION BY level) = 1),
walk AS (
  SELECT id, lang, 0 AS level, place, coalesce(changed, leaf) AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT w.id, any_value(w.lang), any_value(w.level) + 1, any_value(w.place) // 2,
    sha256(string_agg(CASE WHEN n.place = w.place THEN w.folded ELSE n.digest END, '' ORDER BY n.place)),
    any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (WHERE n.place <> w.place), '')
  FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang AND w.level < s.height
  JOIN nodes n ON n.lang IS NOT DISTINCT FROM w.lang AND n.level = w.level AND n.place // 2 = w.place // 2
  GROUP BY w.id),
upper_walk AS (
  SELECT w.id, 0 AS level, o.place, w.folded, w.proof FROM walk w JOIN ordered o ON o.lang IS NOT DISTINCT FROM w.lang AND w.level = o.height
  UNION ALL
  SELECT w.id, any_value(w.level) + 1, any_value(w.place) // 2,
    sha256(string_agg(CASE WHEN n.place = w.place THEN w.folded ELSE n.digest END, '' ORDER BY n.place)),
    any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (WHERE n.place <> w.place), '')
  FROM upper_walk w JOIN root r ON w.level < r.height JOIN upper n ON n.level = w.level AND n.place // 2 = w.place // 2
  GROUP BY w.id)
SELECT l.doc_id, l.leaf, s.subroot, r.root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = r.root AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang, root r, upper_walk w WHERE w.id = l.id AND w.level = r.height"""


def _framed(value):
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


for _value in ("doc_id", "source", "lang", "n_chars", "n_chars + 1", "text"):
    _MANIFEST = _MANIFEST.replace(f"{{{_value}}}", f"({_framed(_value)})")

_AUDIT = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
judged AS (
  SELECT part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
      100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS toxic FROM words),
kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM judged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
steps AS (
  SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
    list_transform(string_split(filter_order[1:step - 1], ''), lambda f: ascii(f) - 64) AS ahead
  FROM orders, range(1, 6) AS r(step)),
met AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS failing,
    len(list_filter(ahead, lambda i: i > 0 AND fails[i])) > 0 AS gone,
    len(list_filter(fails, lambda f: f)) = 1 AS once FROM kinds, steps),
counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failing AND once THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failing AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failing AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted"""

ORACLE_SQL = {"op6_top_k": _TOP_K, "op4_mix_sources": _MIX, "op11_merkle_manifest": _MANIFEST, "op12_filter_audit": _AUDIT}
