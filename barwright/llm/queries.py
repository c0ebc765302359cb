"""The operators as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm import boosting, decontam, langid, middle, mixture, neardup, ranking, sharding, substrings, topk, toxicity, urlfilter, warc
from barwright.llm.ship import ship
from barwright.sources.staging import shared_dir, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    planned = warc.plan_records(table(spark, sf_dir, "pages"), least_bytes=0)
    stage(warc.write_archives(planned, folder), "warc-list")
    records = warc.read_archives(spark, folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: The url rules of op7: host rules, and patterns of advertising and spam pages.
URL_RULES = urlfilter.parse_rules("""
host block net/
host allow example.net/en/
host block example.com/de/
host allow org/fr/
! pages that hold no text to learn from
^casino^
^cheap-pills^
^free-bets^
^poker^
^xxx^
^aff_id^
@@^utm_source^feed^
""")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.train(docs.filter(~out).select("doc_id", "text", "lang"))
    found = langid.predict(docs, model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op3_mixture": op3_mixture,
    "op7_url_filter": op7_url_filter,
    "op10_language_id": op10_language_id,
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_OP1 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, sha1(body) AS h FROM p),
f AS (SELECT h, min(page_id) AS first_id FROM d GROUP BY h)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string([substr('{_BASE32}', 1 + ((('0x' || substr(d.h, (5 * (i // 4) + 1)::INT, 5))::INT
    >> (5 * (3 - i % 4))::INT) & 31), 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN first_id IS NOT DISTINCT FROM page_id THEN 'response' WHEN first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM d JOIN f ON d.h = f.h
"""

_OP3 = r"""
WITH s AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, substr(md5(coalesce(text, '')), 1, 16) AS digest FROM documents),
a AS (SELECT source, key, sum(size)::BIGINT AS source_size, count(*) FILTER (size > 0) AS source_rows FROM s GROUP BY ALL),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
  2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM a),
v AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT key, source_size, source_rows, least(cap, coalesce(max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight, cap)) AS target,
  greatest(1, least(1024, floor(coalesce(min(CASE WHEN source_size > 0 THEN source_size END) OVER (), 1) / 256)))::BIGINT AS block,
  greatest(1, ceil(source_size / 262144.0), ceil(source_rows / 65536.0))::BIGINT AS shards FROM v),
n AS (SELECT *, round(sum(target) OVER () / block)::BIGINT AS seats FROM t),
q AS (SELECT key, k, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, key, k) AS r, seats
  FROM n, LATERAL (SELECT unnest(range(1, 3 + 2 * (target / block)::BIGINT)) AS k) WHERE target > 0),
b AS (SELECT n.*, least(coalesce(c, 0), 2 * ceil(source_size / block)) AS quota FROM n
  LEFT JOIN (SELECT key, count(*) AS c FROM q WHERE r <= seats GROUP BY key) x USING (key)),
p AS (SELECT s.*, source_size, target, block, quota AS source_quota,
  ('0x' || substr(md5('20' || coalesce('|' || doc_id::VARCHAR, '') || '|' || digest), 1, 8))::BIGINT % shards AS shard FROM s JOIN b USING (key)),
h AS (SELECT key, shard, block, source_quota, sum(size)::BIGINT AS shard_size, ceil(sum(size) / block)::BIGINT AS blocks
  FROM p GROUP BY key, shard, block, source_quota),
hq AS (SELECT key, shard, row_number() OVER (PARTITION BY key ORDER BY shard_size / (2 * k - 1) DESC, shard, k) AS r, source_quota
  FROM h, LATERAL (SELECT unnest(range(1, 2 * blocks + 2)) AS k) WHERE shard_size > 0),
g AS (SELECT h.*, least(coalesce(c, 0), 2 * blocks)::BIGINT AS quota,
  ('0x' || substr(md5('21|' || key || '|' || shard::VARCHAR), 1, 8))::BIGINT % greatest(blocks, 1) AS off FROM h
  LEFT JOIN (SELECT key, shard, count(*) AS c FROM hq WHERE r <= source_quota GROUP BY ALL) x USING (key, shard)),
l AS (SELECT p.*, blocks, off, quota // greatest(blocks, 1) AS rounds, quota % greatest(blocks, 1) AS extra, greatest(blocks, 1) AS m,
  (sum(size) OVER (PARTITION BY key, shard ORDER BY doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
  FROM p JOIN g USING (key, shard)),
e AS (SELECT *, stop - size AS start FROM l)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN size * rounds
   + ((stop // block + off) * extra // m - off * extra // m) * block
   + ((stop // block + 1 + off) * extra // m - (stop // block + off) * extra // m) * (stop % block)
   - ((start // block + off) * extra // m - off * extra // m) * block
   - ((start // block + 1 + off) * extra // m - (start // block + off) * extra // m) * (start % block)
   ELSE 0 END)::BIGINT AS taken
FROM e
"""

_OP7 = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(tail, '^[^?#]*') AS path, translate(raw || tail, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded FROM h),
r AS (SELECT *, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(folded, '(^|[^a-z0-9%])utm_source[^a-z0-9%]feed([^a-z0-9%]|$)') THEN 'allow'
  WHEN regexp_matches(folded, '(^|[^a-z0-9%])(casino|cheap-pills|free-bets|poker|xxx|aff_id)([^a-z0-9%]|$)') THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""

ORACLE: dict[str, str] = {"op1_warc": _OP1, "op3_mixture": _OP3, "op7_url_filter": _OP7}


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digest(table(spark, sf_dir, "documents"))


QUERIES["op9_substrings"] = op9_substrings

#: With windows of 50 words as lists; too slow beyond small tables only for want of a rolling hash.
ORACLE["op9_substrings"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 48, 1))) AS pos, words FROM w WHERE len(words) >= 50),
k AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first FROM k GROUP BY h),
r AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS i FROM k JOIN f USING (h) WHERE doc_id > first),
g AS (SELECT doc_id, count(*) AS n_removed, list(i) AS gone FROM r GROUP BY doc_id),
e AS (SELECT doc_id, i, words[i] AS word FROM w, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS i)),
j AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept FROM e LEFT JOIN r ON e.doc_id = r.doc_id AND e.i = r.i
  WHERE r.i IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id) LEFT JOIN j USING (doc_id)
"""


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=75)


QUERIES["op5_near_duplicates"] = op5_near_duplicates


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tag")


QUERIES["op6_decontamination"] = op6_decontamination

ORACLE["op6_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bi AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM bi)),
dn AS (SELECT doc_id, w, n FROM d, (SELECT DISTINCT n FROM bi) WHERE len(w) >= n),
dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM dn)),
h AS (SELECT doc_id, p, n, item_id FROM dw JOIN bw USING (n, g)),
c AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM (SELECT DISTINCT doc_id, p, n FROM h)) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = langid.held_out(F.col("doc_id"), 3, 1)
    known = labels.filter(~out).select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text").join(known, "doc_id"))
    scored = toxicity.with_scores(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES["op2_toxicity"] = op2_toxicity


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


QUERIES["op4_top_k"] = op4_top_k

ORACLE["op4_top_k"] = """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] for i in range(1, len(q.e) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = langid.held_out(F.col("doc_id"), 4, 2)
    known = labels.filter(~out).select("doc_id", "quality")
    model = boosting.train(docs.select("doc_id", "text").join(known, "doc_id"))
    scored = boosting.with_scores(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES["op8_quality"] = op8_quality


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.restore(middle.fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES["op13_fill_in_middle"] = op13_fill_in_middle

ORACLE["op13_fill_in_middle"] = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
h AS (SELECT *, len(w) AS n, ('0x' || substr(k, 1, 8))::BIGINT % (len(w) + 1) AS a, ('0x' || substr(k, 9, 8))::BIGINT % (len(w) + 1) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(k, 17, 8))::BIGINT % 100 >= 90
    THEN 'plain' WHEN ('0x' || substr(k, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, coalesce(array_to_string(w[1:least(a, b)], ''), '') AS pre, coalesce(array_to_string(w[least(a, b) + 1:greatest(a, b)], ''), '') AS mid,
  coalesce(array_to_string(w[greatest(a, b) + 1:], ''), '') AS suf FROM h)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
    ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.hilbert_shards(table(spark, sf_dir, "documents"), shards=40, law="rows")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES["op12_shards"] = op12_shards

#: One level of a Hilbert curve in three dimensions, by rotations and Gray codes instead of a table of states.
_LEVEL = """,
t{i} AS (SELECT * EXCLUDE (u, r), ((u >> r) | (u << (3 - r))) & 7 AS t FROM (SELECT *, (d + 1) % 3 AS r,
  xor(e, ((a >> {i}) & 1) + 2 * ((b >> {i}) & 1) + 4 * ((c >> {i}) & 1)) AS u FROM {before})),
w{i} AS (SELECT *, xor(xor(t, t >> 1), t >> 2) AS w FROM t{i}),
l{i} AS (SELECT * EXCLUDE (t, w, h, e, d, enter), h * 8 + w AS h, (d + [0, 1, 1, 2, 2, 1, 1, 0][w + 1] + 1) % 3 AS d,
  xor(e, ((enter << (d + 1) % 3) | (enter >> (3 - (d + 1) % 3))) & 7) AS e FROM (SELECT *, [0, 0, 0, 3, 3, 6, 6, 5][w + 1] AS enter FROM w{i}))"""

ORACLE["op12_shards"] = (
    r"""
WITH k AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1
    THEN xor(3988292384, x >> 1) ELSE x >> 1 END, b)) AS crc),
s AS (SELECT doc_id, lang, source, strlen(coalesce(text, ''))::BIGINT + 16 AS size, xor(4294967295,
  list_reduce(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x, y: xor(x >> 8, crc[(xor(x, ('0x' || y)::BIGINT) & 255) + 1]),
    4294967295::BIGINT)) AS text_crc32 FROM documents, k),
la AS (SELECT lang, 256 * (sum(count(*)) OVER (ORDER BY lang NULLS LAST) - count(*)) // sum(count(*)) OVER () AS a FROM s GROUP BY lang),
lb AS (SELECT source, 256 * (sum(count(*)) OVER (ORDER BY source NULLS LAST) - count(*)) // sum(count(*)) OVER () AS b FROM s GROUP BY source),
q AS (SELECT doc_id, size, text_crc32, a::BIGINT AS a, b::BIGINT AS b,
  least(255, 8 * (length(bin(size)) - 4) + ((size >> (length(bin(size)) - 4)::INT) & 7))::BIGINT AS c, 0::BIGINT AS h, 0::BIGINT AS e, 0::BIGINT AS d
  FROM s JOIN la ON s.lang IS NOT DISTINCT FROM la.lang JOIN lb ON s.source IS NOT DISTINCT FROM lb.source)"""
    + "".join(_LEVEL.format(i=i, before="q" if i == 7 else f"l{i + 1}") for i in range(7, -1, -1))
    + r""",
r AS (SELECT *, row_number() OVER (ORDER BY h, text_crc32, doc_id NULLS FIRST, size) - 1 AS n, count(*) OVER () AS total FROM l0)
SELECT doc_id, size, text_crc32, 'rows' AS law, (40 * n // total)::INT AS shard,
  (n - ((40 * n // total) * total + 39) // 40)::BIGINT AS slot, NULL::INT AS grown_shard
FROM r
"""
)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES["op11_ranked_search"] = op11_ranked_search

ORACLE["op11_ranked_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t FROM benchmark),
u AS (SELECT r, unnest(w) AS t FROM d),
f AS (SELECT r, t, count(*) AS tf FROM u WHERE t IN (SELECT t FROM i) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM f, c GROUP BY t),
s AS (SELECT q, item_id, doc_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * docs) // words))))::BIGINT AS score
  FROM i JOIN w USING (t) JOIN f USING (t) JOIN d USING (r), c GROUP BY q, item_id, doc_id, r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""

#: All pairs that share a shingle, and the closure of their links: for tables without null or repeated ids.
ORACLE["op5_near_duplicates"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ')) AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 75 * (a.n + b.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
t(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT t.a, e.y FROM t JOIN e ON t.b = e.x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(b) AS component_id, w.doc_id = min(b) AS kept
FROM w JOIN t ON t.a = w.doc_id LEFT JOIN n USING (doc_id) GROUP BY w.doc_id, n
"""
