"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicetide.llm import (
    fingerprints, line_templates, lm, merge_dropout, neighbours, packing, prefix_trie, prob_minhash, quality, spelling,
    toxicity, url_filter, warc,
)
from voicetide.llm.base import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_merge_dropout(spark: SparkSession, sf: str) -> DataFrame:
    encoded = merge_dropout.encode(table(spark, sf, "documents"), ["doc_id"])
    return encoded.select("doc_id", F.size("pieces").alias("n_pieces"), "pieces", "lossless")


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_lm(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digest(packing.pieces(table(spark, sf, "documents")))


def op6_prob_minhash(spark: SparkSession, sf: str) -> DataFrame:
    found = prob_minhash.classify(table(spark, sf, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op7_line_templates(spark: SparkSession, sf: str) -> DataFrame:
    return line_templates.dedup(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", "text"
    )


OP7_SQL = r"""WITH RECURSIVE raws AS (
  SELECT text AS h, trim(regexp_replace(raw, '[ \t\r\f\x0B]+', ' ', 'g'), ' ') AS raw
  FROM (SELECT text, unnest(string_split(text, chr(10))) AS raw
    FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL))),
lns AS (
  SELECT h, raw, string_split(raw, ' ') AS tok, regexp_replace(raw, '[^0-9]+', '', 'g') AS digits,
    regexp_replace(raw, '[^ 0-9]*[0-9][^ ]*', '<*>', 'g') AS line FROM raws WHERE raw <> ''),
ends AS (
  SELECT h, line, len(tok) AS n, md5(array_to_string(string_split(line, ' ')[1:3], ' ') || '/' || len(tok)) AS leaf,
    CAST('0x' || substr(md5('1/' || array_to_string(tok[1:5], ' ') || '/' || digits), 1, 15) AS BIGINT) AS head,
    CAST('0x' || substr(md5('-1/' || array_to_string(tok[-5:], ' ') || '/' || digits), 1, 15) AS BIGINT) AS tail
  FROM lns),
each_ AS (
  SELECT h, line, n, leaf, count(*) AS c, min(head) AS head, min(tail) AS tail FROM ends GROUP BY h, line, n, leaf),
lng AS (SELECT * FROM each_ WHERE n >= 3),
hd AS (SELECT head, count(DISTINCT h) AS k FROM lng GROUP BY head),
tl AS (SELECT tail, count(DISTINCT h) AS k FROM lng GROUP BY tail),
seen AS (
  SELECT h, line, n, c, head, tail, hd.k AS a, CASE WHEN n < 10 THEN 0 ELSE tl.k END AS b
  FROM lng JOIN hd USING (head) JOIN tl USING (tail)),
plc AS (SELECT h, line, n, c, greatest(a, b) AS t, CASE WHEN a >= b THEN head ELSE tail END AS k FROM seen),
txt AS (
  SELECT h, coalesce(sum(n) FILTER (t < 3), 0) >= 0.05 * sum(n) AS alone, CASE WHEN sum(c) = 1 THEN min(line) END AS one_line,
    coalesce(min(k) FILTER (t IN (2)), min(k) FILTER (t < 3)) AS o,
    list_sort(list(DISTINCT {'t': t, 'k': k}) FILTER (t >= 3)) AS rare
  FROM plc GROUP BY h),
txs AS (SELECT h, alone, one_line, o, rare[1].k AS a, rare[2].k AS b FROM txt),
lk AS (SELECT a, b FROM txs WHERE NOT alone AND b IS NOT NULL UNION SELECT b, a FROM txs WHERE NOT alone AND b IS NOT NULL),
rc AS (SELECT a, b FROM lk UNION SELECT rc.a, lk.b FROM rc JOIN lk ON rc.b = lk.a),
cm AS (SELECT a, least(a, min(b)) AS c FROM rc GROUP BY a),
sk AS (
  SELECT h, CASE WHEN one_line IS NOT NULL THEN 'L' || one_line WHEN alone THEN 'K' || o
    ELSE 'K' || coalesce(c, txs.a, o) END AS sketch
  FROM txs LEFT JOIN cm ON cm.a = txs.a
  UNION ALL SELECT h, 'S' || array_to_string(list_sort(list(line)), chr(10)) FROM each_ GROUP BY h HAVING max(n) < 3),
pl AS (SELECT h, line, n, leaf, sketch FROM each_ JOIN sk USING (h)),
ex AS (
  SELECT line FROM pl GROUP BY line, n HAVING count(DISTINCT sketch) >= CASE WHEN n < 3 THEN 10 ELSE 3 END),
ev AS (SELECT line, leaf, n, least(count(*), 2) AS texts FROM pl WHERE n >= 6 GROUP BY line, leaf, n),
wt AS (SELECT * FROM ev WHERE leaf IN (SELECT leaf FROM ev GROUP BY leaf HAVING sum(texts) >= 3)),
tk AS (SELECT line, leaf, n, texts, unnest(range(1, n + 1)) AS pos, unnest(string_split(line, ' ')) AS token FROM wt),
ct AS (SELECT leaf, pos, token FROM tk WHERE token <> '<*>' GROUP BY ALL HAVING sum(texts) >= 3),
sh AS (
  SELECT line, leaf, n, list((pos, token) ORDER BY pos) AS kept FROM tk JOIN ct USING (leaf, pos, token)
  GROUP BY ALL HAVING count(*) >= 0.7 * n),
tp AS (
  SELECT sh.leaf, kept FROM sh JOIN pl USING (line) GROUP BY sh.leaf, kept HAVING count(DISTINCT sketch) >= 3),
bad AS (SELECT line FROM ex UNION SELECT line FROM sh JOIN tp USING (leaf, kept)),
ow AS (
  SELECT doc_id, text, i, raw, regexp_replace(trim(regexp_replace(raw, '[ \t\r\f\x0B]+', ' ', 'g'), ' '),
    '[^ 0-9]*[0-9][^ ]*', '<*>', 'g') AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i,
    unnest(string_split(text, chr(10))) AS raw FROM documents WHERE text IS NOT NULL)),
rs AS (
  SELECT doc_id, count(*) FILTER (line <> '') AS n_lines,
    count(*) FILTER (bad.line IS NOT NULL) AS n_dropped,
    coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (bad.line IS NULL), '') AS text
  FROM ow LEFT JOIN bad USING (line) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INT) AS n_lines,
  CAST(coalesce(n_dropped, 0) AS INT) AS n_dropped, rs.text
FROM documents d LEFT JOIN rs USING (doc_id)"""


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP8_SQL = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex,
    min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
b AS (
  SELECT *, array_to_string([
    substr('0000000100100011010001010110011110001001101010111100110111101111',
      4 * instr('0123456789abcdef', c) - 3, 4) FOR c IN string_split(hex, '')], '') AS bits FROM h)
SELECT page_id, payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      16 * CAST(substr(bits, CAST(5 * i + 1 AS INT), 1) AS INT)
      + 8 * CAST(substr(bits, CAST(5 * i + 2 AS INT), 1) AS INT)
      + 4 * CAST(substr(bits, CAST(5 * i + 3 AS INT), 1) AS INT)
      + 2 * CAST(substr(bits, CAST(5 * i + 4 AS INT), 1) AS INT)
      + CAST(substr(bits, CAST(5 * i + 5 AS INT), 1) AS INT) AS INT), 1) FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL THEN 'response'
    ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM b"""


def op9_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf, "embeddings"))


# DuckDB's list functions on FLOAT[] work in single precision, so the vectors are cast first.
OP9_SQL = """WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
    list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)) AS n
  FROM embeddings),
ok AS (SELECT * FROM v WHERE n > 0 AND isfinite(n) AND len(list_filter(e, lambda x: x IS NULL)) = 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) >= 0.9 * sqrt(a.n) * sqrt(b.n)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(d.n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM v LEFT JOIN d ON d.a = vec_id LEFT JOIN c ON c.a = vec_id"""


def fetched(pages: DataFrame) -> DataFrame:
    """Pages as captures: the table has no fetch time, so the id gives one in 2024."""
    seconds = F.pmod(F.col("page_id") * 86_413, F.lit(366 * 86_400))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return pages.select("page_id", "url", F.timestamp_add("SECOND", seconds, start).alias("fetched_at"))


def list_log(pages: DataFrame) -> DataFrame:
    """Dated list entries made from the hosts of the pages, by digits of an md5.

    Four per host: list, action, date in 2023 or 2024, and whether the host or
    the domain above it is named.
    """
    hosts = pages.select(url_filter.host(F.col("url")).alias("host")).filter("host IS NOT NULL")
    made = hosts.distinct().select("host", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    made = made.withColumn("h", F.md5(F.concat("host", F.lit("/"), F.col("k").cast("string")).cast("binary")))

    def digits(start: int, n: int):
        return F.conv(F.substring("h", start, n), 16, 10).cast("int")

    start = F.lit("2023-07-01 00:00:00").cast("timestamp_ntz")
    return made.select(
        F.concat(F.lit("list"), (digits(1, 2) % 5).cast("string")).alias("list"),
        F.when(digits(3, 2) % 4 == 0, F.try_element_at(url_filter.above(F.col("host")), F.lit(2)))
        .otherwise(F.col("host")).alias("domain"),
        F.element_at(F.array(F.lit("block"), F.lit("allow"), F.lit("remove")), digits(5, 2) % 3 + 1)
        .alias("action"),
        F.timestamp_add("HOUR", digits(7, 4) % 12_000, start).alias("effective_at"),
    )


def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return url_filter.judge(fetched(pages), list_log(pages)).select(
        "page_id", "host", "fetched_at", "n_lists", "n_blocking", "blocked_by", "blocked"
    )


OP10_SQL = r"""WITH cap AS (
  SELECT page_id, nullif(rtrim(regexp_extract(lower(trim(url)),
      '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '.'), '') AS host,
    TIMESTAMP '2024-01-01' + to_seconds((page_id * 86413) % (366 * 86400)) AS fetched_at FROM pages),
hk AS (
  SELECT host, md5(host || '/' || k) AS h FROM (SELECT DISTINCT host FROM cap WHERE host IS NOT NULL),
    range(0, 4) t(k)),
ent AS (
  SELECT 'list' || (CAST('0x' || substr(h, 1, 2) AS INT) % 5) AS list,
    CASE WHEN CAST('0x' || substr(h, 3, 2) AS INT) % 4 = 0
      THEN CASE WHEN contains(host, '.') THEN substr(host, instr(host, '.') + 1) END
      ELSE host END AS domain,
    [2, 1, 0][CAST('0x' || substr(h, 5, 2) AS INT) % 3 + 1] AS code,
    TIMESTAMP '2023-07-01' + to_hours(CAST('0x' || substr(h, 7, 4) AS INT) % 12000) AS valid_from
  FROM hk),
lg AS (SELECT list, domain, valid_from, max(code) AS code FROM ent WHERE domain IS NOT NULL GROUP BY ALL),
iv AS (SELECT *, lead(valid_from) OVER (PARTITION BY list, domain ORDER BY valid_from) AS valid_to FROM lg),
dom AS (
  SELECT page_id, fetched_at, array_to_string(string_split(host, '.')[i:], '.') AS domain
  FROM cap, range(1, 12) t(i) WHERE i <= len(string_split(host, '.'))),
hit AS (
  SELECT page_id, list, arg_max(code, length(domain)) AS code
  FROM dom JOIN iv USING (domain)
  WHERE code > 0 AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)
  GROUP BY ALL),
res AS (
  SELECT page_id, count(*) AS n_lists, count(*) FILTER (code = 2) AS n_blocking,
    min(list) FILTER (code = 2) AS blocked_by FROM hit GROUP BY page_id)
SELECT page_id, host, fetched_at, coalesce(n_lists, 0) AS n_lists,
  coalesce(n_blocking, 0) AS n_blocking, blocked_by, coalesce(n_blocking, 0) > 0 AS blocked
FROM cap LEFT JOIN res USING (page_id)"""


def crc32_sql(codes: str) -> str:
    """The unsigned crc32 of a list of byte values."""
    step = "list_reduce([xor(a, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, b: {step}), 4294967295)"


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


ID_CRC = crc32_sql("[CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]")
OP11_SQL = f"""WITH tn AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
    dense_rank() OVER (ORDER BY role, text) AS t, length(text) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL)),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first, {ID_CRC} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM tn)),
rb AS (
  SELECT conv_id, list(t ORDER BY part, pos) AS ts FROM (
    SELECT i.conv_id, 0 AS part, pos, t FROM ids i JOIN tn ON tn.conv_id = i.first AND pos <= h
    UNION ALL SELECT conv_id, 1, pos, t FROM ids JOIN tn USING (conv_id) WHERE pos > h) GROUP BY conv_id),
cv AS (SELECT conv_id, coalesce(ts, CAST([] AS BIGINT[])) AS ts FROM ids LEFT JOIN rb USING (conv_id)),
mem AS (
  SELECT conv_id, d, ts[1:d] AS node, len(ts) = d AS ends
  FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM cv)),
nd AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids FROM mem GROUP BY node, d),
kid AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nd WHERE d > 0 GROUP BY 1),
al AS (
  SELECT nd.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(chars, 0) AS value
  FROM nd LEFT JOIN kid USING (node) LEFT JOIN (SELECT DISTINCT t, chars FROM tn) ON t = node[d]),
up AS (
  SELECT node[1:e] AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(value) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM al) GROUP BY 1)
SELECT al.conv_id, al.d AS depth, p.conv_id AS parent_conv_id, al.n_convs, al.n_children, n_leaves, saved_tokens,
  sha256(al.ids) AS ends_sha256
FROM al JOIN up ON up.node = al.node LEFT JOIN nd p ON al.d > 0 AND p.d = al.d - 1 AND p.node = al.node[1:al.d - 1]"""


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Every 31st pair of document and word has a letter deleted, so that there are variants."""
    return spelling.variants(spelling.words(table(spark, sf, "documents"), planted=31))


RUN_BYTES = """flatten([CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)]
    ELSE [CAST(192 + (ord(c) >> 6) AS BIGINT), CAST(128 + (ord(c) & 63) AS BIGINT)] END
    FOR c IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, '')])"""
OP12_SQL = f"""WITH RECURSIVE rn AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hs AS (SELECT run, k, {crc32_sql(RUN_BYTES)} AS h FROM rn),
vo AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(k) AS BIGINT) AS n
  FROM hs GROUP BY 1 HAVING length(word) >= 7 AND sum(k) >= 2),
dl AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vo)),
ed AS (SELECT dl.word AS a, vo.word AS b FROM dl JOIN vo ON vo.word = d),
nr AS (
  SELECT a, b FROM ed UNION SELECT b, a FROM ed
  UNION SELECT x.word, y.word FROM dl x JOIN dl y ON x.i = y.i AND x.d = y.d AND x.word <> y.word),
bs AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY vo.n DESC, b) AS best, max(vo.n) AS best_n
  FROM nr JOIN vo ON vo.word = b GROUP BY a),
fm AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
    CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM vo LEFT JOIN bs USING (word)),
ch AS (
  SELECT word, word AS at FROM fm
  UNION ALL SELECT ch.word, fm.form FROM ch JOIN fm ON fm.word = ch.at WHERE fm.form IS NOT NULL),
rt AS (SELECT ch.word, ch.at AS root FROM ch JOIN fm ON fm.word = ch.at WHERE fm.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM fm JOIN rt USING (word)"""


def op13_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_merge_dropout, op2_toxicity, op3_lm, op4_quality, op5_packing, op6_prob_minhash, op7_line_templates,
        op8_warc, op9_embeddings, op10_url_filter, op11_prefix_trie, op12_spelling, op13_fingerprints,
    )
}
ORACLES: dict[str, str] = {
    "op7_line_templates": OP7_SQL, "op8_warc": OP8_SQL, "op9_embeddings": OP9_SQL, "op10_url_filter": OP10_SQL,
    "op11_prefix_trie": OP11_SQL, "op12_spelling": OP12_SQL,
}
