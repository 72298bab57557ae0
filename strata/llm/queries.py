"""Registered queries of the operators, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# The words of a text: runs of characters other than space and \x09-\x0D.
WORDS = "regexp_extract_all(coalesce({0}, ''), '[^\\x20\\x09-\\x0D]+')"

OP10_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
x AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k
      FROM d, unnest(range(1, len(w) - 18)) AS u(s) WHERE len(w) >= 20),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM x) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, s + j AS i FROM r, unnest(range(0, 20)) AS u(j)),
h AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(coalesce(gone, [])) AS BIGINT) AS n_removed,
       sha256(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(coalesce(gone, []), i)], ' ')) AS kept_sha256
FROM d LEFT JOIN h USING (doc_id)
"""


@register("op10_substring_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import remove_repeats
    return remove_repeats(read(spark, sf_dir, "documents"), keep_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP8_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN {WORDS.format('text')}] AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)])
                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS e FROM d),
x AS (SELECT doc_id, unnest(e) AS g FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
         WHERE 100 * i >= 80 * (len(sa.e) + len(sb.e) - i)),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(e) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


@register("op8_minhash_near_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sketch import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"), k=4, num=80, den=100)


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS x FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY x, n) AS last FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1) FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM m
"""


@register("op1_warc", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.session import shared_table_path

    from .warc import read_payloads, write_archive
    path = shared_table_path(spark, "warc")
    write_archive(read(spark, sf_dir, "pages"), path, min_bytes=0)
    return read_payloads(spark, path).drop("payload")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


OP3_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e,
    embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0 AS ok FROM embeddings),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.ok AND b.ok AND len(a.e) = len(b.e)
         WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY 1)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""


@register("op3_sorted_projection", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .projection import near_vectors
    return near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.9)


OP5_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@register("op5_exact_topk", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mtree import top_products
    table = read(spark, sf_dir, "embeddings")
    return top_products(table, table.where("vec_id % 100 = 0"), k=10)


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import THRESHOLD, fit, held_out, score
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@register("op6_line_templates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .templates import drop_template_lines
    out = drop_template_lines(read(spark, sf_dir, "documents"), min_docs=10)
    return out.select("rest.doc_id", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


@register("op7_kneser_ney")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kneser_ney import quality
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").where("quality = 1"))


@register("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .unigram import Pieces, decode, encode
    pieces = spark.sparkContext.broadcast(Pieces.load(tokenizer_path("piece_bpe_32k.model")))
    out = decode(encode(read(spark, sf_dir, "documents"), pieces), pieces)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"),
                      F.col("decoded").eqNullSafe(F.translate("text", "▁", " ")).alias("round_trip"))


OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS.format('text')} AS w FROM documents),
f AS (SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM d),
g AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN g USING (doc_id) GROUP BY part, fails),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT *, CAST(i AS INT) AS step, substr(filter_order, i, 1) AS x FROM o, range(1, 6) AS r(i)),
m AS (SELECT *, list_min([strpos(filter_order, substr(fails, i, 1)) FOR i IN range(1, length(fails) + 1)]) AS gone FROM c, o),
t AS (SELECT m.part, s.filter_order, s.step, s.x, sum(CASE WHEN coalesce(gone, 9) > s.step THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN gone = s.step THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone < s.step AND contains(fails, s.x) THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = s.x THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN gone = s.step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = s.step THEN toxic ELSE 0 END) AS toxic_lost
      FROM m JOIN s USING (filter_order) GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM t
"""


@register("op11_filter_audit", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audit import filter_audit
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import align_tokenizers
    return align_tokenizers(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def _ring_sql(shards: int = 8, vnodes: int = 128, ring: int = 1 << 16, sub: int = 16) -> str:
    """The ring in rounds; CRC-32 from its polynomial (a fixed value), byte by byte."""
    position = "CAST('0x' || substr({0}, 1, 4) AS BIGINT)"
    sql = f"""
WITH t AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
           lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS mark, octet_length(encode(coalesce(text, ''))) + 1 AS size,
      [CAST('0x' || h AS BIGINT) FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')] AS b FROM documents),
e AS (SELECT doc_id, mark, size, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
      lambda a, x: xor(a >> 8, tab[CAST((xor(a, x) & 255) + 1 AS INTEGER)])), 4294967295) AS crc FROM d, t),
k AS (SELECT {position.format("md5('shard-' || (i // " + str(vnodes) + ") || '-' || (i % " + str(vnodes) + "))")} AS pos, i // {vnodes} AS shard, i FROM range({shards * vnodes}) r(i)),
nodes AS (SELECT row_number() OVER (ORDER BY pos, i) - 1 AS node, shard, pos FROM k),
placed AS (SELECT e.*, {position.format('mark')} AS p, coalesce((SELECT min(node) FROM nodes WHERE pos >= {position.format('mark')}), 0) AS arc FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY arc ORDER BY CASE WHEN p > (SELECT max(pos) FROM nodes) THEN p - {ring} ELSE p END,
             crc % {sub}, mark, size, crc, doc_id) - 1 AS place FROM placed),
cap AS (SELECT i AS shard, (SELECT count(*) FROM e) // {shards} + CASE WHEN i < (SELECT count(*) FROM e) % {shards} THEN 1 ELSE 0 END AS room FROM range({shards}) s(i)),
w0 AS (SELECT doc_id, size, crc, arc, place, arc AS node FROM r),
left0 AS (SELECT shard, room, room AS free FROM cap)"""
    for i in range(shards):
        sql += f""",
q{i} AS (SELECT w.*, shard, row_number() OVER (PARTITION BY shard ORDER BY arc, place) AS nth FROM w{i} w JOIN nodes USING (node)),
p{i} AS (SELECT q.*, free, room FROM q{i} q JOIN left{i} USING (shard)),
left{i + 1} AS (SELECT shard, room, free - least(free, coalesce(n, 0)) AS free FROM left{i} LEFT JOIN (SELECT shard, count(*) AS n FROM q{i} GROUP BY shard) USING (shard)),
open{i} AS (SELECT node FROM nodes JOIN left{i + 1} USING (shard) WHERE free > 0),
w{i + 1} AS (SELECT doc_id, size, crc, arc, place, coalesce((SELECT min(o.node) FROM open{i} o WHERE o.node > p.node), (SELECT min(o.node) FROM open{i} o)) AS node
       FROM p{i} p WHERE nth > free)"""
    placed = " UNION ALL ".join(f"SELECT doc_id, size, crc, shard, room - free + nth - 1 AS slot FROM p{i} WHERE nth <= free" for i in range(shards))
    return sql + f"""
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(slot AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard FROM ({placed})
"""


@register("op13_ring", _ring_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ring import shard_documents
    out = shard_documents(read(spark, sf_dir, "documents"), shards=8, keep=["doc_id"])
    return out.select("rest.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
