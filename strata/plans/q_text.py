"""Text enrichment and search queries (TXT-01..13, Q-18, 20, 24) with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..marts import cases as C
from ..operators import govern as G
from ..operators import search as SE
from ..operators import text as TX
from ..operators import windows as W
from ..session import shared_table_path
from ..sources.io import materialize, scan
from .catalog import register
from .roles import AS_OF_ORDERS as ORD, R, Roles


def _q(s: str) -> str:
    return s.replace("'", "''")


def _sql_list(xs) -> str:
    return "[" + ", ".join(f"'{_q(x)}'" for x in xs) + "]"


def sql_redact(e: str) -> str:
    for _, pat, rep in TX.PII_PATTERNS:
        e = f"regexp_replace({e}, '{_q(pat)}', '{rep}', 'g')"
    return e


def sql_tokens(e: str) -> str:
    return f"string_split_regex(lower({e}), '{TX.TOKEN_SPLIT}')"


def sql_hits(tok: str, terms) -> str:
    return f"len(list_filter({tok}, lambda x: list_contains({_sql_list(terms)}, x)))"


def sql_reason(e: str) -> str:
    tok = sql_tokens(e)
    scores = "[" + ", ".join(sql_hits(tok, TX.REASON_TERMS[l]) for l in TX.CALL_REASONS) + "]"
    return f"{_sql_list(TX.CALL_REASONS)}[list_position({scores}, list_max({scores}))]"


def sql_sentiment(e: str) -> str:
    tok = sql_tokens(e)
    p, n = sql_hits(tok, TX.POSITIVE_TERMS), sql_hits(tok, TX.NEGATIVE_TERMS)
    return (f"CASE WHEN {p} = 0 AND {n} = 0 THEN 'neutral' WHEN {p} > 0 AND {n} > 0 AND abs({p} - {n}) <= 1 THEN 'mixed' "
            f"WHEN {p} > {n} THEN 'positive' ELSE 'negative' END")


def sql_summary(table: str, key: str, col: str) -> str:
    """CTE body list (without WITH) producing summ(key, summary)."""
    sp = f"string_split_regex({col}, '{TX.SENTENCE_SPLIT}')"
    return (f"s AS (SELECT {key}, unnest({sp}) AS sentence, generate_subscripts({sp}, 1) - 1 AS pos FROM {table}), "
            "s2 AS (SELECT * FROM s WHERE length(trim(sentence)) > 0), "
            f"tk AS (SELECT {key}, pos, unnest({sql_tokens('sentence')}) AS term FROM s2), tk2 AS (SELECT * FROM tk WHERE length(term) > 0), "
            f"tf AS (SELECT {key}, term, count(*) AS tf FROM tk2 GROUP BY 1, 2), dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), "
            f"nd AS (SELECT count(DISTINCT {key}) AS n FROM {table}), "
            f"w AS (SELECT tf.{key}, tf.term, tf.tf * ln(nd.n / dfq.df) AS tfidf FROM tf JOIN dfq USING (term), nd), "
            f"sc AS (SELECT tk2.{key}, tk2.pos, floor(sum(w.tfidf) / count(*) * 1e9 + 0.5) / 1e9 AS score FROM tk2 JOIN w USING ({key}, term) GROUP BY 1, 2), "
            f"tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, pos) AS r FROM sc) WHERE r <= 2), "
            f"summ AS (SELECT tp.{key}, string_agg(trim(s2.sentence), '. ' ORDER BY tp.pos) AS summary FROM tp JOIN s2 USING ({key}, pos) GROUP BY 1)")


# promises are taken from redacted turns, never from the raw text
_COMMIT_SQL = (
    f"rt AS (SELECT conv_id, turn, role, {sql_redact('text')} AS text FROM conversations), "
    "ag AS (SELECT conv_id, turn, unnest(string_split_regex(text, '" + TX.SENTENCE_SPLIT + "')) AS sentence, "
    "generate_subscripts(string_split_regex(text, '" + TX.SENTENCE_SPLIT + "'), 1) - 1 AS pos FROM rt WHERE role = 'assistant'), "
    "hit AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) AS r FROM ag WHERE regexp_matches(lower(sentence), '"
    + _q(TX.PROMISE_PATTERN) + "')), "
    "cm AS (SELECT k.conv_id, 'Commitment: ' || coalesce(trim(h.sentence), 'None') AS commitment FROM (SELECT DISTINCT conv_id FROM conversations) k "
    "LEFT JOIN (SELECT * FROM hit WHERE r = 1) h ON k.conv_id = h.conv_id)")

_INSIGHT_SQL = (f"{R('calls')}, {_COMMIT_SQL}, red AS (SELECT contact_id, order_id, started_at, duration_sec, "
                f"{sql_redact('transcript')} AS transcript_redacted FROM calls), "
                "ins AS (SELECT red.contact_id, red.order_id, red.started_at, CAST(red.started_at AS DATE) AS call_date, red.duration_sec, "
                f"red.transcript_redacted, {sql_reason('red.transcript_redacted')} AS call_reason, "
                f"{sql_sentiment('red.transcript_redacted')} AS sentiment, cm.commitment FROM red "
                "LEFT JOIN cm ON CAST(red.contact_id AS BIGINT) = cm.conv_id)")


def _commitments(spark, d):
    turns = TX.redact(scan(spark, d, "conversations"), "text")
    return TX.commitments(turns, "conv_id", "turn", "role", "text")


def _insights(spark, d):
    r = Roles(spark, d)
    calls = TX.redact(r.calls(), "transcript", out="transcript_redacted").drop("transcript")
    calls = TX.classify_rules(calls, "transcript_redacted")
    calls = TX.sentiment(calls, "transcript_redacted")
    cm = _commitments(spark, d)
    calls = calls.join(cm.select(F.col("conv_id").cast("string").alias("contact_id"), "commitment"), "contact_id", "left")
    return calls.select("contact_id", "order_id", "started_at", F.to_date("started_at").alias("call_date"), "duration_sec",
                        "transcript_redacted", "call_reason", "sentiment", "commitment")


@register("txt_redact_documents", f"SELECT doc_id, {sql_redact('text')} AS text_redacted FROM documents")
def txt_redact_documents(spark, d):
    """TXT-01 PII redaction of whole documents to typed placeholders."""
    return TX.redact(scan(spark, d, "documents").select("doc_id", "text"), "text", out="text_redacted").drop("text")


@register("txt_pii_counts", "SELECT doc_id, " + ", ".join(f"len(regexp_extract_all(text, '{_q(p)}')) AS n_{k}" for k, p, _ in TX.PII_PATTERNS)
          + " FROM documents", big=" ".join(f"n_{k}" for k, _, _ in TX.PII_PATTERNS))
def txt_pii_counts(spark, d):
    """TXT-02 PII match counts per kind."""
    return TX.pii_counts(scan(spark, d, "documents").select("doc_id", "text"), "text").drop("text")


@register("gov_redaction_check", f"SELECT count(*) AS leaked FROM (SELECT {sql_redact('text')} AS t FROM documents) WHERE "
          + " OR ".join(f"regexp_matches(t, '{_q(p)}')" for k, p, _ in TX.PII_PATTERNS))
def gov_redaction_check(spark, d):
    """GOV-05 nothing downstream of redaction still matches a pattern of any of the six kinds."""
    red = TX.redact(scan(spark, d, "documents").select("doc_id", "text"), "text", out="t")
    return G.assert_redacted_before(red, "t", [p for _, p, _ in TX.PII_PATTERNS]).agg(F.count(F.lit(1)).alias("leaked"))


@register("txt_classify_documents", f"SELECT doc_id, {sql_reason('text')} AS call_reason, {sql_sentiment('text')} AS sentiment FROM documents")
def txt_classify_documents(spark, d):
    """TXT-03 rule classification into the 8 reasons and TXT-05 lexicon sentiment over whole documents."""
    x = scan(spark, d, "documents").select("doc_id", "text")
    return TX.sentiment(TX.classify_rules(x, "text"), "text").drop("text")


@register("txt_label_distribution", f"SELECT {sql_reason('text')} AS call_reason, {sql_sentiment('text')} AS sentiment, count(*) AS docs "
          "FROM documents GROUP BY 1, 2")
def txt_label_distribution(spark, d):
    """TXT-03/05 label distribution over the corpus."""
    x = TX.sentiment(TX.classify_rules(scan(spark, d, "documents").select("doc_id", "text"), "text"), "text")
    return x.groupBy("call_reason", "sentiment").agg(F.count(F.lit(1)).alias("docs"))


@register("txt_commitments", f"WITH {_COMMIT_SQL} SELECT * FROM cm")
def txt_commitments(spark, d):
    """TXT-09 'Commitment:' line per conversation from the agent's promise sentences, else 'None'."""
    return _commitments(spark, d)


@register("txt_call_insights", f"WITH {_INSIGHT_SQL}, {sql_summary('ins', 'contact_id', 'transcript_redacted')}, {R('scr_orders')} "
          "SELECT ins.*, summ.summary, o.candidate_id FROM ins LEFT JOIN summ ON ins.contact_id = summ.contact_id "
          "LEFT JOIN scr_orders o ON ins.order_id = o.order_id", big="candidate_id")
def txt_call_insights(spark, d):
    """TXT-07 CALL_INSIGHTS: redacted transcript, reason, sentiment, commitment, summary and candidate per call."""
    i = _insights(spark, d)
    i = i.join(TX.summarize(i.select("contact_id", "transcript_redacted"), "contact_id", "transcript_redacted"), "contact_id", "left")
    return i.join(Roles(spark, d).scr_orders().select("order_id", "candidate_id"), "order_id", "left")


@register("txt_summarize_documents", f"WITH {sql_summary('documents', 'doc_id', 'text')} SELECT * FROM summ")
def txt_summarize_documents(spark, d):
    """TXT-08 two-sentence extractive summary (TF-IDF sentence scores) of every whole document."""
    docs = scan(spark, d, "documents").select("doc_id", "text")
    return TX.summarize(docs, "doc_id", "text")


def _corpus_sql() -> str:
    from . import q_cases  # noqa: F401  (registers the ops-notes oracle used below)
    from .catalog import ORACLE
    return (f"WITH {_INSIGHT_SQL}, {sql_summary('ins', 'contact_id', 'transcript_redacted')} "
            "SELECT 'CALL' AS doc_type, ins.contact_id AS doc_id, ins.order_id, ins.started_at AS doc_ts, ins.call_reason, "
            "concat_ws(chr(10), ins.transcript_redacted, 'Summary: ' || coalesce(summ.summary, ''), ins.commitment) AS content "
            "FROM ins LEFT JOIN summ USING (contact_id) UNION ALL "
            "SELECT 'OPS_NOTE', CAST(n.note_id AS VARCHAR), n.order_id, CAST(n.created_at AS TIMESTAMP), NULL, n.note_text "
            f"FROM ({ORACLE['mart_ops_notes']}) n")


@register("txt_search_corpus", _corpus_sql(), big="order_id")
def txt_search_corpus(spark, d):
    """TXT-10 / SET-02 search corpus: redacted calls (text + summary + commitment) UNION ALL ops notes,
    NULL-padded columns."""
    ins = _insights(spark, d)
    summ = TX.summarize(ins.select("contact_id", "transcript_redacted"), "contact_id", "transcript_redacted")
    calls = ins.join(summ, "contact_id", "left").select(
        F.lit("CALL").alias("doc_type"), F.col("contact_id").alias("doc_id"), "order_id", F.col("started_at").alias("doc_ts"),
        "call_reason", F.concat_ws("\n", "transcript_redacted", F.concat(F.lit("Summary: "), F.coalesce("summary", F.lit(""))),
                                   "commitment").alias("content"))
    notes = C.ops_notes(C.order_status(Roles(spark, d).scr_orders(), ORD)).select(
        F.lit("OPS_NOTE").alias("doc_type"), F.col("note_id").cast("string").alias("doc_id"), "order_id",
        F.col("created_at").alias("doc_ts"), F.col("note_text").alias("content"))
    return calls.unionByName(notes, allowMissingColumns=True)


@register("gov_corpus_check", f"WITH c AS ({_corpus_sql()}) SELECT count(*) AS leaked FROM c WHERE "
          + " OR ".join(f"regexp_matches(content, '{_q(p)}')" for _, p, _ in TX.PII_PATTERNS), big="leaked")
def gov_corpus_check(spark, d):
    """GOV-05 rows of the search corpus (transcripts, summaries, promises, notes) that still match a PII pattern."""
    leaked = G.assert_redacted_before(txt_search_corpus(spark, d), "content", [p for _, p, _ in TX.PII_PATTERNS])
    return leaked.agg(F.count(F.lit(1)).alias("leaked"))


_BM25_SQL = (
    f"tok AS (SELECT doc_id, unnest({sql_tokens('text')}) AS term FROM documents), tok2 AS (SELECT * FROM tok WHERE length(term) > 0), "
    "post AS (SELECT doc_id, term, count(*) AS tf FROM tok2 GROUP BY 1, 2), dl AS (SELECT doc_id, count(*) AS dl FROM tok2 GROUP BY 1), "
    "st AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM dl), dfq AS (SELECT term, count(*) AS df FROM post GROUP BY 1), "
    f"q AS (SELECT item_id, unnest({sql_tokens('text')}) AS term FROM benchmark), q2 AS (SELECT DISTINCT item_id, term FROM q WHERE length(term) > 0), "
    "qt AS (SELECT q2.item_id, q2.term, ln(1 + (st.n_docs - dfq.df + 0.5) / (dfq.df + 0.5)) AS idf, st.avgdl FROM q2 JOIN dfq USING (term), st), "
    "sc AS (SELECT qt.item_id, p.doc_id, floor(sum(qt.idf * (p.tf * 2.2) / (p.tf + 1.2 * (1 - 0.75 + 0.75 * dl.dl / qt.avgdl))) * 1e9 + 0.5) / 1e9 AS score "
    "FROM qt JOIN post p USING (term) JOIN dl USING (doc_id) GROUP BY 1, 2), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc)")


@register("txt_bm25_search", f"WITH {_BM25_SQL} SELECT item_id, doc_id, score, rank FROM ranked WHERE rank <= 8", dbl="score")
def txt_bm25_search(spark, d):
    """TXT-11 batch BM25 search: every benchmark passage as a query over all documents, top 8."""
    return SE.bm25_search(scan(spark, d, "documents").select("doc_id", "text"), "doc_id", "text",
                          scan(spark, d, "benchmark"), "item_id", "text", k=8)


@register("txt_bm25_filtered", f"WITH {_BM25_SQL.replace('FROM documents)', 'FROM documents WHERE lang = ' + repr('en') + ')', 1)} "
          "SELECT item_id, doc_id, score, rank FROM ranked WHERE rank <= 8", dbl="score")
def txt_bm25_filtered(spark, d):
    """TXT-11 with an attribute filter (English documents only) applied before indexing."""
    return SE.bm25_search(scan(spark, d, "documents").select("doc_id", "text", "lang"), "doc_id", "text",
                          scan(spark, d, "benchmark"), "item_id", "text", k=8, where=F.col("lang") == "en")


def _search_sql(table: str, text: str) -> str:
    """The BM25 ranking of ``_BM25_SQL`` over another table."""
    return _BM25_SQL.replace("unnest(" + sql_tokens("text") + ") AS term FROM documents", f"unnest({sql_tokens(text)}) AS term FROM {table}")


@register("txt_corpus_search", f"WITH corpus AS ({_corpus_sql()}), calls_only AS (SELECT * FROM corpus WHERE doc_type = 'CALL'), "
          f"{_search_sql('calls_only', 'content')} SELECT r.item_id, r.doc_id, c.call_reason, r.score, r.rank FROM ranked r "
          "JOIN calls_only c USING (doc_id) WHERE rank <= 5", dbl="score")
def txt_corpus_search(spark, d):
    """TXT-10/11 search over the redacted corpus (calls with summary and promise, notes), filtered by its attributes:
    the 5 calls nearest to every benchmark passage, with their reason."""
    corpus = materialize(txt_search_corpus(spark, d), shared_table_path(spark, "search_corpus")).where(F.col("doc_type") == "CALL")
    hits = SE.bm25_search(corpus, "doc_id", "content", scan(spark, d, "benchmark"), "item_id", "text", k=5)
    return hits.join(corpus.select("doc_id", "call_reason"), "doc_id").select("item_id", "doc_id", "call_reason", "score", "rank")


@register("txt_vector_search", "WITH c AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM (SELECT label, unnest(embedding) AS v, "
          "generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2), cent AS (SELECT label AS query_label, list(m ORDER BY i) AS centroid "
          "FROM c GROUP BY 1), sc AS (SELECT cent.query_label, e.vec_id, list_dot_product(CAST(e.embedding AS DOUBLE[]), cent.centroid) / "
          "(sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))) * sqrt(list_dot_product(cent.centroid, cent.centroid))) AS score0 "
          "FROM embeddings e, cent), sc2 AS (SELECT query_label, vec_id, floor(score0 * 1e12 + 0.5) / 1e12 AS score FROM sc) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY score DESC, vec_id) AS rank FROM sc2) "
          "WHERE rank <= 5", dbl="score", big="query_label")
def txt_vector_search(spark, d):
    """TXT-12 exact cosine top-5 per query; the queries are the per-label centroid vectors."""
    e = scan(spark, d, "embeddings")
    q = SE.centroids(e, "label", "embedding", 64).withColumnRenamed("label", "query_label")
    return SE.vector_search(e, "vec_id", "embedding", q, "query_label", "centroid", k=5)


@register("txt_top_reasons", f"WITH {_INSIGHT_SQL}, g AS (SELECT CAST(date_trunc('week', call_date) AS DATE) AS period, call_reason, count(*) AS calls "
          "FROM ins GROUP BY 1, 2), t AS (SELECT period, sum(calls) AS tot FROM g GROUP BY 1) SELECT * FROM (SELECT g.period, g.call_reason, g.calls, "
          "g.calls / t.tot AS share, row_number() OVER (PARTITION BY g.period ORDER BY g.calls DESC, g.call_reason) AS rank FROM g JOIN t USING (period)) "
          "WHERE rank <= 5", dbl="share")
def txt_top_reasons(spark, d):
    """TXT-13 / Q-18 top call reasons per week with counts and share."""
    return TX.top_reasons(_insights(spark, d), "call_date", "call_reason", k=5)


@register("q18_sentiment_trend", f"WITH {_INSIGHT_SQL} SELECT CAST(date_trunc('week', call_date) AS DATE) AS period, count(*) AS calls, "
          "avg(CASE WHEN sentiment = 'negative' THEN 1.0 ELSE 0.0 END) AS negative_share, avg(CASE WHEN sentiment = 'positive' THEN 1.0 ELSE 0.0 END) "
          "AS positive_share FROM ins GROUP BY 1", dbl="negative_share positive_share")
def q18_sentiment_trend(spark, d):
    """Q-18 sentiment trend by week."""
    from ..operators.aggs import rate
    i = _insights(spark, d)
    return i.groupBy(F.date_trunc("week", "call_date").cast("date").alias("period")).agg(
        F.count(F.lit(1)).alias("calls"), rate(F.col("sentiment") == "negative").alias("negative_share"),
        rate(F.col("sentiment") == "positive").alias("positive_share"))


@register("q20_negative_calls_next_steps", f"WITH {_INSIGHT_SQL} SELECT contact_id, order_id, call_reason, sentiment, commitment FROM ins "
          "WHERE sentiment IN ('negative', 'mixed')")
def q20_negative_calls_next_steps(spark, d):
    """Q-20 negative (or mixed) calls with their reason and the agent's next step."""
    i = _insights(spark, d)
    return i.where(F.col("sentiment").isin("negative", "mixed")).select("contact_id", "order_id", "call_reason", "sentiment", "commitment")


@register("q24_last_calls_per_person", f"WITH {_INSIGHT_SQL}, {R('scr_orders')}, x AS (SELECT o.candidate_id, i.contact_id, i.started_at, i.commitment, "
          "row_number() OVER (PARTITION BY o.candidate_id ORDER BY i.started_at DESC, i.contact_id) AS rn FROM ins i JOIN scr_orders o ON i.order_id = o.order_id) "
          "SELECT candidate_id, contact_id, started_at, commitment, rn, '***MASKED***' AS transcript FROM x WHERE rn <= 3", big="rn")
def q24_last_calls_per_person(spark, d):
    """Q-24 last 3 calls per candidate with the promise made; raw transcript masked for SUPPORT_AGENT."""
    r = Roles(spark, d)
    i = _insights(spark, d).join(r.scr_orders().select("order_id", "candidate_id"), "order_id")
    i = i.join(r.calls().select("contact_id", "transcript"), "contact_id")
    t = W.top_k_per_salted(i, "candidate_id", [F.desc("started_at"), F.asc("contact_id")], 3, ["contact_id"], name="rn")
    t = G.apply_policies(t, {"transcript": "string"}, "SUPPORT_AGENT")
    return t.select("candidate_id", "contact_id", "started_at", "commitment", "rn", "transcript")
