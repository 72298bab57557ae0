"""Text enrichment operators.

Per-row work stays in JVM expressions: regex replacement/counting, and
lexicon scoring as higher-order array functions over the token array, so
classification and sentiment need no shuffle and no Python.  Only the
extractive summary needs corpus statistics (document frequency), computed as
a grouped aggregate and handed back to parts of the documents, which array
code scores.  Whole texts are processed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# PII kinds in replacement order -> (pattern, placeholder).  Patterns use the
# regex subset shared by Java and RE2 (no look-around, no back-references, no \b).
PII_PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    ("phone", r"(\+1 )?\(\d{3}\) \d{3}-\d{4}", "[PHONE]"),
    ("card", r"\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}", "[CARD]"),
    ("ssn", r"\d{3}-\d{2}-\d{4}", "[SSN]"),
    ("ip", r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", "[IP]"),
    ("dob", r"(0[1-9]|1[0-2])/(0[1-9]|[12][0-9]|3[01])/(19|20)[0-9]{2}", "[DOB]"),
]
# The eight call-reason labels, in tie-break order.
CALL_REASONS = ["Order status inquiry", "Delay complaint", "Education verification issue", "Dispute of report findings",
                "Portal or consent form help", "Drug test scheduling", "Adverse action question", "Employer / HR escalation"]
# Lexicon terms per call reason.
REASON_TERMS = {
    "Order status inquiry": ["status", "update", "progress", "check", "order"],
    "Delay complaint": ["delay", "delayed", "late", "waiting", "slow", "weeks"],
    "Education verification issue": ["education", "degree", "school", "university", "diploma"],
    "Dispute of report findings": ["dispute", "wrong", "incorrect", "error", "mistake"],
    "Portal or consent form help": ["portal", "consent", "form", "login", "password", "link"],
    "Drug test scheduling": ["drug", "test", "lab", "clinic", "appointment"],
    "Adverse action question": ["adverse", "action", "notice", "denied", "rejected"],
    "Employer / HR escalation": ["employer", "hr", "escalate", "manager", "recruiter"],
}
# Sentiment lexicon.
POSITIVE_TERMS = ["good", "great", "thanks", "thank", "happy", "resolved", "helpful", "appreciate", "excellent", "perfect"]
NEGATIVE_TERMS = ["bad", "angry", "frustrated", "delay", "late", "wrong", "problem", "issue", "terrible", "upset"]
SENTIMENTS = ["positive", "neutral", "negative", "mixed"]
# Promise phrases that mark an agent commitment.
PROMISE_PATTERN = r"(^|[^a-z])(i will|we will|i'll|we'll|going to|promise)([^a-z]|$)"
TOKEN_SPLIT = r"[^a-z0-9]+"
SENTENCE_SPLIT = r"[.!?]\s+"


def tokens(c) -> Column:
    """Lower-case ASCII word tokens of the whole text (non-ASCII letters separate tokens)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.split(F.lower(c), TOKEN_SPLIT)


# A pattern can only match text containing its guard, so the regex is skipped otherwise.
_GUARDS = {"email": lambda c: c.contains("@"), "phone": lambda c: c.contains(") "),
           "card": lambda c: c.rlike("[0-9]"), "ssn": lambda c: c.rlike("[0-9]"),
           "ip": lambda c: c.rlike("[0-9]"), "dob": lambda c: c.contains("/")}


def redact(df: DataFrame, col: str, kinds: Sequence[str] | None = None, out: str | None = None) -> DataFrame:
    """TXT-01 ordered regex replacement of PII to typed placeholders (whole texts)."""
    e = F.col(col)
    for kind, pat, rep in PII_PATTERNS:
        if kinds is None or kind in kinds:
            e = F.when(_GUARDS[kind](e), F.regexp_replace(e, pat, rep)).otherwise(e)
    return df.withColumn(out or col, e)


def pii_counts(df: DataFrame, col: str) -> DataFrame:
    """TXT-02 number of matches per PII kind (each kind counted on the original text)."""
    return df.withColumns({f"n_{k}": F.regexp_count(F.col(col), F.lit(p)) for k, p, _ in PII_PATTERNS})


def _term_hits(tok: Column, terms: Sequence[str]) -> Column:
    return F.size(F.filter(tok, lambda x: x.isin(list(terms))))


def classify_rules(df: DataFrame, col: str, lexicon: Mapping[str, Sequence[str]] = REASON_TERMS,
                   out: str = "call_reason") -> DataFrame:
    """TXT-03 rule classifier: per-label term occurrence counts, argmax with ties (and the
    all-zero case) resolved by list order."""
    labels = list(lexicon)
    allterms = sorted({t for l in labels for t in lexicon[l]})
    # one pass over the tokens keeps only lexicon hits; labels are counted on that short array
    x = df.withColumn("_hits", F.filter(tokens(col), lambda t: t.isin(allterms)))
    x = x.withColumn("_scores", F.array(*[_term_hits(F.col("_hits"), lexicon[l]) for l in labels]))
    pos = F.array_position(F.col("_scores"), F.array_max("_scores"))
    return x.withColumn(out, F.get(F.array(*[F.lit(l) for l in labels]), (pos - 1).cast("int"))).drop("_scores", "_hits")


def sentiment(df: DataFrame, col: str, out: str = "sentiment") -> DataFrame:
    """TXT-05 lexicon sentiment: neutral without hits, mixed when both sides are within one hit,
    else the larger side."""
    allterms = sorted(set(POSITIVE_TERMS) | set(NEGATIVE_TERMS))
    x = df.withColumn("_tok", F.filter(tokens(col), lambda t: t.isin(allterms)))
    x = x.withColumns({"_p": _term_hits(F.col("_tok"), POSITIVE_TERMS), "_n": _term_hits(F.col("_tok"), NEGATIVE_TERMS)})
    lab = (F.when((F.col("_p") == 0) & (F.col("_n") == 0), F.lit("neutral"))
           .when((F.col("_p") > 0) & (F.col("_n") > 0) & (F.abs(F.col("_p") - F.col("_n")) <= 1), F.lit("mixed"))
           .when(F.col("_p") > F.col("_n"), F.lit("positive")).otherwise(F.lit("negative")))
    return x.withColumn(out, lab).drop("_p", "_n", "_tok")


def rating_sentiment(rating) -> Column:
    """TXT-06 rating 1..5 -> clamp((r - 3) / 2, -1, 1)."""
    r = F.col(rating) if isinstance(rating, str) else rating
    return F.when(r.isNull(), F.lit(None)).otherwise(F.least(F.greatest((r - 3) / 2, F.lit(-1.0)), F.lit(1.0)))


def sentences(df: DataFrame, key: str, col: str) -> DataFrame:
    """Split each whole text into (key, pos, sentence) rows."""
    return df.select(key, F.posexplode(F.split(F.col(col), SENTENCE_SPLIT)).alias("pos", "sentence")) \
        .where(F.length(F.trim("sentence")) > 0)


# text of a part: what one task scores at once
SUMMARY_PART_BYTES = 8 << 20


def summarize(df: DataFrame, key: str, col: str, k: int = 2, out: str = "summary") -> DataFrame:
    """TXT-08 extractive k-sentence summary.

    Sentence score = mean over its tokens of tf(term, doc) * ln(N / df(term));
    df is counted over documents (distinct terms per document, aggregated), the
    top k sentences per document (ties by position) are re-emitted in their
    original order.

    Documents are dealt to parts of about ``SUMMARY_PART_BYTES`` of text.  What is shuffled are the
    texts and each part's distinct terms, never a row per word: a part's terms are counted where its
    texts lie, summed by term and handed back with their weight.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    parts = max(1, -(-(df.agg(F.sum(F.octet_length(col).cast("bigint"))).first()[0] or 0) // SUMMARY_PART_BYTES))
    dealt = df.select(F.pmod(F.xxhash64(key), F.lit(parts)).alias("_part"), key, col).repartition(parts, "_part")
    terms = dealt.select("_part", key, F.explode(F.array_distinct(tokens(col))).alias("term")).where(F.length("term") > 0)
    held = terms.distinct().groupBy("_part", "term").agg(F.count(F.lit(1)).alias("_n"))
    n_docs = df.select(key).distinct().agg(F.count(F.lit(1))).scalar()
    dfreq = F.sum("_n").over(Window.partitionBy("term"))
    # a name and an attribute of its own: the weights and the texts come from one plan, whose part both sides would else share
    idf = held.select(F.col("_part").alias("_of"), "term", dfreq.alias("df")).select("_of", "term", F.log(n_docs / F.col("df")).alias("idf"))
    s = dealt.where(F.col(key).isNotNull()).select("_part", key, F.split(F.col(col), SENTENCE_SPLIT).alias("_s"))
    s = s.withColumn("_t", F.transform("_s", lambda x: F.filter(tokens(x), lambda t: F.length(t) > 0)))
    kind = df.schema[key].dataType
    return s.groupBy("_part").cogroup(idf.groupBy("_of")).applyInArrow(
        _pick_sentences(key, to_arrow_type(kind), k, out), f"`{key}` {kind.simpleString()}, `{out}` string")


def _pick_sentences(key: str, key_type, k: int, out: str):
    """The summaries of one part from its documents' sentences, their tokens and the part's weights."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def flat(column) -> tuple:
        """The rows' lists one after the other, each element's row and its place there."""
        n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(n)), n)
        return column.flatten(), row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)

    def run(docs: pa.Table, weights: pa.Table) -> pa.Table:
        keys = docs.column(key).combine_chunks().dictionary_encode()
        doc = keys.indices.to_numpy(zero_copy_only=False).astype("int64")
        text, row, pos = flat(docs.column("_s").combine_chunks())
        word, line, _ = flat(flat(docs.column("_t").combine_chunks())[0])
        found = []
        if len(word):
            # rows with the same key are one document, their sentences at the same place are one
            places = int(pos.max()) + 1
            ids, sentence = np.unique(doc[row] * places + pos, return_inverse=True)
            term = pc.index_in(word, value_set=weights.column("term").combine_chunks()).to_numpy(zero_copy_only=False).astype("int64")
            _, pair, tf = np.unique(doc[row[line]] * len(weights) + term, return_inverse=True, return_counts=True)
            tfidf = tf[pair] * weights.column("idf").to_numpy()[term]
            of = sentence[line]
            n = np.bincount(of, minlength=len(ids))
            # snapped to 1e-9, so that exact ties (repeated lines) break by position in every engine
            score = np.floor(np.bincount(of, weights=tfidf, minlength=len(ids)) / np.maximum(n, 1) * 1e9 + 0.5) / 1e9
            best = np.lexsort((ids, -score, ids // places))
            best = best[n[best] > 0]
            owner = ids[best] // places
            rank = np.arange(len(best)) - np.searchsorted(owner, owner)
            taken = np.flatnonzero(np.isin(sentence, best[rank < k]))
            lines = sorted((d, p, t) for d, p, t in zip(doc[row[taken]].tolist(), pos[taken].tolist(), text.take(pa.array(taken)).to_pylist())
                           if t.strip(" "))
            for d, _, t in lines:
                if found and found[-1][0] == d:
                    found[-1][1].append(t.strip(" "))
                else:
                    found.append((d, [t.strip(" ")]))
        return pa.Table.from_arrays([keys.dictionary.take(pa.array([d for d, _ in found], "int64")).cast(key_type),
                                     pa.array([". ".join(x) for _, x in found], "string")], [key, out])

    return run


def commitments(turns: DataFrame, key: str, order: str, role_col: str, text_col: str,
                agent_role: str = "assistant", out: str = "commitment") -> DataFrame:
    """TXT-09 first agent sentence with a promise phrase, as 'Commitment: ...', else 'Commitment: None'."""
    a = turns.where(F.col(role_col) == agent_role).select(
        key, order, F.posexplode(F.split(F.col(text_col), SENTENCE_SPLIT)).alias("pos", "sentence"))
    hit = a.where(F.lower("sentence").rlike(PROMISE_PATTERN))
    first = hit.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order, "pos"))).where("_r = 1")
    keys = turns.select(key).distinct()
    j = keys.join(first.select(key, F.trim("sentence").alias("_s")), key, "left")
    return j.select(key, F.concat(F.lit("Commitment: "), F.coalesce("_s", F.lit("None"))).alias(out))


def top_reasons(df: DataFrame, date_col: str, reason_col: str, k: int = 5, period: str = "week") -> DataFrame:
    """TXT-13 top reasons per period with counts and share of the period's calls."""
    p = F.date_trunc(period, date_col).cast("date").alias("period")
    g = df.groupBy(p, reason_col).agg(F.count(F.lit(1)).alias("calls"))
    tot = g.groupBy("period").agg(F.sum("calls").alias("_tot"))
    x = g.join(tot, "period").withColumn("share", F.col("calls") / F.col("_tot")).drop("_tot")
    w = Window.partitionBy("period").orderBy(F.desc("calls"), F.asc(reason_col))
    return x.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
