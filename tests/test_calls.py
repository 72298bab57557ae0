"""Queries over calls (conversations put together) against their SQL, on rows of their own."""

import duckdb
import pytest

from oracle_check import compare

TURNS = [
    (1, 1, "user", "Where is my order? The report is late and I am upset. Mail me at maria.lopez@example.com please."),
    (1, 2, "assistant", "Thanks for waiting. I will send the update to maria.lopez@example.com today. Anything else?"),
    (2, 1, "user", "My degree is missing. The school says it is wrong! Call (555) 123-4567 now."),
    (2, 2, "assistant", "That is noted. Nothing is known yet."),
    (3, 1, "user", "thanks"),
    (3, 1, "user", "thanks"),
    (4, 1, "user", "The lab gave me no appointment for the drug test. My number is 123-45-6789. It is a problem."),
    (4, 2, "assistant", "We'll book the clinic. The lab is open. The lab is open."),
    (9, 1, "assistant", "Nobody ordered this. We're going to close it."),
]
TABLES = {
    "conversations": ("conv_id long, turn int, role string, text string", TURNS),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string",
               [(k, 10 + k % 3, "OPF"[k % 3], f"1997-0{1 + k % 8}-15") for k in range(1, 9)] + [(20, 11, "F", "1996-02-01"), (30, 99, "O", "1998-03-01")]),
    "customer": ("c_custkey long, c_nationkey int", [(10, 1), (11, 2), (12, 3)]),
    "benchmark": ("item_id long, text string", [(1, "Where is the order report?"), (2, "drug test at the lab"), (3, "zebra"), (4, "the update today")]),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d, con = str(tmp_path_factory.mktemp("calls")), duckdb.connect()
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet/*.parquet')")
    return d, con


def _compared(spark, tables, name):
    import __spark_entry__ as E
    d, con = tables
    df = E.queries()[name](spark, d).cache()
    ok, msg, _ = compare(spark, con, name, lambda *_: df, E.oracle_sql()[name], d)
    assert ok, msg
    return df.collect()


def test_call_insights(spark, tables):
    rows = {r.contact_id: r for r in _compared(spark, tables, "txt_call_insights")}
    assert set(rows) == {"1", "2", "3", "4", "9"}
    assert rows["1"].commitment == "Commitment: I will send the update to [EMAIL] today" and rows["1"].candidate_id == 11
    assert rows["4"].call_reason == "Drug test scheduling" and "[SSN]" in rows["4"].transcript_redacted
    assert rows["9"].candidate_id is None and all(r.summary for r in rows.values())


def test_search_corpus(spark, tables):
    rows = _compared(spark, tables, "txt_search_corpus")
    calls = {r.doc_id: r for r in rows if r.doc_type == "CALL"}
    assert set(calls) == {"1", "2", "3", "4", "9"} and len(rows) > len(calls)
    assert calls["9"].content == ("assistant: Nobody ordered this. We're going to close it.\n"
                                  "Summary: assistant: Nobody ordered this. We're going to close it.\nCommitment: We're going to close it.")
    assert all(r.call_reason is None and r.content for r in rows if r.doc_type == "OPS_NOTE")


def test_corpus_check(spark, tables):
    assert [r.leaked for r in _compared(spark, tables, "gov_corpus_check")] == [0]


def test_corpus_search(spark, tables):
    best = {r.item_id: r for r in _compared(spark, tables, "txt_corpus_search") if r["rank"] == 1}
    assert {i: r.doc_id for i, r in best.items()} == {1: "1", 2: "4", 4: "1"}
    assert best[2].call_reason == "Drug test scheduling"
