"""Ids and keys as bytes in the shuffle of a narrow gate, and as they were after it."""

import pytest
from events import AS_OF, UUID, event, raw
from pyspark.sql import functions as F
from tables import same_as_duckdb, write_tables

from lendmill.operators import gate as G
from lendmill.sinks import layers as S
from lendmill.sources import testviews as V


@pytest.mark.parametrize("text", [UUID.format(7), UUID.format(7)[:16], "", "x", "00000000-0000-4000-8000-0000-0000001", "é" * 36, None])
def test_ids_come_back_as_they_were(spark, text):
    for holds in (True, False):
        if holds and text and len(text) == 36 and text != UUID.format(7):
            continue  # does not hold its form
        row = spark.createDataFrame([(text,)], "id string").select("id", G.packed("id", F.lit(holds)).alias("p")).select("id", "p", G.unpacked(F.col("p")).alias("back")).first()
        assert row["back"] == text
        assert (row["p"] is not None and len(row["p"]) == 16) == (holds and text == UUID.format(7))


def test_failing_ids_keep_their_text_in_a_narrow_gate(spark):
    odd = ["a" * 16, "no uuid", "00000000-0000-4000-8000-0000-0000001", UUID.format(5) + "\n", UUID.format(6).upper()]
    rows = raw(spark, [event(1), event(1), "junk", *[event(2, event_id=i, customer_id=j) for i in odd for j in (UUID.format(8), odd[0])]])
    names = ["event_id", "customer_id", "correlation_id", "outcome", "reason"]
    narrow = G.gate(rows, AS_OF, columns=names)
    whole = G.gate(rows, AS_OF).select(*names, "copies")
    assert narrow.schema.simpleString() == whole.schema.simpleString()
    assert sorted(map(repr, narrow.collect())) == sorted(map(repr, whole.collect()))


def test_typed_ids_are_packed_in_the_shuffle(spark):
    rows = raw(spark, [event(1, "loan_decision"), event(1, "loan_decision"), event(2, "repayment"), event(3, "loan_decision", drop=["customer_id"])])
    for table, ids in (("loan_decisions", ["application_id"]), ("repayments", ["application_id", "loan_id"])):
        narrow = G.gate(rows, AS_OF, columns=S.typed_columns(table))
        types = dict(narrow.dtypes) | {f.name: f.dataType.simpleString() for f in narrow.schema["payload"].dataType}
        assert {types[c] for c in ["event_id", "customer_id", *ids]} == {"binary"}
        wanted = S.typed_rows(G.accepted(G.gate(rows, AS_OF)), table)
        got = S.typed_rows(G.accepted(narrow), table)
        assert got.count() == 1 and got.collect() == wanted.select(*got.columns).collect()


def test_lines_are_dealt_by_one_join(spark, tmp_path):
    """One shuffle of the lines for the join, none after it; the rows stay those of the SQL."""
    path = write_tables(spark, tmp_path)
    plan = V.loan_messages(spark, path)._jdf.queryExecution().executedPlan().toString()
    by_application = [line for line in plan.splitlines() if "Exchange hashpartitioning(application_id" in line]
    assert len(by_application) == 4 and not any("REPARTITION" in line for line in by_application)
    pytest.importorskip("duckdb")
    for name in ("typed_loan_decisions", "typed_repayments"):
        assert same_as_duckdb(spark, path, name)
