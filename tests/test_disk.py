"""What a run leaves on the disk while it goes on, and what its targets shuffle."""

import os

import pytest
from events import AS_OF, event, raw
from pyspark.sql import functions as F

from lendmill import session
from lendmill.operators import gate as G
from lendmill.plans import batch as P
from lendmill.sinks import ledger as E
from lendmill.sources import lake as L

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture()
def lake(tmp_path):
    return L.Lake(str(tmp_path), ("processing_date",))


def test_shuffle_files_go_with_their_job_during_a_batch_run(spark, lake, monkeypatch):
    seen, whole = [], P._run_batch
    monkeypatch.setattr(P, "_run_batch", lambda *a: seen.append(spark.conf.get(KEY)) or whole(*a))
    P.run_batch(spark, lake, raw(spark, [event(1), event(1), "junk"]), AS_OF, "r1")
    assert (seen, spark.conf.get(KEY)) == (["true"], "false")
    with pytest.raises(ZeroDivisionError), session.dropping_shuffles(spark):
        raise ZeroDivisionError
    assert spark.conf.get(KEY) == "false"


def test_a_dropped_shuffle_is_made_again_when_it_is_asked_for(spark):
    with session.dropping_shuffles(spark):
        counted = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
        assert len(counted.collect()) == len(counted.collect()) == 10


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_known_keys_leave_the_rows_where_they_are(spark, lake, monkeypatch, most):
    monkeypatch.setattr(E, "MAX_BROADCAST_KEYS", most)
    ledger = E.Ledger(spark, lake)
    keys = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "key string").withColumn("verdict", F.lit(G.ACCEPTED))
    ledger.enter(keys, "load", 1, streamed=False)
    rows = spark.createDataFrame([("a", 1), ("c", 2), ("c", 3), (None, 4), ("b", 5)], "key string, n int")
    with ledger.unknown(rows, 5, "load", 2) as fresh:
        assert sorted(r["n"] for r in fresh.collect()) == [2, 3, 4]
        assert ("strategy=broadcast" in fresh._jdf.queryExecution().optimizedPlan().toString()) == (most > 0)
    with ledger.unknown(rows, 5, "load", 1) as fresh:  # its own entries do not count
        assert fresh.count() == 5
    with E.Ledger(spark, lake, "empty").unknown(rows, 5, "load", 1) as fresh:
        assert fresh.count() == 5
    assert os.path.isdir(ledger.main_path)
