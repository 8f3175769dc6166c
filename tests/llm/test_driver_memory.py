"""Near-dedup builds no side of a join on the driver, at the broadcast threshold that Spark has by default."""

import pytest
from pyspark.sql import functions as F

from terracell.llm import simhash


@pytest.fixture
def plans(spark):
    """The plans, as they ended, of the queries that ran since."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    bus.waitUntilEmpty()
    since = max([e.executionId() for e in _all(store)], default=-1)

    def read():
        bus.waitUntilEmpty()
        return [e.physicalPlanDescription() for e in _all(store) if e.executionId() > since]

    yield read
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _all(store):
    found = store.executionsList()
    return [found.apply(k) for k in range(found.size())]


def _docs(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[k % 7 * 40 : k % 7 * 40 + 60] + [f"x{k % 20}"]) for k in range(60)] + [None, "", "one"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_groups_broadcast_nothing(spark, plans):
    got = {r.doc_id: r for r in simhash.groups(_docs(spark)).collect()}
    assert len(got) == 63 and all(r.component_id == min(x.doc_id for x in got.values() if x.component_id == r.component_id) for r in got.values())
    assert len(seen := plans()) > 3 and any("Join" in p for p in seen) and not [p for p in seen if "BroadcastExchange" in p]


def test_near_dedup_broadcasts_nothing(spark, plans, monkeypatch):
    monkeypatch.setattr(simhash, "FEW", 2)  # both ways of comparison
    docs = _docs(spark).withColumn("other", F.lit(1))
    kept = sorted(r.doc_id for r in simhash.first_of_each(docs).collect())
    assert kept == [0, 1, 2, 3, 4, 5, 6, 60, 62]
    assert len(seen := plans()) > 3 and not [p for p in seen if "BroadcastExchange" in p]
