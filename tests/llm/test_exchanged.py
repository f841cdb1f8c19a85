"""Tables that grow with the input are exchanged for a join, however small Spark takes them to be; only hot keys and a mix's sources go to all tasks."""

import re

import pytest

from rastra.llm import mixing, near, simhash

#: Right keys of the tables that are bounded: keys with a large share of all rows, the list of sources and its bands.
BOUNDED = ("_hot_", "g#", "coalesce(g#", "coalesce(g2#")


def sent(spark, run) -> list[str]:
    """Keys of the tables that were sent to all tasks while ``run`` ran."""
    sql, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    before = sql.executionsCount()
    run()
    bus.waitUntilEmpty()
    done = sql.executionsList()
    plans = [done.apply(i).physicalPlanDescription() for i in range(before, done.size())]
    assert any("SortMergeJoin" in p for p in plans)
    return [key for p in plans for key in re.findall(r"BroadcastHashJoin.*\n.*\nRight keys[^:]*: \[(.*)\]", p)]


@pytest.fixture(scope="module")
def docs(spark):
    words = lambda i: [f"w{(i // 3 * 31 + k * k) % 997}" for k in range(40)]
    rows = [(i, " ".join([*words(i), *[f"only{i}"] * (i % 3 == 1)]), f"src{i % 3}") for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).cache()


@pytest.mark.parametrize(
    "run",
    [
        lambda d: simhash.near_duplicate_groups(d, shingle=4),
        lambda d: simhash.near_duplicate_groups(d, shingle=4, reps=2, min_match=5, max_bits=6),
        lambda d: simhash.drop_near_duplicates(d, shingle=4),
        lambda d: near.drop_near_duplicates(d, shingle=5, similarity=0.8),
        lambda d: near.drop_near_duplicates(d.unionByName(d), shingle=5, similarity=0.8, block_rows=16),
        lambda d: mixing.take_mix(d, share=1.5),
    ],
    ids=["groups", "groups of two", "bits", "sets", "sets of copies", "mix"],
)
def test_grown_tables_are_not_sent(spark, docs, run):
    keys = sent(spark, lambda: run(docs).write.format("noop").mode("overwrite").save())
    assert [k for k in keys if not k.startswith(BOUNDED)] == []
