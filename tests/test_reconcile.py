"""Deletes by digests."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import Replica
from tidemark.operators import reconcile
from tidemark.workload import queries


def content(df):
    return sorted(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("buckets", [1, 7, 64, 4096])
def test_deleted_keys_are_the_set_difference(spark, buckets):
    rng = random.Random(buckets)
    ours = [(rng.randrange(500), rng.choice("abc")) for _ in range(400)]
    theirs = [k for k in ours if rng.random() < 0.95] * 2 + [(rng.randrange(500, 900), "z") for _ in range(50)]
    live = spark.createDataFrame(sorted(set(ours)), "id int, part string")
    source = spark.createDataFrame([(i, p, 1) for i, p in theirs] + [(None, "a", 1), (3, None, 1)], "id long, part string, v int")
    got = reconcile.deleted(live, source, ["id", "part"], buckets)
    assert content(got) == sorted(set(ours) - set(theirs))


def test_digests_do_not_depend_on_order_and_tell_sets_apart(spark):
    df = spark.range(2000)
    one = content(reconcile.digests(df.repartition(7), ["id"], 16))
    assert one == content(reconcile.digests(df.orderBy(F.desc("id")).coalesce(1), ["id"], 16))
    assert sum(r[1] for r in one) == 2000
    for other in (df.where("id <> 77"), df.where("id <> 77").unionByName(spark.range(5000, 5001)), df.unionByName(spark.range(1))):
        changed = reconcile.differing(reconcile.digests(df, ["id"], 16), reconcile.digests(other, ["id"], 16)).collect()
        assert 1 <= len(changed) <= 2
    assert reconcile.differing(reconcile.digests(df, ["id"], 16), reconcile.digests(df.repartition(3), ["id"], 16)).isEmpty()


def test_only_differing_buckets_meet(spark):
    """Of 20,000 keys those that share a bucket with the three deleted ones reach the join, and no others."""
    live = spark.range(20_000)
    source = live.where("id NOT IN (5, 500, 5000)")
    ours, theirs = reconcile.suspects(live, source, ["id"], 4096)
    wrong = {r[0] for r in reconcile.differing(reconcile.digests(live, ["id"], 4096), reconcile.digests(source, ["id"], 4096)).collect()}
    assert 1 <= len(wrong) <= 3
    in_them = live.where(F.pmod(F.xxhash64("id"), F.lit(4096)).isin(wrong)).count()
    assert ours.count() == in_them < 60 and theirs.count() == in_them - 3
    # the numbers of those buckets filter both sides before anything is exchanged by key
    steps = plan(reconcile.deleted(live, source, ["id"], 4096))
    assert steps.count("BroadcastHashJoin") >= 2 and "LeftSemi" in steps and "LeftAnti" in steps


def test_a_digest_moves_one_row_for_each_bucket_and_task(spark):
    steps = plan(reconcile.digests(spark.range(0, 100_000, 1, 8), ["id"], 8))
    assert steps.count("Exchange") == 1 and steps.index("partial_count") > 0


def test_nothing_lost_nothing_published(spark, root):
    replica = Replica(spark, root, "t")
    rows = spark.createDataFrame([(i, i * 10) for i in range(100)], "id int, seq int")
    replica.increment(rows, "seq", ["id"])
    assert not replica.reconcile(rows.unionByName(spark.createDataFrame([(999, 1)], "id int, seq int")))["published"]
    # an empty source is taken for a fault
    assert not replica.reconcile(rows.where("false"))["published"]
    assert replica.versions() == [1]


def test_reconcile_drops_lost_rows_and_keeps_the_mark(spark, root):
    replica = Replica(spark, root, "t")
    rows = spark.createDataFrame([(i, i * 10, f"v{i}") for i in range(100)], "id int, seq int, v string")
    replica.increment(rows, "seq", ["id"], bucket_bytes=512)
    # the last row goes too, and a changed row is left to the next increment
    source = rows.where("id NOT IN (0, 50, 99)").withColumn("v", F.when(F.col("id") == 7, "new").otherwise(F.col("v")))
    record = replica.reconcile(source, bucket_bytes=512)
    assert (record["mode"], record["published"], record["last_rows"], record["watermark_value"]) == ("reconcile", True, 97, "990")
    assert content(replica.read()) == content(rows.where("id NOT IN (0, 50, 99)"))
    assert not replica.increment(source, "seq")["published"]
    replica.increment(source.unionByName(spark.createDataFrame([(50, 2000, "back")], rows.schema)), "seq")
    assert replica.read().where("id = 50").first().v == "back"
    replica.reconcile(source.where("false"), on_empty="replace")
    assert replica.read().isEmpty()


def test_reconcile_needs_a_key(spark, root):
    replica = Replica(spark, root, "t")
    with pytest.raises(ValueError):
        replica.reconcile(spark.range(3))
    replica.full_refresh(spark.range(3))
    with pytest.raises(ValueError):
        replica.reconcile(spark.range(3))


def test_deletes_of_the_given_events(spark, sf_dir):
    lost = {r[0] for r in queries.deletes_found(spark, sf_dir).collect()}
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert 0 < len(lost) < events.count() / 10
    assert {r.event_id for r in queries.deletes_reconciled(spark, sf_dir).collect()} == {r.event_id for r in events.collect()} - lost
