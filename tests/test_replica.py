"""Merges, replicas, runs and streams: the delta scenarios and their laws."""

import datetime as dt
import json
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import BadDelta, LostRace, Mark, Replica, files
from tidemark.operators import infer, merge
from tidemark.plans import replica as store
from tidemark.plans.policy import Policy
from tidemark.plans.run import TablesFailed, run
from tidemark.streaming import feed

SCHEMA = "id int, seq int, v string"
# a few rows fill a bucket
SMALL = 512


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(replica):
    return sorted(map(tuple, replica.read().collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


START = [(1, 10, "a"), (2, 20, "b"), (3, 30, "c")]


@pytest.fixture
def keyed(spark, root):
    replica = Replica(spark, root, "t")
    replica.increment(frame(spark, START), "seq", ["id"], bucket_bytes=SMALL)
    return replica


def test_initial_load(keyed):
    assert content(keyed) == START
    record = keyed.commit()
    assert (record["mode"], record["watermark_value"], record["last_rows"]) == ("incremental-initial", "30", 3)


def test_upsert_replaces_and_inserts(spark, keyed):
    delta = frame(spark, [*START, (2, 40, "B"), (4, 50, "d")])
    record = keyed.increment(delta, "seq", ["id"])
    after = [(1, 10, "a"), (2, 40, "B"), (3, 30, "c"), (4, 50, "d")]
    assert content(keyed) == after
    assert (record["mode"], record["watermark_value"], record["last_rows"]) == ("incremental", "50", 2)
    # the same delta again
    keyed.apply(frame(spark, [(2, 40, "B"), (4, 50, "d")]), "seq", ["id"])
    assert content(keyed) == after
    # nothing new: no version
    version = keyed.commit()["version"]
    assert keyed.increment(delta, "seq", ["id"])["published"] is False
    assert keyed.commit()["version"] == version


def rows_of(n, step=1, first=0):
    return [(i * step, i, "x" * 20) for i in range(first, first + n)]


@pytest.mark.parametrize("step", [1, 1_000_003])
def test_only_touched_buckets_are_rewritten(spark, root, step):
    replica = Replica(spark, root, "t")
    replica.increment(frame(spark, rows_of(200, step)), "seq", ["id"], bucket_bytes=200)
    first = replica.commit()
    replica.apply(frame(spark, [(7 * step, 500, "new")]), "seq", bucket_bytes=1 << 30)
    second = replica.commit()
    moved = [b for b, (i, _) in second["buckets"].items() if second["folders"][i] != first["folders"][0]]
    assert len(moved) == 1 and len(second["buckets"]) > 8
    assert len(content(replica)) == 200 and (7 * step, 500, "new") in content(replica)


def test_buckets_double_as_the_table_grows(spark, root):
    replica = Replica(spark, root, "t")
    model, counts = {}, []
    for step in range(6):
        new = rows_of(20 * 4**step, first=20 * 4**step) + rows_of(3)
        model |= {r[0]: r for r in new}
        replica.apply(frame(spark, new), "seq", ["id"], bucket_bytes=4096)
        record = replica.commit()
        counts.append(record["count"])
        assert content(replica) == sorted(model.values())
        # a bucket is as large as asked for, but for its share of chance and of file headers
        assert max(size / n for size, n in record["sizes"].values()) < 3 * 4096
    assert counts == sorted(counts) and counts[0] == 1 and counts[-1] >= 16
    assert all(c & (c - 1) == 0 for c in counts)


def test_untouched_buckets_stay_when_others_are_cut_in_two(spark, root):
    replica = Replica(spark, root, "t")
    replica.apply(frame(spark, rows_of(400)), "seq", ["id"], bucket_bytes=2048)
    old = replica.commit()
    replica.apply(frame(spark, [(5, 900, "y")]), "seq", bucket_bytes=512)
    new = replica.commit()
    assert new["count"] > old["count"]
    rewritten = {b for b, (i, _) in new["buckets"].items() if new["folders"][i] not in old["folders"]}
    assert len({int(b) % old["count"] for b in rewritten}) == 1
    assert {n for b, (_, n) in new["buckets"].items() if b not in rewritten} == {old["count"]}
    assert content(replica) == sorted([r for r in rows_of(400) if r[0] != 5] + [(5, 900, "y")])


def test_one_merge_task_for_each_bucket(spark, root):
    replica = Replica(spark, root, "t")
    replica.apply(frame(spark, rows_of(500)), "seq", ["id"], bucket_bytes=512)
    record = replica.commit()
    for b in record["buckets"]:
        folder = f"{replica.path}/data/{record['folders'][0]}/{store.BUCKET}={b}"
        assert len([f for f, _ in files.children(spark, folder) if f.startswith("part-")]) == 1


def test_merge_has_one_shuffle(spark, root):
    keyed = Replica(spark, root, "t")
    keyed.apply(frame(spark, rows_of(200)), "seq", ["id"], bucket_bytes=512)
    record = keyed.commit()
    live = keyed._rows(record, keyed._folders(record))
    stage = frame(spark, [(1, 40, "A")])
    for targets in (list(range(record["count"])), [0, 3]):
        text = plan(keyed._merge(live, stage, live.schema, keyed._rules(record, (), None, None, None, None), record["count"], targets))
        assert text.count("Exchange shufflepartitionid") == 1 and "Exchange hash" not in text


def test_settings_survive_a_refresh(spark, root):
    replica = Replica(spark, root, "t")
    text = "id string, seq int, v string"
    replica.full_refresh(frame(spark, [("a", 1, "x"), ("A", 2, "y")], text), ["id"], "seq", order=["v"], fold_case=True, latest=True)
    replica.full_refresh(frame(spark, [("b", 1, "x"), ("B", 2, "y")], text))
    assert content(replica) == [("B", 2, "y")]
    replica.apply(frame(spark, [("b", 1, "late")], text), "seq")
    assert content(replica) == [("B", 2, "y")]
    record = replica.commit()
    assert (record["fold_case"], record["order"], record["latest"]) == (True, ["v"], True)
    # another comparison lays the table out anew
    replica.apply(frame(spark, [("b", 3, "z")], text), "seq", fold_case=False)
    assert content(replica) == [("B", 2, "y"), ("b", 3, "z")]


def test_late_rows(spark, root):
    for latest, kept in ((False, (1, 5, "late")), (True, (1, 10, "a"))):
        replica = Replica(spark, root, f"t{latest}")
        replica.apply(frame(spark, [(1, 10, "a")]), "seq", ["id"], latest=latest)
        replica.apply(frame(spark, [(1, 5, "late")]), "seq")
        assert content(replica) == [kept]


def test_small_folders_are_put_together(spark, root):
    replica = Replica(spark, root, "t")
    for i in range(12):
        replica.apply(frame(spark, [(i, i, "x")]), "seq", most_folders=4)
        assert len(replica.commit()["folders"]) <= 4
    assert content(replica) == [(i, i, "x") for i in range(12)]
    never = Replica(spark, root, "u")
    for i in range(6):
        never.apply(frame(spark, [(i, i, "x")]), "seq", most_folders=None)
    assert len(never.commit()["folders"]) == 6
    # folders of full size stay as they are
    for i in range(6, 9):
        never.apply(frame(spark, [(i, i, "x")]), "seq", most_folders=2, bucket_bytes=1)
    assert len(never.commit()["folders"]) == 9
    replica.clean(min_age_seconds=0, keep=1)
    assert content(replica) == [(i, i, "x") for i in range(12)]
    assert len(files.children(spark, f"{replica.path}/data")) == len(replica.commit()["folders"])


def test_append_keeps_duplicates(spark, root):
    replica = Replica(spark, root, "t")
    replica.increment(frame(spark, START), "seq")
    replica.apply(frame(spark, [(3, 30, "c")]), "seq")
    assert content(replica) == sorted([*START, (3, 30, "c")])


def test_later_row_of_a_delta_wins(spark, keyed):
    keyed.apply(frame(spark, [(1, 41, "first"), (1, 43, "last"), (1, 42, "middle")]), "seq", ["id"])
    assert content(keyed)[0] == (1, 43, "last")


def test_null_mark_is_merged_and_ignored(spark, keyed):
    keyed.apply(frame(spark, [(8, None, "n")]), "seq", ["id"])
    assert (8, None, "n") in map(tuple, keyed.read().collect())
    assert keyed.commit()["watermark_value"] == "30"


def test_ties_with_the_mark_are_not_read(spark, keyed):
    assert keyed.increment(frame(spark, [(9, 30, "tie")]), "seq", ["id"])["published"] is False
    keyed.increment(frame(spark, [(9, 30, "tie")]), "seq", ["id"], lookback=5)
    assert (9, 30, "tie") in content(keyed)
    assert keyed.commit()["watermark_value"] == "30"


def test_lookback_needs_a_key(spark, root):
    with pytest.raises(ValueError):
        Replica(spark, root, "t").increment(frame(spark, START), "seq", lookback=1)


def test_new_and_lost_columns(spark, keyed):
    keyed.apply(frame(spark, [(1, 40, "A", 7)], SCHEMA + ", extra int"), "seq", ["id"])
    assert content(keyed) == [(1, 40, "A", 7), (2, 20, "b", None), (3, 30, "c", None)]
    # a delta without the column leaves the stored value
    keyed.apply(frame(spark, [(1, 50, "AA"), (9, 51, "z")]), "seq", ["id"])
    assert set(map(tuple, keyed.read().collect())) == {(1, 50, "AA", 7), (2, 20, "b", None), (3, 30, "c", None), (9, 51, "z", None)}


def test_types_widen_and_never_change(spark, keyed):
    keyed.apply(frame(spark, [(5_000_000_000, 40, "big"), (2, 41, "B")], "id bigint, seq int, v string"), "seq", ["id"])
    assert content(keyed) == [(1, 10, "a"), (2, 41, "B"), (3, 30, "c"), (5_000_000_000, 40, "big")]
    with pytest.raises(ValueError, match="seq"):
        keyed.apply(frame(spark, [(1, "x", "a")], "id bigint, seq string, v string"), "seq", ["id"])


def test_widening_appends(spark, root):
    replica = Replica(spark, root, "t")
    replica.apply(frame(spark, [(1, 1, "a")]), "seq")
    replica.apply(frame(spark, [(1 << 40, 2, "b", 2.5)], "id bigint, seq int, v string, w double"), "seq")
    assert set(map(tuple, replica.read().collect())) == {(1, 1, "a", None), (1 << 40, 2, "b", 2.5)}


def test_decimals_widen(spark, root):
    for keys in ([], ["id"]):
        replica = Replica(spark, root, f"t{len(keys)}")
        replica.apply(spark.sql("SELECT 1 AS id, 1 AS seq, 12.34BD AS m UNION ALL SELECT 3, 1, 0.50BD"), "seq", keys, bucket_bytes=SMALL)
        replica.apply(spark.sql("SELECT 2 AS id, 2 AS seq, 123456.789BD AS m"), "seq")
        got = {r.id: str(r.m) for r in replica.read().collect()}
        assert got == {1: "12.340", 2: "123456.789", 3: "0.500"}
    with pytest.raises(ValueError, match="m"):
        merge.widen(spark.sql("SELECT 1.5BD AS m").schema, spark.sql("SELECT 'x' AS m").schema)


@pytest.mark.parametrize("table,keys", [("embeddings", ["vec_id"]), ("conversations", ["conv_id", "turn"]), ("pages", ["url"])])
def test_given_tables_by_their_keys(spark, root, sf_dir, table, keys):
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    replica = Replica(spark, root, table)
    replica.full_refresh(df, keys, bucket_bytes=SMALL)
    replica.apply(df, df.columns[0], keys)
    distinct = df.select(*keys).distinct().count()
    assert replica.read().count() == distinct
    assert replica.read().exceptAll(df).count() == 0


@pytest.mark.parametrize("rows,schema,keys,error", [
    ([(None, 40, "x")], SCHEMA, ["id"], BadDelta),
    ([(1, 40, "x")], SCHEMA, ["nope"], ValueError),
    ([(1, "x")], "id int, v string", ["id"], ValueError),
])
def test_bad_deltas_change_nothing(spark, keyed, rows, schema, keys, error):
    with pytest.raises(error):
        keyed.apply(frame(spark, rows, schema), "seq", keys)
    assert content(keyed) == START
    assert keyed.commit()["version"] == 1


def test_mark_of_another_field_is_void(spark, keyed):
    assert keyed.mark("seq") == Mark("int", "30")
    assert keyed.mark("id") is None
    # everything is read again, by key
    record = keyed.increment(frame(spark, START), "id", ["id"])
    assert (record["mode"], record["last_rows"], record["watermark_value"]) == ("incremental-initial", 3, "3")
    assert content(keyed) == START


def test_first_marks_of_an_unkeyed_table_do_not_double_it(spark, root):
    replica = Replica(spark, root, "t")
    replica.full_refresh(frame(spark, START))
    record = replica.increment(frame(spark, START), "seq")
    assert (record["mode"], record["watermark_value"], content(replica)) == ("incremental-initial", "30", START)
    # another field: its marks start anew as well
    replica.increment(frame(spark, [*START, (4, 40, "d")]), "id")
    assert content(replica) == [*START, (4, 40, "d")]
    unmarked = Replica(spark, root, "u")
    for _ in range(2):
        unmarked.increment(frame(spark, [(1, None, "a")]), "seq")
    assert content(unmarked) == [(1, None, "a")]


def test_full_refresh_then_increment(spark, keyed):
    keyed.full_refresh(frame(spark, [*START, (4, 35, "d")]))
    assert keyed.commit()["watermark_value"] == "35"
    assert keyed.commit()["keys"] == ["id"]
    keyed.increment(frame(spark, [*START, (4, 35, "d"), (2, 60, "B")]), "seq", ["id"])
    assert content(keyed) == [(1, 10, "a"), (2, 60, "B"), (3, 30, "c"), (4, 35, "d")]


def test_full_refresh_drops_deleted_rows_and_keeps_on_empty(spark, keyed):
    keyed.full_refresh(frame(spark, START[:2]))
    assert content(keyed) == START[:2]
    assert keyed.full_refresh(frame(spark, []))["published"] is False
    assert content(keyed) == START[:2]
    keyed.full_refresh(frame(spark, []), on_empty="replace")
    assert content(keyed) == []


def test_full_refresh_stamp(spark, root):
    replica = Replica(spark, root, "t")
    replica.full_refresh(frame(spark, START), stamp=True)
    assert replica.read().columns == ["id", "seq", "v", "_synced_at"]
    assert replica.read().where("_synced_at IS NULL").isEmpty()


def test_key_for_a_table_that_had_none(spark, root):
    replica = Replica(spark, root, "t")
    replica.increment(frame(spark, START), "seq")
    replica.apply(frame(spark, [(3, 31, "c2")]), "seq")
    replica.increment(frame(spark, [(1, 70, "A")]), "seq", ["id"], bucket_bytes=SMALL)
    assert content(replica) == [(1, 70, "A"), (2, 20, "b"), (3, 31, "c2")]


def test_key_only_table(spark, root):
    replica = Replica(spark, root, "t")
    for _ in range(2):
        replica.apply(spark.createDataFrame([(1,), (2,)], "id int"), "id", ["id"], bucket_bytes=SMALL)
    assert content(replica) == [(1,), (2,)]


def test_keys_without_case(spark, root):
    replica = Replica(spark, root, "t")
    replica.apply(frame(spark, [("Ab", 1, "x"), ("c", 1, "y")], "id string, seq int, v string"), "seq", ["id"], bucket_bytes=SMALL, fold_case=True)
    replica.apply(frame(spark, [("aB", 2, "z")], "id string, seq int, v string"), "seq", ["id"])
    assert content(replica) == [("aB", 2, "z"), ("c", 1, "y")]


class Crash(Exception):
    pass


class Crashing(Replica):
    def _commit(self, record):
        raise Crash


def test_keys_by_collation(spark, root):
    names = [("Élan", 1, "a"), ("elan", 2, "b"), ("ELAN ", 3, "c"), ("elan x", 4, "d")]
    rows = spark.createDataFrame(names, "name string, seq int, v string")
    how = {"keys": ["name"], "collation": "UNICODE_CI_AI_RTRIM", "bucket_bytes": SMALL}
    replica = Replica(spark, root, "t")
    # hashes of equal keys differ unless the session takes collations into account
    with pytest.raises(ValueError, match="collationAwareHashFunctions"):
        replica.increment(rows, "seq", **how)
    spark.conf.set("spark.sql.legacy.collationAwareHashFunctions", "true")
    try:
        replica.increment(rows, "seq", **how)
        assert content(replica) == [("ELAN ", 3, "c"), ("elan x", 4, "d")]
        many = [(f"Nöm {i}" if i % 2 else f"NOM {i}  ", 10 + i, "x") for i in range(300)]
        replica.increment(spark.createDataFrame(many, rows.schema), "seq", bucket_bytes=SMALL)
        assert replica.commit()["count"] > 1
        again = [(f"nom {i}", 1000 + i, "y") for i in range(0, 300, 3)] + [("élan", 5000, "z")]
        replica.increment(spark.createDataFrame(again, rows.schema), "seq", bucket_bytes=SMALL)
        left = {r.name: r.v for r in replica.read().collect()}
        assert len(left) == 302 and left["élan"] == "z" and sum(v == "y" for v in left.values()) == 100
        gone = replica.reconcile(spark.createDataFrame([("NÖM 0", 0, ""), ("elan", 0, "")], rows.schema), bucket_bytes=SMALL)
        assert gone["last_rows"] == 2 and {r.name for r in replica.read().collect()} == {"nom 0", "élan"}
    finally:
        spark.conf.unset("spark.sql.legacy.collationAwareHashFunctions")


def test_upsert_of_frames_by_collation(spark):
    live = spark.createDataFrame([("Ana ", 1, "a"), ("bob", 2, "b")], "name string, seq int, v string")
    delta = spark.createDataFrame([("ANÁ", 3), ("BÖB", 4), ("ana", 2), ("bub", 5)], "name string, seq int")
    got = sorted(map(tuple, merge.upsert(live, delta, ["name"], ["seq"], collation="UNICODE_CI_AI_RTRIM").collect()))
    # the last of equal keys wins, and keeps what the delta does not know
    assert got == [("ANÁ", 3, "a"), ("BÖB", 4, "b"), ("bub", 5, None)]


def test_kinds_are_kept_and_merged(spark, root):
    replica = Replica(spark, root, "t")
    with pytest.raises(LookupError):
        replica.types()
    schema = "id int, x double, s string, n string"
    for rows in ([(1, 1.0, None, None)], [(2, 2.0, None, None), (3, None, "a", None)], [(4, 2.5, "b", None)]):
        replica.apply(spark.createDataFrame(rows, schema), "id", track_types=True)
    assert replica.commit()["kinds"] == {"id": 4, "x": 13, "s": 17, "n": 1}
    assert replica.types().collect() == infer.widest(replica.read()).collect()
    # a column that came later, and one that a delta lacks
    replica.apply(spark.createDataFrame([(5, "c", True)], "id int, s string, late boolean"), "id")
    assert {r["name"]: r["kind"] for r in replica.types().collect()} == {"id": "int", "x": "float", "s": "str", "n": "null", "late": "bool"}
    assert {r["name"]: r["type"] for r in replica.types(keys=["s"]).collect()}["s"] == "VARCHAR(255)"
    # what is replaced is forgotten
    replica.full_refresh(spark.createDataFrame([(1, 1.0)], "id int, x double"))
    assert replica.commit()["kinds"] == {"id": 4, "x": 4}


def test_kinds_of_rows_written_before_they_were_kept(spark, root):
    replica = Replica(spark, root, "t")
    replica.apply(spark.createDataFrame([(1, 0.5)], "id int, x double"), "id", ["id"])
    assert replica.commit()["kinds"] is None
    replica.apply(spark.createDataFrame([(2, 3.0)], "id int, x double"), "id", track_types=True)
    assert replica.commit()["kinds"] == {"id": 4, "x": 12}
    replica.apply(spark.createDataFrame([(3, None)], "id int, x double"), "id", track_types=False)
    assert replica.commit()["kinds"] is None


def test_facts_come_from_the_write(spark, root):
    """A run without a key is one pass: the jobs of a run that writes rows are those of the write."""
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "seq int, v string").repartition(4)
    group = "facts-of-a-run"
    spark.sparkContext.setJobGroup(group, group)
    try:
        record = Replica(spark, root, "t").apply(rows, "seq")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    # the shuffle of repartition(4) and the write; counting read all rows again before
    assert len(set(stages)) <= 3 and len(tracker.getJobIdsForGroup(group)) <= 2
    assert (record["last_rows"], record["watermark_value"]) == (50, "49")


RETRIED = """
import sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from tidemark import Replica, files

spark = (
    SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {scratch!r})
    .config("spark.sql.shuffle.partitions", "3").getOrCreate()
)

def first_attempts_fail(frames):
    # after its rows have been handed on, so that they were measured once already
    yield from frames
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")

rows = spark.range(0, 1000, 1, 5).withColumn("x", F.col("id") / 2)
for keys in ([], ["id"]):
    replica = Replica(spark, files.scratch(spark, "replica"), "t")
    record = replica.apply(rows.mapInPandas(first_attempts_fail, rows.schema), "id", keys, track_types=True)
    print("RESULT", record["last_rows"], record["watermark_value"], replica.read().count(), record["kinds"])
"""


def test_a_task_that_fails_first_counts_once(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", RETRIED.format(repo=repo, scratch=str(tmp_path))], capture_output=True, text=True, timeout=300)
    found = [line for line in done.stdout.splitlines() if line.startswith("RESULT")]
    assert found == ["RESULT 1000 999 1000 {'id': 4, 'x': 12}"] * 2, done.stderr[-2000:]


def test_crash_before_the_commit(spark, root, keyed):
    delta = [(2, 40, "B"), (4, 50, "d")]
    with pytest.raises(Crash):
        Crashing(spark, root, "t").increment(frame(spark, delta), "seq", ["id"])
    assert content(keyed) == START
    assert keyed.commit()["watermark_value"] == "30"
    left = keyed.orphans()
    assert len(left) == 2 and {p.split("/")[-2] for p in left} == {"data", "stage"}
    assert keyed.orphans(min_age_seconds=3600) == []
    # the next run starts from the same mark
    keyed.increment(frame(spark, delta), "seq", ["id"])
    assert content(keyed) == [(1, 10, "a"), (2, 40, "B"), (3, 30, "c"), (4, 50, "d")]
    before = content(keyed)
    assert set(left) <= set(keyed.clean(min_age_seconds=0))
    assert content(keyed) == before and keyed.orphans() == []


def test_old_versions_stay_readable_until_cleaned(spark, keyed):
    for i in range(3):
        keyed.apply(frame(spark, [(1, 100 + i, f"v{i}")]), "seq")
    assert sorted(map(tuple, keyed.read(1).collect())) == START
    now = content(keyed)
    keyed.clean(min_age_seconds=0, keep=2)
    assert keyed.versions() == [3, 4]
    assert content(keyed) == now
    # the first folder keeps only the buckets that still count
    record = keyed.commit()
    kept = {b for b, (i, _) in record["buckets"].items() if i == 0}
    folder = f"{keyed.path}/data/{record['folders'][0]}"
    assert {n for n, _ in files.children(spark, folder)} == {f"{store.BUCKET}={b}" for i, b in keyed._parts(record) if i == 0}
    assert 0 < len(kept) < len(record["buckets"])


def test_second_writer_loses(spark, root, keyed):
    class Slow(Replica):
        def _commit(self, record):
            # another run commits in between
            Replica(spark, root, "t").apply(frame(spark, [(5, 70, "other")]), "seq", ["id"])
            super()._commit(record)

    with pytest.raises(LostRace):
        Slow(spark, root, "t").increment(frame(spark, [(6, 60, "mine")]), "seq", ["id"])
    assert content(keyed) == [*START, (5, 70, "other")]


def test_slices_add_up_to_a_full_refresh(spark, root, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    steps, whole = Replica(spark, root, "steps"), Replica(spark, root, "whole")
    for day in (5, 12, 21, 40):
        seen = events.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(days=day)).cast("timestamp_ntz"))
        steps.increment(seen, "ts", ["event_id"], bucket_bytes=SMALL)
    whole.full_refresh(events, ["event_id"], "ts", bucket_bytes=SMALL)
    assert content(steps) == content(whole) == sorted(map(tuple, events.collect()))
    assert steps.commit()["watermark_value"] == whole.commit()["watermark_value"]


@pytest.mark.parametrize("seed", range(4))
def test_random_deltas_against_a_dict(spark, root, seed):
    rng = random.Random(seed)
    model, replica, seq = {}, Replica(spark, root, "t"), 0
    for _ in range(4):
        rows = []
        for _ in range(rng.randint(1, 30)):
            seq += 1
            # one key holds a third of the rows
            key = 0 if rng.random() < 0.34 else rng.randint(1, 15)
            rows.append((key, seq, f"{key}-{seq}"))
            model[key] = rows[-1]
        rng.shuffle(rows)
        replica.apply(frame(spark, rows), "seq", ["id"], bucket_bytes=SMALL)
        assert content(replica) == sorted(model.values())
        assert replica.commit()["watermark_value"] == str(seq)


def test_upsert_of_frames(spark):
    live = frame(spark, START)
    delta = frame(spark, [(2, 40, "B"), (2, 41, "BB"), (4, 50, "d")])
    once = merge.upsert(live, delta, ["id"], ["seq"])
    twice = merge.upsert(once, delta, ["id"], ["seq"])
    want = [(1, 10, "a"), (2, 41, "BB"), (3, 30, "c"), (4, 50, "d")]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want
    lost = merge.upsert(live, spark.createDataFrame([(2, 99), (7, 98)], "id int, seq int"), ["id"], ["seq"])
    assert sorted(map(tuple, lost.collect()), key=str) == sorted([(1, 10, "a"), (2, 99, "b"), (3, 30, "c"), (7, 98, None)], key=str)


def test_hot_keys_are_cut_down_before_the_shuffle(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = plan(merge.dedupe_last(lines, ["l_returnflag"], ["l_shipdate"]))
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_delta_keys_shuffle_alone(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = plan(merge.upsert(lines, lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


# state


def legacy(spark, entries):
    path = files.scratch(spark, "legacy")
    spark.createDataFrame([(json.dumps(entries, indent=1),)], "value string").coalesce(1).write.text(path)
    return path


def test_state_and_import(spark, root):
    old = {
        "a": {"watermark": 5, "last_rows": 3, "updated_at": "2026-01-02T03:04:05"}, "b": {"watermark": "2026-04-22T16:09:19"},
        "c": {"watermark": 2.5}, "d": {"watermark": True}, "e": {"watermark": None},
    }
    path = legacy(spark, old)
    assert store.import_state(spark, root, f"{path}-none") == 0
    assert store.import_state(spark, root, path) == 5
    assert store.import_state(spark, root, path) == 0
    got = {r.source_table: (r.watermark_type, r.watermark_value, r.last_rows, r.published) for r in store.state(spark, root).collect()}
    assert got == {
        "a": ("int", "5", 3, False), "b": ("str", "2026-04-22T16:09:19", 0, False), "c": ("float", "2.5", 0, False),
        "d": ("bool", "1", 0, False), "e": (None, None, 0, False),
    }
    # the first run reads the whole table, with and without a key
    for table, keys in (("a", []), ("c", ["n"])):
        replica = Replica(spark, root, table)
        assert replica.mark("n") is None
        record = replica.increment(spark.createDataFrame([(4,), (6,)], "n int"), "n", keys)
        assert (record["mode"], content(replica)) == ("incremental-initial", [(4,), (6,)])
        assert replica.increment(spark.createDataFrame([(4,), (6,), (7,)], "n int"), "n")["mode"] == "incremental"
    # once a table has been synced, old files do not count any more
    assert store.import_state(spark, root, legacy(spark, {"new": {"watermark": 1}})) == 0


def test_import_is_whole_or_none(spark, root):
    with pytest.raises(ValueError, match="2nd"):
        store.import_state(spark, root, legacy(spark, {"a": {"watermark": 1}, "2nd": {"watermark": 2}, "z": {"watermark": 3}}))
    assert store.state(spark, root).isEmpty()
    # an import that died half way is completed
    both = legacy(spark, {"a": {"watermark": 1}, "z": {"watermark": 3}})
    store.import_state(spark, root, legacy(spark, {"a": {"watermark": 1}}))
    assert store.import_state(spark, root, both) == 1
    assert store.state(spark, root).count() == 2


def test_names_with_an_underscore_are_seen(spark, root):
    Replica(spark, root, "_x").full_refresh(frame(spark, START), ["id"], "seq")
    assert [r.source_table for r in store.state(spark, root).collect()] == ["_x"]


def test_upsert_refuses_rows_without_a_key(spark):
    with pytest.raises(Exception, match="without a key"):
        merge.upsert(frame(spark, START), frame(spark, [(None, 1, "x")]), ["id"], ["seq"]).collect()


def test_rows_with_maps_inside_are_told_apart(spark):
    df = spark.sql("SELECT 1 AS k, named_struct('m', map('a', 1)) AS s, array(map('b', 2)) AS l, map('c', 3) AS m")
    assert merge.dedupe_last(df.unionByName(df), ["k"], []).count() == 1


def test_broken_legacy_file_is_ignored(spark, root):
    path = files.scratch(spark, "legacy")
    spark.createDataFrame([("{not json",)], "value string").coalesce(1).write.text(path)
    assert store.import_state(spark, root, path) == 0


def test_state_of_nothing(spark, root):
    assert store.state(spark, root).count() == 0
    with pytest.raises(LookupError):
        Replica(spark, root, "t").read()


def test_names_are_checked(spark, root):
    for name in ("a/b", "../x", "", "a b"):
        with pytest.raises(ValueError):
            Replica(spark, root, name)
    odd = Replica(spark, root, "SQL$odd-x#1")
    odd.full_refresh(frame(spark, START))
    assert content(odd) == START
    assert [r.source_table for r in store.state(spark, root).collect()] == ["SQL$odd-x#1"]


# runs


def sources(spark, rows):
    def broken():
        raise RuntimeError("HTTP 500")

    return {
        "keyed": frame(spark, rows), "plain": frame(spark, rows), "appended": frame(spark, rows), "skipped": frame(spark, rows),
        "broken": broken, "nokey": frame(spark, rows), "empty": frame(spark, []),
    }


RULES = Policy(
    skip=("skipped",),
    incremental={"keyed": {"field": "seq", "pk": "id"}, "appended": {"field": "seq"}, "nokey": {"field": "seq", "pk": "none"}},
)


def test_run_isolates_failures(spark, root):
    first = {r.table_name: r for r in run(spark, sources(spark, START), root, RULES, bucket_bytes=SMALL).collect()}
    assert {t: (r.mode, r.rows, r.ok) for t, r in first.items()} == {
        "keyed": ("incremental-initial", 3, True), "plain": ("full", 3, True), "appended": ("incremental-initial", 3, True),
        "broken": ("full", 0, False), "nokey": ("incremental-initial", 0, False), "empty": ("full", 0, True),
    }
    with pytest.raises(ValueError, match="a_b"):
        run(spark, {"a-b": frame(spark, START), "a_b": frame(spark, START)}, root)
    assert first["broken"].error == "HTTP 500" and first["keyed"].bytes > 0 and first["keyed"].watermark == "30"
    later = [(1, 40, "A"), *START[1:], (4, 50, "d")]
    second = {r.table_name: r for r in run(spark, sources(spark, later), root, RULES).collect()}
    assert (second["keyed"].mode, second["keyed"].rows) == ("incremental", 2)
    assert content(Replica(spark, root, "keyed")) == sorted(later)
    assert content(Replica(spark, root, "plain")) == sorted(later)
    assert content(Replica(spark, root, "appended")) == sorted([*START, (1, 40, "A"), (4, 50, "d")])


def test_run_cleans_imports_and_writes_its_report(spark, root):
    old = files.scratch(spark, "legacy")
    spark.createDataFrame([('{"appended": {"watermark": 20}}',)], "value string").coalesce(1).write.text(old)
    with pytest.raises(Crash):
        Crashing(spark, root, "plain").full_refresh(frame(spark, START))
    assert len(Replica(spark, root, "plain").orphans()) == 1
    path = files.scratch(spark, "report")
    some = {t: s for t, s in sources(spark, START).items() if t in ("plain", "appended")}
    made = run(spark, some, root, RULES, legacy_state=old, clean_age_seconds=0, report_path=path)
    got = {r.table_name: (r.mode, r.rows) for r in made.collect()}
    # an imported mark has no rows to speak for
    assert got == {"plain": ("full", 3), "appended": ("incremental-initial", 3), "keyed": ("unknown", 0), "nokey": ("unknown", 0), "skipped": ("unknown", 0)}
    assert Replica(spark, root, "plain").orphans() == []
    assert content(Replica(spark, root, "appended")) == START
    assert spark.read.option("header", True).csv(path).count() == 5


def test_full_run_then_incremental_run(spark, root):
    rules = Policy(incremental={"keyed": {"field": "seq", "pk": "id"}})
    run(spark, {"keyed": frame(spark, START)}, root, rules, full_refresh=True, bucket_bytes=SMALL)
    assert Replica(spark, root, "keyed").commit()["watermark_value"] == "30"
    made = run(spark, {"keyed": frame(spark, [*START, (2, 60, "B")])}, root, rules).first()
    assert (made.mode, made.rows) == ("incremental", 1)
    assert content(Replica(spark, root, "keyed")) == [(1, 10, "a"), (2, 60, "B"), (3, 30, "c")]


def test_run_removes_lost_rows_where_the_policy_says_so(spark, root):
    rows = spark.createDataFrame([(i, i, "a") for i in range(20)], SCHEMA)
    rules = {"field": "seq", "pk": "id", "track_types": True}
    policy = Policy(incremental={"with": {**rules, "deletes": True}, "without": rules})
    for source in (rows, rows.where("id > 4")):
        report = run(spark, {"with": source, "without": source}, root, policy, bucket_bytes=SMALL)
        assert all(r.ok for r in report.collect())
    assert {t: Replica(spark, root, t).read().count() for t in ("with", "without")} == {"with": 15, "without": 20}
    assert {r["name"]: r["kind"] for r in Replica(spark, root, "with").types().collect()} == {"id": "int", "seq": "int", "v": "str"}


def test_strict_and_resumed_runs(spark, root):
    with pytest.raises(TablesFailed) as failure:
        run(spark, sources(spark, START), root, RULES, strict=True)
    assert failure.value.report.count() == 6
    assert [r.table_name for r in run(spark, sources(spark, START), root, RULES, start_index=5).collect()] == ["plain"]
    with pytest.raises(ValueError):
        run(spark, sources(spark, START), root, RULES, start_index=6)


# streams


def test_stream_merges_each_batch_once(spark, root):
    schema = frame(spark, []).schema
    replica = Replica(spark, f"{root}/replica", "t")

    def follow(**kwargs):
        query = feed.follow(spark, f"{root}/in", schema, replica, f"{root}/checkpoint", "seq", bucket_bytes=SMALL, **kwargs)
        query.awaitTermination()

    frame(spark, START).coalesce(1).write.mode("append").parquet(f"{root}/in")
    follow()
    frame(spark, [(2, 40, "B"), (4, 50, "d")]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    follow()
    follow()
    assert content(replica) == sorted([*START, (2, 40, "B"), (4, 50, "d")])
    assert replica.commit()["version"] == 2


def test_stream_repeats_a_batch_that_died(spark, root):
    schema = frame(spark, []).schema
    frame(spark, START).coalesce(1).write.parquet(f"{root}/in")

    class DiesAfterCommit(Replica):
        def _commit(self, record):
            super()._commit(record)
            raise Crash

    def follow(replica):
        feed.follow(spark, f"{root}/in", schema, replica, f"{root}/checkpoint", "seq").awaitTermination()

    with pytest.raises(Exception):
        follow(DiesAfterCommit(spark, f"{root}/replica", "t"))
    follow(Replica(spark, f"{root}/replica", "t"))
    assert content(Replica(spark, f"{root}/replica", "t")) == START


def test_stream_in_small_batches(spark, root):
    schema = frame(spark, []).schema
    for i, row in enumerate(START):
        frame(spark, [row]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    replica = Replica(spark, f"{root}/replica", "t")
    feed.follow(spark, f"{root}/in", schema, replica, f"{root}/checkpoint", "seq", ["id"], bucket_bytes=SMALL, files_per_batch=1).awaitTermination()
    assert replica.commit()["version"] == 3
    assert content(replica) == START
