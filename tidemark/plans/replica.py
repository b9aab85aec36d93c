"""A replicated table: parquet folders and one small commit record per version.

    <root>/<table>/data/<version>-<id>/[bucket_=<b>/]part-*.parquet
    <root>/<table>/stage/<version>-<id>/part-*.parquet
    <root>/<table>/commits/<version>.json

A version becomes visible when its commit record appears, and the record holds the
watermark, so rows and watermark move together. A run that dies before leaves the old
version readable; of two runs that race, one commits and the other fails.

Keyed tables are split into buckets by a hash of the key; an upsert rewrites the buckets
its delta touches and the record points the others at the folders they already have. The
number of buckets doubles when the measured bytes have outgrown it: a bucket of n is then
two buckets of 2n, and is cut in two when a delta touches it next. Keys are unique once
deduplicated, so no bucket can become hot. Tables without a key gain a folder per delta,
and small folders are put together when there are many.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.functions.marks import Mark, encode, literal, mark_type
from tidemark.functions.names import IDENTIFIER, column, require_identifier
from tidemark.operators import infer, merge, reconcile
from tidemark.sources.tables import above

BUCKET = "bucket_"
BUCKET_BYTES = 512 * 1024 * 1024
MOST_FOLDERS = 64

COMMIT_SCHEMA = (
    "source_table STRING, version BIGINT, mode STRING, watermark_type STRING, watermark_value STRING, "
    "watermark_field STRING, pk_field STRING, last_rows BIGINT, updated_at TIMESTAMP, published BOOLEAN"
)


class BadDelta(ValueError):
    """The delta cannot be merged; the table stays as it was."""


class LostRace(RuntimeError):
    """Another run committed this version first; the table holds that run's rows."""


class Replica:
    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = require_identifier(table)
        self.path = f"{self.root}/{table}"
        self.staged_sec = 0.0  # seconds in which the last source was read and written out

    # reading

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n, _ in files.children(self.spark, f"{self.path}/commits") if n.endswith(".json")]

    def commit(self, version: int | None = None) -> dict | None:
        """The commit record of a version, by default the latest."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = max(known)
        return json.loads(files.read_text(self.spark, f"{self.path}/commits/{version:012d}.json"))

    def mark(self, field: str, last: dict | None = None) -> Mark | None:
        """The stored watermark; void when it was taken from another field, or when no
        rows are published that it could speak for (an imported mark)."""
        last = last if last is not None else self.commit()
        if last is None or last["schema"] is None or last["watermark_value"] is None or last["watermark_field"] not in (None, field):
            return None
        return Mark(last["watermark_type"], last["watermark_value"])

    def read(self, version: int | None = None) -> DataFrame:
        record = self.commit(version)
        if record is None or record["schema"] is None:
            raise LookupError(f"{self.table} has no published version below {self.root}")
        return self._rows(record, self._folders(record))

    def _parts(self, record: dict, only: set[int] | None = None) -> set[tuple[int, int]]:
        """(folder, bucket folder) that hold the given buckets, by default all. A bucket that
        was written before the number doubled lies in the folder of its remainder."""
        return {(i, b % n) for b, (i, n) in _buckets(record).items() if only is None or b in only}

    def _folders(self, record: dict, parts: set[tuple[int, int]] | None = None) -> list[str]:
        data = f"{self.path}/data"
        if record["buckets"] is None or (parts is None and len(record["folders"]) == 1):
            return [f"{data}/{f}" for f in record["folders"]]
        parts = self._parts(record) if parts is None else parts
        return [f"{data}/{record['folders'][i]}/{BUCKET}={b}" for i, b in sorted(parts)]

    def _rows(self, record: dict, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(record["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*folders)
        return rows.select(*[column(n) for n in schema.names])

    # writing

    def full_refresh(
        self, source: DataFrame, keys: Sequence[str] = (), field: str | None = None, order: Sequence[str] | None = None,
        bucket_bytes: int = BUCKET_BYTES, on_empty: str = "keep", fold_case: bool | None = None, latest: bool | None = None,
        stamp: bool = False, mode: str = "full", collation: str | None = None, track_types: bool | None = None,
    ) -> dict:
        """Publish the whole source as a new version.

        An empty source keeps the live rows (`on_empty='replace'` publishes it). `stamp`
        adds `_synced_at`, which rewrites rows that did not change otherwise.
        """
        last = self.commit()
        rules = self._rules(last, keys, field, order, fold_case, latest, collation, track_types)
        if stamp:
            source = source.withColumn("_synced_at", F.current_timestamp())
        return self._replace(last, source, rules, None, mode, bucket_bytes, on_empty)

    def _replace(self, last: dict | None, source: DataFrame, rules: dict, mark: Mark | None, mode: str, bucket_bytes: int, on_empty: str) -> dict:
        stage, folder, facts = self._stage(last, source, rules, mark)
        if facts["rows"] == 0 and on_empty == "keep":
            self._drop_stage(folder)
            return {**(last or {}), "mode": mode, "last_rows": 0, "published": False}
        return self._write(last, None, stage, folder, rules, facts, mode, _nullable(source.schema), bucket_bytes)

    def reconcile(self, source: DataFrame, bucket_bytes: int = BUCKET_BYTES, on_empty: str = "keep", digest_buckets: int = reconcile.BUCKETS) -> dict:
        """Remove the rows whose keys the source has lost; `last_rows` counts what stays.

        Finding them moves digests and few keys, see `operators.reconcile`. Where there are
        any, the rest is published as a new version with the mark that was stored, so a lost last row
        does not turn the clock back. Rows that changed or came are left to the next increment.
        """
        last = self.commit()
        if last is None or last["schema"] is None or not last["keys"]:
            raise ValueError(f"{self.table} has no published rows with a key")
        rules = self._rules(last, (), None, None, None, None)
        how = (rules["keys"], rules["fold_case"], rules["collation"])
        unchanged = {**last, "mode": "reconcile", "published": False}
        if on_empty == "keep" and source.isEmpty():
            return unchanged
        live, path = self.read(), files.scratch(self.spark, "deleted")
        reconcile.deleted(live, source, rules["keys"], digest_buckets, *how[1:]).write.parquet(path)
        gone = self.spark.read.schema(T.StructType([live.schema[k] for k in rules["keys"]])).parquet(path)
        if gone.isEmpty():
            return unchanged
        mark = self.mark(rules["field"], last) if rules["field"] else None
        return self._replace(last, merge.without(live, gone, *how), rules, mark, "reconcile", bucket_bytes, "replace")

    def types(self, target: str = "mysql", keys: Sequence[str] = ()) -> DataFrame:
        """(ordinal, name, kind, type) of every column by the kinds of all values that were
        written, from the commit alone. Kinds are kept since the last full refresh, of rows replaced or removed as well."""
        record = self.commit()
        if record is None or record.get("kinds") is None:
            raise LookupError(f"{self.table}: no run has kept the kinds of its values (track_types=True)")
        return infer.widest_of_kinds(self.spark, T.StructType.fromJson(record["schema"]).names, record["kinds"], target, keys)

    def increment(
        self, source: DataFrame, field: str, keys: Sequence[str] = (), order: Sequence[str] | None = None, lookback=None,
        bucket_bytes: int = BUCKET_BYTES, fold_case: bool | None = None, latest: bool | None = None,
        most_folders: int | None = MOST_FOLDERS, collation: str | None = None, track_types: bool | None = None,
    ) -> dict:
        """Merge the source rows above the stored watermark.

        Rows that arrive late, at or below the mark, are only seen with a `lookback`,
        which reads some rows again and therefore needs a key.
        """
        if lookback is not None and not keys:
            raise ValueError("a lookback reads rows again and needs a key")
        merge.require_columns(source, [field], "watermark")
        last = self.commit()
        mark = self.mark(field, last) if last else None
        if mark is None and last and last["schema"] and not (keys or last["keys"]):
            # all rows are read again and there is no key to match them: they replace the old ones
            return self.full_refresh(source, field=field, mode="incremental-initial", track_types=track_types)
        delta = source if mark is None else above(source, field, mark, lookback)
        return self._apply(last, delta, self._rules(last, keys, field, order, fold_case, latest, collation, track_types), bucket_bytes, most_folders)

    def apply(
        self, delta: DataFrame, field: str, keys: Sequence[str] = (), order: Sequence[str] | None = None,
        bucket_bytes: int = BUCKET_BYTES, fold_case: bool | None = None, latest: bool | None = None,
        feed: str | None = None, batch: int | None = None, most_folders: int | None = MOST_FOLDERS,
        collation: str | None = None, track_types: bool | None = None,
    ) -> dict:
        """Merge a delta and move the watermark, in one commit.

        A batch of a feed that was committed before is not applied again. Of equal keys the
        row that arrives last wins, whatever its field says; with `latest` the row that is
        last by field and order wins, so a late older row changes nothing.
        """
        last = self.commit()
        if feed is not None and last and last["feeds"].get(feed, -1) >= batch:
            return {**last, "published": False}
        rules = self._rules(last, keys, field, order, fold_case, latest, collation, track_types)
        if feed is not None:
            rules["feeds"][feed] = batch
        return self._apply(last, delta, rules, bucket_bytes, most_folders)

    def _apply(self, last: dict | None, delta: DataFrame, rules: dict, bucket_bytes: int, most_folders: int | None) -> dict:
        """The delta is written out before anything is computed from it: the source may
        change meanwhile, and watermark and rows must come from the same reading."""
        mark = self.mark(rules["field"], last) if last else None
        mode = "incremental" if mark else "incremental-initial"
        live = last if last is not None and last["schema"] is not None else None
        schema = _nullable(delta.schema)
        if live:
            schema = merge.widen(T.StructType.fromJson(live["schema"]), schema)
            if rules["track_types"] and live.get("kinds") is None:
                # the rows so far were written without looking: once, they are read
                live = {**live, "kinds": infer.kinds_of(self.read())}
        stage, folder, facts = self._stage(last, delta, rules, mark)
        if facts["rows"] == 0:
            self._drop_stage(folder)
            return {**(last or {}), "mode": mode, "last_rows": 0, "published": False}
        return self._write(last, live, stage, folder, rules, facts, mode, schema, bucket_bytes, most_folders)

    def _rules(self, last: dict | None, keys, field, order, fold_case, latest, collation=None, track_types=None) -> dict:
        """Key, field, order and comparison belong to the table: a run that names none keeps the stored ones."""
        merge.require_collated_hash(self.spark, collation)
        known = {"keys": [], "watermark_field": None, "order": [], "fold_case": False, "latest": False, "collation": None, "kinds": None, "feeds": {}, **(last or {})}
        return {
            "keys": list(keys or known["keys"]),
            "field": field or known["watermark_field"],
            "order": list(known["order"] if order is None else order),
            "fold_case": known["fold_case"] if fold_case is None else fold_case,
            "collation": known["collation"] if collation is None else collation,
            "latest": known["latest"] if latest is None else latest,
            "track_types": known["kinds"] is not None if track_types is None else track_types,
            "feeds": dict(known["feeds"]),
        }

    @staticmethod
    def _order(rules: dict) -> list[str]:
        return list(dict.fromkeys([*([rules["field"]] if rules["field"] else []), *rules["order"]]))

    def _stage(self, last: dict | None, rows: DataFrame, rules: dict, mark: Mark | None) -> tuple[DataFrame, str, dict]:
        """Rows of one reading, written, and what the writing saw of them; of a keyed table the last row
        of every key. Rows of a table without a key are written where they will stay."""
        version = last["version"] + 1 if last else 1
        folder = f"{version:012d}-{uuid.uuid4().hex[:8]}"
        target = f"{self.path}/{'stage' if rules['keys'] else 'data'}/{folder}"
        if rules["keys"]:
            merge.require_columns(rows, [*rules["keys"], *self._order(rules)])
            rows = merge.dedupe_last(rows, rules["keys"], self._order(rules), rules["fold_case"], rules["collation"])
        start = time.perf_counter()
        facts = self._observed(rows, rules, mark, target)
        self.staged_sec = time.perf_counter() - start
        return self.spark.read.schema(rows.schema).parquet(target), folder, facts

    def _drop_stage(self, folder: str) -> None:
        for kind in ("stage", "data"):
            files.delete(self.spark, f"{self.path}/{kind}/{folder}")

    def _write(
        self, last: dict | None, live: dict | None, stage: DataFrame, folder: str, rules: dict, facts: dict, mode: str,
        schema: T.StructType, bucket_bytes: int, most_folders: int | None = None,
    ) -> dict:
        """Bring staged rows and the live rows they meet into a new version; `live` is None when none stay."""
        keys, data = rules["keys"], f"{self.path}/data/{folder}"
        facts = {**facts, "kinds": infer.merged_kinds(live.get("kinds") if live else None, facts["kinds"])}
        if not keys:
            folders, sizes = (live["folders"], live["sizes"]) if live else ([], {})
            sizes = {**sizes, folder: [files.size(self.spark, data), 1]}
            folders = [*folders, folder]
            if most_folders is not None and len(folders) > most_folders:
                folders, sizes = self._compact(folders, sizes, schema, bucket_bytes)
            return self._publish(last, mode, schema, rules, facts, folders, sizes)

        same = live is not None and live["buckets"] is not None and live["keys"] == keys and all(live.get(k) == rules[k] for k in ("fold_case", "collation"))
        staged_bytes = files.size(self.spark, f"{self.path}/stage/{folder}")
        count = _power_of_two(-(-(staged_bytes + (_live_bytes(live) if live else 0)) // bucket_bytes))
        if same:
            count = max(count, live["count"])
            live = {**live, "count": count, "buckets": _doubled(live, count)}
            bucket = _bucket(schema, rules, count)
            hit = {r[0] for r in merge.conform(stage, schema).select(bucket).distinct().collect()}  # one number for each bucket
            parts = self._parts(live, hit)
            # whoever lies in the same bucket folder moves along
            targets = sorted(hit | {b for b, (i, n) in _buckets(live).items() if (i, b % n) in parts})
            rows = self._rows({**live, "schema": schema.jsonValue()}, self._folders(live, parts))
        else:
            # nothing lives yet, or not by this key: every bucket is new
            targets = list(range(count))
            rows = merge.conform(self._rows(live, self._folders(live)), schema) if live else None
        merged = self._merge(rows, stage, schema, rules, count, targets)
        if not same and live:
            # live rows that had no key before are written by one
            seen = Observation()
            merged = merged.observe(seen, merge.null_keys(merged, keys).alias("nulls"))
        merged.write.partitionBy(BUCKET).parquet(data)
        if not same and live:
            _refuse(seen.get.get("nulls", 0), keys)
        written = [int(n.partition("=")[2]) for n, _ in files.children(self.spark, data) if n.startswith(f"{BUCKET}=")]
        folders = [*(live["folders"] if same else []), folder]
        kept = {b: at for b, at in _buckets(live).items() if b not in set(targets)} if same else {}
        buckets = {**kept, **{b: (len(folders) - 1, count) for b in written}}
        sizes = {**(live["sizes"] if same else {}), folder: [files.size(self.spark, data), len(written)]}
        record = self._publish(last, mode, schema, rules, facts, folders, sizes, count, buckets)
        files.delete(self.spark, f"{self.path}/stage/{folder}")
        return record

    def _compact(self, folders: list[str], sizes: dict, schema: T.StructType, bucket_bytes: int) -> tuple[list[str], dict]:
        """Small folders put together in one; large ones stay as they are."""
        small = [f for f in folders if sizes[f][0] < bucket_bytes]
        if len(small) < 2:
            return folders, sizes
        together = f"{small[-1].partition('-')[0]}-{uuid.uuid4().hex[:8]}"
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in small])
        rows.hint("rebalance").write.parquet(f"{self.path}/data/{together}")
        kept = [f for f in folders if f not in set(small)]
        size = files.size(self.spark, f"{self.path}/data/{together}")
        return [*kept, together], {**{f: sizes[f] for f in kept}, together: [size, 1]}

    def _merge(self, live: DataFrame | None, stage: DataFrame, schema: T.StructType, rules: dict, count: int, targets: list[int]) -> DataFrame:
        """Live and staged rows in one shuffle, one task for each bucket that is written; per key the
        staged row wins, or with `latest` the last by order. The shuffle serves the layout as well."""
        keys = rules["keys"]
        bucket = _bucket(schema, rules, count)
        both = merge.conform(stage, schema).select("*", bucket, F.lit(1).alias("_new"))
        if live is not None:
            both = live.select("*", bucket, F.lit(0).alias("_new")).unionByName(both)
        task = F.col(BUCKET).cast("int")
        if len(targets) < count:
            # a row for each bucket that is written
            numbers = self.spark.createDataFrame(list(zip(targets, range(len(targets)))), f"{BUCKET} BIGINT, _task INT")
            both, task = both.join(F.broadcast(numbers), BUCKET), F.col("_task")
        both = both.repartitionById(len(targets), task)
        group = W.partitionBy(task, BUCKET, *merge.key_columns(keys, schema, rules["fold_case"], rules["collation"]))
        for f in schema:
            if f.name not in stage.columns:
                # the delta has no such column: an updated row keeps its live value
                both = both.withColumn(f.name, F.first(column(f.name), ignorenulls=True).over(group))
        by = [column(o).desc_nulls_last() for o in self._order(rules)]
        newest = F.row_number().over(group.orderBy(*([*by, F.desc("_new")] if rules["latest"] else [F.desc("_new"), *by])))
        merged = both.withColumn("_rank", newest).where("_rank = 1").drop("_rank", "_new", "_task")
        # by key inside a bucket rows compress and skip better
        return merged.sortWithinPartitions(BUCKET, *[column(k) for k in keys])

    def _observed(self, rows: DataFrame, rules: dict, mark: Mark | None, target: str) -> dict:
        """Write rows and learn their count, new watermark and kinds of values on the way; rows without a key are refused.

        The measures belong to the writing stage itself, where a task counts when it has
        succeeded: one that fails, or runs twice, counts once.
        """
        keys, field = rules["keys"], rules["field"]
        kind, measures = None, [F.count(F.lit(1)).alias("rows")]
        if field is not None:
            merge.require_columns(rows, [field], "watermark")
            dtype = rows.schema[field].dataType
            kind = mark_type(dtype)
            top = F.max(column(field))
            if mark is not None:
                top = F.greatest(literal(mark, dtype), top)
            measures.append(encode(top, dtype).alias("mark"))
        if keys:
            measures.append(merge.null_keys(rows, keys).alias("nulls"))
        if rules["track_types"]:
            measures += [infer.kinds_seen(column(f.name), f.dataType).alias(f"kinds_{i}") for i, f in enumerate(rows.schema)]
        seen = Observation()
        rows.observe(seen, *measures).write.parquet(target)
        got = seen.get
        _refuse(got.get("nulls", 0), keys)
        value = got.get("mark")
        kinds = {n: got.get(f"kinds_{i}") or 0 for i, n in enumerate(rows.columns)} if rules["track_types"] else None
        return {"rows": got.get("rows", 0), "mark": Mark(kind, value) if value is not None else None, "kinds": kinds}

    def _publish(
        self, last: dict | None, mode: str, schema: T.StructType, rules: dict, facts: dict, folders: list[str], sizes: dict,
        count: int | None = None, buckets: dict[int, tuple[int, int]] | None = None,
    ) -> dict:
        if buckets is not None:
            # drop folders no bucket points at any more
            used = sorted({i for i, _ in buckets.values()})
            at = {old: new for new, old in enumerate(used)}
            folders = [folders[i] for i in used]
            buckets = {str(b): [at[i], n] for b, (i, n) in buckets.items()}
        mark = facts["mark"]
        if mark is None and last and last["watermark_field"] == rules["field"] and mode == "incremental":
            mark = Mark(last["watermark_type"], last["watermark_value"])
        record = {
            "source_table": self.table,
            "version": last["version"] + 1 if last else 1,
            "mode": mode,
            "watermark_type": mark.type if mark else None,
            "watermark_value": mark.text if mark else None,
            "watermark_field": rules["field"],
            "pk_field": ",".join(rules["keys"]) or None,
            "last_rows": facts["rows"],
            "updated_at": datetime.now(timezone.utc).isoformat(),
            "published": True,
            "schema": schema.jsonValue(),
            "folders": folders,
            "sizes": {f: sizes[f] for f in folders},
            "count": count,
            "buckets": buckets,
            "kinds": facts["kinds"],
            **{k: rules[k] for k in ("keys", "order", "fold_case", "collation", "latest", "feeds")},
        }
        self._commit(record)
        return {**record, "staged_sec": self.staged_sec}

    def _commit(self, record: dict) -> None:
        name = f"{self.path}/commits/{record['version']:012d}.json"
        if not files.create_once(self.spark, name, json.dumps(record)):
            raise LostRace(f"{self.table}: version {record['version']} was committed by another run")

    # cleaning up

    def orphans(self, min_age_seconds: float = 0.0) -> list[str]:
        """Data and stage folders, and buckets inside data folders, that no commit points
        at. The age guard spares the folders of a run that is still writing."""
        named: dict[str, set[int] | None] = {}
        for v in self.versions():
            record = self.commit(v)
            if record["buckets"] is None:
                named |= dict.fromkeys(record["folders"])
            else:
                for i, b in self._parts(record):
                    named.setdefault(record["folders"][i], set()).add(b)
        limit = datetime.now(timezone.utc).timestamp() - min_age_seconds
        found = []
        for kind in ("data", "stage"):
            for path, changed in files.matching(self.spark, f"{self.path}/{kind}/*"):
                if (kind == "stage" or path.rpartition("/")[2] not in named) and changed <= limit:
                    found.append(path)
        for path, changed in files.matching(self.spark, f"{self.path}/data/*/{BUCKET}=*"):
            _, folder, b = path.rsplit("/", 2)
            if named.get(folder) is not None and int(b.partition("=")[2]) not in named[folder] and changed <= limit:
                found.append(path)
        return found

    def clean(self, min_age_seconds: float = 86_400.0, keep: int = 2) -> list[str]:
        """Delete old commits, then the folders nothing points at. The age is the time a
        reader of an old version has to finish."""
        limit = datetime.now(timezone.utc).timestamp() - min_age_seconds
        commits = f"{self.path}/commits"
        for name, changed in files.children(self.spark, commits)[:-keep]:
            if changed <= limit:
                files.delete(self.spark, f"{commits}/{name}")
        gone = self.orphans(min_age_seconds)
        for folder in gone:
            files.delete(self.spark, folder)
        return gone


def _buckets(record: dict) -> dict[int, tuple[int, int]]:
    """Bucket: (folder, number of buckets when it was written)."""
    return {int(b): (i, n) for b, (i, n) in (record["buckets"] or {}).items()}


def _doubled(record: dict, count: int) -> dict[int, tuple[int, int]]:
    """The buckets of a record as seen by a larger number of them: each is several."""
    known = _buckets(record)
    return {b + k * record["count"]: at for b, at in known.items() for k in range(count // record["count"])}


def _power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def _live_bytes(record: dict) -> int:
    """Measured bytes of the live rows: of each folder the share of its buckets that still counts."""
    if record["buckets"] is None:
        return sum(size for size, _ in record["sizes"].values())
    live: dict[int, int] = {}
    for i, _ in {(i, b % n) for b, (i, n) in _buckets(record).items()}:
        live[i] = live.get(i, 0) + 1
    return sum(record["sizes"][record["folders"][i]][0] * n // max(1, record["sizes"][record["folders"][i]][1]) for i, n in live.items())


def _bucket(schema: T.StructType, rules: dict, count: int) -> Column:
    """Bucket of a row: twice the buckets cut each of them in two."""
    return F.pmod(F.xxhash64(*merge.key_columns(rules["keys"], schema, rules["fold_case"], rules["collation"])), F.lit(count).cast("bigint")).alias(BUCKET)


def _refuse(nulls: int, keys: Sequence[str]) -> None:
    if nulls:
        raise BadDelta(f"{nulls} rows without a key in {list(keys)}")


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


# the state of all tables


def state(spark: SparkSession, root: str) -> DataFrame:
    """One row per table: watermark, field, key, rows of the last run, and whether rows are published."""
    newest: dict[str, str] = {}
    for path, _ in files.matching(spark, f"{root.rstrip('/')}/*/commits/*.json"):
        table = path.rsplit("/", 3)[1]
        newest[table] = max(newest.get(table, ""), path)
    if not newest:
        return spark.createDataFrame([], COMMIT_SCHEMA).drop("version", "mode")
    return spark.read.schema(COMMIT_SCHEMA).json(sorted(newest.values())).drop("version", "mode")


def legacy_state(spark: SparkSession, path: str) -> DataFrame:
    """State rows from an old JSON file {table: {watermark, last_rows, updated_at}}."""
    entries = "MAP<STRING, STRUCT<watermark: VARIANT, last_rows: BIGINT, updated_at: STRING>>"
    kind = F.schema_of_variant("watermark")
    wtype = (
        F.when(F.col("watermark").isNull() | (kind == "VOID"), None)
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "BIGINT", "int")
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL"), "float")
        .otherwise("str")
    )
    text = F.col("watermark").cast("string")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json("value", entries)).alias("source_table", "entry"))
        .select("source_table", "entry.*")
        .select(
            "source_table",
            wtype.alias("watermark_type"),
            F.when(wtype == "bool", F.when(text == "true", "1").otherwise("0")).when(wtype.isNotNull(), text).alias("watermark_value"),
            F.coalesce("last_rows", F.lit(0).cast("bigint")).alias("last_rows"),
            F.date_format(F.col("updated_at").try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("updated_at"),
        )
    )


def import_state(spark: SparkSession, root: str, path: str) -> int:
    """Take over old watermarks once: does nothing when a table was synced here before.

    Names are checked before anything is written, and an import that died is completed by
    the next call. An imported mark is history: the first run of its table reads the whole source.
    """
    if not files.exists(spark, path) or not state(spark, root).where("published").isEmpty():
        return 0
    rows = legacy_state(spark, path).collect()  # one row per table
    refused = sorted(r["source_table"] for r in rows if not re.match(IDENTIFIER.replace(r"\z", r"\Z"), r["source_table"] or ""))
    if refused:
        raise ValueError(f"not valid table names, nothing was imported: {refused}")
    taken = 0
    for r in rows:
        replica = Replica(spark, root, r["source_table"])
        if replica.versions():
            continue
        taken += 1
        replica._commit(
            {
                "source_table": r["source_table"], "version": 1, "mode": "import",
                "watermark_type": r["watermark_type"], "watermark_value": r["watermark_value"],
                "watermark_field": None, "pk_field": None, "last_rows": r["last_rows"],
                "updated_at": r["updated_at"], "published": False,
                "keys": [], "schema": None, "folders": [], "sizes": {}, "count": None, "buckets": None,
                "order": [], "fold_case": False, "collation": None, "latest": False, "kinds": None, "feeds": {},
            }
        )
    return taken
