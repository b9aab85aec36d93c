"""One query per operator. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.functions import marks, names, wire
from tidemark.operators import catalog, infer, merge, reconcile, report
from tidemark.plans import policy, replica as store
from tidemark.plans.replica import Replica
from tidemark.plans.run import run
from tidemark.sources import envelopes, footers, jdbc, query, tables as scans
from tidemark.streaming import feed
from tidemark.workload import inputs
from tidemark.workload.inputs import moment, table

# small, so that the given tables have several buckets
BUCKET_BYTES = 256 * 1024


def _before_and_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events a replica has, and events that came since."""
    events = table(spark, sf_dir, "events")
    return events.where(F.col("ts") <= moment(inputs.EVENTS_SYNCED)), events.where(F.col("ts") > moment(inputs.EVENTS_SYNCED))


# scans


def scan_full(spark, sf_dir):
    return scans.load(spark, f"{sf_dir}/orders.parquet")


def scan_incremental_int(spark, sf_dir):
    before, _ = _before_and_after(spark, sf_dir)
    mark = marks.highest(before, "event_id").first()[0]
    return scans.above(table(spark, sf_dir, "events"), "event_id", mark)


def scan_incremental_ts(spark, sf_dir):
    return scans.above(table(spark, sf_dir, "orders"), "o_orderdate", marks.Mark("datetime", inputs.ORDERS_SYNCED))


def scan_page(spark, sf_dir):
    return scans.page(table(spark, sf_dir, "customer"), "c_custkey", limit=100, offset=50)


def scan_pages(spark, sf_dir):
    return scans.pages(table(spark, sf_dir, "orders"), "o_orderkey", page_size=1_000)


def scan_pages_text(spark, sf_dir):
    return scans.pages(table(spark, sf_dir, "pages"), "url", page_size=100).select("page_id", "url", "page")


def _sources(spark, sf_dir) -> dict:
    found = {t: (lambda t=t: table(spark, sf_dir, t)) for t in inputs.TABLES}
    return {**found, "missing": lambda: table(spark, sf_dir, "missing")}


def _odd_tables(spark, sf_dir) -> str:
    """Copies of given tables under awkward names, and a folder that is no parquet."""
    root = files.scratch(spark, "odd")
    for name, source in (("a b", "customer"), ("p%q", "events"), ("_x", "lineitem"), ("plain", "orders")):
        table(spark, sf_dir, source).write.parquet(f"{root}/{name}")
    table(spark, sf_dir, "region").select("r_name").write.text(f"{root}/broken")
    return root


def list_tables(spark, sf_dir):
    found = scans.list_tables(spark, sf_dir)
    wide = catalog.columns(spark, {t: scans.load(spark, p) for t, p in found.items()})
    counted = wide.groupBy("table_name").agg(F.count("*").alias("column_count"))
    counts = catalog.parquet_row_counts(spark, sf_dir).select("table_name", "rows")
    return counts.join(counted, "table_name").orderBy("table_name")


def table_schema(spark, sf_dir):
    """From the schemas, a catalog table with declared lengths among them; one of the tables cannot be opened."""
    name = f"customer_{uuid.uuid4().hex[:8]}"
    place = files.scratch(spark, "declared")
    spark.sql(f"CREATE TABLE {name} (c_custkey BIGINT, c_name VARCHAR(25), c_acctbal DOUBLE, c_mktsegment CHAR(12)) USING parquet LOCATION '{place}'")
    try:
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.insertInto(name)
        found, errors = catalog.discover(spark, {**_sources(spark, sf_dir), "declared": scans.catalog_table(spark, name)})
    finally:
        spark.sql(f"DROP TABLE {name}")
    lost = T.StructType.fromDDL(catalog.COLUMNS_SCHEMA).fields[1:]
    failed = errors.select("table_name", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lost])
    return found.unionByName(failed)


def column_profile(spark, sf_dir):
    return catalog.column_profile(inputs.tables(spark, sf_dir))


def table_count(spark, sf_dir):
    return catalog.row_counts({"lineitem": table(spark, sf_dir, "lineitem")})


def table_count_footers(spark, sf_dir):
    """Counts of all given tables; no row is read."""
    return footers.row_counts(spark, scans.list_tables(spark, sf_dir)).drop("error")


def watermark_max_footers(spark, sf_dir):
    """Marks of three tables; the footers tell two of them, and a moment in time is read from the rows."""
    found = [("events", "event_id"), ("orders", "o_orderkey"), ("lineitem", "l_shipdate")]
    tops = [footers.highest(spark, f"{sf_dir}/{t}.parquet", c) for t, c in found]
    made = [top.select(F.lit(t).alias("table_name"), F.col("watermark").cast("string").alias("watermark"), "from_footers") for (t, _), top in zip(found, tops)]
    return made[0].unionByName(made[1]).unionByName(made[2])


def size_probe(spark, sf_dir):
    sizes = catalog.parquet_row_counts(spark, _odd_tables(spark, sf_dir))
    return catalog.ranked_sizes(sizes).select("table_name", "rows", F.col("error").isNotNull().alias("failed"))


def size_report(spark, sf_dir):
    """The sizes as a CSV file, read back."""
    path = files.scratch(spark, "sizes")
    report.write_csv(catalog.ranked_sizes(catalog.parquet_row_counts(spark, _odd_tables(spark, sf_dir))), path)
    back = spark.read.schema("`table` string, rows bigint, error string").option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return back.select("table", "rows", F.col("error").isNotNull().alias("failed"))


def size_top20(spark, sf_dir):
    return catalog.ranked_sizes(catalog.row_counts(inputs.tables(spark, sf_dir)), top=20)


def size_totals(spark, sf_dir):
    return catalog.size_totals(catalog.parquet_row_counts(spark, _odd_tables(spark, sf_dir)))


def size_errors(spark, sf_dir):
    """Counts one table at a time; one of them cannot be read."""
    found = {t: (lambda p=p: scans.load(spark, p)) for t, p in scans.list_tables(spark, sf_dir).items()}
    sizes = catalog.probe_sizes(spark, {**found, "missing": lambda: table(spark, sf_dir, "missing")})
    return catalog.ranked_sizes(sizes).select("table_name", "rows", F.col("error").isNotNull().alias("failed"))


def envelope_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = files.scratch(spark, "envelopes")
    envelopes.write(orders, path, "orders")
    return merge.conform(envelopes.rows(spark, path, wire.to_wire(orders).schema, "orders").select("row.*"), orders.schema)


def envelope_untyped(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    path = files.scratch(spark, "envelopes")
    envelopes.write(documents, path, "documents")
    found = envelopes.rows(spark, path)
    fields = wire.to_wire(documents).schema
    return found.select(*[F.variant_get("row", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields])


def _customer_envelopes(spark, sf_dir) -> tuple[str, T.StructType]:
    """Customers by market segment; two segments arrive with a fault."""
    customer = wire.to_wire(table(spark, sf_dir, "customer"))
    pages = customer.groupBy("c_mktsegment", F.floor(F.col("c_custkey") / 500).alias("page")).agg(
        F.collect_list(F.to_json(F.struct(*customer.columns))).alias("rows")  # 500 at most
    )
    segment = F.col("c_mktsegment")
    text = envelopes.envelope_text(
        segment,
        F.array(*[F.lit(c) for c in customer.columns]),
        F.col("rows"),
        F.size("rows") + F.when(segment == "MACHINERY", 1).otherwise(0),
        F.when(segment == "BUILDING", "cursor closed"),
    )
    path = files.scratch(spark, "envelopes")
    pages.select(text.alias("value")).write.text(path)
    return path, customer.schema


def envelope_rejects(spark, sf_dir):
    path, _ = _customer_envelopes(spark, sf_dir)
    return envelopes.rejects(envelopes.trailers(spark, path))


def envelope_accepts(spark, sf_dir):
    path, row = _customer_envelopes(spark, sf_dir)
    return envelopes.rows(spark, path, row).select("table", "row.*")


def envelope_incremental(spark, sf_dir):
    """Events as envelopes in folders by week; only the weeks from the mark's on are read."""
    events = table(spark, sf_dir, "events")
    path = files.scratch(spark, "envelopes")
    week = dt.timedelta(days=7)
    envelopes.write_ranges(events, path, "events", "ts", week)
    return envelopes.rows_above(spark, path, events.schema, "ts", marks.Mark("datetime", inputs.EVENTS_SYNCED), week, "events")


ADHOC = """
SELECT n_name, o_orderpriority, count(*) AS orders, max(o_orderdate) AS last_order,
       cast(sum(cast(o_totalprice AS decimal(18, 2))) AS double) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus <> 'DELETE; DROP TABLE orders'
GROUP BY n_name, o_orderpriority
"""


def adhoc_sql(spark, sf_dir):
    for t in ("orders", "customer", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return query.read_only(spark, ADHOC, wire=True)


ADHOC_BOUND = """
SELECT o_orderstatus, count(*) AS orders, max(IDENTIFIER(:field)) AS last_order
FROM IDENTIFIER(:source)
WHERE IDENTIFIER(:field) > :low AND IDENTIFIER(:field) <= :high AND o_orderpriority <> :text
GROUP BY o_orderstatus
"""


def adhoc_bound(spark, sf_dir):
    """Table, field and bounds are parameters; a text that would be SQL stays a value."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    args = {
        "source": "orders", "field": "o_orderdate", "low": dt.datetime(1996, 1, 1), "high": dt.datetime(1998, 6, 15),
        "text": "x' OR '1' = '1'; DROP VIEW orders --",
    }
    return query.read_only(spark, ADHOC_BOUND, wire=True, args=args)


# values


def watermark_coerce(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_id").cast("string").alias("id"),
        wire.iso_timestamp(F.col("ts")).alias("ts"),
        F.col("value").cast("string").alias("value"),
        "event_type",
    )
    return texts.select(
        "event_id",
        *[marks.untyped_kind(F.col(c)).alias(f"{c}_kind") for c in ("id", "ts", "value", "event_type")],
        F.col("id").cast("bigint").alias("id_mark"),
        F.col("ts").cast("timestamp_ntz").alias("ts_mark"),
    )


def state_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kinds = {c: marks.mark_type(events.schema[c].dataType) for c in ("event_id", "ts", "value", "event_type")}
    back = {
        c: marks.decode(F.lit(kind), marks.encode(F.col(c), events.schema[c].dataType)) for c, kind in kinds.items()
    }
    return events.select(
        back["event_id"]["as_int"].alias("event_id"),
        back["ts"]["as_datetime"].alias("ts"),
        back["value"]["as_float"].alias("value"),
        back["event_type"]["as_str"].alias("event_type"),
        marks.decode(F.lit("int"), F.col("event_type"))["as_str"].alias("undecodable"),
    )


def truncate_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return documents.unionByName(pages).withColumn("text", wire.truncate(F.col("text")))


def iso_temporal(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.lit("events").alias("source"), F.col("event_id").alias("id"), "ts")
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts")
    )
    both = events.unionByName(orders)
    return both.select("source", "id", wire.iso_timestamp(F.col("ts")).alias("iso"), F.col("ts").cast("date").cast("string").alias("iso_date"))


def interval_seconds(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        "l_orderkey", "l_linenumber", wire.interval_seconds(F.col("l_shipdate") - F.col("o_orderdate")).alias("seconds")
    )


def decimal_to_double(spark, sf_dir):
    money = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    lines = table(spark, sf_dir, "lineitem")
    return wire.to_wire(lines.withColumns({c: F.col(c).cast("decimal(12,2)") for c in money}))


def flatten_number(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        wire.flat_int(F.col("l_quantity")).alias("quantity_int"),
        wire.flat_int(F.col("l_extendedprice")).alias("price_int"),
        wire.flat_float(F.col("l_extendedprice")).alias("price_float"),
    )


def binary_to_text(spark, sf_dir):
    broken = F.concat(F.lit(bytearray(b"\xff")), F.encode("text", "utf-8"), F.lit(bytearray(b"\xc3")))
    return table(spark, sf_dir, "documents").select("doc_id", wire.binary_text(broken).alias("text"))


def strip_nul(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.translate("text", " ", "\u0000").alias("text"))
    return wire.without_nul(documents)


def normalize_row(spark, sf_dir):
    return wire.to_wire(table(spark, sf_dir, "lineitem"))


def normalize_nested(spark, sf_dir):
    """Whatever is no plain value becomes text."""
    found = wire.to_wire(table(spark, sf_dir, "embeddings"))
    # numbers print differently in other engines: compare them as numbers again
    return found.withColumn("embedding", F.from_json("embedding", "array<float>"))


def all_text(spark, sf_dir):
    found = wire.all_text(table(spark, sf_dir, "customer"))
    # doubles print differently in other engines: compare them as numbers again
    return found.withColumn("c_acctbal", F.when(F.col("c_acctbal") != "", F.col("c_acctbal").cast("double")))


# names


def _data_names(spark, sf_dir) -> DataFrame:
    parts = [("part", "p_name"), ("customer", "c_name"), ("pages", "url"), ("nation", "n_name"), ("lineitem", "l_shipdate")]
    found = [table(spark, sf_dir, t).select(F.lit(t).alias("source"), F.col(c).cast("string").alias("name")) for t, c in parts]
    result = found[0]
    for f in found[1:]:
        result = result.unionByName(f)
    return result.distinct()


def sanitize_names(spark, sf_dir):
    name = F.col("name")
    return _data_names(spark, sf_dir).select("source", "name", *[names.sanitize(name, t).alias(t) for t in ("mysql", "postgres", "sqlite")])


def valid_identifiers(spark, sf_dir):
    return _data_names(spark, sf_dir).select("source", "name", names.is_identifier(F.col("name")).alias("valid"))


def name_collisions(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", " ")).alias("word"))
    return names.collisions(words, "word", "mysql", scope=("lang",))


def target_rows(spark, sf_dir):
    """Rows of a table with awkward names, as a Postgres copy stores them."""
    awkward = table(spark, sf_dir, "customer").toDF("Cust Key", "cust-NAME", "2nd", "ACCT$BAL", "c_mktsegment")
    nul = awkward.withColumn("cust-NAME", F.translate("`cust-NAME`", "#", "\u0000"))
    return jdbc.target_rows(nul, "postgres")


# types


def infer_types_wide(spark, sf_dir):
    return infer.widest(table(spark, sf_dir, "lineitem"))


def infer_types_merged(spark, sf_dir):
    """Types of a table that arrived in three deltas, from the kinds its commits have kept."""
    lines = table(spark, sf_dir, "lineitem")
    replica = Replica(spark, files.scratch(spark, "replica"), "lineitem")
    edges = ["1900-01-01 00:00:00", inputs.LINES_SYNCED, "2000-01-01 00:00:00", "2100-01-01 00:00:00"]
    for low, high in zip(edges, edges[1:]):
        part = lines.where((F.col("l_shipdate") > moment(low)) & (F.col("l_shipdate") <= moment(high)))
        replica.apply(part, "l_shipdate", track_types=True)
    return replica.types()


def infer_types_json(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    rows = part.select(F.to_json(F.struct(*part.columns)).alias("json")).unionByName(
        table(spark, sf_dir, "events").select(F.col("props").alias("json"))
    )
    return infer.widest_json(rows.select(F.parse_json("json").alias("row")), "row")


def infer_types_first(spark, sf_dir):
    return infer.first_row(table(spark, sf_dir, "orders"), "o_orderkey")


def pk_check(spark, sf_dir):
    return infer.widest(table(spark, sf_dir, "customer"), keys=["c_name"])


def target_ddl(spark, sf_dir):
    """Column definitions of the customer table under awkward names."""
    awkward = table(spark, sf_dir, "customer").toDF("Cust Key", "cust-NAME", "2nd", "ACCT$BAL", "c_mktsegment")
    made = [(t, infer.ddl(awkward, infer.widest(awkward, target=t, keys=["Cust Key"]), t, ["Cust Key"])) for t in ("mysql", "sqlite")]
    return spark.createDataFrame(made, "target string, ddl string")


# merging


def watermark_max(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("value") > 5, F.col("ts")))
    return marks.highest(events, "ts", marks.Mark("datetime", inputs.EVENTS_SYNCED), by=("user_id", "event_type"))


def merge_append(spark, sf_dir):
    before, after = _before_and_after(spark, sf_dir)
    return merge.append(before, after.withColumn("seen", F.col("ts").cast("date").cast("string")))


def merge_upsert(spark, sf_dir):
    before, _ = _before_and_after(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    changed = scans.above(events, "ts", marks.Mark("datetime", inputs.EVENTS_SYNCED), lookback=dt.timedelta(days=3))
    return merge.upsert(before, changed.withColumn("value", F.col("value") * 2), ["event_id"], ["ts"])


COLLATION = "UNICODE_CI_AI_RTRIM"


def upsert_collated(spark, sf_dir):
    """Customers whose names come back in other cases, with accents and trailing spaces: they are the same customers."""
    customer = table(spark, sf_dir, "customer")
    number = F.col("c_custkey")
    named = F.when(number % 3 == 0, F.upper("c_name")).when(number % 3 == 1, F.concat(F.replace("c_name", F.lit("o"), F.lit("ö")), F.lit("  "))).otherwise(F.replace("c_name", F.lit("e"), F.lit("É")))
    delta = customer.where(number % 2 == 0).withColumns({"c_name": named, "c_acctbal": F.col("c_acctbal") + 1})
    return merge.upsert(customer, delta, ["c_name"], ["c_custkey"], collation=COLLATION)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def merge_upsert_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    live = merge.dedupe_last(lines.where(F.col("l_shipdate") <= moment(inputs.LINES_SYNCED)), LINE_KEY, LINE_ORDER)
    delta = lines.where(F.col("l_shipdate") > moment(inputs.LINES_SYNCED))
    return merge.upsert(live, delta, LINE_KEY, LINE_ORDER)


def dedupe_last(spark, sf_dir):
    return merge.dedupe_last(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


# planning


def _policy(spark) -> DataFrame:
    return policy.policy_frame(spark, policy.Policy(inputs.POLICY_SKIP, inputs.POLICY_INCREMENTAL))


def _data_state(spark, sf_dir) -> DataFrame:
    """State as earlier syncs of the given tables would have left it."""
    before, _ = _before_and_after(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")

    def row(df: DataFrame, name: str, field: str) -> DataFrame:
        dtype = df.schema[field].dataType
        return df.agg(marks.encode(F.max(field), dtype).alias("watermark_value")).select(
            F.lit(name).alias("source_table"),
            F.lit(field).alias("watermark_field"),
            F.lit(marks.mark_type(dtype)).alias("watermark_type"),
            "watermark_value",
            F.lit(True).alias("published"),
        )

    # the mark of lineitem was taken from another field than the policy names now
    return row(before, "events", "ts").unionByName(row(table(spark, sf_dir, "orders"), "orders", "o_orderkey")).unionByName(
        row(lines, "lineitem", "l_orderkey")
    )


def skip_tables(spark, sf_dir):
    listing = catalog.parquet_row_counts(spark, sf_dir).select("table_name", "rows")
    return policy.without_skipped(listing, _policy(spark), exclude=["region"])


def unknown_policy(spark, sf_dir):
    """Policy entries without a table, and tables whose rows say how often each is named right."""
    listing = catalog.row_counts(inputs.tables(spark, sf_dir))
    known = listing.join(_policy(spark), "table_name").select("table_name", "rows", F.lit(True).alias("known"))
    lost = policy.unknown_tables(listing, _policy(spark)).select("table_name", F.lit(None).cast("bigint").alias("rows"), F.lit(False).alias("known"))
    return known.unionByName(lost)


def plan_modes(spark, sf_dir):
    return policy.modes(catalog.parquet_row_counts(spark, sf_dir), _policy(spark), _data_state(spark, sf_dir))


def resume_slice(spark, sf_dir):
    listing = catalog.parquet_row_counts(spark, sf_dir).select("table_name", "rows")
    plan = policy.modes(listing, _policy(spark), _data_state(spark, sf_dir), full_refresh=True)
    return policy.resume(plan, 5).select("table_name", "mode").join(listing, "table_name")


# replicas


def full_refresh(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    replica = Replica(spark, files.scratch(spark, "replica"), "orders")
    replica.full_refresh(orders.withColumn("o_orderstatus", F.lit("old")), ["o_orderkey"], "o_orderdate", bucket_bytes=BUCKET_BYTES)
    replica.full_refresh(orders, bucket_bytes=BUCKET_BYTES)
    replica.full_refresh(orders.where(F.lit(False)))
    return replica.read()


def full_refresh_stamped(spark, sf_dir):
    """Every row gets the time of the run; the time itself is not compared."""
    replica = Replica(spark, files.scratch(spark, "replica"), "orders")
    replica.full_refresh(table(spark, sf_dir, "orders"), ["o_orderkey"], bucket_bytes=BUCKET_BYTES, stamp=True)
    return replica.read().withColumn("_synced_at", F.col("_synced_at").isNotNull())


def full_refresh_unkeyed(spark, sf_dir):
    replica = Replica(spark, files.scratch(spark, "replica"), "lineitem")
    replica.full_refresh(table(spark, sf_dir, "lineitem"))
    return replica.read()


def incremental_run(spark, sf_dir):
    """The source grows between runs; every run reads above the stored mark."""
    events = table(spark, sf_dir, "events")
    replica = Replica(spark, files.scratch(spark, "replica"), "events")
    for seen in (inputs.EVENTS_SYNCED, "2024-01-24 12:00:00", "2100-01-01 00:00:00"):
        replica.increment(events.where(F.col("ts") <= moment(seen)), "ts", ["event_id"], bucket_bytes=BUCKET_BYTES)
    return replica.read()


def incremental_append(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    replica = Replica(spark, files.scratch(spark, "replica"), "lineitem")
    for seen in (inputs.LINES_SYNCED, "2100-01-01 00:00:00"):
        replica.increment(lines.where(F.col("l_shipdate") <= moment(seen)), "l_shipdate")
    return replica.read()


def incremental_slices(spark, sf_dir):
    """Twenty deltas of a table without a key; small folders are put together on the way."""
    lines = table(spark, sf_dir, "lineitem")
    replica = Replica(spark, files.scratch(spark, "replica"), "lineitem")
    for number in range(20):
        part = lines.where(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(20)) == number)
        replica.apply(part, "l_shipdate", most_folders=4)
    return replica.read()


def incremental_growth(spark, sf_dir):
    """A hundredth of the lines is loaded first: the buckets have to double as the rest arrives."""
    lines = table(spark, sf_dir, "lineitem")
    replica = Replica(spark, files.scratch(spark, "replica"), "lineitem")
    share = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(100))
    for part in (lines.where(share == 0), lines.where((share > 0) & (share < 50)), lines.where(share >= 50)):
        replica.apply(part, "l_shipdate", LINE_KEY, LINE_ORDER, bucket_bytes=BUCKET_BYTES)
    return replica.read()


def incremental_replay(spark, sf_dir):
    """Every batch arrives twice."""
    replica = Replica(spark, files.scratch(spark, "replica"), "events")
    for number, part in enumerate(_before_and_after(spark, sf_dir)):
        for _ in range(2):
            replica.apply(part, "ts", feed="drops", batch=number)
    return replica.read()


def incremental_lookback(spark, sf_dir):
    """Clicks of two days arrive after the mark has passed them."""
    events = table(spark, sf_dir, "events")
    before, _ = _before_and_after(spark, sf_dir)
    late = (F.col("event_type") == "click") & (F.col("ts") > moment(inputs.EVENTS_SYNCED) - F.lit(dt.timedelta(days=2)))
    replica = Replica(spark, files.scratch(spark, "replica"), "events")
    replica.increment(before.where(~late), "ts", ["event_id"], bucket_bytes=BUCKET_BYTES)
    replica.increment(events, "ts", ["event_id"], lookback=dt.timedelta(days=3), bucket_bytes=BUCKET_BYTES)
    return replica.read()


def _lost() -> Column:
    """About a twentieth of the events, by a hash both engines have."""
    return F.conv(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 7), 16, 10).cast("bigint") % 20 == 0


def _replica_of_events(spark, sf_dir) -> tuple[Replica, DataFrame]:
    """A replica of all events, and a source that has lost some."""
    events = table(spark, sf_dir, "events")
    replica = Replica(spark, files.scratch(spark, "replica"), "events")
    replica.increment(events, "ts", ["event_id"], bucket_bytes=BUCKET_BYTES)
    return replica, events.where(~_lost())


def deletes_found(spark, sf_dir):
    """Keys the source has lost, found by digests."""
    replica, source = _replica_of_events(spark, sf_dir)
    return reconcile.deleted(replica.read(), source, ["event_id"])


def deletes_reconciled(spark, sf_dir):
    replica, source = _replica_of_events(spark, sf_dir)
    replica.reconcile(source, bucket_bytes=BUCKET_BYTES)
    return replica.read()


def state_table(spark, sf_dir):
    root = files.scratch(spark, "replica")
    for part in _before_and_after(spark, sf_dir):
        Replica(spark, root, "events").apply(part, "ts", ["event_id"], bucket_bytes=BUCKET_BYTES)
    Replica(spark, root, "orders").full_refresh(table(spark, sf_dir, "orders"), ["o_orderkey"], "o_orderkey", bucket_bytes=BUCKET_BYTES)
    Replica(spark, root, "customer").full_refresh(table(spark, sf_dir, "customer"))
    return store.state(spark, root).drop("updated_at")


def _imported(spark, sf_dir) -> str:
    """A root that took over an old state file about the given tables."""

    def entry(name: str, mark) -> DataFrame:
        facts = F.struct(
            mark.cast("variant").alias("watermark"), F.count("*").alias("last_rows"), F.lit("2024-02-01T03:00:00").alias("updated_at")
        )
        return table(spark, sf_dir, name).agg(facts.alias("facts")).select(F.lit(name).alias("name"), "facts")

    iso = wire.iso_timestamp
    entries = entry("events", iso(F.max("ts")))
    for other in (
        entry("orders", F.max("o_orderkey")), entry("lineitem", iso(F.max("l_shipdate"))),
        entry("part", F.max("p_retailprice")), entry("conversations", F.max("conv_id")),
    ):
        entries = entries.unionByName(other)
    root, legacy = files.scratch(spark, "replica"), files.scratch(spark, "legacy")
    # one entry per table
    whole = entries.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("name", "facts")))).alias("value"))
    whole.coalesce(1).write.text(legacy)
    store.import_state(spark, root, legacy)
    store.import_state(spark, root, legacy)
    return root


def state_import(spark, sf_dir):
    taken = store.state(spark, _imported(spark, sf_dir)).drop("watermark_field", "pk_field")
    return taken.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def import_then_run(spark, sf_dir):
    """An imported mark lies at the end of the table; the first run takes the whole table all the same."""
    replica = Replica(spark, _imported(spark, sf_dir), "events")
    for _ in range(2):
        replica.increment(table(spark, sf_dir, "events"), "ts", ["event_id"], bucket_bytes=BUCKET_BYTES)
    return replica.read()


class _Crash(Exception):
    pass


class _CrashingReplica(Replica):
    """Dies after writing its rows and before committing them."""

    def _commit(self, record: dict) -> None:
        raise _Crash


def orphan_versions(spark, sf_dir):
    """Rows in folders that a crashed run left behind."""
    root = files.scratch(spark, "replica")
    before, after = _before_and_after(spark, sf_dir)
    Replica(spark, root, "events").apply(before, "ts")
    try:
        _CrashingReplica(spark, root, "events").apply(after, "ts")
    except _Crash:
        pass
    found = Replica(spark, root, "events").orphans()
    rows = spark.read.schema(after.schema).parquet(*found)
    return rows.agg(F.lit("events").alias("table_name"), F.lit(len(found)).cast("bigint").alias("folders"), F.count("*").alias("rows"), F.max("ts").alias("last_ts"))


def _run_report(spark, sf_dir) -> DataFrame:
    def broken():
        return table(spark, sf_dir, "no_such_table")

    sources = {t: table(spark, sf_dir, t) for t in ("customer", "events", "lineitem", "orders", "supplier", "pages")}
    rules = policy.Policy(
        skip=("pages",),
        incremental={
            "events": {"field": "ts", "pk": "event_id"},
            "orders": {"field": "o_orderkey", "pk": "o_orderkey"},
            "supplier": {"field": "s_suppkey", "pk": "no_such_column"},
            "ordres": {"field": "o_orderkey"},
        },
    )
    path = files.scratch(spark, "report")
    run(spark, {**sources, "missing": broken}, files.scratch(spark, "replica"), rules, bucket_bytes=BUCKET_BYTES, report_path=path)
    # as written: a CSV file
    written = spark.read.schema(report.REPORT_SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(path, enforceSchema=True)
    return written


def run_report(spark, sf_dir):
    made = _run_report(spark, sf_dir)
    return made.select("table_name", "mode", "rows", "ok", "watermark", F.col("error").isNotNull().alias("failed"))


def run_summary(spark, sf_dir):
    return report.run_summary(_run_report(spark, sf_dir)).withColumn("duration_sec", F.col("duration_sec") > 0)


# catalog profiling


def _all_columns(spark, sf_dir) -> DataFrame:
    own, _ = catalog.discover(spark, _sources(spark, sf_dir))
    own = own.select("table_name", "ordinal", "name", "type")
    return own.unionByName(_legacy_columns(table(spark, sf_dir, "part")))


def _legacy_columns(part: DataFrame) -> DataFrame:
    """The columns of a catalog with one table for each part, in one pass over the parts."""
    base = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.col("p_partkey").cast("string"))
    size, price = F.col("p_size"), F.col("p_retailprice")
    field = F.when(F.col("p_type") == "ECONOMY", "ModifiedDate").when(F.col("p_type") == "STANDARD", "last_updated")
    found = [
        (F.concat(F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("Code")), F.lit("str")),
        (F.when(size > 40, "Comment").when(size > 5, "CustomerID").otherwise("Text"), F.lit("int")),
        (F.when(size > 20, F.concat(F.upper(base), F.lit("Id"))).otherwise("Title"), F.lit("int")),
        (field.when(F.col("p_type") == "PROMO", "Changed").otherwise("Notes"), F.when(size > 15, "datetime").otherwise("str")),
        (F.when(price > 980, "Status").when(price > 950, "is_deleted").otherwise("Memo"), F.lit("int")),
        (F.when(size == 1, "ID").when(size < 10, "updated").otherwise("Active"), F.lit("date")),
    ]
    rows = F.array(*[F.struct(F.lit(i + 1).alias("ordinal"), n.alias("name"), t.alias("type")) for i, (n, t) in enumerate(found)])
    return part.select(F.concat(base, F.lit("s")).alias("table_name"), F.inline(rows))


def infer_pk(spark, sf_dir):
    return catalog.classify(_all_columns(spark, sf_dir)).select("table_name", "pk")


def infer_mtime(spark, sf_dir):
    return catalog.classify(_all_columns(spark, sf_dir)).select("table_name", "mtime_col")


def infer_soft_delete(spark, sf_dir):
    return catalog.classify(_all_columns(spark, sf_dir)).select("table_name", "soft_delete_col")


def infer_catalog(spark, sf_dir):
    path = files.scratch(spark, "catalog")
    classified = catalog.classify(_all_columns(spark, sf_dir))
    report.write_catalog(classified, path)
    return spark.read.schema(classified.schema).json(path)


def catalog_summary(spark, sf_dir):
    _, errors = catalog.discover(spark, _sources(spark, sf_dir))
    return catalog.summary(catalog.classify(_all_columns(spark, sf_dir)), errors)


# streaming


def stream_upsert(spark, sf_dir):
    """Events arrive in three drops; the replica keeps the last event of every user."""
    events = table(spark, sf_dir, "events")
    root = files.scratch(spark, "stream")
    replica = Replica(spark, f"{root}/replica", "users")
    edges = ["1970-01-01 00:00:00", inputs.EVENTS_SYNCED, "2024-01-24 12:00:00", "2100-01-01 00:00:00"]
    for low, high in zip(edges, edges[1:]):
        drop = events.where((F.col("ts") > moment(low)) & (F.col("ts") <= moment(high)))
        drop.write.mode("append").parquet(f"{root}/drops")
        feed.follow(
            spark, f"{root}/drops", events.schema, replica, f"{root}/checkpoint", "ts", ["user_id"], ["event_id"], bucket_bytes=BUCKET_BYTES
        ).awaitTermination()
    return replica.read()


def stream_late(spark, sf_dir):
    """The drops arrive in the wrong order; the last event of every user by time stays."""
    events = table(spark, sf_dir, "events")
    root = files.scratch(spark, "stream")
    replica = Replica(spark, f"{root}/replica", "users")
    edges = ["2100-01-01 00:00:00", "2024-01-24 12:00:00", inputs.EVENTS_SYNCED, "1970-01-01 00:00:00"]
    for high, low in zip(edges, edges[1:]):
        drop = events.where((F.col("ts") > moment(low)) & (F.col("ts") <= moment(high)))
        drop.write.mode("append").parquet(f"{root}/drops")
        feed.follow(
            spark, f"{root}/drops", events.schema, replica, f"{root}/checkpoint", "ts", ["user_id"], ["event_id"],
            bucket_bytes=BUCKET_BYTES, latest=True,
        ).awaitTermination()
    return replica.read()


def stream_append(spark, sf_dir):
    """One pass over the source's own file: every row once."""
    lines = table(spark, sf_dir, "lineitem")
    root = files.scratch(spark, "stream")
    replica = Replica(spark, f"{root}/replica", "lineitem")
    for _ in range(2):
        feed.follow(
            spark, sf_dir, lines.schema, replica, f"{root}/checkpoint", "l_shipdate", pathGlobFilter="lineitem.parquet"
        ).awaitTermination()
    return replica.read()


def flagship(spark, sf_dir):
    """Incremental upsert of events, then a report on the published table."""
    return (
        incremental_run(spark, sf_dir)
        .groupBy("event_type")
        .agg(
            F.count("*").alias("events"),
            F.countDistinct("user_id").alias("users"),
            F.max("ts").alias("last_ts"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"),
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_full, scan_incremental_int, scan_incremental_ts, scan_page, scan_pages, scan_pages_text, list_tables, table_schema, column_profile, table_count,
        table_count_footers, size_probe, size_report, size_errors, size_top20, size_totals, envelope_scan, envelope_untyped, envelope_rejects,
        envelope_accepts, envelope_incremental, adhoc_sql, adhoc_bound, watermark_coerce, state_roundtrip, truncate_text, iso_temporal, interval_seconds,
        decimal_to_double, flatten_number, binary_to_text, strip_nul, normalize_row, normalize_nested, all_text, sanitize_names, valid_identifiers,
        name_collisions, target_rows, infer_types_wide, infer_types_merged, infer_types_json, infer_types_first, pk_check, target_ddl, watermark_max,
        watermark_max_footers, merge_append, merge_upsert, merge_upsert_lines, upsert_collated, dedupe_last, skip_tables, unknown_policy, plan_modes,
        resume_slice, full_refresh, full_refresh_stamped, full_refresh_unkeyed, incremental_run, incremental_append, incremental_slices,
        incremental_growth, incremental_replay, incremental_lookback, deletes_found, deletes_reconciled, state_table, state_import, import_then_run,
        orphan_versions, run_report, run_summary, infer_pk, infer_mtime, infer_soft_delete, infer_catalog, catalog_summary, stream_upsert, stream_late,
        stream_append, flagship,
    )
}
