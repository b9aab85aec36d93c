"""What a source holds: tables, columns, sizes, likely keys and modification columns."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.functions.names import quoted, text_literal
from tidemark.sources.tables import list_tables

Source = DataFrame | Callable[[], DataFrame]

# Name patterns from strong to weak. Case does not matter.
KEY_PATTERNS = (
    r"^id$",
    r"^(.+?)id$",
    r"^(.+?)_id$",
    r"^(.+?)code$",
    r"^(.+?)key$",
    r"^(.+?)no$",
    r"^pk_",
)
MTIME_PATTERNS = (
    r"^modified(date|on|at)?$",
    r"^last[_ ]?modified(date|on|at)?$",
    r"^updated(date|on|at)?$",
    r"^last[_ ]?updated(date|on|at)?$",
    r"^changed(date|on|at)?$",
    r"^edit(ed)?(date|on|at)?$",
    r"^stamp(date|on)?$",
    r"^mtime$",
)
SOFT_DELETE_PATTERNS = (
    r"^deleted$",
    r"^is[_ ]?deleted$",
    r"^active$",
    r"^is[_ ]?active$",
    r"^status$",
    r"^recordstatus$",
)

# columns of one table that are put together before its best candidates are compared
COLUMNS_AT_ONCE = 1024

COLUMNS_SCHEMA = "table_name STRING, ordinal INT, name STRING, type STRING, size INT, nullable BOOLEAN"
SIZES_SCHEMA = "table_name STRING, rows BIGINT, seconds DOUBLE, error STRING"


def columns(spark: SparkSession, tables: Mapping[str, Source]) -> DataFrame:
    """(table_name, ordinal, name, type, size, nullable) from the schemas alone; no table is read.

    `size` is the declared length of a text column: of a CHAR or VARCHAR of a catalog table,
    which Spark reads as STRING, too. `nullable` is what the schema says.
    """
    found, errors = discover(spark, tables)
    if failed := errors.collect():  # one row for each table that cannot be opened
        raise ValueError(f"{failed[0]['table_name']}: {failed[0]['error']}")
    return found


def discover(spark: SparkSession, tables: Mapping[str, Source], workers: int = 16) -> tuple[DataFrame, DataFrame]:
    """The columns of all tables whose schema can be had, and (table_name, error) of the others."""

    def schema(item: tuple[str, Source]) -> tuple[str, T.StructType | None, str | None]:
        name, source = item
        try:
            return name, (source() if callable(source) else source).schema, None
        except Exception as error:
            return name, None, str(error)

    with ThreadPoolExecutor(workers) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(schema), tables.items()))
    rows = [
        (t, i + 1, f.name, *_declared(f), f.nullable)
        for t, s, _ in results if s is not None for i, f in enumerate(s)
    ]
    errors = [(t, error) for t, s, error in results if s is None]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA), spark.createDataFrame(errors, "table_name STRING, error STRING")


def _declared(f: T.StructField) -> tuple[str, int | None]:
    """(type, length) as the table declares them."""
    # Fixed value: where Spark keeps the type of a CHAR or VARCHAR column of a catalog table
    kind = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", f.dataType.simpleString())
    sized = re.fullmatch(r"(?:var)?char\((\d+)\)", kind)
    return kind, int(sized[1]) if sized else None


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same with size (longest text) and nullable (a NULL occurs) as the rows show them.

    This reads every table whole. One aggregate per table, combined inside the tasks; written
    as SQL text because a catalog has thousands of columns.
    """
    parts = []
    for t, df in tables.items():
        measures, rows = [], []
        for i, f in enumerate(df.schema):
            c = quoted(f.name)
            longest = f"max(length({c}))" if isinstance(f.dataType, T.StringType) else "cast(NULL AS INT)"
            measures += [f"{longest} AS s{i}", f"count({c}) < count(*) AS n{i}"]
            rows.append(
                f"struct({text_literal(t)} AS table_name, {i + 1} AS ordinal, {text_literal(f.name)} AS name, "
                f"{text_literal(f.dataType.simpleString())} AS type, s{i} AS size, n{i} AS nullable)"
            )
        parts.append(df.selectExpr(*measures).selectExpr(f"inline(array({', '.join(rows)}))"))
    return _union(parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of any tables in one job; a count reads no columns."""
    return _union([df.agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), "rows") for t, df in tables.items()])


def parquet_row_counts(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, rows, error) of all parquet tables below a folder, in a single scan.

    Reading no column at all, Spark takes the counts from the file footers, and hundreds
    of small tables share one stage instead of taking one each. Broken files are passed
    over in that scan; a table of which it has not seen every file is counted by a job of
    its own, which gives its rows or its error.
    """
    tables = list_tables(spark, root)
    if not tables:
        return spark.createDataFrame([], "table_name STRING, rows BIGINT, error STRING")
    # entry of the folder a file lies in; paths come encoded, with a plus sign as itself
    below = r"^(?:[\w+.-]+:(?://[^/]*)?)?" + re.escape(files.bare(spark, root)) + "/([^/]+)"

    def entry(path: Column) -> Column:
        return F.regexp_extract(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), below, 1).alias("entry")

    paths = list(tables.values())
    found = spark.read.schema(T.StructType([])).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").parquet(*paths)
    counted = found.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    counted = counted.groupBy(entry(F.col("file"))).agg(F.sum("n").alias("n"), F.count("*").alias("seen"))
    # the same files as a listing: their contents are no column that is asked for
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("_metadata.file_path")
    listed = listing.groupBy(entry(F.col("file_path"))).agg(F.count("*").alias("listed"))
    whole = counted.join(listed, "entry").where("seen = listed").select("entry", "n").collect()  # one row for each table
    entries = {p.rpartition("/")[2]: t for t, p in tables.items()}
    rows = {entries[r["entry"]]: r["n"] for r in whole}
    again = probe_sizes(spark, {t: (lambda p=p: spark.read.parquet(p)) for t, p in tables.items() if t not in rows})
    counts = spark.createDataFrame([(t, n, None) for t, n in rows.items()], "table_name STRING, rows BIGINT, error STRING")
    return counts.unionByName(again.select("table_name", "rows", "error"))


def probe_sizes(spark: SparkSession, tables: Mapping[str, Source], workers: int = 16) -> DataFrame:
    """(table_name, rows, seconds, error), each table counted by its own job.

    A table that cannot be read keeps its error and the others their counts.
    """

    def count(source: Source) -> tuple[int | None, float, str | None]:
        start = time.perf_counter()
        try:
            df = source() if callable(source) else source
            return df.count(), time.perf_counter() - start, None
        except Exception as error:
            return None, time.perf_counter() - start, str(error)

    if not tables:
        return spark.createDataFrame([], SIZES_SCHEMA)
    with ThreadPoolExecutor(workers) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(count), tables.values()))
    return spark.createDataFrame([(t, *r) for t, r in zip(tables, results)], SIZES_SCHEMA)


def ranked_sizes(sizes: DataFrame, top: int | None = None) -> DataFrame:
    """Largest table first, failed ones last."""
    order = sizes.orderBy(F.desc_nulls_last("rows"), "table_name")
    return order.limit(top) if top else order


def size_totals(sizes: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("error").isNotNull()) if "error" in sizes.columns else F.lit(0).cast("bigint")
    return sizes.agg(F.count("*").alias("tables"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), failed.alias("failed"))


def _first_pattern(name: Column, patterns: tuple[str, ...]) -> Column:
    """Number of the first pattern a name matches, or NULL."""
    rank = F
    for i, p in enumerate(patterns):
        rank = rank.when(name.rlike("(?i)" + p), i)
    return rank


def classify(found: DataFrame) -> DataFrame:
    """One row per table: likely key, modification column, soft-delete column, strategy.

    Patterns become one CASE per column name, so there is no join; per table the best
    candidate is a minimum, which combines inside the tasks however wide a table is.
    Spark sorts for a minimum of texts, so columns are dealt out first: what a task sorts
    does not follow the size of the file or partition they come from.
    """
    name = F.col("name")
    key_rank = _first_pattern(name, KEY_PATTERNS)
    stem = F.lit("")
    for i, p in reversed(list(enumerate(KEY_PATTERNS))):
        if re.compile(p).groups:
            stem = F.when(key_rank == i, F.regexp_extract(name, "(?i)" + p, 1)).otherwise(stem)
    root = F.regexp_replace("table_name", r"s\z", "")
    # a column named after its table beats the columns in front of it
    miss = F.when((stem != "") & (F.lower(stem) == F.lower(root)), 0).otherwise(1)

    def best(rank: Column, *more: tuple[str, Column]) -> Column:
        parts = [rank.alias("rank"), *[c.alias(n) for n, c in more], F.col("ordinal"), name.alias("name"), F.lower("type").alias("type")]
        return F.min(F.when(rank.isNotNull(), F.struct(*parts)))

    dealt = found.repartition("table_name", F.floor(F.col("ordinal") / COLUMNS_AT_ONCE))
    picked = dealt.groupBy("table_name").agg(
        best(key_rank, ("miss", miss)).alias("key"),
        best(_first_pattern(name, MTIME_PATTERNS)).alias("mtime"),
        best(_first_pattern(name, SOFT_DELETE_PATTERNS)).alias("soft"),
        F.count("*").alias("column_count"),
    )
    # the type is looked at after picking: a poor first match has no second
    temporal = F.col("mtime.type").rlike("date|time")
    return picked.select(
        "table_name",
        F.col("key.name").alias("pk"),
        F.when(temporal, F.col("mtime.name")).alias("mtime_col"),
        F.col("soft.name").alias("soft_delete_col"),
        "column_count",
    ).withColumn("sync_strategy", F.when(F.col("mtime_col").isNotNull(), "incremental").otherwise("full_refresh"))


def summary(classified: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Counts over a classified catalog; `errors` are the tables that discover() could not open."""
    failed = 0 if errors is None else errors.count()
    return classified.agg(
        F.count("*").alias("tables"),
        F.count("pk").alias("with_pk"),
        F.count("mtime_col").alias("with_mtime"),
        F.count("soft_delete_col").alias("with_soft_delete"),
        F.lit(failed).cast("bigint").alias("errors"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    """All parts in one plan, joined pairwise: hundreds of tables stay quick to analyse."""
    while len(parts) > 1:
        parts = [a.unionByName(b[0]) if b else a for a, b in ((parts[i], parts[i + 1 : i + 2]) for i in range(0, len(parts), 2))]
    return parts[0]
