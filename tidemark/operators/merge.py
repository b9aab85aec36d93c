"""Applying a delta to a table: append, upsert, last write per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import column

# Type changes a replica accepts, from narrow to wide.
WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


def require_columns(df: DataFrame, names: Sequence[str], role: str = "key") -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{role} columns {missing} are not among {df.columns}")


def key_columns(keys: Sequence[str], schema: T.StructType, fold_case: bool = False, collation: str | None = None) -> list[Column]:
    """Key expressions. Whole numbers compare (and hash) as bigint, so a column may widen;
    `fold_case` makes text keys that differ only in case equal, and `collation` those that are
    equal by it: `UNICODE_CI_AI_RTRIM` takes no notice of case, accents and trailing spaces.

    Spark groups, sorts and joins a collated value by its collation, and the text itself stays as it came.
    """
    result = []
    for k in keys:
        dtype = schema[k].dataType
        if isinstance(dtype, T.IntegralType):
            result.append(column(k).cast("bigint"))
        elif collation is not None and isinstance(dtype, T.StringType):
            result.append(F.collate(column(k), collation))
        elif fold_case and isinstance(dtype, T.StringType):
            result.append(F.lower(column(k)))
        else:
            result.append(column(k))
    return result


def require_collated_hash(spark: SparkSession, collation: str | None) -> None:
    """xxhash64() of equal keys is equal only if it takes the collation into account; by default it does not."""
    name = "spark.sql.legacy.collationAwareHashFunctions"
    if collation is not None and spark.conf.get(name, "false") != "true":
        raise ValueError(f"keys collated by {collation} are hashed: set {name} to true")


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold_case: bool = False, collation: str | None = None) -> DataFrame:
    """The last row of every key by the order columns; NULLs come first.

    Spark runs a row_number() = 1 filter inside every task before the shuffle, so a key
    holding a third of all rows sends one row per task. Rows equal in the whole order
    are told apart by a hash of the row, the same one on every attempt.
    """
    require_columns(df, [*keys, *order])
    hashed = [c for f in df.schema if (c := _hashable(f)) is not None]
    latest = W.partitionBy(*key_columns(keys, df.schema, fold_case, collation)).orderBy(
        *[column(o).desc_nulls_last() for o in order], F.xxhash64(*hashed).desc()
    )
    return df.withColumn("_last", F.row_number().over(latest)).where("_last = 1").drop("_last")


def _hashable(field: T.StructField) -> Column | None:
    """A column, or its JSON where a map lies inside it; the order of a map's keys then counts."""
    if isinstance(field.dataType, T.VariantType) or _holds_type(field.dataType, T.VariantType):
        return None
    if isinstance(field.dataType, T.MapType):
        return F.to_json(F.struct(column(field.name)))
    return F.to_json(F.struct(column(field.name))) if _holds_type(field.dataType, T.MapType) else column(field.name)


def _holds_type(dtype: T.DataType, wanted: type) -> bool:
    inner = []
    if isinstance(dtype, T.StructType):
        inner = [f.dataType for f in dtype]
    elif isinstance(dtype, T.ArrayType):
        inner = [dtype.elementType]
    elif isinstance(dtype, T.MapType):
        inner = [dtype.keyType, dtype.valueType]
    return any(isinstance(t, wanted) or _holds_type(t, wanted) for t in inner)


def widen(live: T.StructType, delta: T.StructType) -> T.StructType:
    """Columns of both, live ones first; a type may only grow."""
    result = []
    names = {f.name: f.dataType for f in delta}
    for f in live:
        other, dtype = names.get(f.name, f.dataType), f.dataType
        if other != dtype:
            if _holds(other, dtype):
                dtype = other
            elif not _holds(dtype, other):
                raise ValueError(f"column {f.name}: {dtype.simpleString()} cannot take {other.simpleString()}")
        result.append(T.StructField(f.name, dtype, True))
    known = set(live.names)
    return T.StructType(result + [T.StructField(f.name, f.dataType, True) for f in delta if f.name not in known])


def _holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Every value of the narrow type is one of the wide type."""
    if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    return wide.simpleString() in WIDER.get(narrow.simpleString(), ())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema in its order, absent ones NULL."""
    have = set(df.columns)
    return df.select(
        *[(column(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def append(live: DataFrame, delta: DataFrame) -> DataFrame:
    """Plain append: a delta applied twice is there twice."""
    schema = widen(live.schema, delta.schema)
    return conform(live, schema).unionByName(conform(delta, schema))


def upsert(
    live: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str], fold_case: bool = False, collation: str | None = None
) -> DataFrame:
    """Live rows without a newer version, plus the last version of every delta key. A row of
    the delta without a key cannot be matched and fails the query."""
    require_columns(live, keys)
    require_columns(delta, [*keys, *order])
    how = (fold_case, collation)
    lost_key = F.raise_error(F.lit(f"a row without a key in {list(keys)}"))
    delta = delta.where(F.when(no_key(keys), lost_key.cast("boolean")).otherwise(True))
    schema = widen(live.schema, delta.schema)
    fresh = conform(dedupe_last(delta, keys, order, *how), schema)
    if lost := [c for c in live.columns if c not in delta.columns]:
        # the delta knows nothing of these columns: they keep their live values
        kept = live.select(*_aliased(keys, live.schema, *how), *map(column, lost))
        fresh = conform(fresh.drop(*lost).join(kept, _same_key(fresh, kept, keys, *how), "left"), schema)
    return without(conform(live, schema), delta, keys, *how).unionByName(fresh)


def without(live: DataFrame, delta: DataFrame, keys: Sequence[str], fold_case: bool = False, collation: str | None = None) -> DataFrame:
    """Live rows whose key is not in the delta.

    The join takes the distinct delta keys only, so no key is hot in it; Spark broadcasts
    them when their measured size allows and then leaves `live` unshuffled.
    """
    changed = delta.select(*_aliased(keys, delta.schema, fold_case, collation)).distinct()
    return live.join(changed, _same_key(live, changed, keys, fold_case, collation), "left_anti")


def _aliased(keys: Sequence[str], schema: T.StructType, fold_case: bool, collation: str | None) -> list[Column]:
    return [k.alias(f"_k{i}") for i, k in enumerate(key_columns(keys, schema, fold_case, collation))]


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], fold_case: bool, collation: str | None) -> Column:
    match = F.lit(True)
    for i, k in enumerate(key_columns(keys, left.schema, fold_case, collation)):
        match = match & (k == right[f"_k{i}"])
    return match


def null_keys(df: DataFrame, keys: Sequence[str]) -> Column:
    """Counts rows that cannot be matched on their key."""
    return F.count_if(no_key(keys))


def no_key(keys: Sequence[str]) -> Column:
    """Whether a row cannot be matched on its key."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | column(k).isNull()
    return missing
