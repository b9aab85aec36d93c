"""Column and table names: sanitising, validation, collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters each target keeps, and the shape of a valid identifier.
KEPT = {
    "mysql": r"[^a-zA-Z0-9_]",
    "postgres": r"[^a-zA-Z0-9_]",
    "sqlite": r"[^\p{L}\p{N}_]",
}
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_\-$#]*\z"
EMPTY_NAME = "_col"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and hyphens included."""
    return F.col(quoted(name))


def sanitize(name: Column, target: str = "mysql") -> Column:
    """The name as the target stores it; a leading digit gets an underscore."""
    if target == "postgres":
        name = F.lower(name)
    safe = F.regexp_replace(name, KEPT[target], "_")
    return (
        F.when(safe == "", EMPTY_NAME)
        .when(safe.rlike(r"^\p{Nd}"), F.concat(F.lit("_"), safe))
        .otherwise(safe)
    )


def is_identifier(name: Column) -> Column:
    return name.rlike(IDENTIFIER)


def collisions(names: DataFrame, name: str, target: str = "mysql", scope: tuple[str, ...] = ()) -> DataFrame:
    """Sanitised names that more than one different name maps to, within each scope.

    Names are made distinct before they are sanitised: repeats never leave their task.
    """
    distinct = names.select(*[column(s) for s in scope], column(name).alias("name")).distinct()
    return (
        distinct.groupBy(*scope, sanitize(F.col("name"), target).alias("safe_name"))
        .agg(F.count("*").alias("names"), F.min("name").alias("first_name"), F.max("name").alias("last_name"))
        .where("names > 1")
    )


def safe_names(df: DataFrame, target: str = "mysql") -> list[str]:
    """Sanitised names of a DataFrame's columns; a collision is an error."""
    one = df.sparkSession.range(1)
    safe = list(one.select(*[sanitize(F.lit(c), target).alias(f"n{i}") for i, c in enumerate(df.columns)]).first())
    clash = sorted({s for s in safe if safe.count(s) > 1})
    if clash:
        raise ValueError(f"column names collide after sanitising: {clash}")
    return safe


def with_safe_names(df: DataFrame, target: str = "mysql") -> DataFrame:
    return df.toDF(*safe_names(df, target))


def require_identifier(name: str) -> str:
    """The name itself, or an error if a source would not accept it."""
    import re

    if not re.match(IDENTIFIER.replace(r"\z", r"\Z"), name):
        raise ValueError(f"not a valid table or column name: {name!r}")
    return name
