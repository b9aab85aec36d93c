"""Read-only SQL over the session's tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.wire import to_wire

# What a query may consist of, by the names Spark's analysed plans use. A node
# that is not named is refused, whatever it does.
NODES = frozenset(
    (
        "Project", "Filter", "Aggregate", "Join", "LateralJoin", "AsOfJoin", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Tail", "Distinct",
        "Deduplicate", "Union", "Intersect", "Except", "SubqueryAlias", "View", "LogicalRelation", "LogicalRDD", "DataSourceV2Relation",
        "DataSourceV2ScanRelation", "HiveTableRelation", "InMemoryRelation", "LocalRelation", "OneRowRelation", "Range", "Window", "Generate",
        "Expand", "Sample", "WithCTE", "CTERelationDef", "CTERelationRef", "UnionLoop", "UnionLoopRef", "Repartition", "RepartitionByExpression",
        "RebalancePartitions", "ResolvedHint", "PipeOperator", "SingleStatement",
    )
)
# Expressions that call a method by its name, or code that is not Spark's own.
REFLECTION = frozenset(("CallMethodViaReflection", "TryReflect"))
FOREIGN = frozenset(
    (
        "PythonUDF", "PythonUDAF", "PythonUDTF", "PythonFuncExpression", "ScalaUDF", "ScalaUDAF", "ScalaAggregator", "HiveSimpleUDF", "HiveGenericUDF",
        "HiveUDAFFunction", "HiveGenericUDTF", "ApplyFunctionExpression", "V2Aggregator",
    )
)


class NotReadOnly(ValueError):
    """The text is no single query, or one that runs other programs."""


def read_only(
    spark: SparkSession, text: str, wire: bool = False, limit: int | None = None, args: Mapping[str, object] | Sequence[object] | None = None,
    functions: bool = False,
) -> DataFrame:
    """Run one query. Whatever cannot stand as a subquery (INSERT, DROP, SET, two statements)
    is refused before it runs.

    The analysed plan of the very DataFrame that is returned is then walked, views and
    subqueries included: nodes that are not known to read, methods called by reflection and, but with
    `functions`, registered functions are refused. Literals are values there, so words inside them do not matter.

    `args` are bound to the text's parameters (`:name`, or `?` in order) as values, and
    `IDENTIFIER(:name)` takes one as the name of a table or column.
    """
    text = text.strip()
    try:
        spark.sql(f"SELECT * FROM (\n{text}\n) AS q", args=args)
    except ParseException as error:
        raise NotReadOnly(f"not a read-only query: {error}") from error
    except AnalysisException as error:
        # columns may repeat in a result but not in a subquery; the text still parsed as a query
        if "AMBIGUOUS" not in str(error.getCondition()) and "COLUMN_ALREADY_EXISTS" not in str(error.getCondition()):
            raise
    result = spark.sql(text, args=args)
    refused = REFLECTION if functions else REFLECTION | FOREIGN
    for kind, name in _parts(result._jdf.queryExecution().analyzed()):
        if (kind == "node" and name not in NODES) or (kind == "expression" and name in refused):
            raise NotReadOnly(f"a query must not use {name}")
    return to_wire(result, limit) if wire else result


def _parts(plan) -> Iterator[tuple[str, str]]:
    """("node" or "expression", name) of everything in a plan, subqueries included."""
    todo = [plan]
    while todo:
        node = todo.pop()
        yield "node", _name(node)
        inside = _each(node.expressions())
        while inside:
            expression = inside.pop()
            yield "expression", _name(expression)
            inside += _each(expression.children())
        todo += [*_each(node.children()), *_each(node.subqueries())]


def _name(part) -> str:
    return part.getClass().getSimpleName().rstrip("$")


def _each(parts) -> list:
    return [parts.apply(i) for i in range(parts.length())]
