"""Typed commands: SQL text that reads or changes a catalogue snapshot.

The text goes through Spark's own parser, so its grammar is Spark SQL's. What
the parsed plan says (target, assignments, condition, source rows) is handed to
the frame operators of `operators.snapshot`; nothing is executed by the parser.
The parser is reached through the session's JVM, so this module needs a session
with a driver of its own and not a remote one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql.classic.dataframe import DataFrame as ClassicDataFrame

from shelfmark.operators import snapshot as frames
from shelfmark.session import materialize

_PLANS = "org.apache.spark.sql.catalyst.plans.logical."


@dataclass(frozen=True)
class Outcome:
    """What a command did: its kind, the rows it returns (a query's), and the snapshot after it."""

    kind: str
    rows: DataFrame | None
    snapshot: DataFrame


def _plan(spark: SparkSession, text: str) -> JavaObject:
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(text)


def _is(spark: SparkSession, plan: JavaObject, name: str) -> bool:
    return is_instance_of(spark.sparkContext._gateway, plan, _PLANS + name)


def kind_of(spark: SparkSession, text: str) -> str:
    """query, insert, update, delete or other; a text that does not parse raises ParseException."""
    plan = _plan(spark, text)
    known = {"InsertIntoStatement": "insert", "UpdateTable": "update", "DeleteFromTable": "delete"}
    kind = known.get(plan.getClass().getSimpleName())
    if kind:
        return kind
    return "other" if _is(spark, plan, "Command") or _is(spark, plan, "ParsedStatement") else "query"


def _target(plan: JavaObject, text: str) -> str:
    """The name by which a command's expressions may call the catalogue."""
    alias = None
    if plan.getClass().getSimpleName() == "SubqueryAlias":
        alias, plan = plan.alias(), plan.child()
    if plan.getClass().getSimpleName() != "UnresolvedRelation" or plan.multipartIdentifier().mkString(".").lower() != frames.VIEW:
        raise ValueError(f"only {frames.VIEW} can be changed: {text}")
    return alias or frames.VIEW


def _column(spark: SparkSession, expression: JavaObject) -> Column:
    return ClassicColumn(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))


def _listed(sequence: JavaObject) -> Iterator[JavaObject]:
    return (sequence.apply(i) for i in range(sequence.size()))


@contextmanager
def _visible(snapshot: DataFrame):
    """The snapshot under its name while a command is analysed, for subqueries and sources."""
    with frames._view:
        snapshot.createOrReplaceTempView(frames.VIEW)
        try:
            yield
        finally:
            snapshot.sparkSession.catalog.dropTempView(frames.VIEW)


def _name_in(snapshot: DataFrame, name: str) -> str:
    """The snapshot's spelling of a column name; names ignore case, as everywhere in SQL."""
    found = [c for c in snapshot.columns if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no such catalogue column: {name}")
    return found[0]


def _insert(snapshot: DataFrame, plan: JavaObject, text: str) -> DataFrame:
    spark = snapshot.sparkSession
    if plan.overwrite() or not plan.partitionSpec().isEmpty():
        raise ValueError(f"only plain inserts are commands: {text}")
    _target(plan.table(), text)
    rows = ClassicDataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan.query()), spark)
    if plan.byName():
        names = [_name_in(snapshot, c) for c in rows.columns]
    else:
        given = [_name_in(snapshot, c) for c in _listed(plan.userSpecifiedCols())]
        names = given or snapshot.columns
    if len(set(names)) < len(names):
        raise ValueError(f"a column is named twice: {text}")
    if len(names) != len(rows.columns):
        raise ValueError(f"{len(rows.columns)} values for {len(names)} columns: {text}")
    return frames.insert(snapshot, rows.toDF(*names))


def _update(snapshot: DataFrame, plan: JavaObject, text: str) -> DataFrame:
    spark, name = snapshot.sparkSession, _target(plan.table(), text)
    values: dict[str, Column] = {}
    for assignment in _listed(plan.assignments()):
        parts = list(_listed(assignment.key().nameParts()))
        if len(parts) > 2 or len(parts) == 2 and parts[0].lower() != name.lower():
            raise ValueError(f"no such catalogue column: {'.'.join(parts)}")
        column = _name_in(snapshot, parts[-1])
        if column in values:
            raise ValueError(f"a column is set twice: {column}")
        values[column] = _column(spark, assignment.value())
    where = _column(spark, plan.condition().get()) if plan.condition().isDefined() else F.lit(True)
    return frames.update(snapshot.alias(name), values, where).select(*snapshot.columns)


def _delete(snapshot: DataFrame, plan: JavaObject, text: str) -> DataFrame:
    name = _target(plan.table(), text)
    return frames.delete(snapshot.alias(name), _column(snapshot.sparkSession, plan.condition())).select(*snapshot.columns)


def execute(snapshot: DataFrame, text: str) -> Outcome:
    """Apply one command; every value of an update is computed from the old row.

    A text that does not parse, names an unknown column or table, or is no
    query, insert, update or delete raises, and there is no next snapshot.
    Subqueries see the snapshot as it was before the command. All is lazy: what
    only data can spoil raises when the result is first used.
    """
    spark = snapshot.sparkSession
    kind = kind_of(spark, text)
    if kind == "other":
        raise ValueError(f"not a query, insert, update or delete: {text}")
    if kind == "query":
        return Outcome(kind, frames.query(snapshot, text), snapshot)
    apply = {"insert": _insert, "update": _update, "delete": _delete}[kind]
    plan = _plan(spark, text)
    with _visible(snapshot):
        changed = apply(snapshot, plan, text)
        changed.schema  # analysed while the name can be seen
    return Outcome(kind, None, changed)


class Prompt:
    """A catalogue under a row of commands; `current` is the snapshot after the last one that succeeded.

    Each change is written once to the shared folder before it becomes current:
    a command that fails on the data leaves the snapshot as it was, the plan
    does not grow with the number of commands, and lost executors recompute
    nothing older than the last command. `publish` is called with the snapshot
    before and after a change, and only after it succeeded.
    """

    def __init__(self, snapshot: DataFrame, publish: Callable[[DataFrame, DataFrame], None] | None = None):
        self.current = snapshot
        self.publish = publish

    def run(self, text: str) -> Outcome:
        outcome = execute(self.current, text)
        if outcome.kind == "query":
            return outcome
        before, after = self.current, materialize(outcome.snapshot, "snapshot")
        if self.publish:
            self.publish(before, after)
        self.current = after
        return replace(outcome, snapshot=after)

    def run_all(self, texts: Iterable[str]) -> DataFrame:
        """The snapshot after all commands; the first that fails ends the row, and those before it stay done."""
        for text in texts:
            self.run(text)
        return self.current
