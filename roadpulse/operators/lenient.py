"""User expressions that give NULL where they would fail, so that no value fails a batch.

Spark's own parser reads the expression. Casts, arithmetic and every function that has a ``try_`` form
are replaced by those forms, so NULL arises at the smallest part that fails and a ``coalesce`` around it
gives its fallback. What Spark inserts by itself (the cast of a text that is compared or added to a
number, an index beyond an array) is resolved with ANSI mode off, where it gives NULL.

Not covered: ``raise_error`` and ``assert_true``, which fail on purpose, and functions of the user.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.classic.column import Column as ClassicColumn

ANSI = "spark.sql.ansi.enabled"
# Spark's operators and the forms of them that give NULL on overflow and division by zero.
TRY_OPERATORS = {
    "Add": "try_add(a, b)",
    "Subtract": "try_subtract(a, b)",
    "Multiply": "try_multiply(a, b)",
    "Divide": "try_divide(a, b)",
    "Remainder": "try_mod(a, b)",
}


@contextmanager
def ansi_off(spark: SparkSession) -> Iterator[None]:
    """Expressions that are resolved inside keep to NULL on error, also when they run later."""
    before = spark.conf.get(ANSI)
    spark.conf.set(ANSI, "false")
    try:
        yield
    finally:
        spark.conf.set(ANSI, before)


class _Rewriter:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.parser = spark._jsparkSession.sessionState().sqlParser()
        self.known: dict[str, bool] = {}

    def has_function(self, name: str) -> bool:
        if name not in self.known:
            self.known[name] = self.spark.catalog.functionExists(name)
        return self.known[name]

    def form(self, node, parts: list):
        """The NULL-on-error call that stands for this node, before it gets its arguments."""
        kind = node.getClass().getSimpleName()
        if kind in TRY_OPERATORS:
            return self.parser.parseExpression(TRY_OPERATORS[kind])
        if kind == "Cast":
            return self.parser.parseExpression(f"try_cast(a AS {node.dataType().sql()})")
        if kind == "UnaryMinus":
            return self.parser.parseExpression("try_multiply(a, -1)")
        if kind == "UnresolvedFunction" and node.nameParts().size() == 1:
            name = node.nameParts().head().lower()
            if not name.startswith("try_") and self.has_function(f"try_{name}"):
                arguments = ", ".join("a" for _ in parts)
                return self.parser.parseExpression(f"try_{name}({arguments})")
        return None

    def rewritten(self, node):
        children = node.children()
        parts = [self.rewritten(children.apply(i)) for i in range(children.size())]
        form = self.form(node, parts)
        if form is None:
            return node.withNewChildren(self._list(parts)) if parts else node
        own = form.children()
        return form.withNewChildren(self._list(parts + [own.apply(i) for i in range(len(parts), own.size())]))

    def _list(self, parts: list):
        return self.spark._jvm.PythonUtils.toSeq(parts)


def lenient(spark: SparkSession, expression: str) -> Column:
    """The expression with its NULL-on-error forms; add it to a frame inside ``ansi_off``."""
    rewriter = _Rewriter(spark)
    node = rewriter.rewritten(rewriter.parser.parseExpression(expression))
    return ClassicColumn(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(node))


def with_lenient(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds a column for each expression; rows for which one fails hold NULL there."""
    if not columns:
        return frame
    spark = frame.sparkSession
    with ansi_off(spark):
        return frame.withColumns({name: lenient(spark, text) for name, text in columns.items()})
