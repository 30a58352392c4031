"""Metrics of a plan that has run."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _nodes(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(node.executedPlan())
        return
    yield name, node
    if name.endswith("QueryStageExec"):
        yield from _nodes(node.plan())
        return
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def exchanges(df: DataFrame) -> list[tuple[str, int]]:
    """(description, rows written) of each shuffle of ``df``, which is run for it."""
    df.collect()
    out = []
    for name, node in _nodes(df._jdf.queryExecution().executedPlan()):
        if name == "ShuffleExchangeExec":
            out.append((node.simpleString(200), int(node.metrics().apply("shuffleRecordsWritten").value())))
    return out
