"""Connected components on tables saved with an operator's other steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lamina.llm import _common as C
from lamina.operators import graph


def components(edges: DataFrame, scratch: C.Scratch, name: str = "cc") -> DataFrame:
    """node, label: the smallest node that each node of an edge (a, b) reaches, itself included."""
    return graph.components(edges, scratch.path(name)).withColumnRenamed("component", "label")
