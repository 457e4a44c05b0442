"""What other programs read of a run's work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.operators import graph
from lodestone.plans.run import Run


def load_graph(spark: SparkSession, workdir: str) -> dict[str, DataFrame]:
    """nodes (with levels found anew), edges, and flags, of which those of levels are found anew."""
    run = Run(spark, {"workdir": workdir})
    nodes, edges, flags = run.nodes(), run.read("edges", "build"), run.read("flags", "build")
    leveled = graph.levels(nodes, edges)
    nodes = nodes.drop("level").join(leveled, "id", "left")
    soft = graph.soft_violations(leveled, edges)
    return {"nodes": nodes, "edges": edges, "flags": flags.where("kind <> 'level_soft_violation'").unionByName(soft, allowMissingColumns=True)}


def load_sample_bundles(spark: SparkSession, workdir: str) -> DataFrame:
    return Run(spark, {"workdir": workdir}).read("bundles", "sample")


def load_materials(spark: SparkSession, workdir: str) -> DataFrame:
    return Run(spark, {"workdir": workdir}).read("materials", "retrieve")
