"""Trees inside columns, walked level by level: depth is in the data, not in the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Levels that the first pass goes down, and each further one; its plan has so many steps, whatever the depth of the trees.
LEVELS, DEEPER = 12, 48


def walk(roots: DataFrame, keys: list[str], kids: str, levels: int = LEVELS, deeper: int = DEEPER) -> DataFrame:
    """All nodes below ``roots``, these included, as keys, at, v.

    ``roots`` has keys, at (where a node stands) and v (the node); ``kids`` is an SQL expression over at and v that gives
    the children of a node as an array of structs of at and v, or null. The first pass goes down ``levels`` levels, each further one ``deeper`` from the
    nodes that are still open and writes what it finds to the shared folder; the walk ends with the pass that leaves no
    node open. Rows of shallow trees take part in the first pass alone.
    """
    spark = roots.sparkSession
    path = scratch_path(spark, "walk")
    fields = f"struct({{}} AS at, {{}} AS v, {{}} AS open)"
    down = f"transform(CASE WHEN open THEN {kids} END, x -> {fields.format('x.at', 'x.v', 'true')})"
    open_nodes = roots.select(*keys, "at", "v", F.lit(True).alias("open"))
    schema = open_nodes.schema
    n = 0
    while True:
        rows = open_nodes
        for _ in range(deeper if n else levels):
            step = F.explode(F.expr(f"concat(array({fields.format('at', 'v', 'false')}), coalesce({down}, array()))"))
            rows = rows.select(*keys, step.alias("_x")).select(*keys, "_x.*")
        rows.write.parquet(f"{path}/pass={n}")
        written = spark.read.schema(schema).parquet(f"{path}/pass={n}")
        if written.where("open").isEmpty():
            break
        open_nodes = written.where("open")
        n += 1
    return spark.read.schema(schema).option("basePath", path).parquet(path).where("NOT open").select(*keys, "at", "v")


def gather(root: str, kids: str, where: str, take: str, fields: str, levels: str) -> Column:
    """What ``take`` gives of each node of a row's tree for which ``where`` holds, as an array of structs of ``fields``.

    All arguments are SQL. ``root`` is a struct of at and v, ``kids`` an array of such structs or null; it, ``where`` and
    ``take`` read a node as x.at and x.v. The row's tree is walked inside the row, and only one level of it and what was
    taken are held. ``levels`` is how many levels to visit, the root's included, in this row; more than there are do no harm.
    """
    found = f"concat(s.found, transform(filter(s.open, x -> {where}), x -> {take}))"
    step = f"(s, i) -> struct(flatten(transform(s.open, x -> coalesce({kids}, array()))) AS open, {found} AS found)"
    start = f"struct(array({root}) AS open, cast(array() AS array<struct<{fields}>>) AS found)"
    return F.expr(f"aggregate(sequence(1, greatest(1, {levels})), {start}, {step}, s -> s.found)")
