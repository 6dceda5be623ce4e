"""Queues of captured scheduler responses, at any depth.

A scheduler response holds a tree: a queue has ``queues.queue``, a list of queues
of the same form. No fixed schema holds a tree of unknown depth, so a response is
parsed once to a VARIANT and the tree is walked level by level: each level's rows
give their own fields and explode their children, until a level has no rows. A
JSON value is finite, so the walk ends; a level is written before the next reads
it, so no level is parsed twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.session import materialize

# Where a scheduler response keeps its root queue and its children.
ROOT = "$.scheduler.schedulerInfo"
CHILDREN = "$.queues.queue"

#: Fields of a queue: column, place in the queue's object, type.
FIELDS = (("queue", "$.queueName", "string"), ("state", "$.state", "string"), ("capacity", "$.capacity", "double"),
          ("used_capacity", "$.usedCapacity", "double"), ("max_capacity", "$.maxCapacity", "double"),
          ("n_apps", "$.numApplications", "bigint"))


def _children(queue: Column) -> Column:
    """The list of child queues; one child may stand without a list."""
    many = F.try_variant_get(queue, CHILDREN, "array<variant>")
    one = F.try_variant_get(queue, CHILDREN, "variant")
    return F.when(many.isNotNull(), many).when(F.schema_of_variant(one).startswith("OBJECT"), F.array(one))


def queue_tree(responses: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and ``path, depth, queue, state, capacity,
    used_capacity, max_capacity, n_apps`` of every queue of every response. The
    root has depth 0; ``path`` joins the names from the root by ``.``, and a queue
    without a name counts as ``''`` there.

    A body that is not JSON, or has no scheduler, gives no rows; a field that is
    missing or of another type is null; an empty or null list of children ends
    its branch; items of the list that are no objects are left out.
    """
    root = F.try_variant_get(F.try_parse_json(F.col(body)), ROOT, "variant")
    level = responses.select(*keep, F.lit("").alias("above"), root.alias("q")).filter(F.col("q").isNotNull())
    levels, depth = [], 0
    while True:
        named = level.filter(F.schema_of_variant("q").startswith("OBJECT")).select(
            *keep, F.concat("above", F.coalesce(F.try_variant_get("q", "$.queueName", "string"), F.lit(""))).alias("path"),
            "q")
        here = materialize(responses.sparkSession, named.select(
            *keep, "path", F.lit(depth).alias("depth"),
            *(F.try_variant_get("q", place, kind).alias(c) for c, place, kind in FIELDS),
            _children(F.col("q")).alias("_children")))
        levels.append(here.drop("_children"))
        level = here.filter(F.size("_children") > 0).select(
            *keep, F.concat("path", F.lit(".")).alias("above"), F.explode("_children").alias("q"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        depth += 1
