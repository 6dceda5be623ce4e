"""Container and application ids as column expressions.

A container id is ``container_[e<epoch>_]<cluster ts>_<app seq>_<attempt>_<n>``.
The optional epoch part is skipped (the reference's plain split gets a wrong
key for such ids). One ``rlike`` checks the form; the parts are then cut
from the end with ``substring_index``, which is the same for both forms.
Ids that do not have the form give nulls. All JVM-side expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTAINER_ID_PATTERN = r"^container_(?:e\d+_)?\d+_\d+_\d+_\d+$"


def is_container_id(container_id: Column) -> Column:
    return container_id.rlike(CONTAINER_ID_PATTERN)


def _from_end(container_id: Column, k: int, n: int = 1) -> Column:
    """``n`` parts starting at the ``k``-th ``_``-part from the end."""
    tail = F.substring_index(container_id, "_", -k)
    return F.when(is_container_id(container_id),
                  tail if n >= k else F.substring_index(tail, "_", n))


def cluster_ts(container_id: Column) -> Column:
    return _from_end(container_id, 4)


def app_seq(container_id: Column) -> Column:
    return _from_end(container_id, 3)


def app_key(container_id: Column) -> Column:
    """``<cluster ts>_<app seq>``: the key the reference compares."""
    return _from_end(container_id, 4, 2)


def application_id(container_id: Column) -> Column:
    """``application_<cluster ts>_<app seq>``."""
    return F.concat(F.lit("application_"), app_key(container_id))


def app_number(container_id: Column) -> Column:
    """The application sequence number as a long."""
    return app_seq(container_id).try_cast("bigint")


def attempt(container_id: Column) -> Column:
    return _from_end(container_id, 2).try_cast("int")


def container_seq(container_id: Column) -> Column:
    return _from_end(container_id, 1).try_cast("bigint")
