"""Declared schemas of captured resource-manager REST records.

Field names follow the resource manager's public REST API. Reading with a
declared schema (no inference) keeps parsing to one narrow pass; unknown
fields are ignored and missing ones are null.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


APPLICATION = _struct(
    ("id", S), ("user", S), ("name", S), ("queue", S), ("state", S), ("finalStatus", S),
    ("progress", D), ("trackingUI", S), ("trackingUrl", S), ("diagnostics", S),
    ("clusterId", L), ("applicationType", S), ("applicationTags", S),
    ("startedTime", L), ("finishedTime", L), ("elapsedTime", L),
    ("amContainerLogs", S), ("amHostHttpAddress", S),
    ("allocatedMB", I), ("allocatedVCores", I), ("runningContainers", I),
    ("memorySeconds", L), ("vcoreSeconds", L),
    ("preemptedResourceMB", L), ("preemptedResourceVCores", L),
    ("numNonAMContainerPreempted", I), ("numAMContainerPreempted", I))

APP_ATTEMPT = _struct(
    ("id", I), ("startTime", L), ("finishedTime", L), ("containerId", S),
    ("nodeHttpAddress", S), ("nodeId", S), ("logsLink", S), ("appAttemptId", S))

CONTAINER = _struct(
    ("id", S), ("nodeId", S), ("state", S), ("exitCode", I), ("diagnostics", S),
    ("user", S), ("totalMemoryNeededMB", L), ("totalVCoresNeeded", I),
    ("containerLogsLink", S))

NODE = _struct(
    ("id", S), ("rack", S), ("state", S), ("nodeHostName", S), ("nodeHTTPAddress", S),
    ("lastHealthUpdate", L), ("healthReport", S), ("numContainers", I),
    ("usedMemoryMB", L), ("availMemoryMB", L), ("usedVirtualCores", I),
    ("availableVirtualCores", I))

CLUSTER_METRICS = _struct(
    ("appsSubmitted", I), ("appsCompleted", I), ("appsPending", I), ("appsRunning", I),
    ("appsFailed", I), ("appsKilled", I), ("reservedMB", L), ("availableMB", L),
    ("allocatedMB", L), ("totalMB", L), ("reservedVirtualCores", L),
    ("availableVirtualCores", L), ("allocatedVirtualCores", L), ("totalVirtualCores", L),
    ("containersAllocated", I), ("containersReserved", I), ("containersPending", I),
    ("totalNodes", I), ("activeNodes", I), ("lostNodes", I), ("unhealthyNodes", I),
    ("decommissionedNodes", I), ("rebootedNodes", I))

APP_STAT_ITEM = _struct(("state", S), ("type", S), ("count", L))
