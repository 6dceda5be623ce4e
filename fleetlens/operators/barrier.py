"""A user function in N tasks that run at the same time.

The reference starts one command in each of N containers and waits for all of
them; a container's exit status tells whether it failed, and the application has
failed once all are in and one of them did. Here the N tasks are one barrier
stage: Spark starts all of them together or none, each gets its part of the rows
and knows its number and the others', and each reports its outcome as a row.
"""

from __future__ import annotations

import contextlib
import io
import subprocess
import traceback
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import fleetlens.operators.udf  # noqa: F401  (package functions pickle by value)

OUTCOME = "task int, n_tasks int, attempt int, exit_status int, output string, error string"

#: Exit status of a function that raised.
RAISED = 1


def task_resources(vcores: int, memory_mb: int | None = None) -> ResourceProfile:
    """What each task of the stage gets: CPUs, and memory of its executor. A
    cluster manager is needed to grant it; local sessions know no profiles."""
    builder = ResourceProfileBuilder().require(TaskResourceRequests().cpus(vcores))
    if memory_mb is not None:
        builder = builder.require(ExecutorResourceRequests().cores(vcores).memory(f"{memory_mb}m"))
    return builder.build


def shell(command: list[str]) -> Callable[[Iterator[pa.RecordBatch], BarrierTaskContext], tuple[int, str | None]]:
    """A task function that runs a command, which gets none of the rows; what
    the command writes becomes the task's output and error."""

    def run(batches: Iterator[pa.RecordBatch], task: BarrierTaskContext) -> tuple[int, str | None]:
        done = subprocess.run(command, capture_output=True, text=True, errors="replace")
        print(done.stdout, end="")
        return done.returncode, done.stderr or None

    return run


def run_in_tasks(df: DataFrame, fn: Callable, n_tasks: int, task: Column,
                 resources: ResourceProfile | None = None) -> DataFrame:
    """Run ``fn(batches, context)`` in ``n_tasks`` tasks at once; one row a
    task: ``task, n_tasks, attempt, exit_status, output, error``.

    ``task`` says which task a row goes to, 0 to ``n_tasks - 1`` (a task without
    rows runs too). ``fn`` gets the task's rows as Arrow batches and its
    ``BarrierTaskContext`` (``barrier()`` waits for all, ``allGather(message)``
    exchanges messages); what it prints is ``output``; what it returns is the exit
    status (None: 0), or that and an error text. An exception is exit status 1 and its text the ``error``: the
    task reports it instead of failing the stage, so the others' outcomes are kept.
    If a task's process is lost, Spark runs the whole stage again, and ``attempt``
    counts on.

    The stage needs ``n_tasks`` free slots at once; Spark says so if the cluster
    has fewer. ``resources`` (``task_resources``) sets what a task gets.
    """
    rows = df.repartitionById(n_tasks, task.cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        status, error, said = 0, None, io.StringIO()
        with contextlib.redirect_stdout(said):
            try:
                made = fn(batches, context)
                status, error = made if isinstance(made, tuple) else (int(made or 0), None)
            except Exception as e:  # noqa: BLE001 - reported in the task's row
                status, error = RAISED, "".join(traceback.format_exception_only(e)).strip()
        for _ in batches:  # what the function left unread
            pass
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in (
                (context.partitionId(), pa.int32()), (n_tasks, pa.int32()), (context.attemptNumber(), pa.int32()),
                (status, pa.int32()), (said.getvalue(), pa.string()), (error, pa.string()))],
            names=["task", "n_tasks", "attempt", "exit_status", "output", "error"])

    return rows.mapInArrow(run, OUTCOME, barrier=True, profile=resources)


def run_status(outcomes: DataFrame) -> DataFrame:
    """``n_tasks, completed, failed, final_status`` of a run, by the rules of
    ``completion_summary``: FAILED once all tasks are in and one failed."""
    counts = outcomes.groupBy("n_tasks").agg(F.count(F.lit(1)).alias("completed"),
                                             F.count_if(F.col("exit_status") != 0).alias("failed"))
    return counts.withColumn("final_status", F.when(F.col("completed") < F.col("n_tasks"), "RUNNING")
                             .when(F.col("failed") > 0, "FAILED").otherwise("UNDEFINED"))
