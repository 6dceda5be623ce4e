"""Aggregated container logs and container log pages.

Aggregated log text has one section per container::

    Container: <container id> on <node>
    LogType:stderr
    <header lines, e.g. LogLength:...>
    Log Contents:
    <content lines>
    LogType:stdout
    ...

The text reader splits records on ``\\nContainer: `` instead of newlines, so
each record is one section even when a file is cut into many splits (Hadoop's
line reader handles a custom separator across split boundaries). The rest is
narrow column work: ``split`` on ``\\nLogType:``, ``posexplode`` and regexes.

A content line that begins with ``Container: `` cuts its section too, but its
record lacks a container header. Such records go back to the section they were
cut from: the nearest record with a header before them in their file, found
over narrow columns in two steps (within file blocks, then from block to
block). Files without such lines are parsed without any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.session import materialize

# The markers of aggregated logs and the reference's id patterns.
SECTION_SEP = "\nContainer: "
BLOCK_SEP = "\nLogType:"
# The reference's node pattern has no '.' or '-': ``host-1.x_45454`` gives ``host``.
NODE_PATTERN = "[a-zA-Z0-9_]+"
FULL_NODE_PATTERN = r"\S+"
CONTAINER_PATTERN = "[a-zA-Z0-9_]+"


def read_log_sections(spark: SparkSession, path: str, with_file: bool = True) -> DataFrame:
    """Section records of aggregated log files: ``value`` (CRLF line ends
    made LF) and, with ``with_file``, the source ``file``."""
    raw = spark.read.option("lineSep", SECTION_SEP).text(path)
    cols = [F.regexp_replace("value", "\r\n", "\n").alias("value")]
    if with_file:
        cols.append(F.col("_metadata.file_path").alias("file"))
    return raw.select(*cols)


def header_pattern(full_node: bool = False) -> str:
    node = FULL_NODE_PATTERN if full_node else NODE_PATTERN
    return rf"^(?:Container: )?({CONTAINER_PATTERN}) on ({node})"


def whole_log_sections(spark: SparkSession, path: str, full_node: bool = False) -> DataFrame:
    """Section records as ``read_log_sections`` gives them, with the records
    that content lines cut off put back: ``value``, ``file``. What stands
    before a file's first header stays a record of its own."""
    raw = spark.read.option("lineSep", SECTION_SEP).text(path)
    # Rows of a block are read in order by one task; the reader's blocks of a
    # file are ordered by their start.
    records = materialize(spark, raw.select(
        F.regexp_replace("value", "\r\n", "\n").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))
        .withColumn("headed", F.col("value").rlike(header_pattern(full_node))))
    cut_off = records.filter(~F.col("headed"))
    if cut_off.isEmpty():
        return records.select("value", "file")
    head = F.when(F.col("headed"), F.col("seq"))
    within = Window.partitionBy("file", "block").orderBy("seq")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = (records.groupBy("file", "block").agg(F.max(head).alias("end"))
            .select("file", "block", F.last("end", True).over(earlier).alias("carried")))
    heads = (records.select("file", "block", "seq", "headed").withColumn("own", F.last(head, True).over(within))
             .filter(~F.col("headed")).join(ends, ["file", "block"])
             .select("seq", F.coalesce("own", "carried").alias("head")))
    cut_off = cut_off.join(heads, "seq")
    # A section is one row of the result, so its pieces meet in one row.
    pieces = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    tails = (cut_off.filter(F.col("head").isNotNull()).groupBy(F.col("head").alias("seq"))
             .agg(F.array_join(F.transform(pieces, lambda p: p["value"]), SECTION_SEP).alias("tail")))
    whole = records.filter("headed").join(tails, "seq", "left").select(
        F.concat("value", F.coalesce(F.concat(F.lit(SECTION_SEP), "tail"), F.lit(""))).alias("value"), "file")
    return whole.union(cut_off.filter(F.col("head").isNull()).select("value", "file"))


def read_container_logs(spark: SparkSession, path: str, full_node: bool = False,
                        with_file: bool = True) -> DataFrame:
    """Read aggregated log text files into one row per (container, log type),
    with the source ``file`` unless ``with_file=False``. Content lines that
    begin with ``Container: `` stay content."""
    return section_container_logs(whole_log_sections(spark, path, full_node), full_node=full_node,
                                  keep=("file",) if with_file else ())


def section_report(sections: DataFrame, text_col: str = "value", full_node: bool = False) -> DataFrame:
    """Per file: records with a container header and records without one
    (text that was cut off by a content line beginning ``Container: ``).
    One partial aggregate."""
    ok = F.col(text_col).rlike(header_pattern(full_node))
    by = [c for c in ("file",) if c in sections.columns]
    return sections.groupBy(*by).agg(F.count_if(ok).alias("sections"),
                                     F.count_if(~ok).alias("unmatched"))


def section_container_logs(df: DataFrame, text_col: str = "value", full_node: bool = False,
                           keep: tuple[str, ...] = (), keep_unmatched: bool = False) -> DataFrame:
    """Split section records into ``container_id, node_id, log_type, content``.

    Changed on purpose from the reference: header lines between ``LogType``
    and ``Log Contents:`` are left out; content has no leading newline and
    no trailing newlines; a log type other than stdout/stderr is its own row;
    a repeated container header gives a second row rather than erasing the
    first. A record whose first line is not a container header belongs to no
    container (``whole_log_sections`` leaves only what stands before a file's
    first header); it is dropped unless ``keep_unmatched``, then with a null
    ``container_id``.
    """
    header = header_pattern(full_node)
    text = F.col(text_col)
    cid = F.regexp_extract(text, header, 1)
    nid = F.regexp_extract(text, header, 2)
    rows = df.select(
        *keep,
        F.when(cid != "", cid).alias("container_id"),
        F.when(cid != "", nid).alias("node_id"),
        F.posexplode(F.split(text, BLOCK_SEP)).alias("_pos", "_block"))
    rows = rows.filter(F.col("_pos") > 0)
    if not keep_unmatched:
        rows = rows.filter(F.col("container_id").isNotNull())
    block = F.col("_block")
    log_type = F.substring_index(block, "\n", 1)
    content = F.regexp_replace(
        F.regexp_extract(block, r"(?s)\nLog Contents:\n(.*)$", 1), r"[\r\n]+$", "")
    return rows.select(*keep, "container_id", "node_id",
                       log_type.alias("log_type"), content.alias("content"))


# The container log page markers.
LOG_PAGE_START = '<td class="content">'
LOG_PAGE_END = "</td>"
LOG_MISSING = "Cannot find this log"
# The reference's strip character sets (strict_chars=True).
STRIP_LEADING = "\n          <pre>"
STRIP_TRAILING = "</pre>\n        "


def _quote(s: str) -> str:
    return r"\Q" + s + r"\E"


def log_page_content(html: Column, start: str = LOG_PAGE_START, end: str = LOG_PAGE_END,
                     strict_chars: bool = False) -> Column:
    """Text between the first ``start`` and the next ``end``.

    ``''`` when the page says the log is missing or when ``start`` is absent
    (the reference slices at a wrong offset then). The ``<pre>`` wrapper and
    surrounding white space are removed; ``strict_chars=True`` instead strips
    the reference's character sets, which also eats real letters
    (``error: done here`` gives ``or: done h``).
    """
    inner = F.regexp_extract(html, "(?s)" + _quote(start) + "(.*?)" + _quote(end), 1)
    if strict_chars:
        body = F.rtrim(F.ltrim(inner, F.lit(STRIP_LEADING)), F.lit(STRIP_TRAILING))
    else:
        body = F.regexp_extract(inner, r"(?s)^\s*(?:<pre>)?(.*?)(?:</pre>)?\s*$", 1)
    return F.when(html.contains(LOG_MISSING), F.lit("")).otherwise(body)


def extract_log_html(df: DataFrame, html_col: str = "html", start: str = LOG_PAGE_START,
                     end: str = LOG_PAGE_END, strict_chars: bool = False,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, log_page_content(F.col(html_col), start, end, strict_chars).alias("content"))
