"""Typed rows, bad rows, the error limit and row accounting.

A value is bad when its text is not empty and yet decodes to NULL. Each value
is decoded once: text, typed columns and the bad mark are three projections of
one generated stage. The row counts ride along as observed metrics; they are
exact only in the last stage of a job, where a task that is run again counts
once, so no shuffle may follow them.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from py4j.protocol import Py4JError
from pyspark import InheritableThread
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadstone.fields import STRING, FieldSpec, quoted
from loadstone.functions.decode import decode
from loadstone.sources.delimited import (
    BLOCK_BYTES,
    DEFAULT_DELIMITER,
    LINE,
    PLACE,
    field_array,
    field_text,
    split_fields,
)

_FAILED = "undecodable column "
BAD, SURPLUS, CUT = "__bad", "__surplus", "__cut"
REJECTED = "__rejected"
TASK = "__task"

# Tasks whose rows are counted one by one: the aggregate is exact as long as it tracks them all.
MOST_TASKS = 1_000_000


class LoadError(RuntimeError):
    """A load stopped by bad rows."""


def _is_bad(spec: FieldSpec, i: int) -> Column:
    return (F.col(f"f{i}") != "") & F.col(f"v{i}").isNull()


def _decoded(lines: DataFrame, fields: Sequence[FieldSpec], delimiter: str) -> DataFrame:
    """The line, text columns f<i> and typed columns v<i>."""
    text = split_fields(lines, len(fields), delimiter, SURPLUS)
    return text.select("*", *[decode(s, F.col(f"f{i}")).alias(f"v{i}") for i, s in enumerate(fields)])


def _named(fields: Sequence[FieldSpec]) -> list[Column]:
    return [
        F.col(f"v{i}").alias(s.name, metadata={"comment": s.comment} if s.comment else {})
        for i, s in enumerate(fields)
    ]


def typed_rows(
    lines: DataFrame, fields: Sequence[FieldSpec], delimiter: str = DEFAULT_DELIMITER
) -> DataFrame:
    """Every line as a typed row, bad values NULL. Columns nobody reads are not decoded."""
    return _decoded(lines, fields, delimiter).select(*_named(fields))


def first_bad_column(fields: Sequence[FieldSpec]) -> Column:
    """Index of the first bad column of a decoded row, NULL for a good row."""
    tests = [F.when(_is_bad(s, i), F.lit(i)) for i, s in enumerate(fields) if s.kind != STRING]
    return F.coalesce(*tests) if tests else F.lit(None).cast("int")


def _loses_text(fields: Sequence[FieldSpec]) -> Column:
    """Whether a string of a row is cut to its declared length."""
    tests = [F.length(F.col(f"f{i}")) > s.limit for i, s in enumerate(fields) if s.limit]
    return reduce(or_, tests) if tests else F.lit(False)


def _marked(
    lines: DataFrame, fields: Sequence[FieldSpec], delimiter: str, *extra: str
) -> DataFrame:
    """Typed columns v<i> and the index of the first bad one."""
    values = [f"v{i}" for i in range(len(fields))]
    return _decoded(lines, fields, delimiter).select(
        *extra,
        *values,
        SURPLUS,
        _loses_text(fields).alias(CUT),
        first_bad_column(fields).alias(BAD),
        F.spark_partition_id().alias(TASK),
    )


def _counted(marked: DataFrame, observation: Observation | None) -> DataFrame:
    """Observe the counts, of rows that lose text too. This also keeps a filter on the bad mark above the
    decoding: pushed below, it would split the line and decode for each use."""
    places = [F.max(BLOCK_BYTES).alias("split_bytes")] if BLOCK_BYTES in marked.columns else []
    written = F.when(F.col(BAD).isNull(), F.col(TASK))
    tasks = [rows_by_task(written).alias("tasks")] if TASK in marked.columns else []
    return marked.observe(
        observation or Observation(),
        *places,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(BAD)).alias("bad"),
        F.count_if(F.col(SURPLUS)).alias("surplus"),
        F.count_if(F.col(CUT)).alias("cut"),
        *tasks,
    )


def rows_by_task(task: Column) -> Column:
    """Rows of each task, as a metric to observe: ``task`` is the column with its number, or
    NULL for a row that does not count. A task keeps one counter; merging adds one each."""
    return F.call_function("approx_top_k", task, F.lit(MOST_TASKS), F.lit(MOST_TASKS))


def task_counts(found: Sequence | None) -> dict[int, int]:
    """Rows by task number, from an observed :func:`rows_by_task`; of tasks that have any.
    Empty, rather than inexact, beyond ``MOST_TASKS`` tasks."""
    if found is None or len(found) >= MOST_TASKS:
        return {}
    return {task: rows for task, rows in sorted((t, n) for t, n in found if t is not None)}


def good_rows(
    lines: DataFrame,
    fields: Sequence[FieldSpec],
    delimiter: str = DEFAULT_DELIMITER,
    observation: Observation | None = None,
) -> DataFrame:
    """The typed rows without a bad value; all rows and bad rows are counted."""
    counted = _counted(_marked(lines, fields, delimiter), observation)
    return counted.where(F.col(BAD).isNull()).select(*_named(fields))


def strict_rows(
    lines: DataFrame,
    fields: Sequence[FieldSpec],
    delimiter: str = DEFAULT_DELIMITER,
    observation: Observation | None = None,
) -> DataFrame:
    """Every line as a typed row; the first bad value fails the job at once."""
    counted = _counted(_marked(lines, fields, delimiter, LINE), observation)
    message = F.concat(
        F.lit(_FAILED),
        F.col(BAD).cast("string"),
        F.lit(" "),
        _of_column([f"{s.name} {s.describe()}" for s in fields]),
        F.lit(" value='"),
        _bad_text(delimiter),
        F.lit("' line: "),
        F.col(LINE),
    )
    passed = F.when(F.col(BAD).isNull(), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return counted.where(passed).select(*_named(fields))


def _bad_text(delimiter: str) -> Column:
    return field_text(field_array(F.col(LINE), delimiter), F.col(BAD))


def _of_column(texts: Sequence[str]) -> Column:
    """The text that belongs to the bad column."""
    return F.get(F.array(*[F.lit(t) for t in texts]), F.col(BAD))


def observed(observation: Observation) -> dict[str, int] | None:
    """The counts of a finished write; None if it had none to make.

    Spark plans the observation away with an input it finds to be empty.
    """
    try:
        return observation.get or None
    except (PySparkException, Py4JError):
        return None


def bad_rows(
    lines: DataFrame, fields: Sequence[FieldSpec], delimiter: str = DEFAULT_DELIMITER
) -> DataFrame:
    """The rows that do not decode, with their first bad column, and their places if the
    lines have them."""
    places = [c for c in PLACE if c in lines.columns]
    marked = _marked(lines, fields, delimiter, LINE, *places).select(LINE, *places, SURPLUS, CUT, BAD)
    return _counted(marked, None).where(F.col(BAD).isNotNull()).select(*_report(fields, delimiter), *places)


def _report(fields: Sequence[FieldSpec], delimiter: str) -> list[Column]:
    """What is told about a bad row."""
    value = _bad_text(delimiter)
    return [
        F.col(LINE).alias("line"),
        F.col(BAD).alias("col_idx"),
        _of_column([s.name for s in fields]).alias("col_name"),
        _of_column([s.describe() for s in fields]).alias("type"),
        F.length(value).alias("len"),
        value.alias("value"),
    ]


def split_rows(
    lines: DataFrame,
    fields: Sequence[FieldSpec],
    delimiter: str = DEFAULT_DELIMITER,
    observation: Observation | None = None,
) -> DataFrame:
    """Good rows and bad ones, told apart by ``REJECTED``, for a write that is partitioned by
    it: both outputs come from one pass.

    Files hold the columns of the table and no others. A bad row, whose files never become
    the table's, has its report as JSON in the first string column, see :func:`carrier`.
    """
    places = [c for c in PLACE if c in lines.columns]
    counted = _counted(_marked(lines, fields, delimiter, LINE, *places), observation)
    bad = F.col(BAD).isNotNull()
    report = F.to_json(F.struct(*_report(fields, delimiter), *places))
    at = carrier(fields)
    values = [
        F.when(bad, report).otherwise(F.col(f"v{i}")) if i == at else F.when(~bad, F.col(f"v{i}"))
        for i in range(len(fields))
    ]
    named = [
        v.alias(s.name, metadata={"comment": s.comment} if s.comment else {}) for v, s in zip(values, fields)
    ]
    return counted.select(*named, bad.alias(REJECTED))


def carrier(fields: Sequence[FieldSpec]) -> int | None:
    """The column that reports of bad rows travel in; None if no column is a string."""
    return next((i for i, s in enumerate(fields) if s.kind == STRING), None)


def reports(rejected: DataFrame, fields: Sequence[FieldSpec], places: bool) -> DataFrame:
    """The reports in the files of bad rows, as :func:`bad_rows` gives them."""
    kind = "line string, col_idx int, col_name string, type string, len int, value string"
    if places:
        kind += f", {PLACE[0]} string, " + ", ".join(f"{c} bigint" for c in PLACE[1:])
    report = F.from_json(F.col(quoted(fields[carrier(fields)].name)), kind)
    return rejected.select(report.alias("report")).select("report.*")


def count_rows(
    lines: DataFrame, fields: Sequence[FieldSpec], delimiter: str = DEFAULT_DELIMITER
) -> DataFrame:
    """One row: ``rows`` read and ``bad`` rows among them."""
    return (
        _decoded(lines, fields, delimiter)
        .select(first_bad_column(fields).alias(BAD))
        .agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(BAD)).alias("bad"))
    )


def reaches_limit(bad: Column | int, limit: Column | int):
    """Limit 0 stops at the first bad row, n at the n-th; it holds for the whole job."""
    if isinstance(bad, Column) or isinstance(limit, Column):
        return bad >= F.greatest(limit, F.lit(1))
    return bad >= max(limit, 1)


def enforce_limit(bad: int, limit: int) -> None:
    if reaches_limit(bad, limit):
        raise LoadError(f"{bad} rows are bad; the load allows fewer than {max(limit, 1)}")


class LimitWatch:
    """Ends a running job when the bad rows of its finished tasks reach the limit.

    The counts are those of the observed metric, which a task adds to when it ends, once;
    so what stops the job is never more than what it would have counted in the end.
    """

    def __init__(self, spark: SparkSession, name: str, limit: int, every: float = 0.2):
        self.spark, self.name, self.limit, self.every = spark, name, limit, every
        self.tag, self.bad = f"loadstone-{uuid.uuid4().hex}", 0
        self._over = threading.Event()

    def __enter__(self) -> LimitWatch:
        jvm = self.spark._jvm
        self._executions = jvm.org.apache.spark.sql.execution.SQLExecution
        self._store = self.spark._jsparkSession.sharedState().statusStore()
        self.spark.sparkContext.addJobTag(self.tag)
        self._thread = InheritableThread(target=self._watch, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *error) -> None:
        self._over.set()
        self._thread.join()
        self.spark.sparkContext.removeJobTag(self.tag)

    @property
    def stopped(self) -> bool:
        return reaches_limit(self.bad, self.limit)

    def _watch(self) -> None:
        while not self._over.wait(self.every):
            self.bad = max(self.bad, self._so_far())
            if self.stopped:
                self.spark.sparkContext.cancelJobsWithTag(self.tag)
                return

    def _so_far(self) -> int:
        """Bad rows of the finished tasks of the running job."""
        listed = self._store.executionsList()
        for i in range(listed.size() - 1, max(-1, listed.size() - 50), -1):
            run = self._executions.getQueryExecution(listed.apply(i).executionId())
            if run is not None:
                try:
                    counts = run.observedMetrics()
                except Py4JError:  # a counter that grew while it was read; the next look has it
                    continue
                if counts.contains(self.name):
                    row = counts.apply(self.name)
                    at = row.fieldIndex("bad")
                    return 0 if row.isNullAt(at) else row.getLong(at)
        return 0


def failed_value(error: BaseException) -> str | None:
    """The message of the bad value that failed a strict job, if that is what failed it."""
    if not isinstance(error, (PySparkException, Py4JError)):
        return None
    text = str(error)
    at = text.find(_FAILED)
    return text[at:].splitlines()[0] if at >= 0 else None
