"""A table as signed rows in time: past states, differences and retractions on plain partitioned parquet.

Layout: ``root/_at=<step>/_sign=<1 or -1>/[<partition>/]*.parquet``. A row that is added at a step lies below sign 1
of it, a row that is removed below sign -1; nothing written is ever changed. Whole rows are the identity, NULLs
compare equal and repeated rows count. The state at a step is the sum of the signs of all rows up to it, a
difference of two states is the sum between them, and a restore is that sum with the other sign. Steps and signs are
partition columns, so no state or difference lists or reads files of other steps.

A step is written beside the table and takes its place by one rename, so readers see all of it or nothing, and a
step that is written again after a failure replaces itself: it is worked out from the steps before it. There is no list of files and no commit table. One
writer per table is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.predicates import as_column
from sensorloom.operators import corrections
from sensorloom.session import folder, path_exists, remove, rename

AT, SIGN = "_at", "_sign"
Moment = int | dt.datetime


def step_of(at: Moment) -> int:
    """A step as a number: itself, or the microseconds of an instant (UTC if it names no zone)."""
    if isinstance(at, int):
        return at
    zoned = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    return (zoned - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


@dataclass(frozen=True)
class Ledger:
    """The table below ``root`` with the columns of ``schema``; ``partition_by`` are some of them."""

    spark: SparkSession
    root: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def log_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(AT, T.LongType()), T.StructField(SIGN, T.IntegerType())])

    def steps(self) -> list[int]:
        """All steps, in order; a listing of one folder."""
        files, at = folder(self.spark, self.root)
        if not files.exists(at):
            return []
        names = [status.getPath().getName() for status in files.listStatus(at)]
        return sorted(int(name.removeprefix(f"{AT}=")) for name in names if name.startswith(f"{AT}="))

    def land(self, signed: DataFrame, at: Moment) -> None:
        """Write the rows of a step: the table's columns and ``_sign``. Writing the same step again replaces it."""
        step = step_of(at)
        if later := [s for s in self.steps() if s > step]:
            raise ValueError(f"step {step} lies before {later[-1]}, which is written already")
        aside = f"{self.root}/_landing-{uuid.uuid4().hex}"
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        try:
            signed.select(*fields, F.col(SIGN).cast("int").alias(SIGN)).write.partitionBy(SIGN, *self.partition_by).parquet(aside)
            target = f"{self.root}/{AT}={step}"
            remove(self.spark, target)
            rename(self.spark, aside, target)
        finally:
            remove(self.spark, aside)

    def append(self, df: DataFrame, at: Moment) -> None:
        """Add the rows of ``df``; columns of the table that it lacks are NULL."""
        self.land(corrections.append_null_columns(df, self.schema).withColumn(SIGN, F.lit(1)), at)

    def delete_where(self, predicate: str | Column, at: Moment) -> None:
        """Remove the rows for which the predicate is TRUE. It goes down to the scan; other rows are not read."""
        self.land(self.as_of(step_of(at) - 1, predicate).withColumn(SIGN, F.lit(-1)), at)

    def replace_where(self, predicate: str | Column, rows: DataFrame, at: Moment) -> None:
        """Remove the rows for which the predicate is TRUE and add ``rows``, in one step."""
        gone = self.as_of(step_of(at) - 1, predicate).withColumn(SIGN, F.lit(-1))
        come = corrections.append_null_columns(rows, self.schema).withColumn(SIGN, F.lit(1))
        self.land(gone.unionByName(come.select(gone.columns)), at)

    def merge_insert(self, source: DataFrame, on: Sequence[str], at: Moment) -> None:
        """Add the source rows that have no partner on ``on``."""
        self.append(corrections.new_rows(self.as_of(step_of(at) - 1), source, on), at)

    def merge_step(self, step: Moment, on: Sequence[str], at: Moment) -> None:
        """:meth:`merge_insert` with the table's own state at ``step`` as source.

        Rows that are still there match themselves, so only what went since, and rows with a NULL key (which never
        match), are read as source.
        """
        net = _net(self.log(step, step_of(at) - 1), self.columns)
        gone = _copies(net.where("_net < 0").withColumn("_net", -F.col("_net")), self.columns)
        nameless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
        source = gone.where(~nameless).unionByName(self.as_of(step, nameless))
        self.append(corrections.new_rows(self.as_of(step_of(at) - 1), source, on), at)

    def restore(self, to: Moment, at: Moment) -> None:
        """Bring back the state at ``to``; reads only the steps after it."""
        net = _net(self.log(to, step_of(at) - 1), self.columns).withColumn("_net", -F.col("_net"))
        sign = F.when(F.col("_net") > 0, 1).otherwise(-1).alias(SIGN)
        self.land(_copies(net.withColumn(SIGN, sign).withColumn("_net", F.abs("_net")), [*self.columns, SIGN]), at)

    def log(self, after: Moment | None = None, upto: Moment | None = None) -> DataFrame:
        """Signed rows of the steps in ``(after, upto]``, with the step and the sign."""
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], self.log_schema)
        rows = self.spark.read.schema(self.log_schema).parquet(self.root).select(*self.log_schema.names)
        if after is not None:
            rows = rows.where(F.col(AT) > step_of(after))
        return rows if upto is None else rows.where(F.col(AT) <= step_of(upto))

    def as_of(self, at: Moment | None = None, where: str | Column | None = None) -> DataFrame:
        """The rows at the end of step ``at``, by default of the last one; ``where`` is applied in the scan.

        Only partitions from which something was removed are summed up; the others are their files.
        """
        rows = self.log(upto=at)
        if where is not None:
            rows = rows.where(as_column(where))
        added, gone = (rows.where(F.col(SIGN) == sign) for sign in (1, -1))
        if not gone.limit(1).count():
            return added.select(*self.columns)
        if not self.partition_by:
            return _copies(_net(rows, self.columns), self.columns)
        hit = [F.col(c).alias(f"_hit_{c}") for c in self.partition_by]
        touched = gone.select(*hit).distinct()
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hit_{c}")) for c in self.partition_by])
        whole = added.join(touched, same, "left_anti").select(*self.columns)
        summed = _net(added.join(touched, same, "left_semi").unionByName(gone), self.columns)
        return whole.unionByName(_copies(summed, self.columns))

    def changes(self, after: Moment, upto: Moment | None, keys: Sequence[str]) -> DataFrame:
        """Row changes from one state to another, as :func:`corrections.row_changes`; reads only the steps between."""
        return corrections.classify(self.log(after, upto), SIGN, self.columns, keys)

    def history(self) -> DataFrame:
        """Rows added and removed per step, newest first; reads partition columns and row counts only."""
        counts = self.log().groupBy(F.col(AT).alias("step")).agg(
            F.count_if(F.col(SIGN) > 0).alias("rows_added"), F.count_if(F.col(SIGN) < 0).alias("rows_removed"))
        return counts.orderBy(F.desc("step"))

    def compact(self, target: str, at: Moment | None = None) -> Ledger:
        """A new table whose first step is the state at ``at``: one step, no removals, no earlier past."""
        step = step_of(at) if at is not None else (self.steps() or [0])[-1]
        fresh = Ledger(self.spark, target, self.schema, self.partition_by)
        rows = self.as_of(step)
        fresh.append(rows.hint("rebalance", *[F.col(c) for c in self.partition_by]), step)
        return fresh


def _net(signed: DataFrame, columns: Sequence[str]) -> DataFrame:
    return signed.groupBy(*columns).agg(F.sum(SIGN).alias("_net")).where("_net <> 0")


def _copies(net: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row as often as it counts; a count below 0 has no rows."""
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_net"))).alias("_copy")
    return net.where("_net > 0").select(*columns, again).drop("_copy")
