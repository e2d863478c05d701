"""What has been ingested, and what is still to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import let

# Columns of a record that say what was asked for.
_ASKED = ("coin", "vs_currency", "ids", "vs_currencies")
RUN = ("run_id", "source", "dataset", "ingest_ts", "date")


def history_points() -> Column:
    """How many [time, price] points a history response carries."""
    points = F.from_json("data", S.HISTORY_PAYLOAD)["prices"]
    return F.coalesce(F.size(points), F.lit(0))


def request_params(records: DataFrame) -> Column:
    """What a record's request was made with, as an array of name and value: the columns
    ``coin``, ``vs_currency``, ``ids`` and ``vs_currencies`` and the fields of ``request``
    and ``params``, those it has.  A list counts as several values, null as none."""
    found: list[tuple[str, Column, T.DataType]] = []
    for field in records.schema.fields:
        if field.name in _ASKED:
            found.append((field.name, F.col(field.name), field.dataType))
        elif field.name in ("request", "params") and isinstance(field.dataType, T.StructType):
            found += [(f.name, F.col(field.name)[f.name], f.dataType) for f in field.dataType.fields]

    def named(name: str, value: Column, kind: T.DataType) -> Column:
        listed = value if isinstance(kind, T.ArrayType) else F.array(value)
        values = F.coalesce(listed.cast("array<string>"), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("name"), v.alias("value")))

    none = F.array().cast("array<struct<name: string, value: string>>")
    pairs = F.concat(none, *(named(*one) for one in found))
    return F.filter(pairs, lambda p: p["value"].isNotNull())


def _folded(sets: Column) -> Column:
    """One JSON object out of the parameters of a run's requests, names in order; a name
    with several values has them all, in order, as a list."""

    def of_pairs(pairs: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["name"])))

        def field(name: Column) -> Column:
            asked = F.filter(pairs, lambda p: p["name"] == name)
            values = F.array_sort(F.array_distinct(F.transform(asked, lambda p: p["value"])))

            def text(v: Column) -> Column:
                listed = F.to_json(v)
                return F.when(F.size(v) == 1, F.substring(listed, F.lit(2), F.length(listed) - 2)).otherwise(listed)

            quoted = F.to_json(F.array(name))
            return F.concat(
                F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), let(values, text)
            )

        return F.concat(F.lit("{"), F.array_join(F.transform(names, field), ","), F.lit("}"))

    return let(F.flatten(sets), of_pairs)


def run_manifest(
    records: DataFrame, status: str = "success", size: Column | None = None,
    params: Column | None = None,
) -> DataFrame:
    """One manifest row per run, dated from its first response; ``size`` is what each
    response counts for.  With ``params`` (see :func:`request_params`) the run's distinct
    ones are folded into ``request_params``."""
    size = F.lit(1) if size is None else size
    totals = [
        F.min("ingest_ts").alias("ingest_ts"), F.sum(size.cast("bigint")).alias("record_count")
    ]
    shown = [*RUN]
    if params is not None:
        # Requests made alike are one before they are moved.
        totals.append(_folded(F.collect_set(params)).alias("request_params"))
        shown.append("request_params")
    return (
        records.groupBy(*(c for c in RUN if c != "ingest_ts"))
        .agg(*totals)
        .select(*shown, "record_count", F.lit(status).alias("status"))
    )


def ledger_pending(planned: DataFrame, ledger: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Planned units without a successful run.

    ``unit`` sets the grain: dataset and day, or finer.  Nulls in it match.
    """
    done = ledger.filter(F.col("status") == "success").select(F.struct(*unit).alias("_unit"))
    pending = planned.withColumn("_unit", F.struct(*unit))
    return pending.join(done.distinct(), "_unit", "left_anti").drop("_unit")


def successful_responses(responses: DataFrame) -> DataFrame:
    """Responses that are not error reports."""
    status = F.get_json_object("data", "$.status")
    return responses.filter(F.coalesce(status != "error", F.lit(True)))


def calendar_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day from ``first`` to ``last``, both included, as text."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    listed = spark.range(1).select(F.explode(days).alias("date"))
    return listed.select(F.col("date").cast("string"))


def backfill_days(
    spark: SparkSession, first: str, last: str, ledger: DataFrame, dataset: str
) -> DataFrame:
    """The days of a range that ``dataset`` has no successful run for."""
    planned = calendar_days(spark, first, last).withColumn("dataset", F.lit(dataset))
    return ledger_pending(planned, ledger, ["dataset", "date"])
