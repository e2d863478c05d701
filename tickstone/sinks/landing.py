"""Landing raw responses and their manifests as bronze files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ledger import RUN, request_params, run_manifest
from .layout import FILE_BYTES, by_folder, in_files


def _json_line(df: DataFrame, fields: list[str]) -> Column:
    """The fields as a JSON object with ``data`` spliced in as the JSON it is."""
    head = F.to_json(F.struct(*fields))
    opened = F.left(head, F.length(head) - 1)
    # Line breaks can only stand between tokens of JSON text, never in them.
    broken = F.contains("data", F.lit("\n")) | F.contains("data", F.lit("\r"))
    body = F.when(broken, F.regexp_replace("data", r"[\r\n]+", " ")).otherwise(F.coalesce("data", F.lit("null")))
    return F.concat(opened, F.lit(',"data":'), body, F.lit("}"))


def land_bronze(
    records: DataFrame,
    root: str,
    source: str,
    dataset: str,
    unit: tuple[str, str] | None = None,
    file_bytes: int = FILE_BYTES,
    ratio: float = 1.0,
) -> None:
    """Append responses below ``<root>/<source>/<dataset>/date=…/[unit=…/]run_id=…``.

    ``records`` holds the envelope fields, ``data`` as JSON text, and the
    ingestion ``date``.  ``unit`` is the name of a further folder level and the
    column it takes its values from, such as ``("symbol", "request.symbol")``.

    No file has more than ``file_bytes`` unless a single response has.  A line counts for
    its bytes times ``ratio``: at 1 the bound is certain, as compressing does not add to
    text; a smaller one, where the data's compression is known, makes fewer files.
    """
    fields = [c for c in records.columns if c not in ("data", "date")]
    folders = [F.col("date"), F.col("run_id")]
    if unit is not None:
        folders.insert(1, F.col(unit[1]).alias(unit[0]))
    names = ["date", *([unit[0]] if unit else []), "run_id"]
    lines = records.select(_json_line(records, fields).alias("value"), *folders)
    size = F.ceil((F.octet_length("value") + 1) * F.lit(float(ratio))).cast("bigint")
    laid, rows_per_file = in_files(lines.withColumn("_size", size), names, "_size", file_bytes)
    (
        laid.drop("_size")
        .write.mode("append")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*names)
        .text(f"{root.rstrip('/')}/{source}/{dataset}")
    )


def write_manifests(
    records: DataFrame, root: str, source: str, dataset: str, size: Column | None = None
) -> None:
    """Append one manifest per run of ``records`` next to its data, with the parameters
    that the run's requests were made with."""
    manifest = run_manifest(records, size=size, params=request_params(records))
    head = F.to_json(F.struct(*RUN, "record_count", "status"))
    line = F.concat(
        F.regexp_replace(head, r"\}$", ""), F.lit(',"request_params":'), "request_params", F.lit("}")
    ).alias("value")
    (
        by_folder(manifest.select(line, "date", "run_id"), ["date", "run_id"])
        .write.mode("append")
        .partitionBy("date", "run_id")
        .text(f"{root.rstrip('/')}/{source}/{dataset}")
    )
