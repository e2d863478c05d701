"""Spreading rows over write tasks by the folders they go to.

With a folder per symbol and day most folders are tiny and their number, not
their size, is the cost; a few may be huge.  Tasks are therefore counted by
folders as well as by rows, and a huge folder is written by several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_FILE = 2_000_000
FOLDERS_PER_TASK = 32
FILE_BYTES = 128 << 20
# A big folder's rows are dealt to parts of about so many files before they are summed up.
FILES_PER_PART = 16
# A task writes so many small files of rows of like size; files are small when so many of
# them make no more than one of FILE_BYTES.
FILES_PER_TASK = 256
# Rows are of like size where files cut by their number are at least so full.
LIKE = 0.8
# Above this many huge folders their list is joined instead of broadcast.
BROADCAST_FOLDERS = 100_000


def by_folder(
    df: DataFrame, folders: Sequence[str], rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Bring each folder's rows together, big folders in several pieces.

    Reads ``df`` once more for the row counts, so it should be stored or cheap.
    """
    sizes = df.groupBy(*folders).agg(F.count(F.lit(1)).alias("_rows"))
    pieces = F.ceil(F.col("_rows") / rows_per_file)
    found = sizes.agg(
        F.count(F.lit(1)).alias("folders"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.count_if(pieces > 1).alias("huge"),
    ).first()
    tasks = max(
        -(-found["folders"] // FOLDERS_PER_TASK), -(-found["rows"] // rows_per_file), 1
    )
    if not found["huge"]:
        return df.repartition(tasks, *folders)
    huge = sizes.filter(pieces > 1).select(*folders, pieces.alias("_pieces"))
    if found["huge"] <= BROADCAST_FOLDERS:
        huge = F.broadcast(huge)
    # A row's piece follows from its values, so a repeated task agrees.
    piece = F.pmod(F.xxhash64(*df.columns), F.coalesce("_pieces", F.lit(1)))
    spread = df.join(huge, list(folders), "left").withColumn("_piece", piece)
    return spread.repartition(tasks, *folders, "_piece").select(*df.columns)


def by_bytes(
    df: DataFrame, folders: Sequence[str], size: str, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Bring each folder's rows together in files of at most ``file_bytes`` by the column
    ``size``, a row of more than half of that in a file of its own.

    Rows of a big folder are dealt to parts by hash, and each part is cut where its
    running sum of sizes passes a multiple of half the bound: what lies between two cuts
    and the row that starts there stay within it.  Pieces of a folder go to different
    tasks, as a task writes one file for a folder.  Reads ``df`` once more for the sums,
    so it should be stored or cheap, and its rows must not change between two reads.
    """
    sums, found = _sums(df, folders, size, file_bytes)
    return _in_pieces(df, folders, size, file_bytes, sums, found)


def in_files(
    df: DataFrame, folders: Sequence[str], size: str, file_bytes: int = FILE_BYTES
) -> tuple[DataFrame, int]:
    """:func:`by_bytes`, and the rows that a file may hold, for ``maxRecordsPerFile``;
    0 where that needs no bound.

    Small files of rows of like size are cut by that number, which leaves them within the
    bound if all rows were as large as the largest.  So a task writes many files of a
    folder, where a piece each would cost a task's folders for every file.
    """
    sums, found = _sums(df, folders, size, file_bytes)
    most = found["most"] or 0
    rows = file_bytes // most if most else 0
    small = file_bytes * FILES_PER_TASK <= FILE_BYTES
    if not (found["big"] and small and rows and found["bytes"] >= LIKE * most * found["rows"]):
        return _in_pieces(df, folders, size, file_bytes, sums, found), 0
    pieces = F.ceil(F.col("_bytes") / (file_bytes * FILES_PER_TASK)).cast("int")
    tasks = max(found["folders"] // FOLDERS_PER_TASK, found["bytes"] // (file_bytes * FILES_PER_TASK)) + 1
    wide = sums.filter(pieces > 1).select(F.struct(*folders).alias("_folder"), pieces.alias("_pieces"))
    wide = F.broadcast(wide) if found["big"] <= BROADCAST_FOLDERS else wide
    # A row's piece follows from its values, so a repeated task agrees.
    piece = F.pmod(F.xxhash64(*df.columns), F.coalesce("_pieces", F.lit(1)))
    spread = df.withColumn("_folder", F.struct(*folders)).join(wide, "_folder", "left")
    return spread.withColumn("_piece", piece).repartition(tasks, "_folder", "_piece").select(*df.columns), rows


def _sums(df: DataFrame, folders: Sequence[str], size: str, file_bytes: int):
    """Sums by folder, and what they come to."""
    sums = df.groupBy(*folders).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_bytes"), F.max(size).alias("_most")
    )
    big = F.col("_bytes") > file_bytes
    parts = F.when(big, F.ceil(F.col("_bytes") / (file_bytes * FILES_PER_PART))).otherwise(1)
    found = sums.agg(
        F.count(F.lit(1)).alias("folders"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
        F.count_if(big).alias("big"), F.max(parts).alias("parts"), F.max("_most").alias("most"),
        F.sum("_rows").alias("rows"),
    ).first()
    return sums, found


def _in_pieces(
    df: DataFrame, folders: Sequence[str], size: str, file_bytes: int, sums: DataFrame, found
) -> DataFrame:
    half = max(file_bytes // 2, 1)
    big = F.col("_bytes") > file_bytes
    parts = F.when(big, F.ceil(F.col("_bytes") / (file_bytes * FILES_PER_PART))).otherwise(1)
    tasks = max(
        -(-found["folders"] // FOLDERS_PER_TASK), int(-(-found["bytes"] // file_bytes)), 1
    )
    if not found["big"]:
        return df.repartition(tasks, *folders)
    wide = sums.filter(big).select(
        F.struct(*folders).alias("_folder"), parts.cast("int").alias("_parts")
    )
    wide = F.broadcast(wide) if found["big"] <= BROADCAST_FOLDERS else wide
    keyed = df.withColumn("_folder", F.struct(*folders)).join(wide, "_folder", "left")
    row = F.xxhash64(*df.columns)
    dealt = keyed.filter("_parts is not null").withColumns({
        "_row": row, "_part": F.pmod(row, F.col("_parts")).cast("int"),
    })
    # Rows above half the bound count as whole pieces, in the order of all others.
    order = Window.partitionBy("_folder", "_part").orderBy("_row", *df.columns)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    alone = F.col(size) > half
    dealt = dealt.withColumns({
        "_small": F.coalesce(F.sum(F.when(~alone, F.col(size))).over(before), F.lit(0)),
        "_alone": F.coalesce(F.sum(F.when(alone, 1)).over(before), F.lit(0)),
    }).withColumn("_piece", F.when(
        alone, 2 * F.col("_alone") + 1
    ).otherwise(2 * F.floor(F.col("_small") / half))).drop("_row", "_small", "_alone")
    pieces = dealt.agg(F.max("_piece").alias("p")).first()["p"] + 1
    tasks = max(tasks, int(found["parts"]) * int(pieces))
    place = F.col("_part") * F.lit(int(pieces)) + F.col("_piece")
    whole = keyed.filter("_parts is null").withColumns({"_part": F.lit(0), "_piece": F.lit(0)})
    spread = dealt.unionByName(whole.select(*dealt.columns))
    start = F.pmod(F.xxhash64("_folder"), F.lit(tasks))
    at = F.pmod(start + place.cast("bigint"), F.lit(tasks)).cast("int")
    return spread.repartitionById(tasks, at).select(*df.columns)
