"""Rows of stored files told by their places, so that whole rows stay where they are.

A place is a file and the number of a row in it.  Only keys and places are shuffled to
find out which rows are wanted; what is left of them is written once as marks, a bit for
every row of a file, and the rows are then picked by their own bit where they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.sources.writers import materialise

#: Rows that one entry of marks stands for, and the entries that are sent to all tasks: 64 MB.
MARKED_ROWS, MAX_MARKS = 1 << 15, 1 << 14
PLACE = ("_file", "_block", "_bit")


def with_places(rows: DataFrame) -> DataFrame:
    """A scan of stored Parquet files, perhaps with changed or fewer columns, and each row's place."""
    row = F.col("_metadata.row_index")
    values = (F.col("_metadata.file_path"), F.floor(row / MARKED_ROWS), row % MARKED_ROWS)
    return rows.withColumns(dict(zip(PLACE, values)))


def marks_of(places: DataFrame, most: int = MAX_MARKS) -> DataFrame | None:
    """The places as marks; None if these are too many entries to be sent to all tasks."""
    file, block, bit = PLACE
    marks = materialise(places.groupBy(file, block).agg(F.bitmap_construct_agg(bit).alias("_marks")), "marks")
    return None if marks.count() > most else marks


def marked(placed: DataFrame, marks: DataFrame) -> DataFrame:
    """The marked rows of a frame with places, which it keeps."""
    octet = F.substring("_marks", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))
    set_ = F.getbit(F.conv(F.hex(octet), 16, 10).cast("int"), (F.col("_bit") % 8).cast("int")) == 1
    same = (placed["_file"] == marks["_file"]) & (placed["_block"] == marks["_block"]) & set_
    return placed.join(F.broadcast(marks), same, "left_semi")
