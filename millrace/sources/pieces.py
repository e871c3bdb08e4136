"""Large quoted CSV files and JSON arrays read by many tasks.

A file is read in pieces between occurrences of one character: lines for CSV, what stands before each
closing brace for JSON. Spark splits the file into blocks at such places. What a piece means
depends on the state before it (inside quotes or not, how deep), and that is a scan: each block's effect
on the state is summed in its task, the few effects are added up along each file, and
with the state at its start known, each block marks and joins its pieces. Only what crosses a
block's end moves to another one. Records then go through Spark's own ``from_csv`` and ``from_json``.

The file is shuffled once, by block. Compressed files can't be split and are one block each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

# Where a piece stands: its file, the first byte of its block, and a number that rises along the block.
PLACE = ("_file", "_block", "_at")
BLOCK = ("_file", "_block")


def text_pieces(reader, path: str, separator: str) -> DataFrame:
    """The pieces of the files with their file and block, by a batch or streaming reader."""
    pieces = reader.option("lineSep", separator).text(path)
    return pieces.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
    )


def placed(pieces: DataFrame) -> DataFrame:
    """The pieces with their number in the block: a block's pieces are read in order by one task."""
    return pieces.withColumn("_at", F.monotonically_increasing_id())


def _along_block(upto: int) -> Window:
    return Window.partitionBy(*BLOCK).orderBy("_at").rowsBetween(Window.unboundedPreceding, upto)


def _along_file() -> Window:
    return Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def _before(value: Column, window: Window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _occurrences(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("bigint")


def joined(marked: DataFrame, separator: str) -> DataFrame:
    """Records from pieces with ``_first`` (it begins a record): the place and other columns of the first piece, and the text.

    Pieces of a block are put together where they are, in the file's order. Those that continue a record of an earlier
    block are put behind that block's last one. Pieces before the first record of a file belong to none.
    """
    known = marked.withColumn("_record", F.sum(F.col("_first").cast("int")).over(_along_block(0)))
    listed = F.sort_array(F.collect_list(F.when(F.col("_record") == 0, F.struct("_at", "value"))))
    blocks = known.groupBy(*BLOCK).agg(F.max("_record").alias("_records"), listed.alias("_head"))
    begun = F.last(F.when(F.col("_records") > 0, F.struct("_block", "_records")), ignorenulls=True).over(_along_file())
    heads = blocks.withColumn("_home", begun).where((F.size("_head") > 0) & F.col("_home").isNotNull())
    text = lambda pieces: F.array_join(F.transform(pieces, lambda p: p["value"]), separator)
    ordered = F.sort_array(F.collect_list(F.struct("_block", text(F.col("_head")).alias("value"))))
    tails = heads.groupBy("_file", "_home").agg(text(ordered).alias("_tail"))
    tails = tails.select("_file", F.col("_home._block").alias("_block"), F.col("_home._records").alias("_last"), "_tail").alias("tails")
    record = Window.partitionBy(*BLOCK, "_record").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = known.where("_record > 0").withColumn("value", F.array_join(F.collect_list("value").over(record), separator))
    # A block has one tail, of its last record. Joined by block, as the pieces are dealt already, they are not shuffled again.
    own = own.where("_first").alias("own")
    same = [F.col(f"own.{c}") == F.col(f"tails.{c}") for c in BLOCK]
    whole = own.join(tails, [*same, F.col("own._record") >= F.col("tails._last")], "left").select("own.*", "tails._tail")
    value = F.when(F.col("_tail").isNull(), F.col("value")).otherwise(F.concat_ws(separator, "value", "_tail"))
    others = [c for c in marked.columns if c not in (*PLACE, "value", "_first")]
    return whole.select(*PLACE, value.alias("value"), *others)


def csv_records(pieces: DataFrame, quote: str = '"') -> DataFrame:
    """The records of quoted CSV files from their lines: place, ``value``, ``_header`` (the file's first record).

    A quote in a cell stands doubled in a quoted cell; a record with a quote elsewhere is an error, as it can't be
    told where it ends. A file whose first line ends with a carriage return
    has such line ends throughout; they become line feeds.
    """
    lines = placed(pieces).withColumn("_quotes", _occurrences(F.col("value"), quote))
    lines = lines.withColumn("_return", F.col("value").endswith("\r"))
    blocks = lines.groupBy(*BLOCK).agg(F.sum("_quotes").alias("_sum"), F.min_by("_return", "_at").alias("_first_return"))
    whole_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entered = blocks.select(
        *BLOCK,
        (_before(F.col("_sum"), _along_file()) % 2).alias("_entry"),
        F.first("_first_return").over(whole_file).alias("_returns"),
        F.first("_block").over(whole_file).alias("_top"),
    )
    known = lines.join(entered, list(BLOCK))
    inside = (F.col("_entry") + _before(F.col("_quotes"), _along_block(-1))) % 2 == 1
    text = F.when(F.col("_returns") & F.col("_return"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    filled = F.sum((F.col("value") != "").cast("int")).over(_along_block(0))
    marked = known.select(
        *PLACE,
        text.alias("value"),
        *(c for c in pieces.columns if c not in (*PLACE, "value")),
        ((F.col("_block") == F.col("_top")) & (filled == 1) & (F.col("value") != "")).alias("_header"),
        (~inside).alias("_first"),
    )
    records = joined(marked, "\n").where(F.col("value") != "")
    # Between quoted cells stands a delimiter at both ends, and nothing where a quote is doubled.
    parts = F.split("value", quote)
    last = F.size(parts) - 1
    wrong = F.filter(
        parts,
        lambda t, i: (i % 2 == 0) & (t != "") & ~(((i == 0) | t.startswith(",")) & ((i == last) | t.endswith(","))),
    )
    fits = F.size(wrong) == 0
    message = F.concat(F.lit("a quote stands outside a quoted cell in "), "_file", F.lit(": read the file whole"))
    sound = F.when(~F.col("value").contains(quote) | fits, F.col("value")).otherwise(F.raise_error(message))
    return records.withColumn("value", sound)


def json_elements(pieces: DataFrame) -> DataFrame:
    """The objects of JSON array files from their pieces before closing braces: place and ``value``.

    An escape is never cut by a brace, so a piece's effect is told by its quotes without escaped ones, and
    by its opening braces outside of strings, for either state it may be entered in.
    """
    bare = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')

    def opened(inside: int) -> Column:
        outside = F.filter(F.col("_bare"), lambda _, i: i % 2 == inside)
        return _occurrences(F.array_join(outside, ""), "{")

    cut = placed(pieces).withColumn("_bare", bare)
    cut = cut.withColumns({"_quotes": (F.size("_bare") - 1).cast("bigint"), "_open0": opened(0), "_open1": opened(1)}).drop("_bare")

    def step(entry: Column) -> tuple[Column, Column]:
        """Opening braces and the change of depth, for the state at the block's start; a brace in a string closes nothing."""
        inside = (entry + F.col("_quotes_before")) % 2
        opens = F.when(inside == 0, F.col("_open0")).otherwise(F.col("_open1"))
        closes = ((inside + F.col("_quotes")) % 2 == 0).cast("bigint")
        return opens, opens - closes

    seen = cut.withColumn("_quotes_before", _before(F.col("_quotes"), _along_block(-1)))
    sums = [F.sum(step(F.lit(s))[1]).alias(f"_depth{s}") for s in (0, 1)]
    blocks = seen.groupBy(*BLOCK).agg(F.sum("_quotes").alias("_sum"), *sums)
    entered = blocks.withColumn("_entry", _before(F.col("_sum"), _along_file()) % 2)
    change = F.when(F.col("_entry") == 0, F.col("_depth0")).otherwise(F.col("_depth1"))
    entered = entered.select(*BLOCK, "_entry", _before(change, _along_file()).alias("_depth"))
    opens, change = step(F.col("_entry"))
    known = seen.join(entered, list(BLOCK)).select(
        "*", opens.alias("_opens"), (F.col("_depth") + _before(change, _along_block(-1))).alias("_depth_before")
    )
    first = (F.col("_depth_before") == 0) & (F.col("_opens") > 0)
    marked = known.where((F.col("_depth_before") > 0) | first).select(
        *PLACE,
        "value",
        *(c for c in pieces.columns if c not in (*PLACE, "value")),
        first.alias("_first"),
    )
    # What stands before an element's first brace: the array's bracket, commas, blanks, a byte order mark.
    text = F.concat(F.regexp_replace("value", r"^[\s,\[﻿]+", ""), F.lit("}"))
    return joined(marked, "}").withColumn("value", text)


def read_csv_records(spark: SparkSession, path: str) -> DataFrame:
    return csv_records(text_pieces(spark.read, path, "\n"))


def read_json_elements(spark: SparkSession, path: str) -> DataFrame:
    return json_elements(text_pieces(spark.read, path, "}"))
