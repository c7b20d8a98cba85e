"""CSV records with line breaks inside quotes, read from files that many tasks share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

_LINES = "file string, block long, n long, inside boolean, odd boolean, since_out long, since_in long, value string"


def _numbered(batches):
    """Number of each line in its piece of a file, and whether it is inside quotes if the piece starts outside.

    ``since_out`` and ``since_in``: the last line so far, this one included, that is not inside, and that is; -1 if none.
    """
    last, lines, quotes, since = None, 0, 0, [-1, -1]
    for b in batches:
        if not b.num_rows:
            continue
        file, block, value = (b.column(c) for c in ("file", "block", "value"))
        same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        first = np.r_[(file[0].as_py(), block[0].as_py()) != last, ~same.astype(bool)]
        at = np.arange(b.num_rows)
        start = np.maximum.accumulate(np.where(first, at, -1))
        found = pc.count_substring(value, '"').to_numpy().astype(np.int64)
        before = np.cumsum(found) - found
        n = np.where(start < 0, lines + at, at - start)
        inner = np.where(start < 0, quotes + before, before - before[start])
        last, lines, quotes = (file[-1].as_py(), block[-1].as_py()), n[-1] + 1, inner[-1] + found[-1]
        places = []
        for inside in (0, 1):
            hit = np.maximum.accumulate(np.where(inner % 2 == inside, at, -1))
            place = np.where(hit >= np.maximum(start, 0), n[hit], np.where(start < 0, since[inside], -1))
            since[inside] = place[-1]
            places.append(pa.array(place))
        columns = [file, block, pa.array(n), pa.array(inner % 2 == 1), pa.array(found % 2 == 1), *places, value]
        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "n", "inside", "odd", "since_out", "since_in", "value"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block``, ``n`` (place of its first line) and ``text`` of each CSV record that is not blank.

    Lines are read in pieces of files. A piece only knows how many quotes it has; whether it starts inside quotes is the parity
    of all quotes in earlier pieces of its file, summed over one row per piece. A line that is a record stays where it was read, and only
    lines of records with breaks are shuffled, by the place where the record starts. Quotes must be those around cells, or
    doubled inside them, and lines end in ``\\n`` or ``\\r\\n``; where the first line of a file ends in ``\\r\\n``, breaks in its cells become ``\\n``,
    as they do when Spark reads the file whole. Lines are written once, as pieces may be cut otherwise when read again.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    lines = materialize(raw.mapInArrow(_numbered, _LINES), "lines")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    pieces = (
        lines.groupBy("file", "block")
        .agg(
            F.count_if("odd").alias("_odd"), F.max("since_out").alias("_if_out"), F.max("since_in").alias("_if_in"),
            F.max((F.col("block") == 0) & (F.col("n") == 0) & F.col("value").endswith("\r")).alias("_cr"),
        )
        .withColumn("open", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2 == 1)
        .withColumn("_last", F.when(F.col("open"), F.col("_if_in")).otherwise(F.col("_if_out")))
        .withColumn("_start", F.when(F.col("_last") >= 0, F.struct("block", F.col("_last").alias("n"))))
        .select(
            "file", "block", "open", F.last("_start", ignorenulls=True).over(earlier).alias("carried"),
            F.max("_cr").over(W.partitionBy("file")).alias("crlf"),
        )
    )
    placed = lines.join(materialize(pieces, "pieces"), ["file", "block"]).withColumn("first", F.col("inside") == F.col("open"))
    placed = placed.withColumn("value", F.when(F.col("crlf"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value")))
    alone = F.col("first") & ~F.col("odd")
    since = F.when(F.col("open"), F.col("since_in")).otherwise(F.col("since_out"))
    here = F.when(since >= 0, F.struct("block", since.alias("n")))
    broken = placed.where(~alone).withColumn("_start", F.coalesce(here, "carried"))
    joined = broken.groupBy("file", F.col("_start.block").alias("block"), F.col("_start.n").alias("n")).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), F.col("n").alias("m"), "value"))), lambda x: x["value"]),
            "\n",
        ).alias("text")
    )
    out = placed.where(alone).select("file", "block", "n", F.col("value").alias("text")).unionByName(joined)
    return out.withColumn("text", F.regexp_replace("text", r"^\x{FEFF}|\r\z", "")).where("text <> ''")
