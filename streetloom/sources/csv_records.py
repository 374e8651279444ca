"""Records of CSV files whose quoted fields hold line breaks, read by many tasks a file.

A line break ends a record where the number of quotes before it in the file is even, as quotes stand only around
fields and doubled inside them (RFC 4180). Three steps over the files as lines of text:

1. One aggregate counts the quotes of every split; a running sum over a file's splits tells which of them begin
   inside quotes. It also takes the number of fields of each file's first line.
2. Of files with such splits, the pieces of records that cross a split border (the lines before the first and
   after the last record end of a split) are gathered and joined in file order: a few lines for each split.
3. Each task then cuts its own splits into whole records, in one pass and without moving a row.

Steps 1 and 2 run when called. The third relies on the same splits as the first: it fails with a message where
they differ, which needs files or the number of cores to change in between, rather than to cut records wrongly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom.session import checkpointed, ship_sources

_RECORDS = "file string, start bigint, number bigint, kind int, record string"
WHOLE, HEAD, TAIL = 0, 1, 2
MANY = 1_000  # files that a condition names; beyond, all are read


def count_fields(record: Column) -> Column:
    """Number of fields of a CSV record: commas outside quotes, and one."""
    bare = F.regexp_replace(record, '"(?:[^"]|"")*+"', "")
    return F.regexp_count(bare, F.lit(",")) + 1


def lines_of(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value")
    )


def split_table(lines: DataFrame) -> DataFrame:
    """(file, start, open, closed, width): one stored row for each split.

    ``open``: it begins inside quotes; ``closed``: it does not end inside them; ``width``: fields of the file's first line.
    """
    marks = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    at = F.monotonically_increasing_id()  # rises along a split
    counted = (
        lines.select("file", "start", marks.alias("marks"), at.alias("at"), F.when(F.col("start") == 0, F.col("value")).alias("line"))
        .groupBy("file", "start")
        .agg(F.sum("marks").alias("marks"), count_fields(F.min_by("line", "at")).alias("width"))
    )
    along = Window.partitionBy("file").orderBy("start")
    until = F.sum("marks").over(along)
    return checkpointed(
        counted.select(
            "file",
            "start",
            ((until - F.col("marks")) % 2 == 1).alias("open"),
            (until % 2 == 0).alias("closed"),
            F.first("width", True).over(along).alias("width"),
        )
    )


def first_widths(splits: DataFrame) -> DataFrame:
    """(file, width) of the first lines."""
    return splits.where(F.col("start") == 0).select("file", "width")


def _cut(lines: DataFrame, opens: dict[tuple[str, int], bool], quotes: bool) -> DataFrame:
    """Whole records, and the head and tail pieces of split-crossing ones; ``number`` counts a split's rows."""
    shared = lines.sparkSession.sparkContext.broadcast(opens)  # two words and a path for each split
    columns = [part.split()[0] for part in _RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        key, inside, head, number, rest = None, False, False, 0, []

        def row(kind: int, text: str) -> pa.RecordBatch:
            arrays = [pa.array([v], t) for v, t in ((key[0], pa.string()), (key[1], pa.int64()), (number, pa.int64()), (kind, pa.int32()))]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([text], pa.string())], columns)

        def left() -> Iterator[pa.RecordBatch]:
            if rest:
                yield row(HEAD if head else TAIL, "\n".join(rest))

        for batch in batches:
            files, starts = batch.column("file").to_pylist(), batch.column("start").to_numpy()
            values = batch.column("value")
            edges = [k for k in range(1, len(files)) if starts[k] != starts[k - 1] or files[k] != files[k - 1]]
            for a, b in zip([0, *edges], [*edges, len(files)], strict=True):
                if a == b:
                    continue
                if (files[a], int(starts[a])) != key:
                    yield from left()
                    key, number, rest = (files[a], int(starts[a])), 0, []
                    if key not in known:
                        raise RuntimeError(f"the splits of {key[0]} have changed since they were counted; read the files anew")
                    inside = head = known[key]
                part = values.slice(a, b - a)
                marks = pc.count_substring(part, '"').to_numpy() if quotes else np.zeros(len(part), np.int32)
                ends = np.flatnonzero((inside + np.cumsum(marks)) % 2 == 0) + 1
                inside = bool((inside + marks.sum()) % 2)
                froms = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                if not rest and not head and len(ends) == len(part):  # every line is a record
                    records = part
                else:
                    texts = part.to_pylist()
                    joined = ["\n".join(texts[s:e]) for s, e in zip(froms.tolist(), ends.tolist(), strict=True)]
                    if joined:
                        joined[0] = "\n".join([*rest, joined[0]])
                        rest = []
                    rest += texts[ends[-1] if len(ends) else 0 :]
                    records = pa.array(joined, pa.string())
                if not len(records):
                    continue
                kinds = np.full(len(records), WHOLE, np.int32)
                if head:
                    kinds[0], head = HEAD, False
                arrays = [
                    pa.array([key[0]] * len(records), pa.string()),
                    pa.array(np.full(len(records), key[1])),
                    pa.array(np.arange(number, number + len(records))),
                    pa.array(kinds),
                    records,
                ]
                number += len(records)
                yield pa.RecordBatch.from_arrays(arrays, columns)
        yield from left()

    ship_sources(lines.sparkSession)
    return lines.mapInArrow(run, _RECORDS)


def _crossing(lines: DataFrame, opens: dict[tuple[str, int], bool]) -> DataFrame:
    """Records that cross split borders, joined from their pieces, and what an unclosed quote leaves at a file's end."""
    pieces = _cut(lines, opens, True).where(F.col("kind") != WHOLE)
    along = Window.partitionBy("file").orderBy("start", "number")
    chain = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(along)
    joined = (
        pieces.withColumn("chain", chain)
        .groupBy("file", "chain")  # the pieces of one record
        .agg(F.array_sort(F.collect_list(F.struct("start", "number", "record"))).alias("parts"))
    )
    first = F.col("parts")[0]
    whole = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    return joined.select("file", first["start"].alias("start"), first["number"].alias("number"), whole.alias("record"))


def csv_records(
    spark: SparkSession, path: str, multi_line: bool = True, glob: str | None = None, width: int | None = None
) -> DataFrame:
    """(file, first, record): every record that is not blank; ``first`` marks that of a file.

    Line breaks inside quotes are kept as line feeds; without ``multi_line`` each line is a record. With ``width`` only
    files whose first line has so many fields are read.
    """
    lines = lines_of(spark, path, glob)
    splits = split_table(lines)
    rows = splits.select("file", "start", "open", "closed").collect()  # one for each split, that is for some 100 MB of text
    opens = {(r["file"], r["start"]): r["open"] and multi_line for r in rows}
    records = _cut(lines, opens, multi_line)
    unclosed = sorted({r["file"] for r in rows if not r["closed"]}) if multi_line else []
    if unclosed:
        # a condition on the file alone would prune files before they are split, and fewer files make other splits
        named = F.when(F.col("value").isNotNull(), F.col("file")).isin(unclosed)
        some = lines.where(named) if len(unclosed) <= MANY else lines
        crossing = checkpointed(_crossing(some, opens))
        records = records.where(F.col("kind") == WHOLE).drop("kind").unionByName(crossing)
    first = (F.col("start") == 0) & (F.col("number") == 0)
    named = records.select("file", first.alias("first"), "record").where(F.trim("record") != "")
    return named if width is None else named.join(first_widths(splits).where(F.col("width") == width), "file", "left_semi")


def as_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """``records`` with a struct ``row`` of the schema's columns; missing fields are null."""
    return records.withColumn("row", F.from_csv("record", as_ddl(schema), {"escape": '"'}))
