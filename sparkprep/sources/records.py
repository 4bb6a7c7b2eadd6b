"""Records of delimited text whose quoted fields hold line breaks, read by many tasks.

Whether a line begins inside quotes depends on all lines before it. A line is therefore seen as a function: from
the state at its begin (inside quotes or not) to the state at its end. Functions of the lines of
a file split compose to the function of the split, a small table with one row per split; a running composition over
the splits of a file gives the state each split begins with. A second scan then cuts records where lines end outside
quotes. Only records that cross a split are put together by a shuffle: at most two pieces per split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkprep.workspace import land

# A line's function as a bit for each state at its begin: set where the line then ends inside quotes.
FROM_OUTSIDE, FROM_INSIDE = 1, 2
KEEPS = FROM_INSIDE  #: the function of a line without quotes
SWAPS = FROM_OUTSIDE

_RECORDS = "file string, start long, kind int, record string"
#: Kinds of what a split yields: whole records, the first one of a file, and pieces at its begin and end.
WHOLE, FIRST, HEAD, OPEN_HEAD, TAIL = range(5)


def _in_quotes_at_end(line: Column, sep: str) -> Column:
    """Whether a field opened in ``line`` is still open at its end.

    A field is quoted only if a quote is its first character; doubled quotes do not close it.
    """
    begin = rf"(?:^|\Q{sep}\E)"
    closed = F.regexp_replace(line, begin + r'"[^"]*+(?:""[^"]*+)*+"', "x")
    return closed.rlike(begin + '"')


def line_function(line: Column, sep: str) -> Column:
    """The function of one line, as bits."""
    outside = F.when(_in_quotes_at_end(line, sep), FROM_OUTSIDE).otherwise(0)
    inside = F.when(_in_quotes_at_end(F.concat(F.lit('"'), line), sep), FROM_INSIDE).otherwise(0)
    return F.when(F.instr(line, '"') == 0, KEEPS).otherwise(outside + inside).cast("int")


def lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """file, start of the split, line and its function, in the order of the file within each split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
        line_function(F.col("value"), sep).alias("does"),
    )


def states_before(does: np.ndarray, state: int) -> np.ndarray:
    """Whether each line begins inside quotes (1) or not (0), and last the state after them all."""
    swaps = np.concatenate([[0], np.cumsum(does == SWAPS)])
    settles = (does == 0) | (does == FROM_OUTSIDE + FROM_INSIDE)
    # Number of the line that last settled the state whatever it was before; 0: none yet.
    last = np.concatenate([[0], np.maximum.accumulate(np.where(settles, np.arange(1, len(does) + 1), 0))])
    settled = np.concatenate([[state], does != 0])[last]
    return settled.astype(np.int64) ^ ((swaps - swaps[last]) & 1)


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: the composition of its lines."""
    split, ends = None, (0, 1)

    def row() -> pa.RecordBatch:
        does = ends[0] * FROM_OUTSIDE + ends[1] * FROM_INSIDE
        return pa.RecordBatch.from_arrays(
            [pa.array([split[0]]), pa.array([split[1]], pa.int64()), pa.array([does], pa.int32())],
            ["file", "start", "does"],
        )

    for batch in batches:
        for own, part in _by_split(batch):
            if split is not None and own != split:
                yield row()
            if own != split:
                split, ends = own, (0, 1)
            does = part.column("does").to_numpy()
            ends = tuple(int(states_before(does, e)[-1]) for e in ends)
    if split is not None:
        yield row()


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Neighbouring rows of one split."""
    if not batch.num_rows:
        return
    files = batch.column("file").dictionary_encode()
    numbers, starts = files.indices.to_numpy(), batch.column("start").to_numpy()
    cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (starts[1:] != starts[:-1])) + 1
    for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield (files.dictionary[int(numbers[s])].as_py(), int(starts[s])), batch.slice(s, e - s)


def split_states(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """file, start, and the states (inside quotes: 1) that every split begins and ends with; landed, one row per split."""
    functions = lines(spark, path, sep).select("file", "start", "does").mapInArrow(
        _split_functions, "file string, start long, does int"
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    swap = (F.col("does") == SWAPS).cast("long")
    settles = F.col("does").isin(0, FROM_OUTSIDE + FROM_INSIDE)
    marked = functions.withColumn("swaps", F.sum(swap).over(through)).withColumn(
        "settled", F.when(settles, F.struct((F.col("does") != 0).cast("long").alias("to"), "swaps"))
    )
    last = F.last("settled", ignorenulls=True).over(before)
    swapped = F.coalesce(F.sum(swap).over(before), F.lit(0)) - F.coalesce(last["swaps"], F.lit(0))
    state = (F.coalesce(last["to"], F.lit(0)) + swapped) % 2
    begun = marked.select("file", "start", "does", state.cast("int").alias("state"))
    end = F.getbit("does", "state").cast("int").alias("end")
    return land(begun.select("file", "start", "state", end), "split-states")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split, and the pieces at its ends."""
    split, state = None, 0
    seen = first = False  # whether a record has begun in this split; whether the file's first is to come
    held: list[str] = []  # lines of the record that is open

    def out(found: pa.Array, kinds: list[int]) -> pa.RecordBatch:
        n = len(found)
        columns = [
            pa.array([split[0]] * n, pa.string()),
            pa.array([split[1]] * n, pa.int64()),
            pa.array(kinds, pa.int32()),
            found,
        ]
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "kind", "record"])

    def rest() -> Iterator[pa.RecordBatch]:
        if held:  # nothing closed it in this split
            yield out(pa.array(["\n".join(held)], pa.string()), [TAIL if seen else OPEN_HEAD])

    for batch in batches:
        for own, part in _by_split(batch):
            if own != split:
                yield from rest()
                split, state, held = own, part.column("state")[0].as_py(), []
                if state is None:
                    raise RuntimeError("the splits of the files changed between two scans; read them again")
                seen, first = not state, own[1] == 0
            at = states_before(part.column("does").to_numpy(), state)
            state = int(at[-1])
            text = part.column("line")
            single = (at[:-1] == 0) & (at[1:] == 0)
            alone = np.flatnonzero(single)
            kinds = np.full(len(alone), WHOLE)
            if first and single[0] and not held:
                kinds[0], first = FIRST, False
            if len(alone):
                yield out(text.take(pa.array(alone)), kinds.tolist())
            joined, kinds = [], []
            for i in np.flatnonzero(~single).tolist():
                held.append(text[i].as_py())
                seen = seen or not at[i]
                if not at[i + 1]:
                    joined.append("\n".join(held))
                    kinds.append(HEAD if not seen else FIRST if first else WHOLE)
                    held, seen, first = [], True, False
            if joined:
                yield out(pa.array(joined, pa.string()), kinds)
    if split is not None:
        yield from rest()


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """One row per record of the files at ``path``: first (whether it is its file's first) and record.

    Line breaks inside quoted fields belong to the record; what a file ends in the middle of is a record
    too. Files are split as Spark splits text, wherever the cut falls.
    """
    states = split_states(spark, path, sep)
    # One row for each split of the files, some 100 bytes per 128 MB of input.
    read = lines(spark, path, sep).join(F.broadcast(states), ["file", "start"], "left")
    is_first = (F.col("kind") == FIRST).alias("first")
    done = read.mapInArrow(_records, _RECORDS).where(F.col("kind") <= FIRST).select(is_first, "record")
    # Pieces lie in splits that begin or end inside quotes; most files have few or none.
    crossing = states.where((F.col("state") == 1) | (F.col("end") == 1))
    if not crossing.isEmpty():
        some = lines(spark, path, sep).join(F.broadcast(crossing), ["file", "start"])
        pieces = some.mapInArrow(_records, _RECORDS).where(F.col("kind") > FIRST)
        in_file = Window.partitionBy("file").orderBy("start", "kind")
        numbered = pieces.withColumn("number", F.sum((F.col("kind") == TAIL).cast("int")).over(in_file))
        parts = F.array_sort(F.collect_list(F.struct("start", "kind", "record")))
        joined = numbered.groupBy("file", "number").agg(
            F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record")
        )
        done = done.unionByName(joined.select(F.lit(False).alias("first"), "record"))
    return done.withColumn("record", F.regexp_replace("record", "\r$", ""))
