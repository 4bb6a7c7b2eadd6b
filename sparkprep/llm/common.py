"""What several operators share: tables in the shared folder, rows by group, connected groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.workspace import run_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Whether a query's shuffle files are deleted when it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the folder that ``spark.checkpoint.dir`` names.

    A written table ends the lineage: a lost executor costs the tasks at hand only. A table
    that nothing reads any more is deleted with ``drop``. With ``tidy`` the shuffle files of a table go as soon as
    it is written.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark, self.name, self.tidy = spark, name, tidy

    def keep(self, df: DataFrame, step: str) -> DataFrame:
        path = run_path(self.spark, f"{self.name}-{step}")
        before = self.spark.conf.get(TIDY)
        if self.tidy:
            self.spark.conf.set(TIDY, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(TIDY, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            path.getFileSystem(conf).delete(path, True)


def by_group(
    df: DataFrame,
    key: str,
    function: Callable[[pa.Table, np.ndarray], dict[str, object] | None],
    schema: str,
) -> DataFrame:
    """Apply ``function`` to rows brought together by the integer column ``key``.

    ``function`` gets a table of whole groups in order of ``key`` and the row numbers at
    which groups begin (and the end), and returns columns by name. Groups must be bounded:
    callers deal large ones to several keys first.
    """
    from pyspark.sql.types import StructType

    names = [f.name for f in StructType.fromDDL(schema)]
    dealt = df.repartition(key).sortWithinPartitions(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(table: pa.Table, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            out = function(table.combine_chunks(), bounds)
            if out is not None and len(out[names[0]]):
                yield pa.RecordBatch.from_arrays([pa.array(out[n]) for n in names], names)

        waiting: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = table.column(key).to_numpy()
            if waiting and waiting[0].column(key)[0].as_py() != keys[0]:
                held = pa.concat_tables(waiting)
                yield from done(held, held.column(key).to_numpy())
                waiting = []
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:  # the last group may go on in the next batch
                head = pa.concat_tables([*waiting, table.slice(0, cut)])
                yield from done(head, head.column(key).to_numpy())
                waiting = []
            waiting.append(table.slice(cut))
        if waiting:
            held = pa.concat_tables(waiting)
            yield from done(held, held.column(key).to_numpy())

    return dealt.mapInArrow(run, schema)


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): the smallest node it is connected with.

    In each round every node hooks on to its smallest neighbour, two jumps shorten the
    chains, and links are renamed to the new labels; those that join one label go. Groupings
    merge partially. Joins have unique keys on one side; the links of one node meet on the other where adaptive
    execution does not split them.
    """
    pairs = links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    pairs = scratch.keep(pairs.distinct(), "links")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = scratch.keep(nodes.select("node", F.col("node").alias("root")), "labels")
    while not pairs.isEmpty():
        hooked = scratch.keep(pairs.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "hooks")
        one = hooked
        for _ in range(2):
            further = hooked.select(F.col("node").alias("up"), F.col("up").alias("top"))
            one = one.join(further, "up", "left").select(
                "node", F.coalesce("top", "up").alias("up")
            )
        one = scratch.keep(one, "jumps")

        def renamed(df: DataFrame, column: str, to: DataFrame = one) -> DataFrame:
            to = to.select(F.col("node").alias(column), F.col("up").alias("__up"))
            rest = [c for c in df.columns if c != column]
            return df.join(to, column, "left").select(
                *rest, F.coalesce("__up", column).alias(column)
            )

        left = renamed(renamed(pairs, "a"), "b").where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
        left = scratch.keep(left.distinct(), "links")
        named = scratch.keep(renamed(labels, "root").select("node", "root"), "labels")
        scratch.drop(pairs, hooked, one, labels)
        pairs, labels = left, named
    scratch.drop(pairs)
    return labels


MAP_BITS = 24  #: log2 of the bits of a map (2 MB)


class BitMap:
    """A set of well mixed 64-bit keys as a map of ``2 ** MAP_BITS`` bits.

    Its size is fixed, whatever is in it, so it can be broadcast. It may hold too much, never too
    little: for leaving out rows early that a later join would drop.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, df: DataFrame, key: str) -> BitMap:
        """Built from a grouping by 64-bit words of the map: 4 MB reach the driver at most."""
        place = F.shiftrightunsigned(key, 64 - MAP_BITS)
        word, bit = F.shiftright(place, 6), place.bitwiseAND(63).cast("int")
        one = F.expr("shiftleft(1L, bit)")
        rows = df.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(one).alias("bits"))
        found = rows.toPandas()
        bits = np.zeros(1 << (MAP_BITS - 6), dtype=np.uint64)
        bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
        return cls(bits)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        place = keys.view(np.uint64) >> np.uint64(64 - MAP_BITS)
        return (self.bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    def sift(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of ``df`` whose ``key`` the map holds, found in the tasks that scan them."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(shared.value.holds(batch.column(key).to_numpy())))

        return df.mapInArrow(run, df.schema)


class Forest:
    """Union of a bounded set of numbered nodes within a task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def blocks_of(members: DataFrame, group: str, chunks: str, member: str) -> DataFrame:
    """``members`` once for each block of the group that compares them with others.

    A group's members are dealt to ``chunks`` parts by hash; each pair of parts, and each
    part with itself, is one block with the key ``block``. A pair of members of different
    parts meets in the one block whose ``low`` and ``high`` are their ``part``.
    """
    part = F.pmod(F.xxhash64(F.lit("part"), member), F.col(chunks)).cast("long")
    dealt = members.withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(chunks).cast("long") - 1))
    )
    dealt = dealt.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    return dealt.withColumn("block", F.xxhash64(group, "low", "high")).drop("other")


def block_pairs(parts: np.ndarray, low: int, high: int) -> np.ndarray:
    """Which pairs (i < j) of a block's members are this block's to compare."""
    n = len(parts)
    upper = np.triu(np.ones((n, n), dtype=bool), 1)
    return upper if low == high else upper & (parts[:, None] != parts[None, :])
