"""Exact random selection: a fixed number of rows per class, without sorting the table.

Rows are ordered by the hash of seed and key, rows that share a key by the hash of all their
columns; the order does not depend on partitioning, and a tie is settled within its key. The hash that ends each part is found by counting hash prefixes (4096 per
class and round, merged within each task) and narrowing the prefix the cut falls into, so
choosing rows is a map-only comparison. The same comparison in any SQL engine picks the
same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkprep.functions.columns import col, require, small_frame

PREFIX_DIGITS = 3
HASH_DIGITS = 32
AFTER = "~"  #: after every digit: a key's hash with it ends all rows of that key
SLOT_ROWS = 1_000
CHUNK_ROWS = 1_000_000


def row_hash(names: Sequence[str], seed: int) -> Column:
    """MD5 of seed and columns as 32 hex digits; missing values count as empty text."""
    parts = [F.coalesce(col(n).cast("string"), F.lit("")) for n in names]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


@dataclass
class Cut:
    """The hash of the last row before a cut.

    ``ties`` rows share that hash and ``taken`` of them lie before the cut.
    """

    last: str
    taken: int
    ties: int

    @property
    def clean(self) -> bool:
        return self.taken == self.ties


def class_counts(hashed: DataFrame, max_classes: int = 100_000) -> dict:
    """Rows per class. The driver holds a few numbers for each, so more than ``max_classes`` are an error."""
    rows = (
        hashed.groupBy("__class").agg(F.count(F.lit(1)).alias("n")).limit(max_classes + 1).collect()
    )
    if len(rows) > max_classes:
        raise ValueError(f"the label has more than {max_classes} classes")
    return {r["__class"]: r["n"] for r in rows}


def find_cuts(
    hashed: DataFrame, positions: Mapping[object, Sequence[int]], whole_digits: int = HASH_DIGITS
) -> dict:
    """For each class and number of leading rows, the hash that ends them.

    ``hashed`` has the columns ``__class``, ``__hash`` of ``whole_digits`` digits and ``__key_hash``, its first ones. A round counts the next digits
    within the slots that hold a cut; a slot with few rows is resolved to whole hashes.
    """
    # (class, position) -> (hash prefix the cut lies in, rows of the class before it)
    wide = {(k, p): ("", 0) for k, cuts in positions.items() for p in cuts if p > 0}
    narrow: dict = {}
    found: dict = {}
    digits = 0
    while wide:
        upto = min(digits + PREFIX_DIGITS, whole_digits)
        following: dict = {}
        for cut, (slot, before, n) in _refine(hashed, wide, digits, upto).items():
            if upto == whole_digits:
                found[cut] = Cut(slot, cut[1] - before, n)
            elif n <= SLOT_ROWS:
                narrow[cut] = (slot, before)
            else:
                following[cut] = (slot, before)
        known = upto
        if narrow and upto < HASH_DIGITS < whole_digits:
            # A key that one row of the class has ends a part without the hash of whole rows.
            keys = _refine(hashed, narrow, upto, HASH_DIGITS)
            found.update({c: Cut(h + AFTER, 1, 1) for c, (h, _, n) in keys.items() if n == 1})
            narrow, known = {c: (h, before) for c, (h, before, n) in keys.items() if n > 1}, HASH_DIGITS
        if narrow:
            whole = _refine(hashed, narrow, known, whole_digits)
            found.update({c: Cut(h, c[1] - before, n) for c, (h, before, n) in whole.items()})
            narrow = {}
        wide, digits = following, upto
    return found


def _refine(hashed: DataFrame, cuts: Mapping, known: int, digits: int) -> dict:
    """Cut -> (slot of ``digits`` digits it lies in, rows before the slot, rows in it).

    The running sum is taken over counted slots: 4096 per class and round, or the few
    whole hashes of a small slot.
    """
    wanted = _cut_frame(hashed, cuts)
    # Digits of the key's hash do not need the hash of the whole row.
    source = "__key_hash" if digits <= HASH_DIGITS else "__hash"
    outer = F.substring(source, 1, known) if known else F.lit("")
    open_slots = F.broadcast(wanted.select("__class", "__outer").distinct())
    within = hashed.withColumn("__outer", outer).join(
        open_slots, ["__class", "__outer"], "left_semi"
    )
    slots = within.groupBy("__class", "__outer", F.substring(source, 1, digits).alias("__slot"))
    running = Window.partitionBy("__class", "__outer").orderBy("__slot")
    counted = slots.agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(running))
    hits = (
        counted.join(F.broadcast(wanted), ["__class", "__outer"])
        .where("upto >= __need AND upto - n < __need")
        .collect()
    )
    result = {}
    for h in hits:
        cut = (h["__class"], h["__position"])
        result[cut] = (h["__slot"], cuts[cut][1] + h["upto"] - h["n"], h["n"])
    return result


def _cut_frame(hashed: DataFrame, cuts: Mapping) -> DataFrame:
    """Open cuts as a frame; at most classes x cuts rows, both bounded."""
    rows = [
        (str(k), prefix, position, position - before)
        for (k, position), (prefix, before) in cuts.items()
    ]
    return _class_frame(hashed, rows, "__outer string, __position long, __need long")


def with_hash(df: DataFrame, key: Sequence[str] | None, seed: int, label: str | None) -> DataFrame:
    """``df`` with ``__class``, ``__key_hash`` (32 digits of the key) and ``__hash`` (these, then 32 of the whole row).

    Without a key the row's hash alone is taken. Columns of the whole row go by name, so their order
    in the table does not matter.
    """
    names = list(key) if key else df.columns
    require(df, [*names, *([label] if label else [])])
    stratum = col(label) if label else F.lit("all")
    order = row_hash(names, seed)
    whole = F.concat(order, row_hash(sorted(df.columns), seed)) if key else order
    return df.withColumns({"__class": stratum, "__key_hash": order, "__hash": whole})


def assign_parts(
    df: DataFrame,
    parts: Sequence[str],
    quotas: Mapping[object, Sequence[int]],
    out: str,
    key: Sequence[str] | None,
    seed: int,
    label: str | None = None,
) -> DataFrame:
    """Tag exactly ``quotas[class][i]`` rows of each class with ``parts[i]``.

    ``key`` names the columns that identify a row. Rows that share a key are told apart by
    all their columns; wholly equal rows are interchangeable and shared out by number.
    """
    positions = {k: _cumulative(q)[:-1] for k, q in quotas.items()}
    hashed = with_hash(df, key, seed, label)
    cuts = find_cuts(hashed.select("__class", "__key_hash", "__hash"), positions, HASH_DIGITS * (2 if key else 1))

    # One row per class with the last hash of each part; the classes are bounded.
    rows = []
    for k, ends in positions.items():
        found = [cuts.get((k, p)) for p in ends]
        rows.append((str(k), *[None if c is None else c.last for c in found]))
    names = [f"__end{i}" for i in range(len(parts) - 1)]
    ends = _class_frame(hashed, rows, ", ".join(f"{n} string" for n in names))
    tag = F.lit(parts[-1])
    by_key = all(c.last.endswith(AFTER) for c in cuts.values())
    for part, name in reversed(list(zip(parts, names))):
        tag = F.when(F.col("__key_hash" if by_key else "__hash") <= F.col(name), F.lit(part)).otherwise(tag)
    kept = [col(c) for c in df.columns]

    torn = {(k, c.last) for (k, _), c in cuts.items() if not c.clean}
    joined = hashed.join(F.broadcast(ends), "__class")
    if not torn:
        return joined.select(*kept, tag.alias(out))
    pairs = _class_frame(hashed, [(str(k), last) for k, last in torn], "__hash string")
    whole = joined.join(F.broadcast(pairs), ["__class", "__hash"], "left_anti")
    equal = hashed.join(F.broadcast(pairs), ["__class", "__hash"], "left_semi")
    shared = _share_out(equal, parts, positions, cuts, torn, out)
    return whole.select(*kept, tag.alias(out)).unionByName(shared.select(*kept, col(out)))


def _class_frame(hashed: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    frame = small_frame(hashed.sparkSession, rows, f"__class string, {schema}")
    return frame.withColumn("__class", F.col("__class").cast(hashed.schema["__class"].dataType))


def _share_out(
    rows: DataFrame, parts: Sequence[str], positions: Mapping, cuts: Mapping, torn: set, out: str
) -> DataFrame:
    """Divide groups of equal rows by number: reduce each to one row, then repeat it."""
    pieces = []
    for k, last in torn:
        ends, ties = [], 0
        for position in positions[k]:
            cut = cuts.get((k, position))
            if cut is None or cut.last < last:
                ends.append(0)
            elif cut.last == last:
                ends.append(cut.taken)
                ties = cut.ties
            else:
                ends.append(None)
        start = 0
        for part, end in zip(parts, [ties if e is None else e for e in ends] + [ties]):
            for first in range(start, end, CHUNK_ROWS):
                pieces.append((str(k), last, part, first, min(CHUNK_ROWS, end - first)))
            start = max(start, end)
    plan = _class_frame(
        rows, pieces, f"__hash string, `{out}` string, __first long, __times long"
    )
    spread = rows.distinct().join(plan, ["__class", "__hash"]).repartition("__class", "__first")
    return spread.withColumn(
        "__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))
    )


def _cumulative(quota: Sequence[int]) -> list[int]:
    total, result = 0, []
    for q in quota:
        total += q
        result.append(total)
    return result


def exact_sample(
    df: DataFrame, n: int, key: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Exactly ``n`` rows drawn uniformly, or the table itself when it has no more."""
    total = df.count()
    if total <= n:
        return df
    tagged = assign_parts(df, ["in", "out"], {"all": [n, total - n]}, "__part", key, seed)
    return tagged.where(F.col("__part") == "in").drop("__part")
