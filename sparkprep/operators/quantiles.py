"""Exact quantiles of many columns and groups, at every size by the same search.

A cell is a column, or a column within a group. ``percentile_approx`` proposes values of the cell
around each wanted rank, one pass counts the rows at and between the proposals, and the gap a
rank falls into is searched again until few enough rows lie in it to sort. All cells share
each round, which reads the columns twice and shuffles one sketch per task and gap and a few
counts; the counts, not the sketch, decide, so the result is exact. A gap shrinks about a
thousandfold per round, and a value that fills a large share of the cell is found at once.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkprep.functions.columns import col, number
from sparkprep.operators.state import approximate_quantiles
from sparkprep.workspace import land

#: A gap with at most so many rows is sorted in one buffer; it bounds that buffer.
INSIDE_ROWS = 20_000
#: Open gaps that are sent to every task; more are joined by hash, the values of a group in so many parts.
BROADCAST_GAPS, PARTS = 20_000, 8
GRID = 2_000
ACCURACY = 10_000


class Gap(NamedTuple):
    """Rows of a cell strictly between two values; None is no bound."""

    cell: int
    low: float | None
    high: float | None


class Open(NamedTuple):
    rows: int
    ranks: dict[int, int]  #: rank within the gap -> rank in the cell


def _gap_frame(spark: SparkSession, gaps: Sequence[Gap], extra: Sequence[tuple], fields: list) -> DataFrame:
    """One row per open gap; their number is bounded by the wanted ranks."""
    kinds = [("gap", pa.int32()), ("cell", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), *fields]
    columns = zip(*[(i, *g, *e) for i, (g, e) in enumerate(zip(gaps, extra))])
    return spark.createDataFrame(pa.table({n: pa.array(list(v), t) for (n, t), v in zip(kinds, columns)}))


def _inside(cells: DataFrame, frame: DataFrame) -> DataFrame:
    """The rows of each open gap."""
    above = F.col("low").isNull() | (F.col("v") > F.col("low"))
    below = F.col("high").isNull() | (F.col("v") < F.col("high"))
    return cells.join(F.broadcast(frame), "cell").where(above & below)


def _sorted_answers(cells: DataFrame, gaps: dict[Gap, Open]) -> dict[Gap, dict[int, float]]:
    """Order statistics of gaps with few rows, by sorting those rows."""
    ranks = [sorted(o.ranks) for o in gaps.values()]
    wanted = ("ranks", pa.list_(pa.int32()))
    frame = _gap_frame(cells.sparkSession, list(gaps), [(r,) for r in ranks], [wanted])
    ordered = _inside(cells, frame).groupBy("gap", "ranks").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    rows = ordered.select("gap", F.transform("ranks", lambda r: F.get(F.col("vs"), r)).alias("found")).collect()
    names = list(gaps)
    return {names[r["gap"]]: dict(zip(ranks[r["gap"]], r["found"])) for r in rows}


def _proposals(cells: DataFrame, gaps: dict[Gap, Open]) -> dict[Gap, list[float]]:
    """Per gap, values of the cell that enclose the wanted ranks closely."""
    places = []
    for o in gaps.values():
        at = {r / max(o.rows - 1, 1) * GRID for r in o.ranks}
        near = {max(0, math.floor(p) - 1) for p in at} | {min(GRID, math.ceil(p) + 1) for p in at}
        places.append((sorted(near),))
    wanted = ("places", pa.list_(pa.int32()))
    frame = _gap_frame(cells.sparkSession, list(gaps), places, [wanted])
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketched = _inside(cells, frame).groupBy("gap", "places").agg(
        F.percentile_approx("v", grid, ACCURACY).alias("sketch")
    )
    picked = F.transform("places", lambda p: F.get(F.col("sketch"), p))
    names = list(gaps)
    return {names[r["gap"]]: sorted(set(r["picked"])) for r in sketched.select("gap", picked.alias("picked")).collect()}


def _counts(cells: DataFrame, proposals: dict[Gap, list[float]]) -> dict[Gap, dict[int, int]]:
    """Rows per gap at each proposal (odd places) and between them (even places)."""
    gaps = list(proposals)
    widest = max(len(p) for p in proposals.values())
    bounds = [tuple(p) + (None,) * (widest - len(p)) for p in proposals.values()]
    fields = [(f"b{k}", pa.float64()) for k in range(widest)]
    frame = _gap_frame(cells.sparkSession, gaps, bounds, fields)
    place = F.lit(0)
    for k in range(widest):
        at = F.coalesce((F.col("v") >= F.col(f"b{k}")).cast("int"), F.lit(0))
        past = F.coalesce((F.col("v") > F.col(f"b{k}")).cast("int"), F.lit(0))
        place = place + at + past
    rows = _inside(cells, frame).groupBy("gap", place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
    counts: dict[Gap, dict[int, int]] = defaultdict(dict)
    for r in rows.collect():
        counts[gaps[r["gap"]]][r["place"]] = r["n"]
    return counts


def _order_statistics(
    cells: DataFrame, wanted: dict[int, set[int]], counts: dict[int, int]
) -> dict[int, dict[int, float]]:
    found: dict[int, dict[int, float]] = defaultdict(dict)
    gaps = {Gap(c, None, None): Open(counts[c], {r: r for r in ranks}) for c, ranks in wanted.items()}
    while gaps:
        few = {g: o for g, o in gaps.items() if o.rows <= INSIDE_ROWS}
        many = {g: o for g, o in gaps.items() if o.rows > INSIDE_ROWS}
        if few:
            for gap, answers in _sorted_answers(cells, few).items():
                for rank, answer in answers.items():
                    found[gap.cell][few[gap].ranks[rank]] = answer
        gaps = {}
        if not many:
            break
        proposals = _proposals(cells, many)
        placed = _counts(cells, proposals)
        for gap, o in many.items():
            edges = [gap.low, *proposals[gap], gap.high]
            passed = 0
            for place in sorted(placed[gap]):
                n = placed[gap][place]
                for rank, original in o.ranks.items():
                    if not passed <= rank < passed + n:
                        continue
                    if place % 2:
                        found[gap.cell][original] = edges[(place + 1) // 2]
                    else:
                        inner = Gap(gap.cell, edges[place // 2], edges[place // 2 + 1])
                        gaps.setdefault(inner, Open(n, {})).ranks[rank - passed] = original
                passed += n
    return found


def _between(position: float, low: float, high: float) -> float:
    if low == high:
        return low
    floor = math.floor(position)
    return (floor + 1 - position) * low + (position - floor) * high


def _quantiles_of_cells(
    cells: DataFrame, counts: dict[int, int], probabilities: Sequence[float]
) -> dict[int, list[float]]:
    positions = {c: [p * (n - 1) for p in probabilities] for c, n in counts.items()}
    ranks = {c: {r for x in xs for r in (math.floor(x), math.ceil(x))} for c, xs in positions.items()}
    found = _order_statistics(cells, ranks, counts)
    return {
        c: [_between(x, found[c][math.floor(x)], found[c][math.ceil(x)]) for x in xs]
        for c, xs in positions.items()
    }


def _values(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns as doubles; adding 0 makes the two zeros one."""
    return F.array(*[number(df, c) + F.lit(0.0) for c in columns])


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    counts: dict[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column over its non-null values.

    ``counts`` passes the non-null counts when the caller has them already.
    """
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if not columns:
        return result
    if counts is None:
        row = df.agg(*[F.count(number(df, c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
        counts = {c: row[f"c{i}"] for i, c in enumerate(columns)}
    filled = [c for c in columns if counts[c]]
    if filled:
        cells = df.select(F.posexplode(_values(df, filled)).alias("cell", "v")).where("v IS NOT NULL")
        cells = cells.select(F.col("cell").cast("long").alias("cell"), "v")
        found = _quantiles_of_cells(cells, {i: counts[c] for i, c in enumerate(filled)}, probabilities)
        result.update({filled[i]: q for i, q in found.items()})
    return result


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    counts: dict[str, int] | None = None,
    method: str = "exact",
) -> dict[str, list[float | None]]:
    """:func:`exact_quantiles`, or from sketches in one pass where ``method`` is ``approximate``."""
    if method == "exact":
        return exact_quantiles(df, columns, probabilities, counts)
    if method != "approximate":
        raise ValueError("quantiles must be 'exact' or 'approximate'")
    return approximate_quantiles(df, columns, probabilities)


def _by_group(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(g, place, v) of every value."""
    rows = df.select(col(by).alias("g"), F.posexplode(_values(df, columns)).alias("place", "v"))
    return rows.where("v IS NOT NULL")


def _in_gaps(values: DataFrame, gaps: DataFrame, *carried: str) -> DataFrame:
    """(gap, v, carried columns) of the values strictly inside each gap.

    A bounded number of gaps is sent to the tasks. More are joined by hash, with the values of one group
    dealt to several parts, so that a group of any size does not meet in one task.
    """
    few = gaps.limit(BROADCAST_GAPS + 1).count() <= BROADCAST_GAPS
    own = gaps.select(F.col("g").alias("gap_g"), F.col("place").alias("gap_place"), "gap", "low", "high", *carried)
    same = F.col("g").eqNullSafe(F.col("gap_g")) & (F.col("place") == F.col("gap_place"))
    if few:
        met = values.join(F.broadcast(own), same)
    else:
        own = own.withColumn("gap_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        dealt = values.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int"))
        met = dealt.join(own, same & (F.col("part") == F.col("gap_part")))
    above = F.col("low").isNull() | (F.col("v") > F.col("low"))
    below = F.col("high").isNull() | (F.col("v") < F.col("high"))
    return met.where(above & below).select("gap", "v", *carried)


def _few_rows(values: DataFrame, gaps: DataFrame) -> DataFrame:
    """(g, place, rank, v) of gaps with few rows, by sorting these."""
    ordered = _in_gaps(values, gaps).groupBy("gap").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    found = F.transform(
        "ranks", lambda r: F.struct(r["of"].alias("rank"), F.get(F.col("vs"), r["at"].cast("int")).alias("v"))
    )
    return ordered.join(gaps, "gap").select("g", "place", F.inline(found))


def _narrowed(values: DataFrame, gaps: DataFrame) -> DataFrame:
    """Where the ranks of gaps with many rows fall: at a value (``v``), or in a smaller gap.

    (g, place, rank, v, at, low, high, rows): of a rank that is not found yet, its rank ``at`` within the gap.
    """
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketched = _in_gaps(values, gaps).groupBy("gap").agg(F.percentile_approx("v", grid, ACCURACY).alias("sketch"))
    place = F.transform("ranks", lambda r: r["at"] / F.greatest(F.col("rows") - 1, F.lit(1)) * GRID)
    below = F.transform(place, lambda x: F.greatest(F.floor(x) - 1, F.lit(0)))
    above = F.transform(place, lambda x: F.least(F.ceil(x) + 1, F.lit(GRID)))
    picked = F.transform(F.concat(below, above), lambda i: F.get(F.col("sketch"), i.cast("int")))
    bounded = gaps.join(sketched, "gap").withColumn("bounds", F.array_sort(F.array_distinct(picked))).drop("sketch")
    bounded = land(bounded, "quantile-bounds")
    # Even slots lie between bounds, odd ones at a bound.
    slot = 2 * F.size(F.filter("bounds", lambda b: b < F.col("v"))) + F.array_contains("bounds", F.col("v")).cast("int")
    counted = _in_gaps(values, bounded, "bounds").groupBy("gap", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("gap").orderBy("slot")) - F.col("n")
    slots = counted.withColumn("before", before)
    ranks = bounded.select("gap", "g", "place", "low", "high", "bounds", F.inline("ranks"))
    met = ranks.join(slots, "gap").where((F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("n")))
    half = F.floor(F.col("slot") / 2).cast("int")
    return met.select(
        "g",
        "place",
        F.col("of").alias("rank"),
        F.when(F.col("slot") % 2 == 1, F.get("bounds", half)).alias("v"),
        (F.col("at") - F.col("before")).alias("at"),
        F.when(half > 0, F.get("bounds", half - 1)).otherwise(F.col("low")).alias("low"),
        F.coalesce(F.get("bounds", half), F.col("high")).alias("high"),
        F.col("n").alias("rows"),
    )


def exact_quantiles_by(
    df: DataFrame, by: str, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Quantiles per group, one row per (group, column): ``by``, ``column``, ``quantiles``.

    All groups share the rounds of one search, whatever their number and sizes: what is open is a table of gaps by
    group and column, landed each round, and nothing about a group reaches the driver. A group or column
    without values has null quantiles.
    """
    counts = [F.count(number(df, c)).alias(f"c{i}") for i, c in enumerate(columns)]
    sizes = df.groupBy(col(by).alias("g")).agg(*counts)
    sizes = sizes.select("g", F.posexplode(F.array(*[F.col(f"c{i}") for i in range(len(columns))])).alias("place", "n"))
    sizes = land(sizes, "group-sizes")
    values = _by_group(df, by, columns)

    place = [F.lit(p) * (F.col("n") - 1) for p in probabilities]
    wanted = F.array_distinct(F.array(*[f(x).cast("long") for x in place for f in (F.floor, F.ceil)]))
    no_bound = F.lit(None).cast("double")
    gaps = sizes.where("n > 0").select(
        F.monotonically_increasing_id().alias("gap"),
        "g",
        "place",
        no_bound.alias("low"),
        no_bound.alias("high"),
        F.col("n").alias("rows"),
        F.transform(wanted, lambda r: F.struct(r.alias("at"), r.alias("of"))).alias("ranks"),
    )
    answers = None
    while True:
        gaps = land(gaps, "quantile-gaps")
        few, many = (gaps.where(F.col("rows") <= INSIDE_ROWS), gaps.where(F.col("rows") > INSIDE_ROWS))
        found = land(_few_rows(values, few), "quantile-answers")
        answers = found if answers is None else answers.unionByName(found)
        if many.isEmpty():
            break
        narrowed = land(_narrowed(values, many), "quantile-ranks")
        answers = answers.unionByName(narrowed.where("v IS NOT NULL").select("g", "place", "rank", "v"))
        left = narrowed.where("v IS NULL").groupBy("g", "place", "low", "high").agg(
            F.max("rows").alias("rows"), F.collect_list(F.struct("at", F.col("rank").alias("of"))).alias("ranks")
        )
        gaps = left.select(F.monotonically_increasing_id().alias("gap"), "g", "place", "low", "high", "rows", "ranks")

    listed = F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at")
    known = answers.groupBy(F.col("g").alias("own"), F.col("place").alias("own_place")).agg(listed)
    same = F.col("g").eqNullSafe(F.col("own")) & (F.col("place") == F.col("own_place"))

    def between(x: Column) -> Column:
        low, high = (F.try_element_at("at", f(x).cast("long")) for f in (F.floor, F.ceil))
        rest = x - F.floor(x)
        return F.when(low == high, low).otherwise((F.lit(1.0) - rest) * low + rest * high)

    names = F.array(*[F.lit(c) for c in columns])
    return sizes.join(known, same, "left").select(
        F.col("g").alias(by),
        F.get(names, F.col("place")).alias("column"),
        F.array(*[between(x) for x in place]).alias("quantiles"),
    )
