"""Sharding along a Hilbert curve through several metadata dimensions.

Each dimension is quantised into cells of about equal numbers of rows, the cells of a row are a
point of a grid, and the place of the point on the Hilbert curve through the grid orders the rows,
with the id and the other given columns to part what shares a cell. The order is cut into shards
whose numbers of rows differ by one at most. Neighbours on the curve are neighbours in every
dimension, so files cut from it have narrow value ranges in all of them at once.

Everything is DataFrame functions. The global rank comes from a range partitioning on the curve:
its rows are written once with the number of their range, the ranges are counted, and a row's rank
is the rows of earlier ranges plus its place in its own. No task sees more than one range, and a
value that a third of all rows share spreads over the ranges by the further columns.

A dimension's levels are counted and cut into cells the same way, by ranges and the rows before
them. The table of levels is sent to all tasks up to ``most_levels`` (checked); beyond that rows
and levels meet by shuffle, with the same cells.

Defined cases: null is a level of its own before all others. Rows that agree in all order columns
may change places with each other. An empty table gives none. All columns of the input are passed
through as a struct, so their names cannot clash with those added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botiquin.llm.tables import stored

MOST_LEVELS = 1 << 16


def size_level(value: Column) -> Column:
    """Levels of a whole number at about equal ratios: its bit length and the three bits after."""
    bits = F.length(F.bin(value))
    return F.when(value < 8, value).otherwise(bits * 8 + _after_first(value, bits))


def _after_first(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits - 4).bitwiseAND(7)


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digits and next states of the curve, by state and cell; a state is entry point and axis."""
    size, mask = 1 << dims, (1 << dims) - 1

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & mask

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    def entry(w: int) -> int:
        return 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def axis(w: int) -> int:
        if w == 0:
            return 0
        odd = w if w % 2 else w - 1
        return ((odd + 1) & -(odd + 1)).bit_length() - 1 if w % 2 else (w & -w).bit_length() - 1

    place = {gray(w): w for w in range(size)}
    digits, following = [], []
    for state in range(dims * size):
        start, along = divmod(state, dims)
        for cell in range(size):
            w = place[turn(cell ^ start, dims - (along + 1))]
            digits.append(w)
            next_start = start ^ turn(entry(w), along + 1)
            following.append(next_start * dims + (along + axis(w) + 1) % dims)
    return digits, following


def curve_place(cells: list[Column], bits: int) -> Column:
    """Place on the curve of a point whose coordinates have ``bits`` bits."""
    dims = len(cells)
    digits, following = curve_tables(dims)
    digit_table = F.array(*[F.lit(x) for x in digits])
    next_table = F.array(*[F.lit(x) for x in following])

    def step(done: Column, bit: Column) -> Column:
        cell = F.lit(0)
        for dim, value in enumerate(cells):
            cell = cell + F.call_function("shiftright", value, bit).bitwiseAND(1) * (1 << dim)
        at = done["state"] * (1 << dims) + cell
        return F.struct(
            F.get(next_table, at).alias("state"),
            (done["place"] * (1 << dims) + F.get(digit_table, at)).alias("place"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("place"))
    order = F.array(*[F.lit(bit) for bit in range(bits - 1, -1, -1)])
    return F.aggregate(order, start, step)["place"]


def cells_of(rows: DataFrame, level: str, bits: int, most_levels: int = MOST_LEVELS) -> DataFrame:
    """Each level of a column with its cell: the share of rows before it, times the cells.

    Levels lie in ranges of neighbours; the rows before a level are those of the ranges before its
    own and of the levels before it there, so no task sees all levels. Up to ``most_levels`` of them
    are sent to all tasks; more are joined by their shuffle.
    """
    order = F.asc_nulls_first(level)
    counts = stored(
        rows.groupBy(level).agg(F.count("*").alias("n")).repartitionByRange(order)
        .select(F.col(level).alias("level"), "n", F.spark_partition_id().alias("range")),
        "hilbert-levels",
    )
    # One row per range.
    ranges = counts.groupBy("range").agg(F.sum("n").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = ranges.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    inside = Window.partitionBy("range").orderBy(F.asc_nulls_first("level")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = counts.join(F.broadcast(firsts), "range").withColumn(
        "rows_before", F.col("first") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )
    cells = placed.select("level", F.expr(f"rows_before * {1 << bits} div {total}").cast("int").alias("cell"))
    if counts.limit(most_levels + 1).count() <= most_levels:
        return F.broadcast(cells)
    return stored(cells, "hilbert-cells")


def hilbert_shards(
    rows: DataFrame,
    dimensions: list[Column],
    order: list[str],
    shards: int = 24,
    bits: int = 8,
    most_levels: int = MOST_LEVELS,
) -> DataFrame:
    """``row`` (a struct of all columns), ``curve``, ``shard`` and ``slot`` (from 0 in the shard)."""
    names = [f"level_{k}" for k in range(len(dimensions))]
    base = stored(
        rows.select(
            F.struct("*").alias("row"),
            *[value.alias(name) for name, value in zip(names, dimensions)],
            *[F.col(name).alias(f"order_{k}") for k, name in enumerate(order)],
        ),
        "hilbert-rows",
    )
    placed = base
    for k, name in enumerate(names):
        cells = cells_of(base, name, bits, most_levels)
        placed = placed.join(cells, placed[name].eqNullSafe(cells["level"])).select(
            *placed.columns, F.col("cell").alias(f"cell_{k}")
        )
    keys = ["curve", *[f"order_{k}" for k in range(len(order))]]
    curve = curve_place([F.col(f"cell_{k}") for k in range(len(dimensions))], bits)
    ranged = stored(
        placed.select("row", curve.alias("curve"), *keys[1:])
        .repartitionByRange(*keys).withColumn("range", F.spark_partition_id()),
        "hilbert-ranges",
    )
    counts = ranged.groupBy("range").count()
    total = ranged.count()
    # One row per range.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("range").orderBy(*keys)
    rank = F.col("first") + F.row_number().over(inside) - 1
    return (
        ranged.join(F.broadcast(firsts), "range").withColumn("rank", rank)
        .withColumn("shard", F.expr(f"rank * {shards} div {max(total, 1)}").cast("int"))
        .select(
            "row", "curve", "shard",
            (F.col("rank") - F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}"))
            .cast("long").alias("slot"),
        )
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Files of consecutive rows of a shard, in folders by shard, for pruning by value ranges."""
    part = F.floor(F.col("slot") / rows_per_file)
    (
        sharded.withColumn("part", part).repartition("shard", "part").sortWithinPartitions("shard", "slot")
        .select("row.*", "shard").write.partitionBy("shard").parquet(path)
    )
