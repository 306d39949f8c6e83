"""Zones from coordinates: bounding boxes and generated grids.

A point belongs to the box with the lowest zone id that contains it, edges
included. There are two ways to find it, and which one is taken does not change a row:

* Up to ``MOST_INDEXED`` boxes become an interval index: along each axis, the sorted edges cut the
  line into slots, and every slot has a bit for each box that covers it. A point is placed
  by two binary searches inside the projection, and the lowest common bit is its zone. Trips don't move.
* More boxes become an equi-join on grid cells: a box is listed under the at most four cells of a
  size like its own that it touches, a point looks up its cell of every size, and the box's own
  bounds decide. Only the distinct points of the trips look up cells, and get their lowest zone; the
  trips then find their point by an ordinary join. Trips move once at most, however many
  boxes there are and however they overlap. Which side of a join is broadcast is Spark's decision.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import AtomicType

from tripflow.constants import DEFAULT_BOUNDS, DEFAULT_GRID_ZONES, Bounds
from tripflow.operators.columns import column

# Cell sizes are powers of two, in degrees.
FINEST, COARSEST = -12, 12
LEVELS = tuple(range(FINEST, COARSEST + 1, 3))
# Coordinates are clamped to this square for cell numbers only. Clamping keeps
# order, so a point inside a box is still inside it and shares a cell with it.
CELL_LIMIT = 512.0
CELLS_PER_AXIS = 2**22
# Trips without coordinates match nothing; they are spread over so many join keys.
SPREAD = 4096
AXES = ("longitude", "latitude")
# So many boxes are read while a query is built; more are joined.
MOST_INDEXED = 256
# Bits of a word that mark boxes: a long without its sign.
WORD_BITS = 63


def clamped(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(-CELL_LIMIT)), F.lit(CELL_LIMIT))


def cell_index(value: Column, level: Column) -> Column:
    return F.floor(clamped(value) / F.pow(F.lit(2.0), level))


def cell_number(x: Column, y: Column) -> Column:
    """One number for a cell of a level."""
    return x * CELLS_PER_AXIS + y


def point_cell(longitude: Column, latitude: Column, level: Column) -> Column:
    return cell_number(cell_index(longitude, level), cell_index(latitude, level))


def contains(box, longitude: Column, latitude: Column) -> Column:
    """Whether a box holds a point; ``box`` maps a bound's name to its column."""
    return (
        (longitude >= box("min_longitude"))
        & (longitude <= box("max_longitude"))
        & (latitude >= box("min_latitude"))
        & (latitude <= box("max_latitude"))
    )


def usable_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes that can contain anything: bounds known and in order."""
    return boxes.where(
        (F.col("min_longitude") <= F.col("max_longitude"))
        & (F.col("min_latitude") <= F.col("max_latitude"))
    )


def _first_and_last_cell(axis: str, level: Column) -> list[Column]:
    return [cell_index(F.col(f"{side}_{axis}"), level) for side in ("min", "max")]


def box_cells(leveled: DataFrame) -> DataFrame:
    """One row per box and cell it touches, at the box's ``__level``."""
    level = F.col("__level")
    return (
        leveled.withColumn("__x", F.explode(F.sequence(*_first_and_last_cell("longitude", level))))
        .withColumn("__y", F.explode(F.sequence(*_first_and_last_cell("latitude", level))))
        .withColumn("__cell", cell_number(F.col("__x"), F.col("__y")))
        .drop("__x", "__y")
    )


def own_level(boxes: DataFrame) -> DataFrame:
    """Add the smallest of ``LEVELS`` whose cells are at least as large as the box."""

    def extent(axis: str) -> Column:
        low, high = (clamped(F.col(f"{side}_{axis}")) for side in ("min", "max"))
        return high - low

    size = F.greatest(extent("longitude"), extent("latitude"))
    level = F.lit(LEVELS[-1])
    for candidate in reversed(LEVELS[:-1]):
        level = F.when(size <= 2.0**candidate, candidate).otherwise(level)
    return boxes.withColumn("__level", level)


def zones_of_points(points: DataFrame, boxes: DataFrame, join: str | None = None) -> DataFrame:
    """(x, y, zone) of the points (x, y) that a box contains; ``join`` is a join hint."""
    cells = box_cells(own_level(usable_boxes(boxes))).select(
        "__level",
        "__cell",
        F.struct("zone_id", "zone_name").alias("__zone"),
        *[F.col(f"{side}_{axis}").alias(f"__{side}_{axis}") for side in ("min", "max") for axis in AXES],
    )
    if join:
        cells = cells.hint(join)
    levels = F.explode(F.array(*[F.lit(level) for level in LEVELS]))
    looked_up = points.withColumn("__p_level", levels).withColumn(
        "__p_cell", point_cell(F.col("__x"), F.col("__y"), F.col("__p_level"))
    )
    inside = contains(lambda bound: F.col(f"__{bound}"), F.col("__x"), F.col("__y"))
    same = (F.col("__p_level") == F.col("__level")) & (F.col("__p_cell") == F.col("__cell"))
    return looked_up.join(cells, same & inside).groupBy("__x", "__y").agg(F.min("__zone").alias("__zone"))


def _rank(value: float) -> tuple[bool, float]:
    """Spark's order of doubles: NaN is the largest, and minus zero is zero."""
    return (value != value, 0.0 if value != value else value + 0.0)


def _sql(value: float) -> str:
    return f"double('{value!r}')"


def _slot(value: str, edges: list[float]) -> str:
    """SQL that finds the slot of a value by binary search: 2k + 1 is the k-th edge, 2k lies before it."""

    def search(low: int, high: int) -> str:
        if low == high:
            return str(2 * low)
        middle = (low + high) // 2
        edge = _sql(edges[middle])
        return (
            f"case when {value} < {edge} then {search(low, middle)} "
            f"when {value} = {edge} then {2 * middle + 1} else {search(middle + 1, high)} end"
        )

    return search(0, len(edges))


@dataclass(frozen=True)
class BoxIndex:
    """Boxes in the order of their zones, the sorted edges of each axis, and each slot's box bits.

    ``covers`` has, by axis, one list of words per slot; box k is bit k % 63 of word k // 63.
    """

    zones: list[tuple[int | None, str | None]]
    edges: dict[str, list[float]]
    covers: dict[str, list[list[int]]]

    @staticmethod
    def of(boxes: list[Row]) -> BoxIndex:
        ordered = sorted(boxes, key=_zone_order)
        edges, covers = {}, {}
        words = max(1, -(-len(ordered) // WORD_BITS))
        for axis in AXES:
            sides = [(_rank(b[f"min_{axis}"]), _rank(b[f"max_{axis}"])) for b in ordered]
            known = sorted({edge for side in sides for edge in side})
            place = {edge: 2 * k + 1 for k, edge in enumerate(known)}
            slots = [[0] * words for _ in range(2 * len(known) + 1)]
            for k, (low, high) in enumerate(sides):
                for slot in range(place[low], place[high] + 1):
                    slots[slot][k // WORD_BITS] |= 1 << (k % WORD_BITS)
            edges[axis] = [float("nan") if rank[0] else rank[1] for rank in known]
            covers[axis] = slots
        return BoxIndex([(b.zone_id, b.zone_name) for b in ordered], edges, covers)


def _zone_order(box: Row) -> list[tuple]:
    """The order of ``min(struct(zone_id, zone_name))``: NULLs are the lowest."""
    return [(value is not None, value) if value is not None else (False,) for value in (box.zone_id, box.zone_name)]


def box_index(boxes: DataFrame) -> BoxIndex | None:
    """The index over ``boxes``, or None where there are more than ``MOST_INDEXED``: never more rows than that are read."""
    bounds = [F.col(f"{side}_{axis}").cast("double").alias(f"{side}_{axis}") for axis in AXES for side in ("min", "max")]
    few = usable_boxes(boxes).select("zone_id", "zone_name", *bounds).limit(MOST_INDEXED + 1).collect()
    return None if len(few) > MOST_INDEXED else BoxIndex.of(few)


def attach_index(trips: DataFrame, index: BoxIndex, end: str, zone_type: str, *, unmatched: str = "drop") -> DataFrame:
    """`attach_boxes` by an index: a projection, without a join or a shuffle."""
    _check_unmatched(unmatched)
    slots = {axis: f"__{axis}_slot" for axis in AXES}
    known = F.expr(" and ".join(f"`{end}_{axis}` is not null" for axis in AXES))
    placed = trips.withColumns(
        {
            slots[axis]: F.when(known, F.expr(_slot(f"cast(`{end}_{axis}` as double)", index.edges[axis])))
            for axis in AXES
        }
    )
    words = max(1, -(-len(index.zones) // WORD_BITS))

    def common(word: int) -> str:
        sides = (
            f"get(array({', '.join(f'{slot[word]}L' for slot in index.covers[axis])}), {slots[axis]})"
            for axis in AXES
        )
        return "(" + " & ".join(sides) + ")"

    placed = placed.withColumns({f"__common_{w}": F.expr(common(w)) for w in range(words)})
    lowest = F.coalesce(
        *[
            F.expr(
                f"case when __common_{w} != 0 then bit_count((__common_{w} & -__common_{w}) - 1) + {w * WORD_BITS} end"
            )
            for w in range(words)
        ]
    )
    placed = placed.withColumn("__box", lowest.cast("int"))
    if unmatched == "drop":
        placed = placed.where("__box is not null")
    found = [("zone_id", zone_type, 0), ("zone_name", "string", 1)]
    zones = index.zones or [(None, None)]
    return placed.select(
        *[column(c) for c in trips.columns],
        *[
            F.get(F.array(*[F.lit(zone[k]).cast(kind) for zone in zones]), F.col("__box")).alias(f"{end}_{name}")
            for name, kind, k in found
        ],
    )


def attach_boxes(
    trips: DataFrame, boxes: DataFrame, end: str, *, unmatched: str = "drop", join: str | None = None
) -> DataFrame:
    """Add ``<end>_zone_id`` and ``<end>_zone_name`` of the containing box.

    ``unmatched='drop'`` loses trips outside all boxes, ``'keep'`` gives them a
    NULL zone. Few boxes are read while the query is built and indexed, more are joined; ``join`` names
    a Spark join hint and asks for the join. Identical trips, and the values of all columns, stay as they are.
    """
    _check_unmatched(unmatched)
    index = None if join else box_index(boxes)
    if index is not None:
        zone_type = boxes.schema["zone_id"].dataType.simpleString()
        return attach_index(trips, index, end, zone_type, unmatched=unmatched)
    return join_boxes(trips, boxes, end, unmatched=unmatched, join=join)


def join_boxes(
    trips: DataFrame, boxes: DataFrame, end: str, *, unmatched: str = "drop", join: str | None = None
) -> DataFrame:
    """`attach_boxes` by joins, for any number of boxes."""
    _check_unmatched(unmatched)
    x, y = F.col(f"{end}_longitude"), F.col(f"{end}_latitude")
    known = x.isNotNull() & y.isNotNull()
    points = trips.where(known).select(x.alias("__x"), y.alias("__y")).distinct()
    # Sums as keys, here and below: the zones of the points get a shuffle of their own, between which and the
    # trips' plain shuffle adaptive execution can split a point that many trips share.
    zones = zones_of_points(points, boxes, join).select(
        (F.col("__x") + 0.0).alias("__zx"), (F.col("__y") + 0.0).alias("__zy"), "__zone", F.lit(True).alias("__found")
    )
    if join:
        zones = zones.hint(join)
    # An unknown point would send all its trips to one task of the join.
    plain = [column(f.name) for f in trips.schema.fields if isinstance(f.dataType, AtomicType)]
    spread = F.pmod(F.xxhash64(*plain), F.lit(SPREAD)).cast("double")
    keyed = trips.withColumns(
        {
            "__at_x": F.when(known, x + 0.0).otherwise(spread),
            "__at_y": F.when(known, y + 0.0).otherwise(0.0),
            "__known": known,
        }
    )
    if unmatched == "drop":
        keyed = keyed.where("__known")
    same = (
        (F.col("__at_x") == F.col("__zx")) & (F.col("__at_y") == F.col("__zy")) & (F.col("__known") == F.col("__found"))
    )
    matched = keyed.join(zones, same, "inner" if unmatched == "drop" else "left")
    return matched.select(
        *[column(c) for c in trips.columns],
        F.col("__zone.zone_id").alias(f"{end}_zone_id"),
        F.col("__zone.zone_name").alias(f"{end}_zone_name"),
    )


def _check_unmatched(unmatched: str) -> None:
    if unmatched not in ("drop", "keep"):
        raise ValueError(f"unmatched must be 'drop' or 'keep', not {unmatched!r}")


def coordinate_bounds(trips: DataFrame) -> DataFrame:
    """Smallest and largest pickup coordinates, as one row; NaN is no coordinate."""

    def known(axis: str) -> Column:
        value = F.col(f"pickup_{axis}")
        return F.when(~F.isnan(value), value)

    return trips.agg(
        *[
            f(known(axis)).alias(f"{label}_{axis}")
            for axis in AXES
            for label, f in (("min", F.min), ("max", F.max))
        ]
    )


@dataclass(frozen=True)
class Grid:
    """A square grid: ``side`` zones along each axis of the one row of ``bounds``."""

    bounds: DataFrame
    side: int


def trip_grid(
    trips: DataFrame, num_zones: int = DEFAULT_GRID_ZONES, default: Bounds = DEFAULT_BOUNDS
) -> Grid:
    """The grid over the trips' pickups; bounds the data cannot give are taken from ``default``.

    The bounds are a lazy aggregate: nothing runs before the grid is used.
    """
    side = isqrt(num_zones)
    if side < 1:
        raise ValueError("num_zones must be at least 1")
    if {"pickup_longitude", "pickup_latitude"} <= set(trips.columns):
        bounds = coordinate_bounds(trips)
        bounds = bounds.select(*[F.coalesce(name, F.lit(value)).alias(name) for name, value in vars(default).items()])
    else:
        bounds = trips.sparkSession.range(1).select(*[F.lit(v).alias(n) for n, v in vars(default).items()])
    return Grid(bounds, side)


def _edge(bound, axis: str, step: Column, side: int) -> Column:
    low, high = bound(f"min_{axis}"), bound(f"max_{axis}")
    return low + step * ((high - low) / F.lit(float(side)))


def _zone_name(zone_id: Column) -> Column:
    return F.concat(F.lit("Zone_"), zone_id.cast("string"))


def zones_of_grid(grid: Grid) -> DataFrame:
    """The grid's zones as boxes, numbered from 1 along the longitude, then the latitude."""
    side = grid.side
    numbered = grid.bounds.withColumn("__index", F.explode(F.sequence(F.lit(0), F.lit(side * side - 1))))
    index = F.col("__index")
    row, place = F.floor(index / side).cast("int"), index % side
    return numbered.select(
        (index + 1).alias("zone_id"),
        _zone_name(index + 1).alias("zone_name"),
        _edge(F.col, "longitude", place, side).alias("min_longitude"),
        _edge(F.col, "longitude", place + 1, side).alias("max_longitude"),
        _edge(F.col, "latitude", row, side).alias("min_latitude"),
        _edge(F.col, "latitude", row + 1, side).alias("max_latitude"),
    )


def grid_zones(
    trips: DataFrame, num_zones: int = DEFAULT_GRID_ZONES, default: Bounds = DEFAULT_BOUNDS
) -> DataFrame:
    """Cut the pickup area into a square grid of at most ``num_zones`` zones, as boxes."""
    return zones_of_grid(trip_grid(trips, num_zones, default))


def attach_grid(trips: DataFrame, grid: Grid, end: str, *, unmatched: str = "drop") -> DataFrame:
    """`attach_boxes` with the grid's zones, by arithmetic on the point: no join, no shuffle.

    The one row of bounds is a column of its own, computed once a query. Along each axis the point's zone and both
    neighbours are compared with their edges, so a point on an edge goes to the lower zone whatever the rounding.
    """
    _check_unmatched(unmatched)
    bounds = grid.bounds.select(F.struct(*vars(DEFAULT_BOUNDS)).alias("bounds")).scalar()
    bound = F.col("__bounds").getField

    def guess(axis: str) -> Column:
        value, low = F.col(f"{end}_{axis}"), bound(f"min_{axis}")
        step = (bound(f"max_{axis}") - low) / F.lit(float(grid.side))
        near = F.floor(F.least(F.greatest(F.try_divide(value - low, step), F.lit(0.0)), F.lit(grid.side - 1.0)))
        return F.coalesce(near, F.lit(0)).cast("int")

    def place(axis: str) -> Column:
        value = F.col(f"{end}_{axis}")

        def fits(k: Column) -> Column:
            inside = (value >= _edge(bound, axis, k, grid.side)) & (value <= _edge(bound, axis, k + 1, grid.side))
            return F.when(k.between(0, grid.side - 1) & inside, k)

        return F.coalesce(*[fits(F.col(f"__near_{axis}") + shift) for shift in (-1, 0, 1)])

    zone = (place("latitude") * grid.side + place("longitude") + 1).cast("int")
    placed = (
        trips.withColumn("__bounds", bounds)
        .withColumns({f"__near_{axis}": guess(axis) for axis in AXES})
        .withColumn("__zone_id", zone)
    )
    if unmatched == "drop":
        placed = placed.where("__zone_id is not null")
    return placed.select(
        *[column(c) for c in trips.columns],
        F.col("__zone_id").alias(f"{end}_zone_id"),
        _zone_name(F.col("__zone_id")).alias(f"{end}_zone_name"),
    )
