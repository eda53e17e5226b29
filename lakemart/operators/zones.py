"""Which zones a point lies in: cells of a grid joined by equality, polygons only where they must be.

Every zone is covered by cells of a grid that halves in both directions from
level to level; a cell's number interleaves the bits of its column and row, so
a cell and all cells inside it share their leading bits. Cells that no edge
touches are inside or outside as a whole; the others are cut further, down to
the finest level. A point is looked up under its cell of each level in use;
in a cell of the inside it is a hit at once, in a cell on the border the
polygon itself decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.session import shuffle_partitions

# west, south, width and height of the grid: all coordinates
_WEST, _SOUTH, _WIDTH, _HEIGHT = -180.0, -90.0, 360.0, 180.0
LEVELS = (4, 6, 8, 10)
_SLACK = 1e-9  # degrees by which a cell is widened, above the rounding of its bounds


# expressions over names are written as SQL text, one call each: built column by column they took seconds
_EDGES = "zip_with({ring}, concat(slice({ring}, 2, size({ring})), slice({ring}, 1, 1)), (a, b) -> {edge})"


def contains(ring: str, lon: str, lat: str) -> Column:
    """Even-odd rule for a ring of structs (lon, lat); the last corner is joined to the first.

    An edge counts if it crosses the point's latitude (one end above, the
    other not) to the east of the point.
    """
    east = f"{lon} < (b.lon - a.lon) * ({lat} - a.lat) / (b.lat - a.lat) + a.lon"
    edge = f"coalesce(CASE WHEN (a.lat > {lat}) <> (b.lat > {lat}) THEN {east} END, false)"
    return F.expr(f"size(filter({_EDGES.format(ring=ring, edge=edge)}, hit -> hit)) % 2 = 1")


def _touches(ring: str, west: str, south: str, east: str, north: str) -> Column:
    """Does an edge of the ring meet the box? (Boxes overlap, and the box's corners are not all on one side of the edge.)"""
    sides = ", ".join(f"(b.lon - a.lon) * ({y} - a.lat) - (b.lat - a.lat) * ({x} - a.lon)" for x in (west, east) for y in (south, north))
    edge = (f"greatest(a.lon, b.lon) >= {west} AND least(a.lon, b.lon) <= {east} AND greatest(a.lat, b.lat) >= {south} "
            f"AND least(a.lat, b.lat) <= {north} AND least({sides}) <= 0 AND greatest({sides}) >= 0")
    return F.expr(f"exists({_EDGES.format(ring=ring, edge=edge)}, hit -> hit)")


def _interleaved(column: str, row: str, level: int) -> str:
    """Cell number: the bits of column and row, interleaved, below a leading one."""
    bits = [f"(shiftright({column}, {b}) & 1) * {2 * 4 ** b} + (shiftright({row}, {b}) & 1) * {4 ** b}" for b in range(level)]
    return " + ".join([f"{4 ** level}L", *bits])


def _at(value: str, start: float, width: float, level: int) -> str:
    cells = 1 << level
    return f"least(floor(({value} - {start!r}D) / {width!r}D * {cells}), {cells - 1}L)"


def cover(zones: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """Cells of every zone: zone, ring, cell, inside (boolean).

    ``zones`` has zone and ring (array of struct(lon, lat), within -180..180 and
    -90..90). No two cells of a zone overlap. A zone whose ring is null or has
    fewer than three corners has none. Work and rows grow with the length of
    the borders in cells of the finest level.
    """
    ok = zones.select("zone", "ring").where(F.size("ring") >= 3)
    first = levels[0]

    def span(field: str, start: float, width: float) -> str:
        ends = [_at(f"array_{end}(transform(ring, p -> p.{field}))", start, width, first) for end in ("min", "max")]
        return f"sequence({ends[0]}, {ends[1]})"

    def cells(columns: str, rows: str) -> Column:
        return F.expr(f"flatten(transform({columns}, c -> transform({rows}, r -> named_struct("
                      "'c', c, 'r', r, 'cell', cast(null as bigint), 'inside', cast(null as boolean)))))")

    # one chain of steps: cells that are settled pass on as they are, open ones are judged and, on a border, cut
    here = ok.repartition(shuffle_partitions(zones.sparkSession), "zone").withColumn(
        "_at", F.explode(cells(span("lon", _WEST, _WIDTH), span("lat", _SOUTH, _HEIGHT))))
    for i, level in enumerate(levels):
        w, h = _WIDTH / (1 << level), _HEIGHT / (1 << level)
        west, south = f"(_at.c * {w!r}D + {_WEST!r}D)", f"(_at.r * {h!r}D + {_SOUTH!r}D)"
        touched = _touches("ring", f"({west} - {_SLACK!r}D)", f"({south} - {_SLACK!r}D)", f"({west} + {w + _SLACK!r}D)", f"({south} + {h + _SLACK!r}D)")
        whole = contains("ring", f"({west} + {w / 2!r}D)", f"({south} + {h / 2!r}D)")
        number = _interleaved("_at.c", "_at.r", level)
        settled = [F.expr(f"array(named_struct('c', _at.c, 'r', _at.r, 'cell', {number}, 'inside', {inside}))") for inside in ("true", "false")]
        if i < len(levels) - 1:
            cut = 1 << (levels[i + 1] - level)
            settled[1] = cells(*(f"sequence(_at.{x} * {cut}, _at.{x} * {cut} + {cut - 1})" for x in "cr"))
        after = F.when(F.col("_at.cell").isNotNull(), F.array("_at")).when(touched, settled[1]).when(whole, settled[0])
        here = here.select("zone", "ring", F.explode(after).alias("_at"))
    return here.select("zone", "ring", F.col("_at.cell").alias("cell"), F.col("_at.inside").alias("inside"))


def zone_hits(points: DataFrame, key: str, lat: str, lon: str, zones: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """One row per point and zone that contains it: key, zone. ``key`` is unique.

    Points without coordinates or out of range are in no zone. A point is
    looked up once a level; a cell that holds a mass of points is split as
    skew, or the cells are broadcast once they are measured. ``zone`` is unique
    too: a zone of several parts is several zones.
    """
    la, lo = F.col(f"`{lat}`"), F.col(f"`{lon}`")
    at = [f"named_struct('c', {_at('_lo', _WEST, _WIDTH, v)}, 'r', {_at('_la', _SOUTH, _HEIGHT, v)})" for v in levels]
    numbers = [_interleaved(f"_at[{i}].c", f"_at[{i}].r", v) for i, v in enumerate(levels)]
    asked = points.where((F.abs(la) <= 90) & (F.abs(lo) <= 180)).select(
        F.col(f"`{key}`").alias("_k"), la.cast("double").alias("_la"), lo.cast("double").alias("_lo")).withColumn(
        "_at", F.expr(f"array({', '.join(at)})")).withColumn("cell", F.explode(F.expr(f"array({', '.join(numbers)})"))).drop("_at")
    hit = F.col("inside") | contains("ring", "_lo", "_la")
    return asked.join(cover(zones, levels), "cell").where(hit).select(F.col("_k").alias(key), "zone")


def place_points(points: DataFrame, key: str, lat: str, lon: str, zones: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """One row per point: key, status, n_zones, zone (the least that contains it).

    status: ``missing`` (a coordinate is null or NaN), ``inside``,
    ``swapped`` (in no zone, but in one with latitude and longitude
    exchanged; that zone is named), ``out of range`` or ``outside``. Both readings go through the cells in one join.
    """
    la, lo = F.col(f"`{lat}`"), F.col(f"`{lon}`")
    readings = F.explode(F.array(F.struct(F.lit(False).alias("turned"), la.alias("a"), lo.alias("o")),
                                 F.struct(F.lit(True).alias("turned"), lo.alias("a"), la.alias("o"))))
    both = points.select(F.col(f"`{key}`").alias("k"), readings.alias("p")).select(F.struct("k", "p.turned").alias("id"), "p.a", "p.o")
    hits = zone_hits(both, "id", "a", "o", zones, levels)
    met = hits.groupBy(F.col("id.k").alias("_k")).agg(
        F.count_if(~F.col("id.turned")).alias("_n"), F.min(F.when(~F.col("id.turned"), F.col("zone"))).alias("_z"),
        F.min(F.when(F.col("id.turned"), F.col("zone"))).alias("_t"))
    missing = la.isNull() | lo.isNull() | F.isnan(la) | F.isnan(lo)
    wide = (F.abs(la) > 90) | (F.abs(lo) > 180)
    status = (F.when(missing, "missing").when(F.col("_n") > 0, "inside").when(F.col("_t").isNotNull(), "swapped")
              .when(wide, "out of range").otherwise("outside"))
    return points.join(met, F.col(f"`{key}`") == F.col("_k"), "left").select(
        F.col(f"`{key}`").alias(key), status.alias("status"), F.coalesce("_n", F.lit(0).cast("bigint")).alias("n_zones"),
        F.coalesce("_z", "_t").alias("zone"))
