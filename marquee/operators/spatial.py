"""Place groups on the sphere.

Points sit in grid cells whose diagonal is at most eps, so two points of a cell are
always neighbours and never have to be paired.  Only sparse cells, which hold fewer
than ``min_samples`` points, look at single points of the cells around them; dense
cells are connected through bounding boxes that are refined until they decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.values import EARTH_RADIUS_M, haversine_m
from marquee.operators.components import connected_components
from marquee.operators.ranking import number_rows
from marquee.session import cut_lineage

TWO_PI = 2.0 * math.pi
# A little less than eps/sqrt(2): keeps the cell diagonal below eps on the sphere.
CELL_SHARE = 0.999 / math.sqrt(2.0)
# Sub-cells per side of a cell by refinement level; after the last level single points decide.
SIDES = (1, 2, 8, 64, 512)
LEVELS = len(SIDES) - 1


class Grid:
    """Cell arithmetic for one eps (metres); bands of latitude, columns inside a band."""

    def __init__(self, eps_m: float):
        self.eps = float(eps_m)
        self.angle = self.eps / EARTH_RADIUS_M
        self.side = self.angle * CELL_SHARE

    def band(self, lat: Column) -> Column:
        return F.floor((F.radians(lat) + math.pi / 2) / self.side)

    def _edge_cos(self, band: Column, widest: bool) -> Column:
        lo = band * self.side - math.pi / 2
        hi = lo + self.side
        pick = F.greatest(F.cos(lo), F.cos(hi)) if widest else F.least(F.cos(lo), F.cos(hi))
        if widest:
            return F.when((lo <= 0) & (hi >= 0), F.lit(1.0)).otherwise(pick)
        return F.greatest(pick, F.lit(0.0))

    def columns(self, band: Column) -> Column:
        """Number of cells in a band."""
        return F.greatest(F.ceil(self._edge_cos(band, True) * TWO_PI / self.side), F.lit(1).cast("bigint"))

    def column(self, lon: Column, band: Column) -> Column:
        n = self.columns(band)
        return F.pmod(F.floor((F.radians(lon) + math.pi) * n / TWO_PI), n)

    def around(self, band: Column, lat_cos_min: Column, lon_lo: Column, lon_hi: Column) -> Column:
        """Array of (band, col) that can hold a point within eps of the given strip."""
        top = math.ceil(math.pi / self.side)

        def one_band(step: Column) -> Column:
            b = band + step
            n = self.columns(b)
            reach = math.sin(self.angle / 2) / F.sqrt(F.greatest(lat_cos_min * self._edge_cos(b, False), F.lit(1e-18)))
            swing = F.when(reach >= 1, F.lit(math.pi)).otherwise(2 * F.asin(F.least(reach, F.lit(1.0)))) + 1e-12
            lo = F.floor((F.radians(lon_lo) + math.pi - swing) * n / TWO_PI)
            hi = F.floor((F.radians(lon_hi) + math.pi + swing) * n / TWO_PI)
            cols = F.when(hi - lo + 1 >= n, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.sequence(lo, hi))
            return F.transform(cols, lambda c: F.struct(b.alias("band"), F.pmod(c, n).alias("col")))

        steps = F.sequence(F.lit(-2).cast("bigint"), F.lit(2).cast("bigint"))
        inside = F.filter(steps, lambda s: (band + s >= 0) & (band + s <= top))
        return F.flatten(F.transform(inside, one_band))

    def with_cell(self, df: DataFrame) -> DataFrame:
        df = df.withColumn("band", self.band(F.col("lat")))
        return df.withColumn("col", self.column(F.col("lon"), F.col("band")))

    def explode_around(self, df: DataFrame) -> DataFrame:
        """One row per nearby cell, the cell in ``band, col``; the point's own columns keep a ``p_`` prefix."""
        own = [c for c in df.columns if c not in ("band", "col")]
        near = self.around(F.col("band"), F.cos(F.radians("lat")), F.col("lon"), F.col("lon"))
        return df.select(*[F.col(c).alias(f"p_{c}") for c in own], F.explode(near).alias("__c")).select(
            *[f"p_{c}" for c in own], F.col("__c.band").alias("band"), F.col("__c.col").alias("col"))


CELL = ["state", "band", "col"]


def _within(grid: Grid, probe: DataFrame, target: DataFrame) -> DataFrame:
    d = haversine_m(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon"))
    return probe.join(target, CELL).filter(d <= grid.eps)


def _box_bounds() -> tuple[Column, Column]:
    """(lower, upper) bound in metres of the distance between boxes a and b."""
    r = {k: F.radians(k) for k in ["a_lat_lo", "a_lat_hi", "b_lat_lo", "b_lat_hi"]}
    zero = F.lit(0.0)
    gap_lat = F.greatest(r["b_lat_lo"] - r["a_lat_hi"], r["a_lat_lo"] - r["b_lat_hi"], zero)
    span_lat = F.greatest(r["b_lat_hi"] - r["a_lat_lo"], r["a_lat_hi"] - r["b_lat_lo"])
    middle = (F.radians("b_lon_lo") + F.radians("b_lon_hi") - F.radians("a_lon_lo") - F.radians("a_lon_hi")) / 2
    turn = F.when(middle > math.pi, -TWO_PI).when(middle < -math.pi, TWO_PI).otherwise(0.0)
    east = F.radians("b_lon_hi") + turn - F.radians("a_lon_lo")
    west = F.radians("a_lon_hi") - F.radians("b_lon_lo") - turn
    gap_lon = F.greatest(F.radians("b_lon_lo") + turn - F.radians("a_lon_hi"),
                         F.radians("a_lon_lo") - F.radians("b_lon_hi") - turn, zero)
    span_lon = F.least(F.greatest(east, west), F.lit(math.pi))

    def cos_low(side: str) -> Column:
        return F.least(F.cos(r[f"{side}_lat_lo"]), F.cos(r[f"{side}_lat_hi"]))

    def cos_high(side: str) -> Column:
        lo, hi = r[f"{side}_lat_lo"], r[f"{side}_lat_hi"]
        return F.when((lo <= 0) & (hi >= 0), F.lit(1.0)).otherwise(F.greatest(F.cos(lo), F.cos(hi)))

    def arc(lat_gap: Column, lon_gap: Column, cosines: Column) -> Column:
        h = F.pow(F.sin(lat_gap / 2), F.lit(2.0)) + cosines * F.pow(F.sin(lon_gap / 2), F.lit(2.0))
        return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))

    return (arc(gap_lat, gap_lon, cos_low("a") * cos_low("b")),
            arc(span_lat, span_lon, cos_high("a") * cos_high("b")))


def _connected_cells(core: DataFrame, grid: Grid) -> DataFrame:
    """``(src, dst)`` that join the core cells which hold core points within eps of each other.

    Exact as to what is connected, without pairing points: a pair of boxes closer than
    eps everywhere connects its cells, one further than eps everywhere is dropped, and only the rest is
    split into smaller boxes: 2 x 2 each first, which decides most cells side by side or corner to
    corner.  Cells already connected, through other cells too, are split no further.
    """
    box = ["lat_lo", "lat_hi", "lon_lo", "lon_hi"]
    cells = core.groupBy("cell", *CELL).agg(
        F.min("lat").alias("lat_lo"), F.max("lat").alias("lat_hi"),
        F.min("lon").alias("lon_lo"), F.max("lon").alias("lon_hi"))
    cos_min = F.least(F.cos(F.radians("lat_lo")), F.cos(F.radians("lat_hi")))
    near = (cells.select("state", F.col("cell").alias("a"), *[F.col(c).alias(f"a_{c}") for c in box],
                         F.explode(grid.around(F.col("band"), cos_min, F.col("lon_lo"), F.col("lon_hi"))).alias("c"))
            .select("state", "a", *[f"a_{c}" for c in box], "c.band", "c.col").distinct())
    open_pairs = (near.join(cells.select(*CELL, F.col("cell").alias("b"), *[F.col(c).alias(f"b_{c}") for c in box]),
                            CELL).filter("a < b").drop(*CELL))
    links = None
    level = 0
    while True:
        low, high = _box_bounds()
        judged = cut_lineage(open_pairs.withColumns({"low": low, "high": high}).filter(F.col("low") <= grid.eps))
        yes = judged.filter(F.col("high") <= grid.eps).select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
        links = yes if links is None else links.union(yes)
        rest = judged.filter(F.col("high") > grid.eps).join(
            yes, (F.col("a") == F.col("src")) & (F.col("b") == F.col("dst")), "left_anti")
        level += 1
        if level > LEVELS + 1 or not rest.limit(1).count():
            return links
        if level > 1:
            rest, links = _apart(rest, links)
            if not rest.limit(1).count():
                return links
        sub = _sub_boxes(core, grid, level)
        keys = ["a", "b", "a_sub", "b_sub"] if level > 1 else ["a", "b"]
        rest = rest.select(*keys)

        def side(name: str) -> DataFrame:
            s = sub.select(F.col("cell").alias(name), F.col("up").alias(f"{name}_sub"),
                           F.col("sub").alias(f"{name}_new"), *[F.col(c).alias(f"{name}_{c}") for c in box])
            return s if level > 1 else s.drop(f"{name}_sub")

        on = (lambda n: [n, f"{n}_sub"]) if level > 1 else (lambda n: [n])
        open_pairs = (rest.join(side("a"), on("a")).join(side("b"), on("b")).drop("a_sub", "b_sub")
                      .withColumnRenamed("a_new", "a_sub").withColumnRenamed("b_new", "b_sub"))


def _apart(pairs: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of cells that the links do not join, through other cells or at once; and links that join the same
    cells by way of their component's smallest only."""
    ends = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    found = connected_components(ends, links)
    for name in ("a", "b"):
        pairs = pairs.join(found.select(F.col("node").alias(name), F.col("component").alias(f"{name}_in")), name, "left")
    joined = F.coalesce(F.col("a_in") == F.col("b_in"), F.lit(False))
    stars = found.filter("node <> component").select(F.col("node").alias("src"), F.col("component").alias("dst"))
    return cut_lineage(pairs.filter(~joined).drop("a_in", "b_in")), stars


def _sub_boxes(core: DataFrame, grid: Grid, level: int) -> DataFrame:
    """Boxes of one refinement level with the key of the level above."""
    n = grid.columns(F.col("band"))
    x = (F.radians("lat") + math.pi / 2) / grid.side - F.col("band")
    y = F.pmod((F.radians("lon") + math.pi) * n / TWO_PI, F.lit(1.0))

    def key(at: int) -> Column:
        if at > LEVELS:
            return F.struct(F.col("lat").alias("x"), F.col("lon").alias("y"))
        parts = float(SIDES[at])
        return F.struct(F.floor(x * parts).cast("double").alias("x"), F.floor(y * parts).cast("double").alias("y"))

    return core.groupBy("cell", key(level - 1).alias("up"), key(level).alias("sub")).agg(
        F.min("lat").alias("lat_lo"), F.max("lat").alias("lat_hi"),
        F.min("lon").alias("lon_lo"), F.max("lon").alias("lon_hi"))


def _core(grid: Grid, points: DataFrame, min_samples: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(places, core places, sparse places that are not core).

    Events of one venue share their coordinates, so the work runs on distinct places
    with weights.  A cell holding ``min_samples`` points has only core points; every
    other cell holds fewer, so its points ask the cells around them one by one.
    """
    places = cut_lineage(grid.with_cell(
        points.groupBy("state", "lat", "lon").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("first"))))
    weights = places.groupBy(*CELL).agg(F.sum("w").alias("cell_w"))
    sized = places.join(weights, CELL)
    sparse = sized.filter(F.col("cell_w") < min_samples).drop("cell_w")
    probe = grid.explode_around(sparse.select("state", "first", "lat", "lon", "band", "col")).withColumnRenamed(
        "p_state", "state")
    counts = (_within(grid, probe, places).groupBy("p_first").agg(F.sum("w").alias("near"))
              .filter(F.col("near") >= min_samples).select(F.col("p_first").alias("first")))
    core = cut_lineage(
        sized.filter(F.col("cell_w") >= min_samples).drop("cell_w")
        .unionByName(sparse.join(counts, "first", "left_semi")))
    return places, core, sparse.join(core.select("first"), "first", "left_anti")


def core_points(points: DataFrame, eps_m: float = 500.0, min_samples: int = 5) -> DataFrame:
    """Add ``is_core``: at least ``min_samples`` points, itself included, lie within eps."""
    _, core, _ = _core(Grid(eps_m), points, min_samples)
    flagged = points.join(core.select("state", "lat", "lon", F.lit(True).alias("is_core")), ["state", "lat", "lon"], "left")
    return flagged.withColumn("is_core", F.coalesce("is_core", F.lit(False)))


def place_groups(points: DataFrame, eps_m: float = 500.0, min_samples: int = 5) -> DataFrame:
    """Density groups of ``points(state, id, lat, lon)``; adds ``spatial_label`` (-1 = noise).

    Groups are numbered per state by their smallest core id, which must be unique;
    a border point takes the lowest-numbered group that reaches it.
    """
    grid = Grid(eps_m)
    places, core, rest = _core(grid, points, min_samples)
    if not core.limit(1).count():
        return points.withColumn("spatial_label", F.lit(-1).cast("bigint"))
    names = core.groupBy(*CELL).agg(F.min("first").alias("cell"))
    core = cut_lineage(core.join(names, CELL))
    links = _connected_cells(core, grid)
    comps = connected_components(core.select(F.col("cell").alias("node")).distinct(), links)
    core_comp = cut_lineage(core.join(comps, core["cell"] == comps["node"]).select(
        *CELL, "lat", "lon", "first", "component"))
    border_probe = grid.explode_around(
        rest.select("state", "first", "lat", "lon", "band", "col")).withColumnRenamed("p_state", "state")
    border = (_within(grid, border_probe, core_comp).groupBy(F.col("p_first").alias("first"))
              .agg(F.min("component").alias("component")))
    numbered = number_rows(core_comp.select("state", "component").distinct(), [F.col("component")], "spatial_label",
                           group="state").select("component", "spatial_label")
    place_label = core_comp.select("first", "component").union(border).join(numbered, "component")
    labelled = places.join(place_label, "first").select("state", "lat", "lon", "spatial_label")
    return (points.join(labelled, ["state", "lat", "lon"], "left")
            .withColumn("spatial_label", F.coalesce("spatial_label", F.lit(-1).cast("bigint"))))
