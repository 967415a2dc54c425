"""Points in polygons of many rings: outer rings, holes, islands in holes and further parts, by the parity of all edges.

A feature's edges are dealt to a quadtree of cells. A cell that no edge meets lies inside or outside as a whole; its points
need no test. Of a cell that edges meet only those edges are kept that a ray to the right of its points can cross: edges right
of the cell which span its height are crossed by every such ray and fold into one bit. So the test of a point in a border
cell gives exactly what all edges of all rings would give.

Cells end at two sizes, cell and cell / FINE, so a point looks into two cells by an equi join, whatever the polygons' size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.lookups import edges

#: Sizes of cells, coarsest first, as multiples of cell; FINE is how often the last one fits into it.
COARSE, FINE = 8, 8
#: A cell of size cell with more edges in it is split.
MOST_EDGES = 16
EPS = 1e-9


def crossings(found: Column, x: Column, y: Column) -> Column:
    """How many edges a ray from the point to the right crosses; an edge holds its lower end."""
    return F.size(F.filter(found, lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < (e.x2 - e.x1) * F.try_divide(y - e.y1, e.y2 - e.y1) + e.x1)))


def features(polygons: DataFrame) -> DataFrame:
    """shape, feature_id and edges of all rings of each shape; polygons holds a row for each ring, with its feature_id and, if one
    feature has several shapes, a column shape that tells them apart."""
    shape = F.col("shape") if "shape" in polygons.columns else F.col("feature_id")
    rings = polygons.select(shape.alias("shape"), "feature_id", edges(F.col("ring")).alias("_edges"))
    return rings.groupBy("shape", "feature_id").agg(F.flatten(F.collect_list("_edges")).alias("edges"))


def _narrowed(rows: DataFrame, size: float) -> DataFrame:
    """Of cells not done: the edges that matter within them, the parity of those always crossed, and whether they are done."""
    x0, y0 = F.col("cx") * size, F.col("cy") * size
    x1, y1 = x0 + size, y0 + size
    low = lambda e: F.least(e.y1, e.y2)
    high = lambda e: F.greatest(e.y1, e.y2)
    left = lambda e: F.least(e.x1, e.x2)
    always = lambda e: (low(e) <= y0) & (high(e) >= y1) & (left(e) > x1 + EPS)
    # level edges are never crossed, but part a cell that they lie in
    may = lambda e: ((e.y1 != e.y2) | (left(e) <= x1 + EPS)) & (high(e) >= y0) & (low(e) <= y1) & (F.greatest(e.x1, e.x2) > x0 - EPS)
    spans = F.size(F.filter("edges", always)) % 2 == 1
    rows = rows.withColumn("odd", F.when(F.col("done"), F.col("odd")).otherwise(F.col("odd") != spans))
    rows = rows.withColumn("edges", F.when(F.col("done"), F.col("edges")).otherwise(F.filter("edges", lambda e: may(e) & ~always(e))))
    rows = rows.withColumn("meets", F.when(F.col("done"), F.lit(0)).otherwise(F.size(F.filter("edges", lambda e: left(e) <= x1 + EPS))))
    centre = F.col("odd") != (crossings(F.col("edges"), (x0 + x1) / 2, (y0 + y1) / 2) % 2 == 1)
    whole = ~F.col("done") & (F.col("meets") == 0)
    rows = rows.withColumn("whole", whole).withColumn("odd", F.when(whole, centre).otherwise(F.col("odd")))
    rows = rows.where("NOT whole OR odd").withColumn("edges", F.when(F.col("whole"), F.array().cast(rows.schema["edges"].dataType)).otherwise(F.col("edges")))
    return rows


def cover(polygons: DataFrame, cell: float = 5.0) -> DataFrame:
    """feature_id, fine, cx, cy, odd and edges of the cells that hold a part of a feature; cells wholly inside have no edges."""
    size = cell * COARSE
    box = {f"{c}{n}": f(F.col("edges"), c) for c in "xy" for n, f in ((0, _least), (1, _most))}
    rows = features(polygons).where(F.size("edges") > 0).withColumns(box)
    span = lambda c: F.explode(F.sequence(F.floor(F.col(f"{c}0") / size), F.floor(F.col(f"{c}1") / size)))
    rows = rows.withColumn("cx", span("x")).withColumn("cy", span("y")).select("feature_id", "cx", "cy", "edges", F.lit(False).alias("odd"), F.lit(False).alias("done"), F.lit(False).alias("fine"))
    while True:
        rows = _narrowed(rows, size)
        last = size <= cell / FINE
        n = round(size / cell) if size > cell else 1 if size == cell else round(size * FINE / cell)  # cells of the two sizes along a side
        ends = F.col("whole") | F.lit(last) | (F.lit(size == cell) & (F.col("meets") <= MOST_EDGES))
        at = lambda m, done, fine: F.transform(
            F.sequence(F.lit(0), F.lit(m * m - 1)), lambda k: F.struct((F.col("cx") * m + k % m).alias("cx"), (F.col("cy") * m + F.floor(k / m)).alias("cy"), F.lit(done).alias("done"), F.lit(fine).alias("fine"))
        )
        same = F.array(F.struct("cx", "cy", "done", "fine"))
        parts = F.when(F.col("done"), same).when(ends, at(n, True, size < cell)).otherwise(at(2, False, False))
        rows = rows.withColumn("at", F.explode(parts)).select("feature_id", "at.cx", "at.cy", "edges", "odd", "at.done", "at.fine")
        if last:
            return rows.drop("done")
        size /= 2


def _least(e: Column, c: str) -> Column:
    return F.array_min(F.transform(e, lambda q: F.least(q[f"{c}1"], q[f"{c}2"])))


def _most(e: Column, c: str) -> Column:
    return F.array_max(F.transform(e, lambda q: F.greatest(q[f"{c}1"], q[f"{c}2"])))


def point_in_polygon(points: DataFrame, polygons: DataFrame, x: str, y: str, key: str, cell: float = 5.0, name: str = "basin_flag") -> DataFrame:
    """points with the lowest feature_id of the features around them, 0 without one; a point in a hole is outside, one on an
    island in it inside. key is unique among points; null or NaN places have 0.

    polygons: feature_id and ring, a row for each ring (points x and y), and shape where features have several shapes.
    """
    place = lambda c, size: F.floor(F.col(c) / size)
    both = F.array(*[F.struct(F.lit(fine).alias("fine"), place(x, size).alias("cx"), place(y, size).alias("cy")) for fine, size in ((False, cell), (True, cell / FINE))])
    place_of = {"_key": F.col(key), "_px": F.col(x).cast("double"), "_py": F.col(y).cast("double")}
    p = points.select(*[v.alias(k) for k, v in place_of.items()], F.explode(both).alias("_at")).where("NOT isnan(_px) AND NOT isnan(_py)")
    p = p.select("_key", "_px", "_py", "_at.*")
    met = p.join(cover(polygons, cell), ["fine", "cx", "cy"])
    odd = F.when(F.size("edges") == 0, F.col("odd")).otherwise(F.col("odd") != (crossings(F.col("edges"), F.col("_px"), F.col("_py")) % 2 == 1))
    hits = met.where(odd).groupBy(F.col("_key").alias(key)).agg(F.min("feature_id").alias("_id"))
    return points.join(hits, key, "left").withColumn(name, F.coalesce("_id", F.lit(0))).drop("_id")
