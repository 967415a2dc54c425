"""Fill and diffusion of grids of any size by tiles.

A cell's value after some steps depends on the cells within as many hops of the stencil. So a tile with a halo that many hops deep
takes that many steps by itself, and its own cells come out exact. A round deals the values to tiles and halos, takes the steps in
every tile and stores the tiles' own cells; rounds of filling go on until one changes no cell of any grid. A task holds a tile and
its halo, whatever the size of a grid, and a lost executor costs no more than its tiles of one round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.segments import met
from tidewright.session import released, stored

#: Cells along a tile's side, and the steps of a round: a halo of 16 about a tile of 128 makes half as many rows again.
SIDE, DEPTH = 128, 16
Tile = Callable[[Column], Column]


def squares(n_cols: int, side: int = SIDE) -> Tile:
    """The tile of a cell of a grid that is numbered along rows of n_cols cells."""
    across = -(-n_cols // side)
    return lambda cell: (F.floor(cell / (n_cols * side)) * across + F.floor((cell % n_cols) / side)).cast("long")


def halos(stencil: DataFrame, tile: Tile, depth: int) -> DataFrame:
    """cell, tile and ring: the cells outside a tile that one of its cells reaches in ring hops, the fewest, up to depth."""
    links = stored(stencil.where("row <> col AND val <> 0").select("row", "col").distinct(), "links")
    edge = stored(links.select(F.col("col").alias("cell"), tile(F.col("row")).alias("tile")).where(tile(F.col("cell")) != F.col("tile")).distinct(), "ring")
    rings = [edge]
    for _ in range(1, depth):
        onward = edge.join(links, F.col("cell") == F.col("row")).select(F.col("col").alias("cell"), "tile")
        onward = onward.where(tile(F.col("cell")) != F.col("tile")).distinct()
        for ring in rings:
            onward = onward.join(ring, ["cell", "tile"], "left_anti")
        edge = stored(onward, "ring")
        rings.append(edge)
    out = rings[0].withColumn("ring", F.lit(1))
    for k, ring in enumerate(rings[1:], 2):
        out = out.unionByName(ring.withColumn("ring", F.lit(k)))
    out = stored(out, "halos")
    released(links, *rings)
    return out


def places(stencil: DataFrame, tile: Tile, depth: int) -> DataFrame:
    """A row for each cell with its stencil row (arrays cols and vals) and the tiles whose halo holds it (array halo)."""
    entries = stencil.groupBy(F.col("row").alias("cell")).agg(F.sort_array(F.collect_list(F.struct("col", "val"))).alias("_e"))
    entries = entries.select("cell", F.col("_e.col").cast("array<long>").alias("cols"), F.col("_e.val").cast("array<double>").alias("vals"))
    around = halos(stencil, tile, depth)
    held = around.groupBy("cell").agg(F.collect_list(F.struct("tile", "ring")).alias("halo"))
    out = stored(entries.join(held, "cell", "full").withColumn("cell", F.col("cell").cast("long")), "places")
    released(around)
    return out


def _steps(key: str, steps: int, filling: bool):
    def run(rows: pa.Table) -> pa.Table:
        cells, v = rows["cell"].to_numpy(), rows["v"].to_numpy().astype(float)  # unknown values come as NaN
        ocean, own = rows["ocean"].to_numpy(), rows["ring"].to_numpy() == 0
        cols, vals = (pa.concat_arrays(rows[c].chunks) for c in ("cols", "vals"))
        r = np.repeat(np.arange(len(v)), pc.fill_null(pc.list_value_length(cols), 0).to_numpy())
        order = np.argsort(cells)
        at, w = cols.flatten().to_numpy(), vals.flatten().to_numpy()
        c = order[np.minimum(np.searchsorted(cells, at, sorter=order), len(v) - 1)]
        there = cells[c] == at  # entries of cells that the grid does not have are left out
        r, c, w = r[there], c[there], w[there]
        before = np.isnan(v)
        if filling:
            off = r != c
            r, c, w = r[off], c[off], w[off]
        for _ in range(steps):
            if not filling:
                v = v + np.bincount(r, weights=v[c] * w, minlength=len(v))
                continue
            known = ~np.isnan(v)
            n = np.bincount(r, weights=known[c] * w, minlength=len(v))
            todo = ~known & ocean & (n != 0)
            if not todo.any():
                break
            v[todo] = np.bincount(r, weights=np.where(known, v, 0)[c] * w, minlength=len(v))[todo] / n[todo]
        columns = {key: rows[key], "cell": rows["cell"], "v": pa.array(v, from_pandas=True), "ocean": rows["ocean"], "changed": pa.array(before & ~np.isnan(v))}
        return pa.table(columns).filter(pa.array(own))

    return run


def _round(state: DataFrame, around: DataFrame, key: str, tile: Tile, depth: int, steps: int, filling: bool) -> DataFrame:
    first = F.array(F.struct(tile(F.col("cell")).alias("tile"), F.lit(0).alias("ring")))
    each = state.drop("changed").join(around, "cell", "left").withColumn("_at", F.explode(F.concat(first, F.coalesce("halo", F.array().cast("array<struct<tile: bigint, ring: int>>")))))
    inner = F.col("_at.ring") < depth  # the outermost ring gives values and takes none
    dealt = each.select(*state.drop("changed").columns, F.col("_at.tile").alias("tile"), F.col("_at.ring").alias("ring"), F.when(inner, F.col("cols")).alias("cols"), F.when(inner, F.col("vals")).alias("vals"))
    out = T.StructType([f for f in state.drop("changed").schema] + [T.StructField("changed", T.BooleanType())])
    return stored(dealt.groupBy(key, "tile").applyInArrow(_steps(key, steps, filling), out), "tiles")


def fill_and_diffuse(grid: DataFrame, stencil: DataFrame | Iterable[tuple[int, int, float]], steps: int, tile: Tile, key: str = "grid_date", depth: int = DEPTH) -> DataFrame:
    """grid (key, cell, v, basin_id, any others) filled until no cell changes and then diffused for so many steps, as
    `grid.fill_and_diffuse` does it in one group a grid.

    A grid has a cell once; rows without a cell stay as they are. tile gives a cell's tile, see `squares`; stencil is row, col,
    val. Cells of a grid that the stencil lacks stay, entries of cells that a grid lacks do not count, NaN is unknown, and grids
    without rows give none. Runs its rounds when called; the last one's table stays in the shared folder.
    """
    spark = grid.sparkSession
    if not isinstance(stencil, DataFrame):
        stencil = spark.createDataFrame(list(stencil), "row long, col long, val double")
    ocean = F.coalesce((F.col("basin_id") > 0) & (F.col("basin_id") < 1000), F.lit(False))
    v = F.col("v").cast("double")
    state = grid.where("cell IS NOT NULL").select(key, F.col("cell").cast("long").alias("cell"), F.when(~F.isnan(v), v).alias("v"), ocean.alias("ocean"))
    state, around = stored(state, "tiles"), places(stencil, tile, depth)

    def then(steps: int, filling: bool) -> DataFrame:
        new = _round(state, around, key, tile, depth, steps, filling)
        released(state)
        return new

    more = not state.where("v IS NULL AND ocean").isEmpty()
    while more:
        state = then(depth, True)
        more = not state.where("changed").isEmpty()
    for done in range(0, steps, depth):
        state = then(min(depth, steps - done), False)
    released(around)
    filled = met(grid.where("cell IS NOT NULL"), state.select(key, "cell", F.col("v").alias("_v")), [key, "cell"])
    filled = filled.withColumn("v", F.col("_v").cast(grid.schema["v"].dataType)).select(*grid.columns)
    return filled.unionByName(grid.where("cell IS NULL"))
