"""Agreement of two rasters by cell: six sums, combined map-side, then one formula."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..grid import Grid

KEY = ["r", "c"]
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def cell_of(at: Column, size: int) -> Column:
    return F.floor(at / size).cast("long")


def six_sums(x: Column, y: Column, prefix: str = "", where: Column | None = None) -> list[Column]:
    """Aggregates n, sx, sy, sxx, syy, sxy over rows where both are known."""
    both = x.isNotNull() & y.isNotNull() & (F.lit(True) if where is None else where)
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    values = (F.count(x), F.sum(x), F.sum(y), F.sum(x * x), F.sum(y * y), F.sum(x * y))
    return [v.alias(prefix + k) for k, v in zip(SUMS, values)]


def pearson(prefix: str = "") -> Column:
    """Correlation from six sums; null where either side is constant or empty."""
    n, sx, sy, sxx, syy, sxy = (F.col(prefix + k).cast("double") for k in SUMS)
    spread = (n * sxx - sx * sx) * (n * syy - sy * sy)
    return F.when(spread > 0, (n * sxy - sx * sy) / F.sqrt(spread))


def agreement(moving: DataFrame, reference: DataFrame, cell: int, band: str = "dn") -> DataFrame:
    """Per cell: six sums of band where both are valid, r, and miss, the share of valid reference pixels without moving.

    Both: r, c, band, valid. One equi-join on the lattice, one aggregation with partial sums.
    """
    ref = reference.where("valid").select(*KEY, F.col(band).alias("y"))
    mov = moving.where("valid").select(*KEY, F.col(band).alias("x"))
    both = ref.join(mov, KEY, "left")
    cells = both.groupBy(cell_of(F.col("r"), cell).alias("crow"), cell_of(F.col("c"), cell).alias("ccol"))
    out = cells.agg(*six_sums(F.col("x"), F.col("y")), F.count("*").alias("n_ref"))
    return out.select("crow", "ccol", *SUMS, pearson().alias("r"), (F.lit(1.0) - F.col("n") / F.col("n_ref")).alias("miss"))


def quality_cells(pixels: DataFrame, cell: int, min_share: float = 0.25) -> DataFrame:
    """Per cell: r before and after a warp, mean shift, and counts.

    pixels: r, c, reference, before, after (null where not valid), u, v. Cells below min_share of their pixels have no r.
    """
    least = min_share * cell * cell
    sums = pixels.groupBy(cell_of(F.col("r"), cell).alias("crow"), cell_of(F.col("c"), cell).alias("ccol")).agg(
        *six_sums(F.col("before"), F.col("reference"), "b_"), *six_sums(F.col("after"), F.col("reference"), "a_"),
        F.avg("u").alias("mean_u"), F.avg("v").alias("mean_v"),
    )
    scored = lambda p: F.when(F.col(p + "n") >= least, pearson(p))
    return sums.withColumn("r_before", scored("b_")).withColumn("r_after", scored("a_"))


def pooled(cells: DataFrame, prefix: str = "") -> DataFrame:
    """One r over all cells: their sums are added first."""
    return cells.agg(*[F.sum(prefix + k).alias(k) for k in SUMS]).select("n", pearson().alias("r"))


def map_summary(cells: DataFrame, res: float, cell: int, far_cm: float = 50.0) -> DataFrame:
    """Median move, mapped area, area and share of cells moved more than far_cm, pooled r before and after, look flag."""
    moved = F.hypot("mean_u", "mean_v") * res * 100
    mapped = cells.where("r_after IS NOT NULL").withColumn("move", moved)
    ha = (cell * res) ** 2 / 10_000
    far = F.count_if(F.col("move") > far_cm)
    out = mapped.agg(
        F.median("move").alias("median_move_cm"), (F.count("*") * ha).alias("mapped_ha"), (far * ha).alias("far_ha"), (far * 100.0 / F.count("*")).alias("far_pct"),
        *[F.sum(p + k).alias(p + k) for p in ("b_", "a_") for k in SUMS],
    ).select("median_move_cm", "mapped_ha", "far_ha", "far_pct", pearson("b_").alias("r_before"), pearson("a_").alias("r_after"))
    return out.withColumn("look", (F.col("far_pct") > 0.5) | ~F.coalesce(F.col("r_after") > F.col("r_before"), F.lit(False)))


def gradient(px: DataFrame, band: str, *, keys: list[str] | None = None) -> DataFrame:
    """px with gr and gc: central differences inside, one-sided at the edges of each group, null for a single line."""
    keys = keys or []

    def along(at: str, across: str) -> Column:
        w = Window.partitionBy(*keys, across).orderBy(at)
        before, after = F.lag(band).over(w), F.lead(band).over(w)
        return F.when(before.isNotNull() & after.isNotNull(), (after - before) / 2.0).when(after.isNotNull(), (after - F.col(band)).cast("double")).otherwise((F.col(band) - before).cast("double"))

    return px.withColumn("gr", along("r", "c")).withColumn("gc", along("c", "r"))


def texture_cells(product: DataFrame, anchor: DataFrame, cell: int, block: int, min_n: int, band: str = "dn") -> DataFrame:
    """Per cell: r over textured pixels and the share of anchor pixels that the product misses.

    Textured: gradient of the anchor above the median of its block's pixels valid in both. block: whole cells.
    """
    if block % cell:
        raise ValueError("a block must be whole cells")
    ref = anchor.withColumn("br", cell_of(F.col("r"), block)).withColumn("bc", cell_of(F.col("c"), block))
    ref = gradient(ref, band, keys=["br", "bc"]).withColumn("mag", F.hypot(F.coalesce("gr", F.lit(0.0)), F.coalesce("gc", F.lit(0.0))))
    both = ref.where("valid").select(*KEY, "br", "bc", "mag", F.col(band).alias("y")).join(product.where("valid").select(*KEY, F.col(band).alias("x")), KEY, "left")
    mid = both.where("x IS NOT NULL").groupBy("br", "bc").agg(F.median("mag").alias("mid"))
    rows = both.join(mid, ["br", "bc"], "left")
    cells = rows.groupBy(cell_of(F.col("r"), cell).alias("crow"), cell_of(F.col("c"), cell).alias("ccol"))
    out = cells.agg(*six_sums(F.col("x"), F.col("y"), where=F.col("mag") > F.col("mid")), (F.lit(1.0) - F.count("x") / F.count("*")).alias("miss"))
    return out.select("crow", "ccol", "n", F.when(F.col("n") >= min_n, pearson()).alias("r"), "miss")


def registration_cells(product: DataFrame, product_grid: Grid, anchor: DataFrame, anchor_grid: Grid, cell_m: float, block_m: float, min_n: int = 500, like: Grid | None = None, band: str = "dn") -> DataFrame:
    """texture_cells() of two rasters on their own grids; cells lie on the lattice of like, else of the anchor.

    A cell must be whole pixels and all grids on one lattice; a block is rounded to whole cells, one at least. Rasters that
    share no valid pixel are refused.
    """
    base = like or anchor_grid
    cell = cell_m / anchor_grid.res
    if abs(cell - round(cell)) > 1e-6 or round(cell) < 1:
        raise ValueError(f"a cell of {cell_m} m is not whole pixels of {anchor_grid.res} m")
    cell = round(cell)
    block = max(1, round(block_m / anchor_grid.res / cell)) * cell
    keyed = []
    for rows, grid in ((product, product_grid), (anchor, anchor_grid)):
        moved = base.shift_to(grid)
        if moved is None:
            raise ValueError("the rasters are not on one lattice")
        keyed.append(rows.withColumn("r", F.col("r") + moved[0]).withColumn("c", F.col("c") + moved[1]))
    valid = [x.where("valid").select(*KEY) for x in keyed]
    if not valid[0].join(valid[1], KEY, "left_semi").limit(1).count():
        raise ValueError("the rasters do not overlap")
    return texture_cells(*keyed, cell, block, min_n, band)
