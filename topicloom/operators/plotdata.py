"""What a scatter plot of clusters needs: pixel counts, sampled points, colours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .density import NOISE
from .ranking import ordinal, sample_n

# --- Fixed values: they decide results and must stay as they are. -------------
WIDTH, HEIGHT = 1000, 800
HOVER_ROWS = 2000
SEED = 42
PALETTE_LIMITS = {"small": 20, "medium": 256}
MIN_ALPHA, MAX_ALPHA = 80, 255
SPREAD_DENSITY, SPREAD_PIXELS = 0.7, 3
# ------------------------------------------------------------------------------


def plot_points(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Add x and y, the first two entries, and the cluster id as text."""
    return df.withColumns({"x": F.get(vec, F.lit(0)).cast("double"),
                           "y": F.get(vec, F.lit(1)).cast("double"),
                           cluster: F.col(cluster).cast("string")})


def density_grid(points: DataFrame, cluster: str, width: int = WIDTH,
                 height: int = HEIGHT) -> DataFrame:
    """(px, py, cluster, n): points per pixel and cluster, over the data's extent."""
    low_x, high_x, low_y, high_y = points.agg(
        F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()

    def pixel(name: str, low: float | None, high: float | None, pixels: int):
        if low is None or high == low:
            return F.lit(0).cast("bigint")
        place = F.floor((F.col(name) - F.lit(low)) / F.lit(high - low) * pixels)
        return F.least(place, F.lit(pixels - 1)).cast("bigint")

    return (points.select(pixel("x", low_x, high_x, width).alias("px"),
                          pixel("y", low_y, high_y, height).alias("py"), cluster)
            .groupBy("px", "py", cluster).agg(F.count("*").alias("n")))


def hover_sample(points: DataFrame, key: str, cluster: str, title: str,
                 n: int = HOVER_ROWS, seed: int = SEED) -> DataFrame:
    return sample_n(points.select(key, "x", "y", cluster, title), key, n, seed)


def color_index(df: DataFrame, cluster: str) -> DataFrame:
    """(cluster, color_index, palette, is_noise), in the order of ids as text."""
    ids = cut(df.select(F.col(cluster).cast("string").alias(cluster)).distinct(), "ids")
    n = ids.count()
    palette = next((name for name, most in PALETTE_LIMITS.items() if n <= most), "large")
    return (ordinal(ids, [cluster], "color_index")
            .select(cluster, F.col("color_index").cast("bigint").alias("color_index"),
                    F.lit(palette).alias("palette"),
                    (F.col(cluster) == str(NOISE)).alias("is_noise")))


def shades(grid: DataFrame, cluster: str, min_alpha: int = MIN_ALPHA) -> DataFrame:
    """(px, py, n, cluster, share, level, alpha): how strongly each pixel of a `density_grid` is
    drawn, and for which cluster.

    ``level`` equalises the histogram: the share of filled pixels that hold no more points.
    ``alpha`` runs from ``min_alpha`` at the lowest level to 255 at the highest. ``cluster`` is
    the one with most points in the pixel, the first by name among equals, and ``share`` its
    part of them. The distribution of counts has a row for each count that occurs.
    """
    first = F.min(F.struct((-F.col("n")).alias("_n"), F.col(cluster).alias("_c")))
    pixels = cut(grid.groupBy("px", "py").agg(
        F.sum("n").alias("total"), first.alias("_first")).select(
        "px", "py", "total", (-F.col("_first._n")).alias("_most"),
        F.col("_first._c").alias(cluster)), "pixels")
    counts = pixels.groupBy("total").agg(F.count("*").alias("pixels"))
    # One row for each number of points that some pixel holds.
    so_far = F.sum("pixels").over(Window.orderBy("total"))
    levels = counts.select("total", (so_far / F.sum("pixels").over(Window.partitionBy()))
                           .alias("level"))
    low, high = levels.agg(F.min("level"), F.max("level")).first()
    place = (F.col("level") - F.lit(low)) / F.lit((high or 0) - (low or 0)) if low != high else (
        F.lit(1.0))
    alpha = F.round(min_alpha + (MAX_ALPHA - min_alpha) * place, 6)
    return pixels.join(levels, "total").select(
        "px", "py", F.col("total").alias("n"), cluster,
        (F.col("_most") / F.col("total")).alias("share"), "level", alpha.alias("alpha"))


def _moved(pixels: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Every row once for each offset, at the pixel it reaches."""
    steps = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
                                for x, y in offsets]))
    return pixels.withColumn("_by", steps).withColumns(
        {"px": F.col("px") + F.col("_by.x"), "py": F.col("py") + F.col("_by.y")})


def filled_share(pixels: DataFrame, radius: int) -> float:
    """How much of the square around a filled pixel is filled too, on average."""
    box = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1)
           if (x, y) != (0, 0)]
    filled = pixels.select("px", "py")
    total, met = filled.count(), _moved(filled, box).join(filled, ["px", "py"]).count()
    return met / (total * len(box)) if total else 1.0


def spread(shaded: DataFrame, cluster: str, radius: int | None = None, width: int = WIDTH,
           height: int = HEIGHT) -> DataFrame:
    """The shades with every pixel grown to a disc, so that lone points can be seen.

    Where discs meet the strongest wins; then the one of more points, then the pixel that
    comes first. Without a ``radius`` the largest of at most `SPREAD_PIXELS` is taken up to
    which the picture is not too full.
    """
    if radius is None:
        radius = 0
        while radius < SPREAD_PIXELS and filled_share(shaded, radius + 1) <= SPREAD_DENSITY:
            radius += 1
    disc = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1)
            if x * x + y * y <= radius * radius]
    own = F.struct(F.col("alpha"), F.col("n"), (-F.col("px")).alias("x"), (-F.col("py")).alias("y"),
                   F.col(cluster).alias("_c"))
    grown = _moved(shaded.select("px", "py", own.alias("own")), disc)
    inside = F.col("px").between(0, width - 1) & F.col("py").between(0, height - 1)
    return (grown.where(inside).groupBy("px", "py").agg(F.max("own").alias("own"))
            .select("px", "py", F.col("own._c").alias(cluster), F.col("own.n").alias("n"),
                    F.col("own.alpha").alias("alpha")))
