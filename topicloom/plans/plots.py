"""Tables a scatter plot is drawn from."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.plotdata import (color_index, density_grid, hover_sample, plot_points, shades,
                                  spread)


def run(clustered: DataFrame, out: str, doc: str, vec: str = "reduced",
        title: str = "title") -> None:
    points = plot_points(clustered, vec, "cluster_id")
    density_grid(points, "cluster_id").write.parquet(f"{out}/grid")
    grid = clustered.sparkSession.read.parquet(f"{out}/grid")
    spread(shades(grid, "cluster_id"), "cluster_id").write.parquet(f"{out}/shades")
    hover_sample(points, doc, "cluster_id", title).write.parquet(f"{out}/hover")
    color_index(points, "cluster_id").write.parquet(f"{out}/colors")
