"""From cluster centroids to a topic hierarchy."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.labels import model_namer
from ..operators.ladder import Ladder, as_nodes, lineage, merge_ladder
from ..operators.ranking import ordinal
from ..session import cut
from ..sources.centroid_files import load_centroids, unmatched_configs


def run(spark: SparkSession, folder: str, out: str, model=None, **options) -> Ladder:
    """Merge the centroids of all configurations in ``folder`` down the ladder.

    Writes the nodes per level and at the end, the merges, the summary, and every original
    cluster's path. Configurations of which the centroids or the metadata are missing take
    no part and are listed in ``out``/unmatched. A ``model`` names merged groups (see
    `ask`); without one their most frequent words do.
    """
    loaded = load_centroids(spark, folder)
    unmatched_configs(spark, folder).write.parquet(f"{out}/unmatched")
    leaves = cut(ordinal(loaded, ["source_config", "cluster_id"], "node_id"), "leaves")
    nodes = as_nodes(leaves, "node_id", "vec", "cluster_name", "source_config")
    if model is not None:
        options["namer"] = model_namer(model)
    ladder = merge_ladder(nodes, **options)
    leaves.drop("vec").write.parquet(f"{out}/leaves")
    ladder.levels.write.partitionBy("level").parquet(f"{out}/levels")
    ladder.final.write.parquet(f"{out}/final")
    ladder.history.write.parquet(f"{out}/history")
    # As JSON, one record per merged node; a level is a folder.
    ladder.history.write.partitionBy("level").json(f"{out}/history_json")
    ladder.summary.write.parquet(f"{out}/summary")
    lineage(nodes, ladder.history).write.parquet(f"{out}/lineage")
    return ladder
