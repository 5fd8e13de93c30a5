"""From embedded documents to labelled clusters."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import as_vector, parse_vector, unit
from ..operators.centroids import centroids
from ..operators.density import (MIN_CLUSTER_SIZE, NOISE, pick_best, score_configs, sweep,
                                 sweep_leaves)
from ..operators.descent import knn_descent
from ..operators.labels import (cluster_info, first_texts, label_docs, name_with, prompt_table,
                                relabel, run_metadata)
from ..operators.layout import graph_layout
from ..operators.reduction import COMPONENTS, reduce_dims
from ..session import cut
from ..sources.centroid_files import write_centroids
from ..sources.tables import write_json
from .documents import document_text

DEFAULT_NEIGHBORS = 5  # fixed value


def load_embedded(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Vectors as unit arrays, whether stored as arrays or as text, and the text
    that names clusters."""
    is_text = isinstance(df.schema[vec].dataType, T.StringType)
    v = parse_vector(F.col(vec)) if is_text else as_vector(F.col(vec))
    return document_text(df.withColumn(vec, unit(v)), sep=". ", out="combined_text")


# A configuration's parts that say how to reduce; the rest says how to cluster.
NEIGHBORS = "neighbors"


def reduced(docs: DataFrame, doc: str, vec: str, how: str | None, neighbors: int) -> DataFrame:
    """(doc, reduced): principal components, coordinates from the graph of the ``neighbors``
    nearest rows, or, with None, the vectors themselves.

    Rows that the graph does not hold, such as those without a vector, have null.
    """
    if how is None:
        return docs.select(doc, as_vector(F.col(vec)).alias("reduced"))
    if how == "components":
        return reduce_dims(docs, vec).select(doc, "reduced")
    if how != "layout":
        raise ValueError(f"unknown reduction {how}")
    near = knn_descent(docs, doc, vec, neighbors).withColumn("measure", F.greatest(
        "measure", F.lit(0.0)))
    placed = graph_layout(near, "measure", COMPONENTS).nodes
    return docs.select(doc).join(placed.withColumnRenamed("node", doc), doc, "left").select(
        doc, F.col("coordinates").alias("reduced"))


def swept(spaces: dict[int, DataFrame], doc: str, configs: Sequence[dict]) -> DataFrame:
    """(config, doc, cluster_id) of every configuration, in the space of its ``neighbors``.

    With ``epsilon`` a configuration asks for the clusters at one radius, without for the
    leaves of the hierarchy, see `sweep` and `sweep_leaves`. Configurations that have one
    space in common are swept together.
    """
    runs = []
    for space in {id(s): s for s in spaces.values()}.values():
        for flat, sweeper in ((True, sweep), (False, sweep_leaves)):
            mine = [(n, c) for n, c in enumerate(configs)
                    if spaces[c.get(NEIGHBORS, DEFAULT_NEIGHBORS)] is space
                    and ("epsilon" in c) == flat]
            if mine:
                found = sweeper(space, doc, "reduced", [
                    {k: x for k, x in c.items() if k != NEIGHBORS} for _, c in mine])
                number = F.array(*[F.lit(n) for n, _ in mine])
                found = found.withColumn("config", F.get(number, "config"))
                runs.append(found.select("config", F.col(doc), "cluster_id"))
    # Rows without a usable vector belong to no cluster.
    found = cut(reduce(DataFrame.unionByName, runs), "swept")
    every = F.explode(F.array(*[F.lit(n) for n in range(len(configs))]))
    rows = next(iter(spaces.values())).select(doc, every.alias("config"))
    return cut(rows.join(found, ["config", doc], "left").select(
        "config", doc, F.coalesce("cluster_id", F.lit(NOISE).cast("bigint")).alias("cluster_id")),
        "swept")


def write_config(clustered: DataFrame, info: DataFrame, folder: str, config: dict,
                 vec: str = "embedding") -> None:
    """Write a configuration's mean vectors and names, as `hierarchy.run` reads them.

    The means of the original vectors are written: several configurations share their space.
    """
    means = cut(centroids(clustered, "cluster_id", vec).join(
        info.select("cluster_id", "name"), "cluster_id", "left"), "centroids")
    longest = means.agg(F.max(F.size("vec"))).first()[0]
    write_centroids(means, folder, config.get(NEIGHBORS, DEFAULT_NEIGHBORS),
                    config.get("min_cluster_size", MIN_CLUSTER_SIZE), longest or 0)


def run(df: DataFrame, out: str, doc: str, configs: Sequence[dict], model=None,
        vec: str = "embedding", reduction: str | None = "components",
        every_config: bool = True, **labelling) -> DataFrame:
    """Reduce, cluster, label; write documents, cluster table and run metadata.

    Every configuration is scored and the best one's clusters are kept. ``out``/centroids gets
    the mean vectors and names of all configurations (or of the best), which
    `hierarchy.run` merges. Configurations need distinct (neighbors, min_cluster_size),
    their names there.
    """
    names = [(c.get(NEIGHBORS, DEFAULT_NEIGHBORS), c.get("min_cluster_size", MIN_CLUSTER_SIZE))
             for c in configs]
    if every_config and len(set(names)) < len(names):
        raise ValueError("two configurations have the same neighbors and min_cluster_size")
    docs = cut(load_embedded(df, vec), "embedded")
    every = sorted({n for n, _ in names})
    # Only the layout's space depends on the neighbours.
    own = every if reduction == "layout" else every[:1]
    made = {n: cut(reduced(docs, doc, vec, reduction, n), "reduced") for n in own}
    spaces = {n: made.get(n, made[own[0]]) for n in every}
    runs = swept(spaces, doc, configs)
    best = pick_best(score_configs(runs, "config", "cluster_id"), "config").first()
    info = None
    for number, config in enumerate(configs):
        if number != best["config"] and not every_config:
            continue
        labels = runs.where(F.col("config") == number).select(doc, "cluster_id")
        space = spaces[names[number][0]]
        clustered = docs.join(labels, doc).join(space, doc)
        kept = number == best["config"]
        found = cut(describe(clustered, doc, model if kept else None, **labelling), "info")
        write_config(clustered, found, f"{out}/centroids", config, vec)
        if kept:
            info = found
            label_docs(clustered, info, "cluster_id").write.parquet(f"{out}/clustered")
            info.write.parquet(f"{out}/clusters")
            write_json(run_metadata(labels, "cluster_id", json.dumps(config), model is not None),
                       f"{out}/metadata")
    return info


def describe(clustered: DataFrame, doc: str, model=None, text: str = "combined_text",
             **labelling) -> DataFrame:
    """Keywords, name and size per cluster; a model may rename and summarise."""
    info = cluster_info(clustered, "cluster_id", doc, text, **labelling)
    if model is None:
        return info
    texts = first_texts(clustered, "cluster_id", [doc], text)
    return name_with(info, prompt_table(info, texts, "cluster_id"), "cluster_id", model)


def run_relabel(df: DataFrame, out: str, doc: str, text: str = "combined_text",
                **labelling) -> bool:
    """Name the clusters of a stored table again; False when all have names."""
    relabelled = relabel(df, "cluster_id", doc, text, **labelling)
    if relabelled is None:
        return False
    relabelled.write.parquet(f"{out}/relabelled")
    return True


