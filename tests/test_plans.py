"""The four pipelines end to end on small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from topicloom.operators.centroids import centroids
from topicloom.plans import clusters, documents, hierarchy, plots
from topicloom.plans import queries as Q
from topicloom.sources import centroid_files, records, tables


def test_records_to_topics(spark, small, tmp_path):
    raw = str(tmp_path / "raw")
    Q.envelopes(spark, small).select("source", "xml").write.partitionBy("source").text(raw)
    docs = documents.extract_documents(spark, raw, str(tmp_path / "docs"), str(tmp_path / "state"),
                                       pattern="*.txt", record_end=records.RECORD_END)
    assert docs.count() == spark.read.parquet(f"{small}/documents.parquet").count()

    documents.run(docs, str(tmp_path / "final"))
    papers = spark.read.parquet(str(tmp_path / "final" / "papers"))
    assert papers.where("clean_abstract IS NULL OR embedding IS NULL").isEmpty()

    assert papers.select("doc_id").distinct().count() == papers.count()
    configs = [{"epsilon": 0.3, "min_cluster_size": 5}, {"min_cluster_size": 8, "floor": 0.2}]
    out = str(tmp_path / "clusters")
    info = clusters.run(papers, out, "doc_id", configs)
    clustered = spark.read.parquet(f"{out}/clustered")
    assert clustered.count() == papers.count()
    assert info.agg(F.sum("size")).first()[0] == clustered.where("cluster_id <> -1").count()
    assert clustered.where("cluster_id = -1 AND name IS NOT NULL").isEmpty()
    meta = spark.read.json(f"{out}/metadata").first()
    assert meta["n_clusters"] == info.count()
    assert not clusters.run_relabel(clustered, out, "doc_id")
    assert clusters.run_relabel(clustered.withColumn("name", F.lit("")), out, "doc_id")

    # The clusters of both configurations are the leaves of the hierarchy.
    spark.range(1).write.csv(f"{out}/centroids/centroids_9_9")
    done = hierarchy.run(spark, f"{out}/centroids", str(tmp_path / "topics"))
    leaves = spark.read.parquet(str(tmp_path / "topics" / "leaves"))
    configs_of = {r.source_config: r["count"] for r in leaves.groupBy("source_config").count()
                  .collect()}
    assert set(configs_of) <= {"5_5", "5_8"} and info.count() in configs_of.values()
    kept = done.final.agg(F.sum("leaves"), F.array_distinct(F.flatten(F.collect_list("configs")))
                          ).first()
    assert kept[0] == leaves.count() and set(kept[1]) == set(configs_of)
    unmatched = spark.read.parquet(str(tmp_path / "topics" / "unmatched")).collect()
    assert [(r.key, r.missing) for r in unmatched] == [("9_9", "metadata")]
    # The merges as JSON, and the nodes by level, say the same as the tables.
    history = spark.read.parquet(str(tmp_path / "topics" / "history"))
    said = spark.read.schema(history.schema).json(str(tmp_path / "topics" / "history_json"))
    assert sorted(map(tuple, said.select(history.columns).collect())) == sorted(
        map(tuple, history.collect()))
    levels = spark.read.parquet(str(tmp_path / "topics" / "levels"))
    assert sorted(levels.select("level", "node_id", "leaves").collect()) == sorted(
        done.levels.select("level", "node_id", "leaves").collect())

    plots.run(clustered, str(tmp_path / "plots"), "doc_id")
    grid = spark.read.parquet(str(tmp_path / "plots" / "grid"))
    assert grid.agg(F.sum("n")).first()[0] == clustered.count()


def test_centroids_to_hierarchy(spark, small, tmp_path):
    folder = str(tmp_path / "results")
    e = tables.read_table(spark, f"{small}/embeddings.parquet")
    for key, cluster in {(5, 10): F.col("label"), (10, 20): F.col("label") % 5}.items():
        means = centroids(e.withColumn("cluster_id", cluster.cast("bigint")), "cluster_id",
                          "embedding")
        centroid_files.write_centroids(means.withColumn("name", F.lit("topic")), folder, *key, 64)
    done = hierarchy.run(spark, folder, str(tmp_path / "out"))
    left = spark.read.parquet(str(tmp_path / "out" / "final"))
    assert left.agg(F.sum("leaves")).first()[0] == 15
    assert left.count() == done.final.count() < 15
    assert spark.read.parquet(str(tmp_path / "out" / "lineage")).where("round = 0").count() == 15


def test_missing_column(spark):
    with pytest.raises(ValueError):
        tables.require_columns(spark.range(1), "cluster_id")


def test_failing_model_keeps_default_names(spark):
    from topicloom.operators.labels import name_with

    def broken():
        def answer(prompts):
            raise RuntimeError("no connection")
        return answer
    info = spark.createDataFrame([(1, ["a"], "a", "", 900)],
                                 "cluster_id int, keywords array<string>, name string, "
                                 "summary string, size bigint")
    prompts = info.select("cluster_id", "size", F.lit("p").alias("label_prompt"),
                          F.lit("q").alias("summary_prompt"))
    named = name_with(info, prompts, "cluster_id", broken).first()
    assert (named["name"], named["summary"]) == ("a", "")


def test_sample_of_files_in_batches(spark, small, tmp_path):
    """At most max_docs files, the same in every run; a second run adds what is missing."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "docs")
    Q.envelopes(spark, small).select(F.col("doc_id").alias("k"), "xml").where("k < 12").write.partitionBy(
        "k").text(raw)
    how = dict(pattern="*.txt", record_end=records.RECORD_END)
    assert documents.extract_sample(spark, raw, out, 5, files_per_batch=2, **how) == 3
    first = {r.file for r in spark.read.parquet(out).collect()}
    assert len(first) == 5
    assert documents.extract_sample(spark, raw, out, 5, files_per_batch=2, **how) == 0
    docs = documents.extract_documents(spark, raw, out, "", max_docs=100, files_per_batch=4, **how)
    assert docs.count() == 12 and first <= {r.file for r in docs.collect()}


def test_languages_in_the_chain(spark, small, tmp_path):
    from topicloom.operators.language import language_profiles
    known = tables.read_table(spark, f"{small}/documents.parquet")
    profiles = language_profiles(known, "text", "lang")
    raw = known.select(F.col("doc_id").cast("string").alias("file"),
                       F.when(F.col("doc_id") % 4 > 0, F.substring("text", 1, 200)).alias("title"),
                       F.col("text").alias("abstract"))
    documents.run(raw, str(tmp_path / "all"), profiles=profiles)
    got = spark.read.parquet(str(tmp_path / "all" / "papers")).join(
        known.select(F.col("doc_id").cast("string").alias("file"), "lang"), "file")
    assert got.where("title_lang IS NULL").count() >= got.where("title = ''").count() > 0
    assert got.where("abstract_lang = lang").count() > 0.9 * got.count()
    documents.run(raw, str(tmp_path / "known"), profiles=profiles, drop_unknown=True, start=5000)
    kept = spark.read.parquet(str(tmp_path / "known" / "papers"))
    assert kept.where("title_lang IS NULL OR abstract_lang IS NULL OR doc_id < 5000").isEmpty()
    assert kept.count() == got.where("title_lang IS NOT NULL AND abstract_lang IS NOT NULL").count()


def test_layout_as_reduction(spark, small, monkeypatch):
    real = clusters.graph_layout
    monkeypatch.setattr(clusters, "graph_layout", lambda *a: real(*a, rounds=2))
    docs = Q.hashed(spark, small).select("doc_id", F.col("vec").alias("embedding"))
    placed = clusters.reduced(docs, "doc_id", "embedding", "layout", 5)
    assert placed.count() == docs.count()
    assert placed.where("size(reduced) <> 10").isEmpty()


def test_model_names_merged_groups(spark):
    from topicloom.operators import ladder
    from topicloom.operators.labels import model_namer

    def model():
        def answer(prompts):
            if any("red" in p for p in prompts):
                raise RuntimeError("no connection")
            return [f"<think></think> {p.splitlines()[2]}" for p in prompts]
        return answer
    rows = [(0, "blue c", [1.0, 0.0]), (1, "blue a", [1.0, 0.01]), (2, "blue b", [1.0, 0.02]),
            (3, "red", [0.0, 1.0]), (4, "red", [0.01, 1.0])]
    nodes = ladder.as_nodes(spark.createDataFrame(rows, "id int, name string, v array<double>"),
                            "id", "v", "name")
    done = ladder.merge_round(nodes, 0.9, namer=model_namer(model, most=2))
    assert {r.name for r in done.nodes.collect()} == {"blue a, blue b", "General"}


def test_workers_find_the_package_anywhere(tmp_path):
    """A driver that was started elsewhere, with the package on its own path only."""
    import subprocess
    import sys
    from pathlib import Path
    home = str(Path(__file__).resolve().parents[1])
    code = f"""import sys; sys.path.insert(0, {home!r})
from topicloom.session import local_session
from topicloom.operators.encoding import embed_with
spark = local_session(2)
df = spark.createDataFrame([("a b",)], "t string")
print(embed_with(df, "t", lambda: (lambda ts: [[3.0, 4.0] for _ in ts])).first().embedding)"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          timeout=300)
    assert "[0.6, 0.8]" in done.stdout, done.stderr[-2000:]
