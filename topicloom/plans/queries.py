"""One query per operator over the given tables, by name.

Each takes a session and a folder of Parquet tables. Vectors come out in long
form (id, pos, value) and numbers rounded, so that results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..operators import density, descent, ladder, labels, language, layout, neighbours, plotdata
from ..operators.centroids import centroids, mean_vectors
from ..operators.encoding import embed_with
from ..operators.graph import connected_components
from ..operators.ranking import ordinal, sample_n
from ..operators.reduction import reduce_dims
from ..operators.tfidf import tfidf_terms, token_counts
from ..session import cut, scratch_path
from ..sources import centroid_files, records, tables
from ..streaming import upsert
from ..streaming.ingest import ingest
from . import clusters, hierarchy
from . import documents as D

KEYS = {"documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "labels": "doc_id",
        "conversations": "conv_id", "benchmark": "item_id"}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Word lists with hits in the given texts, next to the built-in ones without.
TYPES = {"contact": r"(?i)(?:^|[^\p{L}\p{N}_])(?:email|key|token|license|copyright)"
                    r"(?:[^\p{L}\p{N}_]|$)"}
OPENING_WORDS = [*X.BOILERPLATE_WORDS, "the", "la", "der", "un"]
CUTS = [0.46, 0.44, 0.42, 0.40, 0.38, 0.36]


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Its files are one row group each, which one task reads, so a
    session on one machine deals the rows to its cores; a cluster reads as it scans."""
    df = tables.read_table(spark, f"{folder}/{name}.parquet")
    context = spark.sparkContext
    if context.master.startswith("local["):
        return df.repartition(context.defaultParallelism, KEYS[name])
    return df


def long_form(df: DataFrame, ids: Sequence[str], vec: str, *more: str) -> DataFrame:
    return (V.entries(df, [*ids, *more], vec)
            .select(*ids, *more, F.col("pos").cast("bigint").alias("pos"),
                    F.round("x", 6).alias("value")))


# --- Derived inputs, one row per given row ------------------------------------

def titled(spark, folder) -> DataFrame:
    """Every document with its whole text as abstract, titled where a quality label exists;
    and a record without abstract for every label, its title blank where quality is 0."""
    docs, lab = read(spark, folder, "documents"), read(spark, folder, "labels")
    quality = F.concat(F.lit("quality "), F.col("quality").cast("string"))
    given = docs.join(lab, "doc_id", "left").select(
        "doc_id", "lang", "source", quality.alias("title"), F.col("text").alias("abstract"))
    none = F.lit(None).cast("string")
    bare = lab.select(
        (-1 - F.col("doc_id")).alias("doc_id"), none.alias("lang"), none.alias("source"),
        F.when(F.col("quality") == 0, F.lit(" \u3000\u00a0")).otherwise(quality).alias("title"),
        none.alias("abstract"))
    return given.unionByName(bare)


def clustered(spark, folder) -> DataFrame:
    """Documents with the number of their source as cluster, 0 read as noise."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("bigint")
    return read(spark, folder, "documents").select(
        "doc_id", F.when(number == 0, -1).otherwise(number).alias("cluster_id"), "text")


def noisy_labels(spark, folder, limit: float = 0.1) -> DataFrame:
    """Vectors with their label, noise where the first entry is large."""
    first = F.get("embedding", F.lit(0)).cast("double")
    return read(spark, folder, "embeddings").select(
        "vec_id", "embedding",
        F.when(first > limit, -1).otherwise(F.col("label")).cast("bigint").alias("cluster_id"))


def hashed(spark, folder) -> DataFrame:
    """Hashed text vectors, written once as the pipelines do: the operators read
    their input more than once."""
    return cut(read(spark, folder, "documents").select(
        "doc_id", "lang", "source", V.hash_embed(F.col("text")).alias("vec")), "hashed")


def topic_nodes(spark, folder) -> DataFrame:
    """Mean hashed vector per language and source, as ladder nodes."""
    means = mean_vectors(hashed(spark, folder), ["lang", "source"], "vec")
    numbered = ordinal(means, ["lang", "source"], "node_id")
    return ladder.as_nodes(numbered.withColumn("name", F.concat_ws(" ", "lang", "source")),
                           "node_id", "vec", "name")


def envelopes(spark, folder) -> DataFrame:
    """Documents as RDF records: English title (not for German), untagged title
    (only with a quality label), and the text as notation."""
    docs, lab = read(spark, folder, "documents"), read(spark, folder, "labels")
    english = F.when(F.col("lang") != "de", F.concat_ws(" ", "source", F.col("doc_id")))
    other = F.concat(F.lit("quality "), F.col("quality").cast("string"))
    xml = records.to_record([(english, "en"), (other, None)], F.col("text"))
    return docs.join(lab, "doc_id", "left").select("doc_id", "lang", "source", xml.alias("xml"))


# --- Sources and sinks ---------------------------------------------------------

@query
def extract_record(spark, folder):
    found = records.extract_record(
        envelopes(spark, folder).withColumn("file", F.col("doc_id").cast("string")), "file", "xml")
    return found.select(F.col("file").cast("bigint").alias("doc_id"), "title", "abstract",
                        "corrupt")


@query
def scan_records(spark, folder):
    root = scratch_path(spark, "records")
    envelopes(spark, folder).select("lang", "xml").write.partitionBy("lang").text(root)
    found = records.scan_records(spark, root, "*.txt", records.RECORD_END)
    return found.select("title", "abstract")


@query
def ingest_incremental(spark, folder):
    root, out = scratch_path(spark, "archives"), scratch_path(spark, "ingested")
    state = scratch_path(spark, "ingest-state")
    envelopes(spark, folder).select("lang", "source", "xml").write.partitionBy(
        "lang", "source").text(root)
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, root, out, state, pattern="*.txt", record_end=records.RECORD_END,
               files_per_batch=20)
    return spark.read.parquet(out).select("title", "abstract")


@query
def ingest_upsert(spark, folder):
    """Three deliveries: documents with even ids, all documents, and the German ones changed."""
    root, out, state = (scratch_path(spark, f"upsert-{k}") for k in ("in", "out", "state"))
    docs = read(spark, folder, "documents")
    deliveries = [docs.where("doc_id % 2 = 0"), docs,
                  docs.where("lang = 'de'").withColumn("text", F.concat(F.lit("new "), "text"))]
    for number, rows in enumerate(deliveries):
        xml = records.to_record([(F.concat(F.lit("record "), F.col("doc_id")), None)], F.col("text"))
        rows.select(xml).write.text(f"{root}/{number}")
        upsert.ingest_upsert(spark, root, out, state, F.col("title"), pattern="*.txt",
                             record_end=records.RECORD_END)
    return upsert.newest(spark, out).select(
        F.substring_index("key", " ", -1).cast("bigint").alias("doc_id"), "version", "abstract")


@query
def union_batches(spark, folder):
    docs = read(spark, folder, "documents").select(
        F.lit("documents").alias("batch"), F.col("doc_id").alias("id"), "text", "lang")
    bench = read(spark, folder, "benchmark").select(
        "text", F.lit("benchmark").alias("batch"), F.col("item_id").alias("id"))
    return tables.union_batches(docs, bench)


@query
def roundtrip_csv(spark, folder):
    return tables.roundtrip_csv(titled(spark, folder).select(
        F.col("doc_id").cast("string").alias("file"), "title", "abstract"))


@query
def sample_docs(spark, folder):
    return sample_n(read(spark, folder, "documents").select("doc_id", "lang"), "doc_id", 100)


@query
def load_centroids(spark, folder):
    root = scratch_path(spark, "configs")
    e = read(spark, folder, "embeddings")
    above = [F.when(F.get("embedding", F.lit(k)) > 0, 1 << k).otherwise(0) for k in range(3)]
    for key, cluster in {(5, 10): F.col("label"), (10, 20): above[0] + above[1] + above[2]}.items():
        means = centroids(e.withColumn("cluster_id", cluster.cast("bigint")), "cluster_id",
                          "embedding")
        named = means.withColumn("name", F.concat(F.lit("topic "), F.col("cluster_id")))
        centroid_files.write_centroids(named, root, *key, dims=64)
    return long_form(centroid_files.load_centroids(spark, root),
                     ["source_config", "cluster_id"], "vec", "cluster_name")


# --- Text ------------------------------------------------------------------------

@query
def drop_empty(spark, folder):
    return D.drop_empty(titled(spark, folder)).select("doc_id", "title", "abstract")


@query
def clean_text(spark, folder):
    """Document texts set in some LaTeX, so that every rule has work."""
    marked = F.concat(F.lit("\\begin{abstract} \\emph{"), F.col("source"), F.lit("} "),
                      F.col("text"), F.lit("\n ``na\\\"ive'' $\\alpha_"), F.col("lang"),
                      F.lit("$ l\\'eau \\cite \u3000\u00a0\u2028 \\end{abstract}"))
    return D.clean(read(spark, folder, "documents").withColumn("abstract", marked)).select(
        "doc_id", "clean_abstract")


@query
def clean_html(spark, folder):
    return D.clean(read(spark, folder, "pages"), "html", "clean_html").select(
        "page_id", "clean_html")


@query
def classify_docs(spark, folder):
    docs = read(spark, folder, "documents")
    by_given = X.document_type(F.col("text"), TYPES)
    return docs.select("doc_id", by_given.alias("type"),
                       X.document_type(F.concat(F.lit("LHD #"), "source")).alias("coded_type"),
                       X.document_type(F.concat(F.lit("lhd "), F.col("n_chars"))).alias("shot_type"))


@query
def route_by_type(spark, folder):
    typed = read(spark, folder, "documents").select(
        X.document_type(F.col("text"), TYPES).alias("type"), "n_chars")
    return typed.groupBy("type").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@query
def drop_boilerplate(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", X.clean_markup(F.col("text"))
                                                   .alias("clean_abstract"))
    return D.drop_boilerplate(docs, words=OPENING_WORDS).select("doc_id", "clean_abstract")


@query
def doc_text(spark, folder):
    t = titled(spark, folder)
    return t.select("doc_id",
                    X.joined(F.col("title"), F.col("abstract"), sep=" ").alias("embedding_text"),
                    X.joined(F.col("title"), F.col("abstract"), sep=". ").alias("combined_text"))


@query
def funnel_counts(spark, folder):
    funnel = D.Funnel()
    chain = D.prepare_documents(titled(spark, folder), lambda df: df, funnel,
                                title="abstract", types=TYPES)
    chain.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(funnel.counts(), "position bigint, stage string, n bigint")


@query
def q_token_counts(spark, folder):
    return token_counts(read(spark, folder, "documents"), "lang", "text")


@query
def q_tfidf_terms(spark, folder):
    return (tfidf_terms(read(spark, folder, "documents"), "lang", "doc_id", "text")
            .withColumn("rank", F.col("rank").cast("bigint")))


@query
def language_id(spark, folder):
    """Documents with odd ids, by what those with even ids teach."""
    docs = read(spark, folder, "documents")
    known = language.language_profiles(docs.where("doc_id % 2 = 0"), "text", "lang")
    return language.language_id(docs.where("doc_id % 2 = 1"), "doc_id", "text", known)


@query
def known_language(spark, folder):
    """Rows whose title and abstract both have a language, given as labels."""
    t = titled(spark, folder).select(
        "doc_id", F.when(F.col("title").isNotNull(), F.lit("en")).alias("title_lang"),
        F.when(~X.is_blank(F.col("abstract")), F.col("lang")).alias("abstract_lang"))
    return language.drop_unknown_language(t, "title_lang", "abstract_lang")


# --- Vectors -----------------------------------------------------------------------

@query
def hash_embed(spark, folder):
    return long_form(hashed(spark, folder), ["doc_id"], "vec")


@query
def q_embed_with(spark, folder):
    def encoder():
        return lambda texts: [[len(t), t.count(" "), t.count("e"), 1] for t in texts]
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return long_form(embed_with(docs, "text", encoder), ["doc_id"], "embedding")


@query
def parse_vector(spark, folder):
    written = read(spark, folder, "embeddings").select(
        "vec_id", F.to_json(V.as_vector(F.col("embedding"))).alias("literal"))
    return long_form(written.select("vec_id", V.parse_vector(F.col("literal")).alias("v")),
                     ["vec_id"], "v")


@query
def l2_normalize(spark, folder):
    """Vectors scaled by their label, so label 0 gives zero vectors, with the
    first entry made infinite where it is large."""
    v = F.transform(V.as_vector(F.col("embedding")), lambda x, k: F.when(
        (k == 0) & (x > 0.2), F.lit(float("inf"))).otherwise(x * F.col("label")))
    e = read(spark, folder, "embeddings").select("vec_id", V.unit(V.finite(v)).alias("v"))
    return long_form(e, ["vec_id"], "v")


@query
def cosine_pairs(spark, folder):
    return neighbours.cosine_pairs(read(spark, folder, "embeddings"), "vec_id", "embedding",
                                   0.4).withColumn("cosine", F.round("cosine", 6))


@query
def cosine_pairs_texts(spark, folder):
    return neighbours.cosine_pairs(hashed(spark, folder), "doc_id", "vec", 0.9).withColumn(
        "cosine", F.round("cosine", 6))


@query
def vector_copies(spark, folder):
    return neighbours.copies_of(hashed(spark, folder), "doc_id", "vec").select(
        F.col("id").alias("doc_id"), F.col("point").alias("first_copy"))


@query
def knn_graph(spark, folder):
    return (neighbours.knn_graph(read(spark, folder, "embeddings"), "vec_id", "embedding", 5)
            .select("i", "j", "rank", F.round("measure", 6).alias("cosine")))


@query
def knn_graph_texts(spark, folder):
    """Neighbours among texts, many of which are copies of each other."""
    return (neighbours.knn_graph(hashed(spark, folder), "doc_id", "vec", 5)
            .select("i", "j", "rank", F.round("measure", 6).alias("cosine")))


@query
def q_reduce_dims(spark, folder):
    e = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return long_form(reduce_dims(e, "embedding"), ["vec_id"], "reduced")


# --- Graphs and clusters -------------------------------------------------------------

@query
def q_connected_components(spark, folder):
    """Components of the pair table itself, embedded vectors at cosine 0.35."""
    pairs = neighbours.cosine_pairs(read(spark, folder, "embeddings"), "vec_id", "embedding", 0.35)
    return connected_components(pairs)


@query
def threshold_cuts(spark, folder):
    return density.threshold_cuts(read(spark, folder, "embeddings"), "vec_id", "embedding", CUTS)


@query
def threshold_groups_texts(spark, folder):
    return density.threshold_groups(hashed(spark, folder), "doc_id", "vec", 0.9)


@query
def core_distance(spark, folder):
    e = read(spark, folder, "embeddings")
    return density.core_distance(e, "vec_id", "embedding").withColumn("core", F.round("core", 6))


@query
def mutual_reachability(spark, folder):
    e = read(spark, folder, "embeddings")
    pairs = density.euclidean_pairs(e, "vec_id", "embedding", 1.1)
    cores = density.core_distance(e, "vec_id", "embedding")
    return density.mutual_reachability(pairs, cores, "vec_id").withColumn(
        "reach", F.round("reach", 6))


@query
def density_clusters(spark, folder):
    return density.density_clusters(hashed(spark, folder), "doc_id", "vec", epsilon=0.5)


@query
def density_leaves(spark, folder):
    return density.density_leaves(hashed(spark, folder), "doc_id", "vec",
                                  [0.8, 0.7, 0.6, 0.5, 0.4, 0.3])


RADII = [0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25]


@query
def density_tree(spark, folder):
    """The clusters at twelve radii, from one tree."""
    tree = density.density_tree(hashed(spark, folder), "doc_id", "vec", max(RADII))
    return density.clusters_at(tree, RADII).withColumnRenamed("node", "doc_id")


@query
def density_tree_leaves(spark, folder):
    tree = density.density_tree(hashed(spark, folder), "doc_id", "vec", 0.8)
    return density.tree_leaves(tree, floor=0.3).withColumnRenamed("node", "doc_id")


SWEEP = [{"min_samples": 5, "min_cluster_size": 10, "floor": 0.3, "largest": 0.8},
         {"min_samples": 5, "min_cluster_size": 20, "floor": 0.5, "largest": 0.8},
         {"min_samples": 3, "min_cluster_size": 10, "floor": 0.3, "largest": 0.7}]


@query
def sweep_leaves(spark, folder):
    return density.sweep_leaves(hashed(spark, folder), "doc_id", "vec", SWEEP)


@query
def knn_descent(spark, folder):
    """Nearly the nearest neighbours of the texts' vectors, copies included."""
    return (descent.knn_descent(hashed(spark, folder), "doc_id", "vec", 5)
            .select("i", "j", "rank", F.round("measure", 6).alias("cosine")))


@query
def graph_layout(spark, folder):
    """Coordinates of the vectors from the graph of their five nearest neighbours."""
    near = neighbours.knn_graph(read(spark, folder, "embeddings"), "vec_id", "embedding", 5)
    placed = layout.graph_layout(near, "measure", dims=2).nodes
    return placed.select(F.col("node").alias("vec_id"), *[
        F.round(F.get("coordinates", F.lit(k)), 6).alias(f"x{k}") for k in range(2)])


def config_labels(spark, folder) -> DataFrame:
    runs = [noisy_labels(spark, folder, limit).select(
        F.lit(number).cast("bigint").alias("config"), "vec_id", "cluster_id")
        for number, limit in enumerate([0.0, 0.1, 0.2, 0.2])]
    return tables.union_batches(*runs)


@query
def score_configs(spark, folder):
    return density.score_configs(config_labels(spark, folder), "config", "cluster_id")


@query
def pick_best(spark, folder):
    return density.pick_best(score_configs(spark, folder), "config")


# --- Labels ----------------------------------------------------------------------------

def info(spark, folder) -> DataFrame:
    return labels.cluster_info(clustered(spark, folder), "cluster_id", "doc_id", "text")


@query
def cluster_info(spark, folder):
    return info(spark, folder).withColumn("keywords", F.array_join("keywords", ", "))


@query
def label_docs(spark, folder):
    return labels.label_docs(clustered(spark, folder), info(spark, folder), "cluster_id").select(
        "doc_id", "cluster_id", "name", "summary")


@query
def relabel(spark, folder):
    """Documents with an outdated name: in run 0 only some have one, in run 1 all."""
    runs = []
    for number, name in enumerate([F.when(F.length("text") > 1000, F.lit("outdated")),
                                   F.lit("outdated")]):
        named = clustered(spark, folder).withColumns({"name": name, "summary": F.lit("old")})
        done = labels.relabel(named, "cluster_id", "doc_id", "text")
        runs.append((named if done is None else done).select(
            F.lit(number).alias("run"), "doc_id", "cluster_id", "name", "summary"))
    return tables.union_batches(*runs)


def prompts(spark, folder, described: DataFrame) -> DataFrame:
    texts = labels.first_texts(clustered(spark, folder), "cluster_id", ["doc_id"], "text")
    return labels.prompt_table(described, texts, "cluster_id")


@query
def prompt_table(spark, folder):
    return prompts(spark, folder, info(spark, folder))


@query
def name_with(spark, folder):
    """Answers of a stand-in model that counts the prompt's characters."""
    def model():
        return lambda asked: [f"<think>how many?</think> {len(p)} characters " for p in asked]
    described = cut(info(spark, folder))
    named = labels.name_with(described, prompts(spark, folder, described), "cluster_id", model,
                             min_size=50)
    return named.withColumn("keywords", F.array_join("keywords", ", "))


@query
def clean_answer(spark, folder):
    said = F.concat(F.lit("<think>"), F.col("text"), F.lit("</think>\n "), F.col("role"),
                    F.lit(" \u3000"))
    return read(spark, folder, "conversations").select(
        "conv_id", "turn", X.clean_answer(said).alias("answer"))


@query
def merged_names(spark, folder):
    turns = read(spark, folder, "conversations").select("role", F.col("text").alias("name"))
    return labels.merged_names(turns, "role")


@query
def merge_prompts(spark, folder):
    named = read(spark, folder, "documents").select(
        "lang", F.concat_ws(" ", "lang", "source").alias("name")).distinct()
    return labels.merge_prompts(named, "lang")


@query
def run_metadata(spark, folder):
    return labels.run_metadata(noisy_labels(spark, folder), "cluster_id").drop("timestamp")


# --- Ladder ------------------------------------------------------------------------------

@query
def q_centroids(spark, folder):
    means = centroids(noisy_labels(spark, folder), "cluster_id", "embedding")
    return long_form(means, ["cluster_id"], "vec", "size")


@query
def merge_round(spark, folder):
    done = ladder.merge_round(topic_nodes(spark, folder), 0.95)
    return long_form(done.nodes, ["node_id"], "vec", "name", "leaves")


def whole_ladder(spark, folder):
    nodes = cut(topic_nodes(spark, folder))
    return nodes, ladder.merge_ladder(nodes)


@query
def merge_ladder(spark, folder):
    _, done = whole_ladder(spark, folder)
    return long_form(done.levels, ["level", "node_id"], "vec", "name", "leaves")


@query
def merge_history(spark, folder):
    return whole_ladder(spark, folder)[1].history


@query
def merge_summary(spark, folder):
    nodes, done = whole_ladder(spark, folder)
    return ladder.merge_summary(done.history, nodes.count(), ladder.default_levels())


@query
def lineage(spark, folder):
    nodes, done = whole_ladder(spark, folder)
    return ladder.lineage(nodes, done.history)


# --- Plot data -----------------------------------------------------------------------------

def points(spark, folder) -> DataFrame:
    return plotdata.plot_points(noisy_labels(spark, folder), "embedding", "cluster_id")


@query
def density_grid(spark, folder):
    return plotdata.density_grid(points(spark, folder), "cluster_id")


@query
def grid_shades(spark, folder):
    """The pixels of 100 x 80 as they are drawn, lone ones grown."""
    grid = cut(plotdata.density_grid(points(spark, folder), "cluster_id", 100, 80), "grid")
    return plotdata.spread(plotdata.shades(grid, "cluster_id"), "cluster_id", width=100, height=80)


@query
def hover_sample(spark, folder):
    titled_points = points(spark, folder).withColumn(
        "title", F.concat(F.lit("vector "), F.col("vec_id")))
    return (plotdata.hover_sample(titled_points, "vec_id", "cluster_id", "title", n=200)
            .withColumns({"x": F.round("x", 6), "y": F.round("y", 6)}))


@query
def color_index(spark, folder):
    return plotdata.color_index(noisy_labels(spark, folder), "cluster_id")


# --- Pipelines, end to end -----------------------------------------------------------------

def raw_documents(spark, folder) -> DataFrame:
    """Documents as they come out of record files."""
    return read(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("file"), F.col("source").alias("title"),
        F.col("text").alias("abstract"))


def run_chain(spark, folder) -> str:
    """Raw documents to embedded papers to clusters and their centroid files."""
    root = scratch_path(spark, "chain")
    D.run(raw_documents(spark, folder), f"{root}/final")
    papers = spark.read.parquet(f"{root}/final/papers")
    clusters.run(papers, f"{root}/results", "doc_id",
                 [{"epsilon": 0.6, "neighbors": 5}, {"epsilon": 0.45, "neighbors": 10}],
                 reduction=None)
    return root


@query
def documents_to_clusters(spark, folder):
    """The number that the first pipeline gave each document, and its cluster by the second."""
    found = spark.read.parquet(f"{run_chain(spark, folder)}/results/clustered")
    return found.select("doc_id", "file", "cluster_id")


@query
def clusters_to_hierarchy(spark, folder):
    """The clusters of both configurations, as the third pipeline read them."""
    root = run_chain(spark, folder)
    hierarchy.run(spark, f"{root}/results/centroids", f"{root}/hierarchy")
    return spark.read.parquet(f"{root}/hierarchy/leaves").select(
        "node_id", "source_config", "cluster_id")
