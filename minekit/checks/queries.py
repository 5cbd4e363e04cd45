"""Every operator as a query over the test tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.checks import views
from minekit.checks.settings import CANDIDATES, CORPUS_FOLDERS, KMEANS_STEPS, MIN_LEAF, RANK_STEPS, SEARCH, TOP
from minekit.functions.storage import fresh_path, settle
from minekit.operators import cluster, codes, features, graph, matrix, minhash, pairs, splits, text, tree
from minekit.plans.decision_tree import DecisionTree, feature_splits, level_candidates, library_accuracy, search_splits
from minekit.plans.kmeans import KMeans, KMeansFit, compare_runs, cost_changes
from minekit.plans.pagerank import PageRank, load_ranks, save_ranks
from minekit.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def places(column: str, digits: int) -> Column:
    """Rounded, with negative zero turned into zero."""
    return (F.round(column, digits) + 0.0).alias(column)


def or_none(column: str) -> Column:
    """An integer column with -1 where it is absent."""
    return F.coalesce(column, F.lit(-1)).alias(column)


def through_text(df: DataFrame, line: Column, label: str) -> str:
    """Write lines to a fresh folder and return it."""
    path = fresh_path(df.sparkSession, label)
    writers.write_lines(df, line, path)
    return path


# --- matrices -------------------------------------------------------------------------------------


@query
def matrix_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = through_text(views.entries(spark, sf_dir), writers.entry_line(), "entries")
    return readers.read_matrix(spark, lines)


@query
def matrix_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.select_matrix(views.entries(spark, sf_dir), "M")


@query
def matrix_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = views.entries(spark, sf_dir)
    return matrix.matrix_product(matrix.select_matrix(both, "M"), matrix.select_matrix(both, "N"))


@query
def matrix_product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = matrix.ordered_cells(matrix_product(spark, sf_dir))
    return spark.read.text(through_text(cells, writers.matrix_line(), "product")).select(F.col("value").alias("line"))


# --- graphs ---------------------------------------------------------------------------------------


@query
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = through_text(views.edges(spark, sf_dir), writers.edge_line(), "edges")
    return readers.read_edges(spark, lines)


@query
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_nodes(views.edges(spark, sf_dir))


@query
def out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = views.edges(spark, sf_dir)
    return graph.out_degree(graph.graph_nodes(edges), edges)


@query
def transition_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.transition_matrix(views.edges(spark, sf_dir)).select("src", "dst", places("weight", 9))


@query
def dangling_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = views.edges(spark, sf_dir)
    return graph.dangling_nodes(graph.graph_nodes(edges), edges)


@query
def dangling_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = views.edges(spark, sf_dir)
    nodes = graph.graph_nodes(edges)
    filled = graph.dangling_fill(graph.transition_matrix(edges), graph.dangling_nodes(nodes, edges), nodes.count())
    return filled.select("src", or_none("dst"), places("weight", 9))


def ranks_after(spark: SparkSession, sf_dir: str, steps: int) -> DataFrame:
    return PageRank().run(views.edges(spark, sf_dir), steps)


@query
def pagerank_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks_after(spark, sf_dir, 1).select("node", places("rank", 9))


@query
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks_after(spark, sf_dir, RANK_STEPS).select("node", places("rank", 9))


@query
def pagerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.top_ranks(ranks_after(spark, sf_dir, RANK_STEPS)).select("node", places("rank", 9))


@query
def pagerank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.top_ranks(ranks_after(spark, sf_dir, RANK_STEPS)).select(writers.rank_line().alias("line"))


@query
def pagerank_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two steps, saved as tuples of text and as a table; the rest from the reloaded ranks."""
    edges = views.edges(spark, sf_dir)
    early = PageRank().run(edges, 1)
    reloaded = readers.read_rank_text(spark, through_text(early, writers.rank_tuple(), "ranks-text"))
    path = fresh_path(spark, "ranks-table")
    save_ranks(PageRank().run(edges, 1, reloaded), path)
    return PageRank().run(edges, RANK_STEPS - 2, load_ranks(edges, path)).select("node", places("rank", 9))


# --- points ---------------------------------------------------------------------------------------


@query
def points_with_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without a key, numbered in file order."""
    lines = through_text(views.points(spark, sf_dir).orderBy("id"), writers.bare_vector_line(), "points")
    indexed = readers.read_numbered_vectors(spark, lines)
    return indexed.select("id", F.posexplode("v").alias("pos", "x")).select("id", "pos", places("x", 6))


@query
def keyed_points_with_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = through_text(views.points(spark, sf_dir), writers.vector_line(), "points")
    vectors = readers.read_keyed_vectors(spark, lines).withColumnRenamed("id", "vec_id")
    indexed = cluster.points_with_index(vectors, "vec_id")
    return indexed.select("id", F.posexplode("v").alias("pos", "x")).select("id", "pos", places("x", 6))


@query
def pairwise_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    distances = cluster.pairwise_distance(views.points(spark, sf_dir), views.centroids(spark, sf_dir))
    return distances.select("id", "cid", places("l1", 6), places("l2sq", 6))


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.assignments(views.points(spark, sf_dir), views.centroids(spark, sf_dir))


@query
def nearest_centroid_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.nearest_centroid(assigned(spark, sf_dir), "l1").select("id", "cid", places("distance", 6))


@query
def nearest_centroid_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.nearest_centroid(assigned(spark, sf_dir), "l2").select("id", "cid", places("distance", 6))


@query
def clustering_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.clustering_cost(assigned(spark, sf_dir)).select(places("cost_l1", 6), places("cost_l2sq", 6))


def vector_cells(clusters: DataFrame, *names: str) -> DataFrame:
    cells = clusters.select("cid", *names, F.posexplode("v").alias("pos", "x"))
    return cells.select("cid", *names, "pos", places("x", 6))


@query
def centroid_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = views.points(spark, sf_dir)
    dimension = points.select(F.max(F.size("v"))).first()[0]
    return vector_cells(cluster.centroid_update(assigned(spark, sf_dir), "l2", dimension), "n")


def fitted(spark: SparkSession, sf_dir: str, metric: str) -> KMeansFit:
    return KMeans(metric, KMEANS_STEPS).fit(views.points(spark, sf_dir), views.centroids(spark, sf_dir))


@query
def kmeans_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_cells(fitted(spark, sf_dir, "l1").centroids)


@query
def kmeans_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_cells(fitted(spark, sf_dir, "l2").centroids)


@query
def kmeans_cost_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = fitted(spark, sf_dir, "l2").history.withColumn("run", F.lit("c1/l2"))
    return cost_changes(history).select(
        "run",
        "iteration",
        "k",
        *[places(c, 6) for c in ("cost_l1", "cost_l2sq", "change_l1", "change_l2sq")],
    )


@query
def kmeans_init_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = {name: views.centroids(spark, sf_dir, name) for name in ("c1", "c2")}
    runs = compare_runs(views.points(spark, sf_dir), starts, KMEANS_STEPS)
    return runs.select("init", "metric", "iteration", "k", places("cost_l1", 6), places("cost_l2sq", 6))


# --- documents ------------------------------------------------------------------------------------


@query
def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = text.doc_tokens(views.docs(spark, sf_dir))
    return tokens.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, written one per file and read back as ``doc_id, text``."""
    path = fresh_path(spark, "corpus")
    writers.write_corpus(views.docs(spark, sf_dir).select(F.col("doc_id").alias("name"), "text"), path, CORPUS_FOLDERS)
    number = F.regexp_extract("file", r"^(-?\d+)\.txt$", 1).cast("bigint")
    return readers.read_corpus(spark, path, folders=True).select(number.alias("doc_id"), "text")


@query
def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = text.doc_tokens(corpus_files(spark, sf_dir), F.md5("text").alias("digest")).where("doc_id is not null")
    return tokens.select("doc_id", "digest", F.size("tokens").cast("bigint").alias("n_tokens"))


@query
def corpus_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best pairs of a folder with one document per file."""
    return SEARCH.top(corpus_files(spark, sf_dir), TOP, dealt=True)


@query
def doc_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.doc_shingles(text.doc_tokens(views.docs(spark, sf_dir)), SEARCH.k)


@query
def shingle_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEARCH.shingle_ids(views.docs(spark, sf_dir))


@query
def shingle_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.shingle_frequency(SEARCH.shingle_ids(views.docs(spark, sf_dir)))


@query
def shingle_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and last hash of each shingle, and all of them weighted by their places."""
    hashes = minhash.shingle_hashes(SEARCH.shingle_ids(views.docs(spark, sf_dir)), SEARCH.family)
    names = SEARCH.family.names()
    weighted = reduce(lambda s, h: s + h, [F.col(n) * (i + 1) for i, n in enumerate(names)])
    return hashes.select("shingle_id", F.col(names[0]).alias("first"), F.col(names[-1]).alias("last"), weighted.alias("weighted"))


@query
def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    signatures = minhash.minhash_signatures(SEARCH.shingle_ids(views.docs(spark, sf_dir)), SEARCH.family)
    return signatures.select("doc_id", F.array_join("sig", ":").alias("sig"))


@query
def lsh_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = minhash.lsh_rows(SEARCH.signatures(views.docs(spark, sf_dir)), SEARCH.bands, SEARCH.rows)
    buckets = minhash.lsh_buckets(rows)
    return buckets.select("band", F.array_join("bucket", ":").alias("bucket"), "n_docs", "first_doc")


@query
def bucket_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = settle(minhash.lsh_rows(SEARCH.signatures(views.docs(spark, sf_dir)), SEARCH.bands, SEARCH.rows), "banded")
    return minhash.bucket_members(rows).select("band", F.array_join("bucket", ":").alias("bucket"), "doc_id")


def stored_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEARCH.groups(SEARCH.signatures(views.docs(spark, sf_dir)))


@query
def signature_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    signatures = settle(SEARCH.signatures(views.docs(spark, sf_dir)), "signatures")
    return pairs.group_members(signatures, SEARCH.groups(signatures))


@query
def lsh_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEARCH.candidates(stored_groups(spark, sf_dir))


@query
def candidate_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = stored_groups(spark, sf_dir)
    wanted = pairs.candidate_signatures(groups, SEARCH.candidates(groups))
    return wanted.select("doc_id", "n_docs", F.array_join("sig", ":").alias("sig"))


@query
def pair_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEARCH.similarities(stored_groups(spark, sf_dir))


@query
def similar_pairs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEARCH.top(views.docs(spark, sf_dir), TOP)


@query
def similar_pairs_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = SEARCH.top(views.docs(spark, sf_dir), TOP)
    return spark.read.text(through_text(best, writers.pair_line(), "pairs")).select(F.col("value").alias("line"))


@query
def similar_pairs_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs at a Jaccard similarity of 80 % and more, without bands."""
    return SEARCH.above(views.docs(spark, sf_dir), 80)


# --- labelled rows --------------------------------------------------------------------------------


def tsv_line() -> Column:
    """Quoted fields: url, id, text, category, the numbers, an unused field, the label."""
    fields = [
        F.lit("url"),
        F.col("row_id").cast("string"),
        F.lit("body"),
        F.col("category"),
        *[F.element_at("numbers", i) for i in (1, 2, 3)],
        F.lit("0"),
        F.col("label").cast("string"),
    ]
    return F.concat_ws("\t", *[F.concat(F.lit('"'), f, F.lit('"')) for f in fields])


@query
def labeled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.labeled(spark, sf_dir).select(tsv_line().alias("value"))
    names = ("url", "row_id", "body", "category", "chars", "words", "mean", "unused", "label")
    path = fresh_path(spark, "labeled")
    header = "\t".join(f'"{name}"' for name in names)
    # every file of the folder starts with the header
    whole = rows.withColumnRenamed("value", header)
    whole.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    read = readers.read_labeled(spark, path)
    numbers = [features.to_number(F.element_at("numbers", i + 1)).alias(n) for i, n in enumerate(names[4:7])]
    return read.select("row_id", "category", *numbers, "label")


@query
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.category_index(views.labeled(spark, sf_dir))


@query
def one_hot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.labeled(spark, sf_dir)
    one_hot = features.one_hot_features(rows, features.category_index(rows))
    return one_hot.select("row_id", F.posexplode("one_hot").alias("pos", "x"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.labeled(spark, sf_dir)
    return features.feature_vectors(rows, features.category_index(rows))


@query
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("row_id", "label", F.posexplode("features").alias("pos", "x"))


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.train_test_split(views.labeled(spark, sf_dir), "row_id").select("row_id", "part")


def at_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).withColumn("node_id", F.lit(tree.ROOT))


def numbered(nodes: DataFrame) -> DataFrame:
    """Nodes by number instead of path."""
    names = [c for c in ("node_id", "left", "right") if c in nodes.columns]
    return nodes.withColumns({c: tree.node_number(F.col(c)) for c in names})


@query
def node_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy of the whole set and of both sides of its best split."""
    rows = settle(at_root(spark, sf_dir), "rows")
    sides = tree.split_rows(rows, search_splits(rows, CANDIDATES))
    nodes = rows.select("node_id", "label").unionByName(sides.select("node_id", "label"))
    return numbered(splits.node_entropy(nodes)).select("node_id", "n", "n_pos", places("entropy", 9))


def coded_root(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, codes.Coded]:
    coded = codes.code_values(vectors(spark, sf_dir))
    return coded.rows.withColumn("node_id", F.lit(tree.ROOT)), coded


@query
def split_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, coded = coded_root(spark, sf_dir)
    found = coded.with_values(level_candidates(rows, coded, CANDIDATES))
    return numbered(found).select("node_id", "feature", "value", "left_n", "left_pos", "n", "n_pos")


@query
def split_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, coded = coded_root(spark, sf_dir)
    gains = splits.split_gains(coded.with_values(level_candidates(rows, coded, CANDIDATES)))
    return numbered(gains).select("node_id", "feature", "value", places("gain", 9))


def per_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_splits(*coded_root(spark, sf_dir), CANDIDATES)


@query
def best_split_per_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(per_feature(spark, sf_dir)).select("node_id", "feature", "split", places("gain", 9))


@query
def best_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(splits.best_split(per_feature(spark, sf_dir))).select("node_id", "feature", "split", places("gain", 9))


@query
def tree_split_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = settle(at_root(spark, sf_dir), "rows")
    return numbered(tree.split_rows(rows, search_splits(rows, CANDIDATES))).select("row_id", "node_id")


def grown(rows: DataFrame) -> DataFrame:
    return DecisionTree(MIN_LEAF, CANDIDATES).fit(rows)


@query
def decision_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = numbered(grown(vectors(spark, sf_dir)))
    return nodes.select(
        "node_id",
        "depth",
        or_none("feature"),
        "split",
        places("gain", 9),
        or_none("left"),
        or_none("right"),
        "n",
        "n_pos",
        "prediction",
    )


def sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.labeled(spark, sf_dir)
    return features.sparse_features(rows, features.category_index(rows))


@query
def sparse_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features that are not 0."""
    return sparse_rows(spark, sf_dir).select("row_id", "label", F.explode("entries").alias("e")).select(
        "row_id", "label", F.col("e.feature").alias("pos"), F.col("e.value").alias("x")
    )


@query
def sparse_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree over sparse features."""
    nodes = numbered(grown(sparse_rows(spark, sf_dir)))
    return nodes.select("node_id", "depth", or_none("feature"), "split", places("gain", 9), "n", "n_pos", "prediction")


@query
def leaf_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(tree.leaf_predictions(grown(vectors(spark, sf_dir))))


@query
def tree_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.tree_listing(grown(vectors(spark, sf_dir)))


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = settle(features.train_test_split(vectors(spark, sf_dir), "row_id"), "parts")
    return rows.where("part = 'train'"), rows.where("part = 'test'")


@query
def tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = parts(spark, sf_dir)
    return numbered(tree.tree_predictions(test, grown(train)))


@query
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = parts(spark, sf_dir)
    return tree.accuracy(tree.tree_predictions(test, grown(train))).select("n", places("accuracy", 6))


@query
def mllib_tree_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library_accuracy(*parts(spark, sf_dir))


@query
def dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = {
        "entries": views.entries(spark, sf_dir),
        "edges": views.edges(spark, sf_dir),
        "points": views.points(spark, sf_dir),
        "documents": views.docs(spark, sf_dir),
        "labeled": views.labeled(spark, sf_dir),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in sets.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
