"""Personalized PageRank over (id) nodes and (src, dst) edges.

With S the source set, m its size and a the jump probability, one step is

    r'(v) = [v in S] * (a/m + (1-a) * D/m) + (1-a) * sum over u->v of r(u)/deg(u)

for every v that has a node record.  D is the rank held by dangling nodes: they point to all sources,
and adding D/m to each source gives the same sums as writing those edges out, without |dangling| * m
rows.  Ranks are plain doubles.  Rank sent to an id without a node record vanishes.

Hot spots: the incoming sum of a popular node is pre-aggregated on the map side.  The outgoing edges
of a hub are split into shards of at most ``SHARD_EDGES`` on average, each joined with its own copy of
the hub's rank, so no single task holds all the edges of one node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brindle.functions.numeric import fixed_point
from brindle.session import shared_dir, work_path, written

# The jump probability.
ALPHA = 0.15

SHARD_EDGES = 1_000_000
CHECKPOINT_EVERY = 1
LOG = (
    "iteration int, nodes bigint, edges bigint, messages bigint, missing bigint, mass double, alpha double, "
    "sources array<bigint>"
)


@dataclass(frozen=True)
class Graph:
    """``nodes``: (id, degree, shards, is_source); ``edges``: (src, shard, dst); ``sources``: distinct ids."""

    nodes: DataFrame
    edges: DataFrame
    sources: list[int]


def _is_source(column: str, sources: list[int]):
    return F.col(column).isin(sources)


def _single_records(ids: DataFrame) -> DataFrame:
    """The ids, once each; an id that occurs twice fails the job."""
    single = F.when(F.col("records") == 1, True).otherwise(
        F.raise_error(F.concat(F.lit("several node records for id "), F.col("id").cast("string"))).cast("boolean")
    )
    return ids.groupBy("id").agg(F.count("*").alias("records")).where(single).select("id")


def edges_from_adjacency(adjacency: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) from (id, neighbours); every list is a node record."""
    edges = adjacency.select(F.col("id").alias("src"), F.explode_outer("neighbours").alias("dst")).where("dst is not null")
    return adjacency.select("id"), edges


def build_graph(
    nodes: DataFrame, edges: DataFrame, sources: list[int], shard_edges: int = SHARD_EDGES
) -> Graph:
    """Prepare a graph: degrees, dangling nodes (degree 0), source marks, sharded edges.

    Repeated edges count repeatedly.  Edges leaving an id without a node record carry no rank and are left out.
    An id with two node records fails the job.  Edges are written first; degrees, and the shards of hubs, are
    taken from what is written.
    """
    sources = sorted(set(sources))
    if not sources:
        raise ValueError("at least one source is needed")
    ids = written(_single_records(nodes.select("id")), "node-ids")
    kept = written(edges.select("src", "dst").join(ids, F.col("src") == F.col("id"), "left_semi"), "raw-edges")
    degrees = kept.groupBy("src").agg(F.count("*").alias("degree"))
    known = ids.join(degrees, F.col("id") == F.col("src"), "left").select(
        "id",
        F.coalesce("degree", F.lit(0)).alias("degree"),
        F.ceil(F.coalesce("degree", F.lit(0)) / shard_edges).cast("int").alias("shards"),
        _is_source("id", sources).alias("is_source"),
    )
    known = written(known, "degrees")
    return Graph(known, _sharded(kept, known), sources)


def _sharded(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src, shard, dst); the shard depends on the edge's ends alone, so every evaluation gives the same."""
    hubs = nodes.where(F.col("shards") > 1).select(F.col("id").alias("src"), "shards")
    return edges.select("src", "dst").join(hubs, "src", "left").select(
        "src",
        F.when(F.col("shards") > 1, F.pmod(F.xxhash64("dst"), F.col("shards"))).otherwise(0).cast("int").alias("shard"),
        "dst",
    )


def materialize(graph: Graph, buckets: int | None = None) -> Graph:
    """Write nodes and edges as bucketed tables in the shared folder, nodes by id and edges by (src, shard).

    Joins on these keys read the buckets in place: a step moves ranks and partial sums but never the edges.
    The number of buckets is the caller's choice, by default as many as a shuffle has partitions.
    """
    spark = graph.nodes.sparkSession
    shared_dir(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Graph(
        _bucketed(graph.nodes, "nodes", buckets, "id"),
        _bucketed(graph.edges, "edges", buckets, "src", "shard"),
        graph.sources,
    )


def _bucketed(table: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    spark = table.sparkSession
    path = work_path(spark, name)
    stored = path.rsplit("/", 1)[-1].replace("-", "_")
    # The shuffle and the buckets use the same hash, so each bucket is written by one task as one file.
    bucketed = table.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    bucketed.option("path", path).saveAsTable(stored)
    return spark.table(stored)


def initial_ranks(graph: Graph) -> DataFrame:
    """(id, degree, shards, is_source, rank): 1/m on the sources, 0 elsewhere."""
    return graph.nodes.withColumn("rank", F.when(F.col("is_source"), 1.0 / len(graph.sources)).otherwise(0.0))


def repaired_edges(graph: Graph) -> DataFrame:
    """(src, dst) with the edges from dangling nodes to all sources written out."""
    to_sources = F.explode(F.array(*[F.lit(s).cast("bigint") for s in graph.sources]))
    dangling = graph.nodes.where(F.col("degree") == 0).select(F.col("id").alias("src"), to_sources.alias("dst"))
    return graph.edges.select("src", "dst").unionByName(dangling)


def dangling_nodes(graph: Graph) -> DataFrame:
    """(id, added): the nodes without edges, and how many edges the repair gives each (one per source)."""
    return graph.nodes.where(F.col("degree") == 0).select("id", F.lit(len(graph.sources)).cast("bigint").alias("added"))


def graph_stats(graph: Graph) -> DataFrame:
    """One row: nodes, edges (a dangling node has none), active nodes."""
    return graph.nodes.agg(
        F.count("*").alias("nodes"),
        F.coalesce(F.sum("degree"), F.lit(0)).alias("edges"),
        F.count_if(F.col("degree") > 0).alias("active_nodes"),
    )


def step(graph: Graph, ranks: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One iteration over ``ranks`` (id, degree, shards, is_source, rank)."""
    m = len(graph.sources)
    senders = ranks.where((F.col("degree") > 0) & (F.col("rank") > 0)).select(
        F.col("id").alias("src"),
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        (F.col("rank") / F.col("degree")).alias("share"),
    )
    # Hash joins that build on the ranks and the sums spare a sort of all edges and nodes in every step.
    received = graph.edges.join(senders.hint("shuffle_hash"), ["src", "shard"]).groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("mass"))
    dangling = ranks.where(F.col("degree") == 0).agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("mass")).scalar()
    jump = F.when(F.col("is_source"), F.lit(alpha / m) + (1 - alpha) * dangling / m).otherwise(0.0)
    return graph.nodes.join(received.hint("shuffle_hash"), "id", "left").select(
        "id",
        "degree",
        "shards",
        "is_source",
        (jump + (1 - alpha) * F.coalesce("mass", F.lit(0.0))).alias("rank"),
    )


def iterate(
    graph: Graph,
    iterations: int,
    ranks: DataFrame | None = None,
    alpha: float = ALPHA,
    checkpoint_every: int = CHECKPOINT_EVERY,
) -> DataFrame:
    """Run a fixed number of steps, from the initial ranks or from given ones (a stored iteration).

    A step reads the ranks before it more than once, so by default each step is written by a reliable
    checkpoint (one row per node); the last stretch stays lazy.
    """
    shared_dir(graph.nodes.sparkSession)
    ranks = initial_ranks(graph) if ranks is None else ranks
    for done in range(1, iterations + 1):
        ranks = step(graph, ranks, alpha)
        if done % checkpoint_every == 0 and done < iterations:
            ranks = ranks.checkpoint()
    return ranks


def save_iteration(ranks: DataFrame, base: str, iteration: int) -> None:
    ranks.write.mode("overwrite").parquet(f"{base.rstrip('/')}/iter{iteration:04d}")


def load_iteration(spark: SparkSession, base: str, iteration: int) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/iter{iteration:04d}")


def missing_targets(graph: Graph) -> int:
    """How many ids without a node record an edge of a known node, or the jump of a dangling node, sends rank to."""
    spark = graph.nodes.sparkSession
    targets = graph.edges.select(F.col("dst").alias("id"))
    if not graph.nodes.where(F.col("degree") == 0).isEmpty():
        targets = targets.unionByName(spark.createDataFrame([(s,) for s in graph.sources], "id bigint"))
    return targets.distinct().join(graph.nodes, "id", "left_anti").count()


def run_logged(graph: Graph, iterations: int, base: str, alpha: float = ALPHA) -> DataFrame:
    """Run until ``iterations`` steps are done, going on after the last complete one that ``base`` holds.

    Every step is written to a folder of its own, and counted and summed up while it is written; then a line goes to
    the log.  A step that was cut off has no line, so a later run writes its folder anew.  The ids without a record
    are the same for every step and are counted once per log.  A log of other sources or another alpha is refused.
    """
    spark = graph.nodes.sparkSession
    log = iteration_log(spark, base)
    last = log.orderBy(F.desc("iteration")).first()
    if last is None:
        done, ranks, missing = 0, initial_ranks(graph), missing_targets(graph)
    else:
        if (last.alpha, list(last.sources)) != (alpha, graph.sources):
            raise ValueError(f"the iterations in {base} have alpha {last.alpha} and sources {last.sources}")
        done, missing = last.iteration, last.missing
        ranks = load_iteration(spark, base, done)
    sent = F.when(F.col("degree") == 0, len(graph.sources)).otherwise(F.col("degree"))
    for iteration in range(done + 1, iterations + 1):
        seen = Observation()
        measures = (F.count("*").alias("nodes"), F.coalesce(F.sum(sent), F.lit(0)).alias("edges"), F.coalesce(F.sum("rank"), F.lit(0.0)).alias("mass"))
        save_iteration(step(graph, ranks, alpha).observe(seen, *measures), base, iteration)
        found = seen.get
        line = (iteration, found["nodes"], found["edges"], found["edges"], missing, found["mass"], alpha, graph.sources)
        spark.createDataFrame([line], LOG).coalesce(1).write.mode("append").parquet(_log_path(base))
        ranks = load_iteration(spark, base, iteration)
    return ranks


def _log_path(base: str) -> str:
    return f"{base.rstrip('/')}/log"


def iteration_log(spark: SparkSession, base: str) -> DataFrame:
    """A line per complete step: iteration, nodes, edges after repair (one message each), ids without record, mass."""
    try:
        return spark.read.schema(LOG).parquet(_log_path(base))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def top_ranks(ranks: DataFrame, k: int) -> DataFrame:
    """The k nodes of the highest rank; ties go to the smaller id."""
    return ranks.select("id", "rank").orderBy(F.desc("rank"), "id").limit(k)


def top_ranks_text(ranks: DataFrame, k: int) -> DataFrame:
    """``top_ranks`` as (rank text with five decimals, id)."""
    return top_ranks(ranks, k).select(fixed_point("rank").alias("rank"), "id")
