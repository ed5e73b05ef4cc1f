"""Named queries over the test tables: each maps the tables to the inputs of one operator.

The tables lack some shapes the operators expect (a graph, labelled features, delimited text); they
are derived here from whole tables.  Output columns are strings, integers and rounded doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brindle.functions.text import tokenize
from brindle.operators import arrivals, classify, cooccurrence, index, pagerank, scoring, training
from brindle.operators.arrivals import Box
from brindle.plans import shipments
from brindle.session import work_path
from brindle.sources import readers, sinks
from brindle.streaming import arrivals as streams

# Parameters of the registered queries.
DAY = "1996-11-01"
NATIONS = ["NATION_3", "NATION_24"]
PART_OFFSET = 1_000_000
SOURCES = [1, 2, 3]
MISSING_SIZE = 1
MODELS = ["m0", "m1", "m2"]
BOXES = [Box("A", 0, 20, 10, 80), Box("B", 20, 60, 80, 140)]
AND_QUERY = "the of AND"
OR_QUERY = "the of OR"
NESTED_QUERY = "the of OR and AND to AND"
EPOCHS = 2
EVENT_FILES = 6
SEED = 7

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Tables:
    """The Parquet tables of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return readers.parquet_table(self.spark, self.folder, name)


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(Tables(spark, folder))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# Shipments -------------------------------------------------------------------------------------


@query
def q1_shipped_count(t: Tables) -> DataFrame:
    return shipments.shipped_count(t.lineitem, DAY)


@query
def q2_clerk_orders(t: Tables) -> DataFrame:
    return shipments.clerk_orders(t.lineitem, t.orders, DAY, clerk="o_orderpriority")


@query
def q3_part_supplier(t: Tables) -> DataFrame:
    return shipments.part_supplier(t.lineitem, t.part, t.supplier, DAY)


@query
def q4_nation_shipments(t: Tables) -> DataFrame:
    return shipments.nation_shipments(t.lineitem, t.orders, t.customer, t.nation, DAY)


@query
def q5_monthly_two_nations(t: Tables) -> DataFrame:
    return shipments.monthly_shipments(t.lineitem, t.orders, t.customer, t.nation, NATIONS)


@query
def q6_pricing_summary(t: Tables) -> DataFrame:
    return shipments.pricing_summary(t.lineitem, DAY)


@query
def q7_top_unshipped(t: Tables) -> DataFrame:
    return shipments.top_unshipped(t.lineitem, t.orders, t.customer, DAY, priority="o_orderpriority")


@query
def sql_pricing_summary(t: Tables) -> DataFrame:
    return shipments.run_sql(t.spark, shipments.PRICING_SQL, {"lineitem": t.lineitem}, day=DAY)


@query
def sql_clerk_orders(t: Tables) -> DataFrame:
    statement = shipments.CLERK_SQL.replace("{clerk}", "o_orderpriority")
    return shipments.run_sql(t.spark, statement, {"lineitem": t.lineitem, "orders": t.orders}, day=DAY)


@query
def sql_nation_shipments(t: Tables) -> DataFrame:
    names = ("lineitem", "orders", "customer", "nation")
    return shipments.run_sql(t.spark, shipments.NATION_SQL, {n: getattr(t, n) for n in names}, day=DAY)


@query
def pricing_from_pipe_text(t: Tables) -> DataFrame:
    """Line items written as '|'-delimited text and read back with a declared schema."""
    path = work_path(t.spark, "lineitem-text")
    sinks.write_pipe_table(t.lineitem.withColumn("l_shipdate", F.to_date("l_shipdate")), path)
    schema = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity decimal(10,2), l_extendedprice decimal(10,2), l_discount decimal(10,2), l_tax decimal(10,2),
        l_returnflag string, l_linestatus string, l_shipdate date"""
    return shipments.pricing_summary(readers.pipe_table(t.spark, path, "lineitem", schema), DAY)


# Co-occurrence ---------------------------------------------------------------------------------


def _documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")


def _lines(t: Tables) -> DataFrame:
    return cooccurrence.tokenized(readers.document_lines(_documents(t)))


def _scaled(value) -> Column:
    return F.round(value * 1e6).cast("bigint").cast("string")


def _stripe_text(stripes: DataFrame, value: Callable[[Column], Column]) -> DataFrame:
    entries = F.transform(F.array_sort(F.map_entries("stripe")), lambda e: F.concat(e["key"], F.lit(":"), value(e["value"])))
    return stripes.select("w1", F.col("block").cast("int").alias("block"), F.array_join(entries, " ").alias("stripe"))


@query
def tokens(t: Tables) -> DataFrame:
    return _lines(t).select(
        "doc_id", "line_no", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("tokens")
    )


@query
def word_line_counts(t: Tables) -> DataFrame:
    return cooccurrence.word_line_counts_with_total(_lines(t))


@query
def bigram_freq_pairs(t: Tables) -> DataFrame:
    return cooccurrence.bigram_frequency_pairs(_lines(t)).withColumn("value", F.round("value", 9))


@query
def bigram_text_sink(t: Tables) -> DataFrame:
    """Bigram counts written as pair text and read back line by line."""
    path = work_path(t.spark, "bigram-text")
    sinks.write_pairs_text(cooccurrence.bigram_counts(_lines(t)), path, ["w1", "w2"], ["n"])
    return readers.text_lines(t.spark, path)


@query
def bigram_freq_stripes(t: Tables) -> DataFrame:
    return _stripe_text(cooccurrence.bigram_frequency_stripes(_lines(t)), _scaled)


def _rounded_pmi(pairs: DataFrame) -> DataFrame:
    return pairs.select("w1", "w2", F.round("pmi", 6).alias("pmi"), "n")


@query
def pmi_pairs(t: Tables) -> DataFrame:
    return _rounded_pmi(cooccurrence.pmi_pairs(_lines(t), ["doc_id", "line_no"]))


@query
def pmi_pairs_pruned(t: Tables) -> DataFrame:
    return _rounded_pmi(cooccurrence.pmi_pairs(_lines(t), ["doc_id", "line_no"]))


@query
def pmi_stripes(t: Tables) -> DataFrame:
    return _stripe_text(
        cooccurrence.pmi_stripes(_lines(t), ["doc_id", "line_no"]),
        lambda v: F.concat(_scaled(v["pmi"]), F.lit("/"), v["n"].cast("string")),
    )


# Index and retrieval ---------------------------------------------------------------------------


def _index(t: Tables) -> DataFrame:
    return index.build_postings(index.term_frequencies(_documents(t)))


def _list_text(entries: str, first: str, second: str) -> Column:
    pairs = F.transform(entries, lambda e: F.concat(e[first].cast("string"), F.lit(":"), e[second].cast("string")))
    return F.array_join(pairs, " ")


def _postings_text(blocks: DataFrame) -> DataFrame:
    return blocks.select("term", "block", "block_df", _list_text("postings", "doc_id", "tf").alias("postings"))


@query
def index_postings(t: Tables) -> DataFrame:
    return _postings_text(_index(t))


def _stored_index(t: Tables) -> DataFrame:
    path = work_path(t.spark, "index")
    sinks.write_index(_index(t), path, buckets=int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return sinks.read_index(t.spark, path)


@query
def index_stored(t: Tables) -> DataFrame:
    """The index written to its term-partitioned, term-sorted table and read back."""
    return _postings_text(_stored_index(t))


@query
def index_gaps(t: Tables) -> DataFrame:
    gaps = index.gap_view(_stored_index(t))
    return gaps.select("term", "block", "block_df", _list_text("gaps", "gap", "tf").alias("gaps"))


@query
def index_gap_decode(t: Tables) -> DataFrame:
    return _postings_text(index.gap_decode(index.gap_view(_stored_index(t))))


@query
def index_size_report(t: Tables) -> DataFrame:
    return index.size_report(index.gap_view(_stored_index(t)))


@query
def term_df(t: Tables) -> DataFrame:
    return index.document_frequency(_index(t))


@query
def boolean_and(t: Tables) -> DataFrame:
    return index.boolean_search(_stored_index(t), AND_QUERY)


@query
def boolean_or(t: Tables) -> DataFrame:
    return index.boolean_search(_stored_index(t), OR_QUERY)


@query
def boolean_nested(t: Tables) -> DataFrame:
    return index.boolean_search(_stored_index(t), NESTED_QUERY)


@query
def boolean_batch(t: Tables) -> DataFrame:
    """One query per benchmark text: its smallest or its greatest word, and all words between."""
    words = F.array_sort(F.array_distinct(tokenize("text")))
    middle = F.slice("words", F.lit(2), F.size("words") - 2)
    postfix = F.concat(
        F.concat_ws(" ", F.element_at("words", 1), F.element_at("words", -1), F.lit(index.OR)),
        F.array_join(F.transform(middle, lambda w: F.concat(F.lit(" "), w, F.lit(f" {index.AND}"))), ""),
    )
    queries = (
        t.benchmark.select("item_id", words.alias("words"))
        .where(F.size("words") > 2)
        .select(F.col("item_id").alias("query_id"), postfix.alias("postfix"))
    )
    return index.boolean_search_batch(_stored_index(t), queries)


@query
def retrieval_snippets(t: Tables) -> DataFrame:
    return index.with_snippets(index.boolean_search(_stored_index(t), NESTED_QUERY), t.documents)


# Graph -----------------------------------------------------------------------------------------


def _edges(t: Tables) -> DataFrame:
    """Supplier -> part for every pair in the line items, and back from parts of an even size."""
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    even = t.part.where(F.col("p_size") % 2 == 0).select("p_partkey")
    forth = pairs.select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") + PART_OFFSET).alias("dst"))
    back = pairs.join(even, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select(
        (F.col("l_partkey") + PART_OFFSET).alias("src"), F.col("l_suppkey").alias("dst")
    )
    return forth.unionByName(back)


def _nodes(t: Tables, parts: DataFrame | None = None) -> DataFrame:
    parts = t.part if parts is None else parts
    return t.supplier.select(F.col("s_suppkey").alias("id")).unionByName(
        parts.select((F.col("p_partkey") + PART_OFFSET).alias("id"))
    )


def _graph(t: Tables) -> pagerank.Graph:
    return pagerank.build_graph(_nodes(t), _edges(t), SOURCES)


def _rounded_ranks(ranks: DataFrame) -> DataFrame:
    return ranks.select("id", F.round("rank", 9).alias("rank"))


@query
def graph_stats(t: Tables) -> DataFrame:
    return pagerank.graph_stats(_graph(t))


@query
def graph_from_adjacency_text(t: Tables) -> DataFrame:
    """The graph written as adjacency text, a line for every node, read back and built from it."""
    path = work_path(t.spark, "adjacency")
    lists = _edges(t).groupBy(F.col("src").alias("id")).agg(F.collect_list(F.col("dst").cast("string")).alias("to"))
    fields = F.concat_ws(" ", F.col("id").cast("string"), "to")
    _nodes(t).join(lists, "id", "left").select(fields.alias("value")).write.text(path)
    nodes, edges = pagerank.edges_from_adjacency(readers.adjacency_lists(t.spark, path))
    return pagerank.graph_stats(pagerank.build_graph(nodes, edges, SOURCES))


@query
def graph_dangling(t: Tables) -> DataFrame:
    """The dangling nodes and how many edges repair each."""
    return pagerank.dangling_nodes(_graph(t))


@query
def pagerank_iter1(t: Tables) -> DataFrame:
    return _rounded_ranks(pagerank.iterate(_graph(t), 1))


@query
def pagerank_iter5(t: Tables) -> DataFrame:
    return _rounded_ranks(pagerank.iterate(pagerank.materialize(_graph(t)), 5))


@query
def pagerank_resumed(t: Tables) -> DataFrame:
    """Three iterations, a fourth that is cut off before it is logged, and a second run that goes on by itself."""
    graph = pagerank.materialize(_graph(t))
    base = work_path(t.spark, "ranks")
    ranks = pagerank.run_logged(graph, 3, base)
    pagerank.save_iteration(ranks.withColumn("rank", F.lit(0.0)), base, 4)
    return _rounded_ranks(pagerank.run_logged(graph, 5, base))


@query
def pagerank_topk(t: Tables) -> DataFrame:
    return pagerank.top_ranks_text(pagerank.iterate(pagerank.materialize(_graph(t)), 20), 10)


def _logged_stats(t: Tables, graph: pagerank.Graph) -> DataFrame:
    """What the log says of the second iteration."""
    base = work_path(t.spark, "ranks")
    pagerank.run_logged(pagerank.materialize(graph), 2, base)
    stats = pagerank.iteration_log(t.spark, base).where("iteration = 2")
    return stats.select("nodes", "edges", "messages", "missing", F.round("mass", 9).alias("mass"))


@query
def pagerank_mass(t: Tables) -> DataFrame:
    return _logged_stats(t, _graph(t))


@query
def pagerank_missing(t: Tables) -> DataFrame:
    """As ``pagerank_mass``, where the parts of one size have edges but no node record."""
    nodes = _nodes(t, t.part.where(F.col("p_size") != MISSING_SIZE))
    return _logged_stats(t, pagerank.build_graph(nodes, _edges(t), SOURCES))


# Classification --------------------------------------------------------------------------------


def _instances(t: Tables) -> DataFrame:
    """Labelled documents; a feature is the number in the first six hex digits of a token's md5."""
    features = F.transform(
        tokenize("text"), lambda w: F.conv(F.substring(F.md5(w), 1, 6), 16, 10).cast("int")
    )
    label = F.when(F.col("quality") == 0, classify.SPAM).otherwise(classify.HAM)
    return _documents(t).join(t.labels.select("doc_id", "quality"), "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id"), label.alias("label"), features.alias("features")
    )


def _model(t: Tables) -> DataFrame:
    """Three models over all features of the documents, with weights that add up exactly in binary."""
    features = _instances(t).select(F.explode_outer("features").alias("feature")).where("feature is not null").distinct()
    weights = F.array(
        *[
            F.struct(F.lit(m).alias("model_id"), ((F.col("feature") * (i + 1) % 17 - 8) / 64.0).alias("weight"))
            for i, m in enumerate(MODELS)
        ]
    )
    return features.select("feature", F.inline(weights).alias("model_id", "weight")).select("model_id", "feature", "weight")


def _scores(t: Tables) -> DataFrame:
    return classify.apply_model(_instances(t), _model(t), MODELS[0])


@query
def spam_scores(t: Tables) -> DataFrame:
    return _scores(t)


@query
def spam_scores_from_text(t: Tables) -> DataFrame:
    """Instances and model written in their text forms and read back."""
    instances, model = work_path(t.spark, "instances"), work_path(t.spark, "model")
    fields = F.concat_ws(" ", "doc_id", "label", F.array_join(F.col("features").cast("array<string>"), " "))
    _instances(t).select(fields.alias("value")).write.mode("overwrite").text(instances)
    sinks.write_model_text(_model(t).where(F.col("model_id") == MODELS[0]), model)
    return classify.apply_model(
        readers.labelled_instances(t.spark, instances), readers.model_text(t.spark, model, MODELS[0]), MODELS[0]
    )


def _rounded_score(scores: DataFrame) -> DataFrame:
    return scores.withColumn("score", F.round("score", 9))


@query
def spam_average(t: Tables) -> DataFrame:
    return _rounded_score(classify.apply_ensemble(_instances(t), _model(t), MODELS, "average"))


@query
def ensemble_from_text(t: Tables) -> DataFrame:
    """As ``spam_average``, by models written in their text form and read back."""
    paths = {m: work_path(t.spark, f"model-{m}") for m in MODELS}
    for m, path in paths.items():
        sinks.write_model_text(_model(t).where(F.col("model_id") == m), path)
    models = readers.ensemble_model_text(t.spark, paths)
    return _rounded_score(classify.apply_ensemble(_instances(t), models, MODELS, "average"))


@query
def spam_vote(t: Tables) -> DataFrame:
    return classify.apply_ensemble(_instances(t), _model(t), MODELS, "vote")


def _rounded_weights(model: DataFrame) -> DataFrame:
    return model.withColumn("weight", F.round("weight", 9))


@query
def spam_train_batch(t: Tables) -> DataFrame:
    return _rounded_weights(training.train_batch(_instances(t), EPOCHS))


def _numbered(t: Tables, model_id: Column) -> DataFrame:
    return _instances(t).select(
        model_id.alias("model_id"), F.col("doc_id").cast("bigint").alias("doc_id"), "label", "features"
    )


@query
def spam_train_sgd(t: Tables) -> DataFrame:
    return _rounded_weights(training.train_minibatch(_numbered(t, F.lit("all"))))


@query
def spam_train_shuffled(t: Tables) -> DataFrame:
    return _rounded_weights(training.train_minibatch(_numbered(t, F.lit("all")), seed=SEED))


@query
def spam_train_mixed(t: Tables) -> DataFrame:
    """Instance by instance in shards, averaged."""
    return _rounded_weights(training.train_mixed(_numbered(t, F.lit("all"))))


@query
def labels_in_random_order(t: Tables) -> DataFrame:
    """The labelled documents in the seeded order; the position makes the order visible in an unordered comparison."""
    return training.in_random_order(t.labels.select("doc_id", "quality"), "doc_id", SEED)


@query
def spam_train_groups(t: Tables) -> DataFrame:
    """Three models in one job; every labelled document belongs to one of them."""
    group = F.concat(F.lit("m"), (F.col("doc_id").cast("bigint") % len(MODELS)).cast("string"))
    return _rounded_weights(training.train_minibatch(_numbered(t, group)))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def roc_area(t: Tables) -> DataFrame:
    return _rounded(scoring.roc_area(_scores(t)), "roca_pct")


@query
def confusion(t: Tables) -> DataFrame:
    return scoring.confusion(_scores(t))


@query
def lam(t: Tables) -> DataFrame:
    return _rounded(scoring.lam(_scores(t)), "lam_pct")


@query
def rate_curve(t: Tables) -> DataFrame:
    return _rounded(scoring.rate_curve(_scores(t)), "fp_at_fn", "fn_at_fp")


@query
def roc_bootstrap(t: Tables) -> DataFrame:
    scored = scoring.bootstrap(_scores(t), seed=SEED)
    return _rounded(scored, *scored.columns)


# Arrivals --------------------------------------------------------------------------------------


def _events(t: Tables) -> DataFrame:
    return t.events.select(F.col("value").alias("x"), F.col("user_id").cast("double").alias("y"), "ts", "event_type")


def _text_times(df: DataFrame) -> DataFrame:
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")}
    return df.withColumns(times)


@query
def region_hourly(t: Tables) -> DataFrame:
    return _text_times(arrivals.region_counts(_events(t), BOXES, "60 minutes"))


@query
def region_sliding(t: Tables) -> DataFrame:
    return _text_times(arrivals.region_counts(_events(t), BOXES, "6 hours", "2 hours"))


@query
def region_from_trip_text(t: Tables) -> DataFrame:
    """Events written as trip records in two layouts and read back."""
    path = work_path(t.spark, "trips")
    green = F.col("event_type") == "purchase"
    point = F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"))
    line = F.concat_ws(
        ",",
        F.when(green, "Green_taxi").otherwise("yellow"),
        F.col("ts").cast("string"),
        F.lit("2,3,4,5,6,7"),
        F.when(green, point).otherwise("0,0"),
        F.when(green, "0,0").otherwise(point),
    )
    _events(t).select(line.alias("value")).write.mode("overwrite").text(path)
    trips = readers.decode_trips(readers.text_lines(t.spark, path), time_field=1)
    return _text_times(arrivals.region_counts(trips, BOXES, "60 minutes"))


@query
def arrivals_history(t: Tables) -> DataFrame:
    return _text_times(arrivals.arrivals_with_previous(_events(t), BOXES, "1 hour"))


@query
def trending(t: Tables) -> DataFrame:
    return _text_times(arrivals.alerts(arrivals.arrivals_with_previous(_events(t), BOXES, "6 hours"), BOXES))


def _streamed(
    t: Tables,
    length_hours: int,
    slide_hours: int,
    build: Callable[[DataFrame, str], DataFrame],
    run: Callable[[DataFrame, str, str], StreamingQuery] | None = None,
) -> DataFrame:
    """Write the events as files in order of time, run a stream over them by name, return what it wrote.

    One event outside every region, a delay after the end of the last window, moves the watermark exactly there.
    """
    spark = t.spark
    events = _events(t).select("x", "y", F.col("ts").cast("timestamp").alias("ts"))
    last = events.agg(F.unix_seconds(F.max("ts"))).first()[0]
    slide, delay = slide_hours * 3600, 3600
    closing = last // slide * slide + length_hours * 3600 + delay
    nowhere = spark.range(1).select(
        F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.timestamp_seconds(F.lit(closing)).alias("ts")
    )
    folder, out, log = (work_path(spark, name) for name in ("event-files", "stream", "stream-log"))
    sinks.write_in_ranges(events.unionByName(nowhere), folder, "ts", EVENT_FILES)
    source = readers.named_file_stream(spark, folder, "x double, y double, ts timestamp", log)
    run = run or (lambda results, out, log: sinks.stream_to_parquet(results, out, log, available_now=False))
    with streams.stream_settings(spark):
        results = build(source, f"{delay} seconds")
        running = run(results, out, log)
    sinks.run_to_end(running)
    return _text_times(spark.read.schema(results.schema).parquet(out).select(*results.columns))


@query
def stream_region_hourly(t: Tables) -> DataFrame:
    return _streamed(t, 1, 1, lambda events, delay: streams.region_stream(events, BOXES, "60 minutes", delay=delay))


@query
def stream_region_sliding(t: Tables) -> DataFrame:
    return _streamed(
        t, 6, 2, lambda events, delay: streams.region_stream(events, BOXES, "6 hours", "2 hours", delay=delay)
    )


@query
def stream_trending(t: Tables) -> DataFrame:
    return _streamed(
        t,
        6,
        6,
        lambda events, delay: arrivals.alerts(streams.arrivals_stream(events, BOXES, "6 hours", delay=delay), BOXES),
    )


@query
def stream_trending_partitioned(t: Tables) -> DataFrame:
    """As ``stream_trending``, with an output folder per window."""
    return _streamed(
        t,
        6,
        6,
        lambda events, delay: arrivals.alerts(streams.arrivals_stream(events, BOXES, "6 hours", delay=delay), BOXES),
        lambda results, out, log: sinks.stream_to_parquet(results, out, log, ["window_start"], available_now=False),
    )


@query
def stream_region_batches(t: Tables) -> DataFrame:
    """As ``stream_region_hourly``, with an output folder per micro-batch."""
    return _streamed(
        t, 1, 1, lambda events, delay: streams.region_stream(events, BOXES, "60 minutes", delay=delay), sinks.stream_in_batches
    )
