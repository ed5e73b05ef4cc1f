"""Linking through inverted lists, and connected components of the links.

``components`` is a distributed union-find: edges are replaced by edges to smaller nodes until every node
points at the smallest one of its component.  Its joins and minima are per node, never per component.

``linked`` finds the connected components of a similarity that is only known pair by pair, when every pair
that may be similar meets in at least one list.  It never writes all pairs of a long list.  Pairs inside one
component need no test, so a list is finished as soon as its members are connected; what remains of a long
list is tested from the members outside its largest component.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brindle.llm._common import stored

#: Lists up to this length are compared member by member, at once; longer ones in rounds, in which LEADERS members
#: at first and then twice as many meet all others.  Lists are met in parts of about PART members.
SHORT = 64
LEADERS = 64
PART = 4096


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of a node are linked to the smallest node around it."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = around.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of the edges (a, b); the component is its smallest node.

    No edges give no rows.  Repeated edges, both directions and loops are allowed; null ends are not.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _labelled(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return entries.withColumn("component", F.col("id"))
    known = labels.select("id", F.col("component").alias("known"))
    return entries.join(known, "id", "left").select(
        *entries.columns, F.coalesce("known", "id").alias("component")
    )


def linked(
    entries: DataFrame,
    confirmed: Callable[[DataFrame], DataFrame],
    near: Callable[[str, str], F.Column] | None = None,
    sketches: DataFrame | None = None,
    likely: Callable[[F.Column, F.Column], F.Column] | None = None,
) -> DataFrame:
    """(id, component) of every id that is linked with another one.

    ``entries`` are (key, id, size); ids with a common key are candidates if their sizes fit (``near``, on the
    size columns ``a_size`` and ``b_size``).  ``confirmed`` keeps of the pairs (a, b) those truly linked.
    ``sketches`` (id and more columns) travel with the members of long lists, so that ``likely``, on two structs of
    the size and these columns, drops a pair where it meets; it must not drop a pair that is linked.
    """
    fits = near("a_size", "b_size") if near else F.lit(True)
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    listed = stored(entries.select("key", "id", "size").join(shared, "key"), "lists")
    # The member whose lists are longest is the likeliest original of a group of copies.
    weights = listed.groupBy("id").agg(F.sum("n").alias("weight"))
    entries = stored(listed.join(weights, "id").select("key", "id", "size", "weight"), "lists")
    # First every member against the weightiest one of its list: this connects groups of copies.
    first = entries.groupBy("key").agg(F.max(F.struct("weight", "id", "size")).alias("first"))
    pairs = (
        entries.join(first, "key")
        .where(F.col("id") != F.col("first.id"))
        .select(F.col("first.id").alias("a"), F.col("id").alias("b"), F.col("first.size").alias("a_size"), F.col("size").alias("b_size"))
        .where(fits)
        .select("a", "b")
        .distinct()
    )
    edges = stored(confirmed(pairs), "links")
    labels = components(edges)
    # Then what is not connected yet in short lists, member by member.
    open_lists = (
        _labelled(entries, labels)
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("key", "n")
    )
    left = stored(_labelled(entries, labels).join(open_lists, "key"), "lists")
    short = left.where(F.col("n") <= SHORT)
    a, b = (short.select("key", *[F.col(c).alias(f"{side}{s}") for c, s in (("id", ""), ("size", "_size"), ("component", "_component"))]) for side in "ab")
    pairs = (
        a.join(b, "key").where("a < b and a_component <> b_component").where(fits).select("a", "b").distinct()
    )
    edges = edges.unionByName(stored(confirmed(pairs), "links"))
    labels = components(edges)
    # At last long lists: members outside the largest component against all others, some at a time.
    rest = left.where(F.col("n") > SHORT).select("key", "id", "size", "weight", F.lit(False).alias("done"))
    # Two ids mostly share many lists; a pair is compared in the first one only, which costs an array per member.
    shared_lists = rest.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    carried = shared_lists if sketches is None else shared_lists.join(sketches, "id")
    rest = stored(rest.join(carried, "id"), "lists")
    extra = [c for c in carried.columns if c != "id"]
    likely_pair = likely(F.struct(*[F.col(f"a_{c}").alias(c) for c in ["size", *extra]]), F.struct("size", *extra)) if likely else F.lit(True)
    n_leaders = LEADERS
    while True:
        named = _labelled(rest, labels)
        sizes = named.groupBy("key", "component").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("key").agg(
            F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("n_components"), F.sum("n").alias("n")
        ).where("n_components > 1").select("key", F.col("top.component").alias("top"), F.ceil(F.col("n") / PART).alias("n_parts"))
        named = stored(named.join(largest, "key"), "lists")
        rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc("weight"), "id"))
        leading = stored(
            named.where("not done and component <> top")
            .select("key", "id", "weight").distinct()
            .withColumn("rank", rank)
            .where(F.col("rank") <= n_leaders)
            .select("key", "id", F.lit(True).alias("used")),
            "leaders",
        )
        if not leading.head(1):
            return labels
        # A long list is met in parts, each with its own copy of the leaders.
        leaders = named.join(leading, ["key", "id"]).select(
            "key",
            F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part"),
            *[F.col(c).alias(f"a_{c}") for c in ["id", "size", "component", *extra]],
        )
        # Those that have led before have met every member already.
        members = named.where("not done").withColumn("part", F.pmod(F.xxhash64("id"), F.col("n_parts")))
        first_met = F.get(F.array_intersect("a_keys", "keys"), F.lit(0)) == F.col("key")
        pairs = (
            leaders.join(members.withColumn("b_size", F.col("size")), ["key", "part"])
            .where((F.col("a_component") != F.col("component")) & (F.col("a_id") != F.col("id")))
            .where(fits & first_met & likely_pair)
            .select(F.least("a_id", "id").alias("a"), F.greatest("a_id", "id").alias("b"))
            .distinct()
        )
        more = stored(confirmed(pairs), "links")
        if more.head(1):
            edges = edges.unionByName(more)
            labels = components(edges)
        rest = stored(
            named.join(leading, ["key", "id"], "left").select(
                "key", "id", "size", "weight", (F.col("done") | F.coalesce("used", F.lit(False))).alias("done"), *extra
            ),
            "lists",
        )
        n_leaders *= 2
