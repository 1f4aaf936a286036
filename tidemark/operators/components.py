"""People as connected components over several keys (M5 with more than one).

A record and each of its keys (e-mail hash, account, user id, anonymous id)
are joined by a link; everything that links reach is one person. Each round
every node points at the least node among itself and its neighbours, the
pointers are followed to their ends, and the links are contracted onto them;
a component shrinks to one node in a number of rounds that is logarithmic in
its size. Every round is groupings and equi-joins of node-sized tables, and
written, so that a lost executor goes back to the last round only.

A key that very many records share (a kiosk's device id) is a node of many
links: its neighbours are reduced to a minimum before the shuffle, and a join
on it is split by AQE. Such hubs are never dropped; they are reported, and the
people they hold together are marked, so that the caller can decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written and read back: the next round starts from files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"components-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _roots(pointers: DataFrame) -> DataFrame:
    """Pointers (node, to) followed to their ends. A pointer never leads to a
    greater node, so there are no circles; each step doubles what is followed."""
    while True:
        ends = pointers.select(F.col("node").alias("at"), F.col("to").alias("end"))
        pointers = _stored(pointers.join(ends, F.col("to") == F.col("at"), "left").select(
            "node", F.coalesce("end", "to").alias("to"), (F.col("end") < F.col("to")).alias("moved")), "pointers")
        if pointers.filter("moved").isEmpty():
            return pointers.select("node", "to")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that links lead to. ``links`` has two
    columns of one orderable type; direction, repeats and links of a node to
    itself do not matter, a node of a link whose other end is NULL stands alone."""
    left, right = F.col(f"`{a}`"), F.col(f"`{b}`")
    nodes = links.select(left.alias("node")).union(links.select(right.alias("node"))).filter("node IS NOT NULL").distinct()
    found = _stored(nodes.select("node", F.col("node").alias("component")), "nodes")
    open_ = _stored(links.select(left.alias("u"), right.alias("v")).filter("u <> v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    while not open_.isEmpty():
        both = open_.select(F.col("u").alias("node"), F.col("v").alias("near")).union(open_.select(F.col("v"), F.col("u")))
        least = both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("to"))
        roots = _roots(_stored(least, "least"))
        of = lambda c: roots.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        open_ = _stored(open_.join(of("u"), "u").join(of("v"), "v").filter("u_to <> v_to").select(
            F.least("u_to", "v_to").alias("u"), F.greatest("u_to", "v_to").alias("v")).distinct(), "links")
        moved = roots.filter("node <> to")
        found = _stored(found.join(moved.select(F.col("node").alias("component"), "to"), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")), "nodes")
    return found


def identity_links(customers: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Links (record, key) of customer records, and of what the event log knows
    of user and anonymous ids. Keys carry their kind (``email:``, ``account:``,
    ``user:``, ``anon:``); an app record's own id is its user id."""
    record = F.concat(F.lit("record:"), F.col("source_system"), F.lit(":"), F.col("source_id"))
    user = F.when(F.col("source_system") == "app", F.concat(F.lit("user:"), F.col("source_id")))
    keys = F.array(F.concat(F.lit("email:"), F.col("email_hash")), F.concat(F.lit("account:"), F.col("account_id")), user)
    links = customers.select(record.alias("a"), F.explode(F.array_compact(keys)).alias("b"))
    if events is not None:
        seen = events.filter("user_id IS NOT NULL AND anonymous_id IS NOT NULL").select(
            F.concat(F.lit("anon:"), F.col("anonymous_id")).alias("a"), F.concat(F.lit("user:"), F.col("user_id")).alias("b")).distinct()
        links = links.unionByName(seen)
    return links


def identity_components(links: DataFrame, hub: int = 1000) -> DataFrame:
    """One row per node of ``links``: node, component, n_nodes and n_records of
    its component, n_links of the node, is_hub (a key with more than ``hub``
    links) and via_hub (its component holds a hub: look before trusting it)."""
    degree = links.distinct().select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    nodes = _stored(components(links).join(degree, "node").withColumn(
        "is_hub", (F.col("n_links") > hub) & ~F.col("node").startswith("record:")), "degrees")
    sums = nodes.groupBy("component").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("node").startswith("record:")).alias("n_records"), F.max("is_hub").alias("via_hub"))
    return nodes.join(sums, "component").select("node", "component", "n_nodes", "n_records", "n_links", "is_hub", "via_hub")


def hubs(found: DataFrame) -> DataFrame:
    """The report of shared keys: node, n_links and what they hold together."""
    return found.filter("is_hub").select("node", "n_links", "component", "n_records")
