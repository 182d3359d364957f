"""People behind customer records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.functions.clean import surrogate_key
from admere.operators.versions import latest_by
from admere.session import release, stable


def bridge_identity(customers: DataFrame, email: str = "email_hash", phone: str = "phone_hash") -> DataFrame:
    """One-hop identity: records that share a phone take its smallest e-mail.

    Adds ``identity_hash`` and ``identity_method``. The bridge wins over the
    record's own e-mail.
    """
    bridge = (
        customers.filter(F.col(phone).isNotNull() & F.col(email).isNotNull())
        .groupBy(F.col(phone).alias("__phone"))
        .agg(F.min(email).alias("__bridge"))
    )
    joined = customers.join(bridge, F.col(phone) == F.col("__phone"), "left")
    method = (
        F.when(F.col(email).isNotNull(), "email")
        .when(F.col("__bridge").isNotNull(), "phone_to_email_bridge")
        .otherwise("phone")
    )
    return (
        joined.withColumn("identity_hash", F.coalesce("__bridge", email, phone))
        .withColumn("identity_method", method)
        .drop("__phone", "__bridge")
    )


def person_key(identity: str = "identity_hash"):
    return surrogate_key(F.lit("customer"), identity)


def late_placeholders(facts: DataFrame, dimension: DataFrame, key: str, newest: tuple[str, ...], lineage: tuple[str, ...] = ("dt", "source_file_name")) -> DataFrame:
    """One row per key the facts name but the dimension lacks, with the newest lineage."""
    dt, source = lineage
    missing = facts.filter(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
    return missing.groupBy(key).agg(F.max(dt).alias(dt), latest_by(source, *newest).alias(source))


#: A node's links are told their least neighbour by a broadcast if it has more of them than this and than a
#: share of all links. Fewer than twice as many nodes as the share says can pass it, so what is broadcast is bounded.
HOT_DEGREE, HOT_SHARE = 64, 50_000


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Component of every node as the smallest node name it is linked to.

    Alternates the large-star and small-star steps of the published map-reduce
    algorithm until no edge changes; the number of rounds grows with the logarithm
    of the component size. Each step is one minimum per node (partial on the map
    side) given back to its edges: by a broadcast to those of the few nodes with very many
    neighbours, which then stay where they are, and by a join to all others. The edge list never
    grows; each round is written and the one before it deleted.
    """
    nodes = edges.select(F.col(src).alias("node")).union(edges.select(F.col(dst).alias("node"))).distinct()
    links = stable(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
    state = None
    while True:
        row = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state == (row["n"], row["h"]):
            break
        state = (row["n"], row["h"])
        degree = max(HOT_DEGREE, row["n"] // HOT_SHARE)
        # Written between the steps, as the second reads the first four times.
        large = stable(_large_star(links, degree))
        release(links)
        links = stable(_small_star(large, degree))
        release(large)
    roots = links.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(roots, F.col("node") == F.col("u"), "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _with_least(pairs: DataFrame, least: DataFrame, degree: int) -> DataFrame:
    """Add the ``root`` of ``n`` to pairs (``n``, ``m``); nodes of more than ``degree`` pairs are not shuffled."""
    many = F.broadcast(least.filter(F.col("degree") > degree).select("n", F.struct("root").alias("__hot")))
    told = pairs.join(many, "n", "left")
    hot = told.filter(F.col("__hot").isNotNull()).select("n", "m", F.col("__hot.root").alias("root"))
    cold = told.filter(F.col("__hot").isNull()).select("n", "m").join(least.filter(F.col("degree") <= degree).select("n", "root"), "n")
    return hot.unionByName(cold)


def _large_star(links: DataFrame, degree: int) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = links.select(F.col("u").alias("n"), F.col("v").alias("m")).union(
        links.select(F.col("v").alias("n"), F.col("u").alias("m"))
    )
    least = both.groupBy("n").agg(F.least(F.col("n"), F.min("m")).alias("root"), F.count(F.lit(1)).alias("degree"))
    return (
        _with_least(both, least, degree)
        .filter(F.col("m") > F.col("n"))
        .select(F.col("m").alias("u"), F.col("root").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame, degree: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    pairs = links.select(F.col("u").alias("n"), F.col("v").alias("m"))
    least = pairs.groupBy("n").agg(F.min("m").alias("root"), F.count(F.lit(1)).alias("degree"))
    moved = _with_least(pairs, least, degree).select(F.col("m").alias("u"), F.col("root").alias("v"))
    own = least.select(F.col("n").alias("u"), F.col("root").alias("v"))
    return moved.union(own).filter(F.col("u") != F.col("v")).distinct()


def people(customers: DataFrame, key: str = "customer_id", email: str = "email_hash", phone: str = "phone_hash") -> DataFrame:
    """Transitive identity: records linked by any chain of shared e-mails and phones."""
    found = connected_components(record_links(customers, key, email, phone)).filter(F.col("node").startswith("c|"))
    return _labelled(customers, found, key)


def record_links(customers: DataFrame, key: str = "customer_id", email: str = "email_hash", phone: str = "phone_hash") -> DataFrame:
    """Edges between records and the e-mails and phones they hold."""
    record = F.concat(F.lit("c|"), F.col(key))
    mail = customers.filter(F.col(email).isNotNull()).select(record.alias("src"), F.concat(F.lit("e|"), F.col(email)).alias("dst"))
    call = customers.filter(F.col(phone).isNotNull()).select(record.alias("src"), F.concat(F.lit("p|"), F.col(phone)).alias("dst"))
    return mail.union(call)


def _labelled(customers: DataFrame, found: DataFrame, key: str) -> DataFrame:
    record = F.concat(F.lit("c|"), F.col(key))
    return customers.select(key).join(
        found.select(F.substring("node", 3, 2_000_000_000).alias(key), "component"), key, "left"
    ).withColumn("component", F.coalesce("component", record))
