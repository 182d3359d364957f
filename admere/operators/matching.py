"""Joins with an interval or an OR in their condition, without listing pairs.

An order with its nearest session is found by two running values over range
partitions of (person, time); the number of sessions in an interval is the
difference of two running counts. Every running value looks back only, so a
partition costs one sorted pass, and one person with a third of all rows, or one
very busy hour, spreads over as many partitions as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admere.session import stable


def running_values(events: DataFrame, points: DataFrame, person: str, at: str, payload: Sequence[str] = ()) -> DataFrame:
    """For each point in time: how many events of the person lie up to it, the last of them, and the next one.

    ``events`` holds ``person``, ``at`` (epoch micros) and the payload; ``points``
    holds ``person``, ``at``, ``id`` and ``kind``. Gives ``who``, ``id``, ``kind``, ``n``,
    ``hit`` and ``next``, structs ``(at, payload...)``. An event at the very instant
    counts as up to it.
    """
    marks = events.select(
        F.col(person).alias("who"),
        F.lit(None).cast(points.schema["id"].dataType).alias("id"),
        F.lit(None).cast("string").alias("kind"),
        F.col(at).alias("when"),
        F.struct(F.col(at).alias("at"), *[F.col(p) for p in payload]).alias("event"),
    )
    asks = points.select(
        F.col(person).alias("who"), "id", "kind", F.col(at).alias("when"), F.lit(None).cast(marks.schema["event"].dataType).alias("event")
    )
    event = F.col("event")
    # Events of one instant sort before the points there; the greatest payload is last.
    order = [F.col("who"), F.col("when"), event.asc_nulls_last()]
    partitions = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written out, since a second sampling could cut the ranges elsewhere.
    both = stable(
        marks.unionByName(asks).repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftrightunsigned("place", 33))
    is_event = event.isNotNull()
    here = Window.partitionBy("who", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    forth, back = here.orderBy("place"), here.orderBy(F.col("place").desc())
    ends = both.groupBy("who", "part").agg(
        F.count_if(is_event).alias("part_n"),
        F.max_by(event, F.when(is_event, F.col("place"))).alias("part_last"),
        F.min_by(event, F.when(is_event, F.col("place"))).alias("part_first"),
    )
    # One row per person and range partition.
    others = Window.partitionBy("who").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("who").alias("carry_who"),
        F.col("part").alias("carry_part"),
        F.coalesce(F.sum("part_n").over(others.orderBy("part")), F.lit(0)).alias("carry_n"),
        F.last("part_last", ignorenulls=True).over(others.orderBy("part")).alias("carry_last"),
        F.last("part_first", ignorenulls=True).over(others.orderBy(F.col("part").desc())).alias("carry_next"),
    )
    local = both.select(
        "who",
        "part",
        "id",
        "kind",
        is_event.alias("is_event"),
        F.count_if(is_event).over(forth).alias("here_n"),
        F.last(event, ignorenulls=True).over(forth).alias("here_last"),
        F.last(event, ignorenulls=True).over(back).alias("here_next"),
    ).filter(~F.col("is_event"))
    found = local.join(carried, (F.col("who") == F.col("carry_who")) & (F.col("part") == F.col("carry_part")), "left")
    return found.select(
        "who",
        "id",
        "kind",
        (F.col("here_n") + F.coalesce("carry_n", F.lit(0))).alias("n"),
        F.coalesce("here_last", "carry_last").alias("hit"),
        F.coalesce("here_next", "carry_next").alias("next"),
    )


def interval_matches(
    orders: DataFrame,
    sessions: DataFrame,
    order_id: str,
    order_at: str,
    session_id: str,
    session_at: str,
    person: str,
    before: int,
    after: int,
    counted: bool = True,
) -> DataFrame:
    """Sessions of the same person that start in ``[order - before, order + after]``.

    Per order that has any: their number ``n_matches`` and the best one by whole
    seconds of distance, then later start, then greater session id, with its
    ``distance_s``. ``before`` and ``after`` are seconds. Without ``counted`` the
    number is left out, and with it two of the three points an order asks for.

    Orders of people without a session are dropped before any row is sorted, and
    the two neighbours of an order come in one row, so nothing is grouped by order
    but the counts of those that match.
    """
    micros = 1_000_000
    marks = sessions.filter(F.col(person).isNotNull() & F.col(session_at).isNotNull()).select(
        F.col(person).alias("who"), F.unix_micros(F.col(session_at)).alias("at"), F.col(session_id).alias("sid")
    )
    seen = marks.select(F.col("who").alias(person)).distinct()
    asks = orders.filter(F.col(person).isNotNull() & F.col(order_at).isNotNull()).join(seen, person, "left_semi").select(
        F.col(person).alias("who"), F.struct(F.col(order_id).alias("key"), F.unix_micros(F.col(order_at)).alias("o")).alias("id")
    )
    # What is known of an order travels in its id, so neither step joins back.
    o = F.col("id.o")

    def points(source: DataFrame, **at: Column) -> DataFrame:
        each = F.array(*[F.struct(F.lit(kind).alias("kind"), c.alias("at")) for kind, c in at.items()])
        return source.select("id", "who", F.inline(each))

    low, high = o - before * micros, o + after * micros
    following = F.col("next.at") <= high
    found = running_values(marks, points(asks, past=o), "who", "at", ["sid"]).filter((F.col("hit.at") >= low) | following)
    seconds = lambda at: F.floor(F.abs(at - o) / micros).cast("bigint")
    # Whole seconds decide first: of the later sessions, the last one within the
    # second of the nearest counts. Without a later one this looks back again.
    edge = F.least(o + (seconds(F.col("next.at")) + 1) * micros - 1, high)
    known = F.struct("id.*", F.col("hit").alias("past"), F.when(following, edge).otherwise(o).alias("edge"))
    # Read twice below; sessions of people without a match are not sorted again.
    asked = stable(found.select("who", known.alias("id")))
    marks = marks.join(asked.select("who").distinct(), "who", "left_semi").select(*marks.columns)
    counts = {"low": low - 1, "high": high} if counted else {}
    tied = running_values(marks, points(asked, tie=F.col("id.edge"), **counts), "who", "at", ["sid"])

    def candidate(hit: str) -> Column:
        shaped = F.struct((-seconds(F.col(f"{hit}.at"))).alias("closeness"), F.col(f"{hit}.at"), F.col(f"{hit}.sid"))
        return F.when(F.col(f"{hit}.at") >= low, shaped)

    best = F.greatest(candidate("id.past"), candidate("hit"))
    if not counted:
        return tied.select(F.col("id.key").alias(order_id), best["sid"].alias(session_id), (-best["closeness"]).alias("distance_s"))
    of = lambda name, c: F.max(F.when(F.col("kind") == name, c))
    return (
        tied.groupBy("who", "id")
        .agg((of("high", F.col("n")) - of("low", F.col("n"))).alias("n_matches"), of("tie", best).alias("best"))
        .select(F.col("id.key").alias(order_id), "n_matches", F.col("best.sid").alias(session_id), (-F.col("best.closeness")).alias("distance_s"))
    )


def exact_matches(orders: DataFrame, sessions: DataFrame, order_id: str, order_at: str, session_id: str, session_at: str, link: str) -> DataFrame:
    """Sessions that name the order: their number and the best one per order."""
    seconds = F.floor(F.abs(F.unix_micros(F.col(session_at)) - F.unix_micros(F.col("__o_at"))) / 1_000_000).cast("bigint")
    pairs = sessions.filter(F.col(link).isNotNull()).join(
        orders.select(F.col(order_id).alias("__oid"), F.col(order_at).alias("__o_at")), F.col(link) == F.col("__oid")
    )
    rank = F.struct(-seconds, F.col(session_at), F.col(session_id))
    return pairs.groupBy(F.col("__oid").alias(order_id)).agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.max_by(F.col(session_id), rank).alias(session_id),
        F.max_by(seconds, rank).alias("distance_s"),
    )


def best_session(
    orders: DataFrame,
    sessions: DataFrame,
    order_id: str,
    order_at: str,
    session_id: str,
    session_at: str,
    person: str,
    link: str,
    before: int = 86_400,
    after: int = 3_600,
) -> DataFrame:
    """Best session of each order that has one: named by it first, then nearest start."""
    exact = exact_matches(orders, sessions, order_id, order_at, session_id, session_at, link)
    near = interval_matches(orders, sessions, order_id, order_at, session_id, session_at, person, before, after, counted=False)
    either = exact.select(
        order_id, session_id, "distance_s", F.lit(True).alias("exact_transaction_match")
    ).unionByName(near.select(order_id, session_id, "distance_s", F.lit(False).alias("exact_transaction_match")))
    pick = F.struct("exact_transaction_match", session_id, "distance_s")
    return (
        either.groupBy(order_id)
        .agg(F.max_by(pick, F.col("exact_transaction_match")).alias("__best"))
        .select(order_id, "__best.*")
    )


def candidate_counts(
    orders: DataFrame,
    sessions: DataFrame,
    order_id: str,
    order_at: str,
    session_id: str,
    session_at: str,
    person: str,
    link: str,
    before: int = 86_400,
    after: int = 3_600,
) -> DataFrame:
    """Sessions matched by "names the order OR same person near in time", per order.

    A session that meets both conditions counts once: the named ones outside the
    interval are added to the interval count.
    """
    near = interval_matches(orders, sessions, order_id, order_at, session_id, session_at, person, before, after)
    o = orders.select(F.col(order_id).alias("__oid"), F.col(order_at).alias("__o_at"), F.col(person).alias("__who"))
    gap = F.unix_micros(F.col(session_at)) - F.unix_micros(F.col("__o_at"))
    inside = F.coalesce(
        (F.col(person) == F.col("__who")) & gap.between(-before * 1_000_000, after * 1_000_000), F.lit(False)
    )
    named = (
        sessions.filter(F.col(link).isNotNull())
        .join(o, F.col(link) == F.col("__oid"))
        .groupBy("__oid")
        .agg(F.count(F.lit(1)).alias("n_exact"), F.count_if(~inside).alias("__outside"))
        .withColumnRenamed("__oid", order_id)
    )
    both = orders.select(order_id).join(near.select(order_id, "n_matches"), order_id, "left").join(named, order_id, "left")
    zero = F.lit(0).cast("bigint")
    return both.select(
        order_id,
        F.coalesce("n_exact", zero).alias("n_exact"),
        F.coalesce("n_matches", zero).alias("n_interval"),
        (F.coalesce("n_matches", zero) + F.coalesce("__outside", zero)).alias("n_candidates"),
    )
