"""Mix sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source is a queue of its documents in shuffled order, walked up to ``REPEATS``
times. A document's virtual finish time is the words its queue has given out with it,
divided by the source's target, so at one moment of virtual time all sources have given
the same share of their targets. All entries are then sorted by finish time over the
whole table, and the sort is cut where the running total reaches the budget.

Targets fill up like water: sources share the budget by weight, none gets more than
``REPEATS`` times its size, and what that leaves over goes to the others by weight.

No queue is held by one task. Both running totals, of a queue and of all entries, come
from range partitions: a sum per partition, then the rows inside each; the rows of one
large source spread over as many partitions as they need. The cut is one pair of values,
so no row is joined back.

Defined results: NULL and empty texts have size 0, and 0 words are taken of them. NULL is
a source of its own, the last. Ties in the shuffle go by id and size, ties in finish time
by source. Rows that repeat an id are entries of their own. An empty table mixes to
nothing. The budget must not exceed ``REPEATS`` times the sum of sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admere.llm.text import WORD_PATTERN
from admere.operators.spread import global_row_number
from admere.session import release, stable

#: Times a document is taken at most.
REPEATS = 3
#: Weights of the sources in order, over and over.
WEIGHTS = (1, 2, 3)
#: Changes the shuffled order.
SEED = "mix"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def running_total(df: DataFrame, order: list[Column], value: str, name: str = "total") -> DataFrame:
    """Sum of ``value`` over all rows up to and including each, in one order of the whole frame."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stable(df.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftrightunsigned("__place", 33))
    # one row per range: at most ``partitions`` rows
    ahead = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("__part").agg(F.sum(value).alias("__sum"))
    before = sums.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumn("__inside", F.sum(value).over(inside))
    return summed.join(F.broadcast(before), F.col("__part") == F.col("__p")).withColumn(name, F.col("__before") + F.col("__inside")).drop("__place", "__part", "__p", "__before", "__inside")


def targets(sizes: DataFrame, source: str = "source", size: str = "size", weights: tuple[int, ...] = WEIGHTS, share: float = 1.0) -> DataFrame:
    """One row per source: its place in order, its size, and the words it should give."""
    found = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    ranked = global_row_number(found, [F.col(source).asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = stable(ranked.withColumn("weight", weight.cast("long")))
    top = F.col("source_size") * REPEATS
    level, full = 0.0, -1
    while True:
        over = (F.col("weight") * F.lit(level) > top) | (top == 0) if full >= 0 else F.lit(False)
        row = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(over, top)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open"),
            F.count_if(over).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full = row["full"]
        # in whole numbers up to the division, so that reruns and SQL get the same value
        budget = row["all"] if share == 1.0 else row["all"] * share
        level = (budget - row["given"]) / row["open"]
    return ranked.withColumn("target", F.least(top.cast("double"), F.col("weight") * F.lit(float(level)))).drop("weight")


def _turn(id: str) -> Column:
    """Where a row stands in the shuffled order of its source."""
    return F.md5(F.concat(F.lit(SEED + "|"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"))


def mix(sizes: DataFrame, id: str = "doc_id", source: str = "source", size: str = "size") -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies``: how often the mix takes each row."""
    plan = stable(targets(sizes, source, size))
    budget = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # a source's words start behind those of the sources before it
    ahead = running_total(plan.select("place", "source_size"), [F.col("place")], "source_size", "upto").select(F.col("place").alias("__n"), (F.col("upto") - F.col("source_size")).alias("start"))
    facts = plan.join(ahead, F.col("place") == F.col("__n")).select(F.col(source).alias("__source"), "place", "source_size", "target", "start")
    # as many sources as there are rows of facts; Spark measures it
    placed = sizes.join(facts, F.col(source).eqNullSafe(F.col("__source"))).drop("__source").withColumn("turn", _turn(id))
    queued = running_total(placed, [F.col("place"), F.col("turn"), F.col(id), F.col(size)], size, "upto")
    queued = stable(queued.withColumn("queue", F.col("upto") - F.col("start")).drop("turn", "upto", "start"))

    def finish(turn: int | Column) -> Column:
        return (F.col("queue") + F.col("source_size") * turn).cast("double") / F.col("target")

    entries = queued.filter(F.col(size) > 0).select("place", "queue", "source_size", "target", size, F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))).alias("turn"))
    entries = entries.select("place", finish(F.col("turn")).alias("finish"), size)
    last = running_total(entries, [F.col("finish"), F.col("place")], size).filter(F.col("total") <= budget).agg(F.max(F.struct("finish", "place")).alias("last")).first()["last"]
    release(plan)
    if last is None:
        return queued.withColumn("copies", F.lit(0)).drop("place", "queue")
    end, place = F.lit(last["finish"]), F.lit(last["place"])
    taken = [((finish(t) < end) | ((finish(t) == end) & (F.col("place") <= place))).cast("int") for t in range(REPEATS)]
    copies = F.when(F.col(size) > 0, sum(taken[1:], taken[0])).otherwise(F.lit(0))
    return queued.withColumn("copies", copies).drop("place", "queue")


def mix_documents(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document."""
    sizes = stable(docs.select("doc_id", "source", word_count().alias("size")))
    return mix(sizes).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def draw(docs: DataFrame) -> DataFrame:
    """The mixed documents: each as many times as the mix takes it, so some not at all.

    In every source the rows taken a given number of times are the first ones of its
    shuffled order, so the last of them says which: ``REPEATS`` cuts per source go to the
    documents, and no text is shuffled. Rows equal in id, source and size are taken alike.
    """
    order = F.struct(_turn("doc_id").alias("turn"), F.col("doc_id").alias("id"), F.col("size").alias("size"))
    taken = mix(stable(docs.select("doc_id", "source", word_count().alias("size"))))
    cuts = stable(
        taken.filter("copies > 0")
        .groupBy(F.col("source").alias("__source"))
        .agg(*[F.max(F.when(F.col("copies") > t, order)).alias(f"__cut{t}") for t in range(REPEATS)])
    )
    own = F.struct(_turn("doc_id"), F.col("doc_id"), F.col("__size"))
    copies = sum((F.coalesce(own <= F.col(f"__cut{t}"), F.lit(False)).cast("int") for t in range(1, REPEATS)), F.coalesce(own <= F.col("__cut0"), F.lit(False)).cast("int"))
    sized = docs.withColumn("__size", word_count()).filter("__size > 0")
    joined = sized.join(cuts, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__copies", copies)
    return joined.filter("__copies > 0").select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).drop("__copy")
