"""Accept or reject a sequence of all-or-nothing requests on shared stock.

In sequence, a request is accepted when every resource it touches still has the level it
needs; an accepted request changes the levels for later ones, a rejected one does not.

First the resources are told apart. Where every need holds even if all open requests are accepted,
nothing has to be decided, and behind the last doubt on a resource nothing either: those rows are
dropped, in one shuffle by resource. What is left is mostly a small part, and only that is
ordered into blocks.

Done in rounds over all open requests at once. For every row two levels are known: the worst and
the best that open earlier requests can leave. A request whose needs hold at the worst levels is
accepted, one with a need that fails at the best level is rejected, the others wait. The first open
request has no open request before it, so every round decides at least one and the result equals
the sequential one.

A few rounds decide most requests; what is left are chains of requests that hang on each other.
These are told apart: requests belong together where they share a resource on which one of them
waits for another. Such components do not touch each other's decisions, so each is gone through
in sequence by itself, many at a time. A component of more than COMPONENT_ROWS rows is left to
further rounds, which make it smaller or break it up; no task gets more than that of one component.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.plans.components import components
from stockloom.plans.lookup import heavy_hashes, shuffle_partitions
from stockloom.plans.scan import BLOCK, running, saved, with_blocks
from stockloom.plans.scratch import Scratch

# Executors get the function below by value and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BEFORE_ALL = -(2**63)  # sequence number of the starting levels
ROUNDS = 2  # before components are looked for, and at least between two attempts
COMPONENT_ROWS = 500_000
HOT_ROWS = 500_000  # of one resource, beyond which its rows are cut into blocks from the start


def resolve(lines: DataFrame, levels: DataFrame) -> DataFrame:
    """Decisions (seq, accepted) for every ``seq`` in ``lines``; see ``refused``."""
    seqs = lines.select(F.col("seq").cast("bigint").alias("seq")).filter("seq IS NOT NULL").distinct()
    no = refused(lines, levels).withColumn("accepted", F.lit(False))
    return seqs.join(no, "seq", "left").withColumn("accepted", F.coalesce("accepted", F.lit(True)))


def refused(lines: DataFrame, levels: DataFrame, merge: bool = False) -> DataFrame:
    """(seq) of the requests that are rejected; all others in ``lines`` are accepted.

    lines: seq, resource, need (NULL: no condition), delta; one row per (seq, resource), or with
    ``merge`` several, of which the greatest need and the sum of the deltas count. Rows without
    a seq are left out.
    levels: resource, level; a resource without a row has level 0. A starting level is
    treated as an accepted change before all requests, so no join is needed for it.
    """
    start = levels.select(
        F.lit(BEFORE_ALL).alias("seq"), "resource", F.lit(None).cast("bigint").alias("need"),
        F.col("level").cast("bigint").alias("delta"),
    )
    asked = lines.select(
        F.col("seq").cast("bigint").alias("seq"), "resource",
        F.col("need").cast("bigint").alias("need"), F.col("delta").cast("bigint").alias("delta"),
    ).filter("seq IS NOT NULL")

    rounds = Scratch(lines.sparkSession, "rounds")
    verdicts = Scratch(lines.sparkSession, "verdicts")
    decided: list[DataFrame] = []

    def judge(scanned: DataFrame) -> tuple[DataFrame, int]:
        # Kept, as the verdicts and the rows that learn them both read it: its windows run once.
        judged = rounds.keep(_round(rounds.keep(scanned)))
        decided.append(verdicts.keep(judged.filter("NOT accepted").select("seq").distinct()))
        left = judged.filter("accepted IS NULL").count()
        rounds.remove_older()
        return judged, left

    def still(judged: DataFrame) -> DataFrame:
        return judged.filter("accepted IS NULL OR accepted").select(
            "seq", "resource", "need", "delta", "level", BLOCK, F.col("accepted").isNotNull().alias("taken"),
        )

    scanned, cut = _opening(rounds.keep(asked.unionByName(start)), merge)
    judged, left = judge(scanned)
    state = still(judged)
    waiting, tried = None, 1  # open requests, rounds since the components were last asked for
    while left:
        if tried >= ROUNDS and (waiting is None or 2 * left <= waiting):
            waiting, tried = left, 0
            state, some = _by_component(_doubtful(state, cut), verdicts, rounds)
            decided.append(some.filter("NOT accepted").select("seq"))
            if state.isEmpty():
                break
        judged, left = judge(_doubtful(state, cut))
        tried += 1
        state = still(judged)
    verdict = saved(reduce(DataFrame.unionByName, decided))
    rounds.remove()
    verdicts.remove()
    return verdict


def _unsure() -> Column:
    return F.col("need").isNotNull() & (F.col("level") + F.col("fall") < F.col("need"))


def _opening(rows: DataFrame, merge: bool) -> tuple[DataFrame, bool]:
    """(``_doubtful`` rows of the first round, whether some resources are cut into blocks).

    rows: seq, resource, need, delta, starting levels under BEFORE_ALL. Rows are dealt by resource, and
    those of a resource are gone through in one task. A resource with more than HOT_ROWS rows is cut
    into blocks instead; a sketch names them, and which ones it names affects speed only.
    """
    hot = heavy_hashes(rows, "resource", HOT_ROWS)

    def opened(some: DataFrame) -> DataFrame:
        return (_merged(some) if merge else some).select(
            "seq", "resource", "need", "delta", F.lit(0).cast("bigint").alias("level"),
            (F.col("seq") == BEFORE_ALL).alias("taken"))

    def dealt(some: DataFrame) -> DataFrame:
        return _up_to_last(opened(some.repartition("resource")))  # merged where they are

    if hot is None:
        return dealt(rows), False
    place = F.xxhash64("resource") == F.col("_hot")
    large = with_blocks(opened(rows.join(F.broadcast(hot), place, "left_semi")), ["resource", "seq"])
    plain = dealt(rows.join(F.broadcast(hot), place, "left_anti"))
    return plain.unionByName(_moved(large).select(*plain.columns)), True


def _doubtful(state: DataFrame, cut: bool) -> DataFrame:
    """Open rows with their level moved on, and how far open earlier rows can move it (fall, rise).

    ``taken`` rows were accepted in the round before: they move the level of later rows once and are then
    dropped. So is what lies behind the last doubt on a resource, unless the resource is cut into blocks.
    """
    if not cut:
        return _up_to_last(state.repartition("resource"))
    plain = _up_to_last(state.filter(F.col(BLOCK).isNull()).repartition("resource"))
    return plain.unionByName(_moved(state.filter(F.col(BLOCK).isNotNull())).select(*plain.columns))


def _up_to_last(dealt: DataFrame) -> DataFrame:
    """``_doubtful`` of rows dealt by resource."""
    opened = ~F.col("taken")
    before = Window.partitionBy("resource").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount).over(before), F.lit(0))

    scanned = dealt.select(
        "seq", "resource", "need", "delta", "taken",
        (F.col("level") + total(F.when(~opened, F.col("delta")).otherwise(F.lit(0)))).alias("level"),
        total(F.when(opened, F.least("delta", F.lit(0))).otherwise(F.lit(0))).alias("fall"),
        total(F.when(opened, F.greatest("delta", F.lit(0))).otherwise(F.lit(0))).alias("rise"),
    )
    last = F.max(F.when(opened & _unsure(), F.col("seq"))).over(Window.partitionBy("resource"))
    return scanned.withColumn("_last", last).filter(opened & (F.col("seq") <= F.col("_last"))).select(
        "seq", "resource", "need", "delta", "level", "fall", "rise", F.lit(None).cast("int").alias(BLOCK))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("resource", "seq").agg(
        F.max("need").alias("need"), F.sum("delta").alias("delta")).select("seq", "resource", "need", "delta")


def _by_component(doubtful: DataFrame, verdicts: Scratch, rounds: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows of components that are too large, decisions of all others) for the open requests.

    A request of which no row is left holds for certain.
    """
    opened = rounds.keep(doubtful)
    # Requests up to the last one that waits on a resource hang together through it.
    ties = opened.groupBy("resource").agg(
        F.min("seq").alias("first"), F.max(F.when(_unsure(), F.col("seq"))).alias("last")
    ).filter("last > first")
    tied = opened.select("seq", "resource").join(ties, "resource").filter("seq <= last AND seq > first")
    found = components(tied.select(F.col("seq").alias("a"), F.col("first").alias("b")))
    named = opened.join(found.withColumnRenamed("node", "seq"), "seq", "left").withColumn(
        "component", F.coalesce("component", "seq"))
    named = rounds.keep(named)
    large = named.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > COMPONENT_ROWS).select("component")
    # Few: each has more than COMPONENT_ROWS rows.
    rest = named.join(F.broadcast(large), "component", "left_anti")
    # A fixed number of tasks: joined to a few by their small size in bytes, they would run alone.
    some = verdicts.keep(
        rest.select("component", "seq", F.col("resource").cast("string").alias("resource"), "need", "delta", "level")
        .repartition(shuffle_partitions(doubtful.sparkSession), "component").sortWithinPartitions("component", "seq")
        .mapInArrow(_in_sequence, "seq bigint, accepted boolean"))
    kept = named.join(F.broadcast(large), "component", "left_semi").select(
        "seq", "resource", "need", "delta", "level", BLOCK, F.lit(False).alias("taken"))
    kept = rounds.keep(kept)
    rounds.remove_older()
    return kept, some


def _in_sequence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decide requests one by one; rows come sorted by component and request."""
    component = request = None
    changed: dict[str, int] = {}  # by accepted requests of the component
    moves: list[tuple[str, int]] = []
    good = True
    for batch in batches:
        seqs, verdicts = [], []
        for of, seq, resource, need, delta, level in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if seq != request or of != component:
                if request is not None:
                    seqs.append(request)
                    verdicts.append(good)
                    if good:
                        for touched, by in moves:
                            changed[touched] = changed.get(touched, 0) + by
                if of != component:
                    changed.clear()
                component, request, good = of, seq, True
                moves.clear()
            if good:
                if need is not None and level + changed.get(resource, 0) < need:
                    good = False
                else:
                    moves.append((resource, delta))
        yield _decisions(seqs, verdicts)
    if request is not None:
        yield _decisions([request], [good])


def _decisions(seqs: list[int], verdicts: list[bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(seqs, pa.int64()), pa.array(verdicts, pa.bool_())], names=["seq", "accepted"])


def _moved(state: DataFrame) -> DataFrame:
    """``_doubtful`` of resources cut into blocks, all open rows of them."""
    opened = ~F.col("taken")
    scanned = running(
        state,
        ["resource"],
        ["seq"],
        sums={
            "moved": F.when(F.col("taken"), F.col("delta")).otherwise(F.lit(0)),
            "fall": F.when(opened, F.least("delta", F.lit(0))).otherwise(F.lit(0)),
            "rise": F.when(opened, F.greatest("delta", F.lit(0))).otherwise(F.lit(0)),
        },
    )
    return scanned.filter(opened).withColumn("level", F.col("level") + F.col("moved"))


def _round(scanned: DataFrame) -> DataFrame:
    """Open rows, levels moved on, with ``accepted`` (NULL: still open).

    Only rows that do not hold for certain say anything about their request.
    """
    fails = F.col("level") + F.col("rise") < F.col("need")
    doubts = scanned.filter(_unsure()).groupBy("seq").agg(F.bool_or(fails).alias("any_fails"))
    return scanned.join(doubts, "seq", "left").select(
        "seq", "resource", "need", "delta", "level", BLOCK,
        F.when(F.col("any_fails").isNull(), F.lit(True)).when(F.col("any_fails"), F.lit(False)).alias("accepted"),
    )
