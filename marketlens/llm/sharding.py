"""Sharding by balanced label propagation, with DataFrame functions only.

Documents with equal texts are linked; shards should cut few links and hold equally many
documents (the law ``rows``: counts differ by one at most).

Linked documents start in the shard their hash names.  In each round every group of
linked documents names, among the shards with room, the one that already holds most of
it, and its documents elsewhere move there as far as the shard's quota reaches.  Members
of a group are interchangeable, so the state is one row for each group and shard with a
count, however large the group.  Moves into a shard are let in by running totals over
bins, never by one task for each shard.  Rounds end when nothing moves.  Documents that
are linked to nothing then level the shards exactly, and so do linked documents beyond a
shard's share, if there are any.

Nulls and edge cases: a null text has size 1, no checksum, and is linked to nothing; an
empty text is a text; a null doc_id is placed as any other; equal rows are members of one
group; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of, drop_stage, released_shuffles, running_total, stage_table, uniform


def _per_shard(df: DataFrame, amount: str, shards: int) -> list[int]:
    """One number a shard."""
    got = {r["shard"]: int(r["n"]) for r in df.groupBy("shard").agg(F.sum(amount).alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _lookup(values: list[int], index: str):
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col(index).cast("int") + 1)


def propagate(state: DataFrame, caps: list[int]) -> DataFrame:
    """``state`` (g, shard, c) after label propagation under the quotas ``caps``, until nothing
    moves.  A move takes rows of a group from a smaller to its largest open part, so the sum
    of the parts' squares grows (or an equal part empties into a smaller shard): it ends."""
    shards = len(caps)
    while True:
        loads = _per_shard(state, "c", shards)
        room = [max(0, cap - load) for cap, load in zip(caps, loads, strict=True)]
        if not any(room):
            break
        open_ = F.when(_lookup(room, "shard") > 0, F.struct("c", (-F.col("shard")).alias("s")))
        best = state.groupBy("g").agg(F.max(open_).alias("best"))
        wish = (state.join(best, "g")
                .filter(F.col("best").isNotNull())
                .withColumn("to", (-F.col("best.s")).cast("int"))
                .filter((F.col("shard") != F.col("to")) & (F.struct("c", (-F.col("shard")).alias("s")) < F.col("best")))
                .select("g", "shard", "to", "c", uniform(F.hex("g"), F.col("shard"), seed="move").alias("key")))
        ranked = running_total(wish, ["to"], "key", F.col("c"), "before", 256, ["g", "shard"])
        moves = (ranked.withColumn("m", F.least(F.col("c"), _lookup(room, "to") - F.col("before")))
                 .filter("m > 0").select("g", "shard", "to", "m"))
        moves = stage_table(moves, "moves")
        if moves.isEmpty():
            drop_stage(moves)
            break
        after = stage_table(
            state.select("g", "shard", "c")
            .unionByName(moves.select("g", "shard", (-F.col("m")).alias("c")))
            .unionByName(moves.select("g", F.col("to").alias("shard"), F.col("m").alias("c")))
            .groupBy("g", "shard").agg(F.sum("c").alias("c")).filter("c > 0"), "state")
        drop_stage(moves, state)
        state = after
    return state


def shard(documents: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each document."""
    with released_shuffles(documents.sparkSession):  # the rounds' counts leave no files
        return _shard(documents, shards)


def _shard(documents: DataFrame, shards: int) -> DataFrame:
    rows = stage_table(
        columns_of(documents, "doc_id", "text")
        .select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                F.crc32("text").cast("long").alias("text_crc32"), F.unhex(F.md5("text")).alias("g"))
        .withColumn("key", uniform(F.col("doc_id"), F.hex("g"), seed="shard")), "rows")
    ties = ["doc_id", "g", "size"]
    total = rows.count()
    caps = [total // shards + (s < total % shards) for s in range(shards)]
    groups = stage_table(rows.filter("g IS NOT NULL").groupBy("g").agg(F.count("*").alias("n"))
                         .filter("n > 1").select(F.col("g").alias("linked")), "groups")
    tagged = rows.join(groups, F.col("g") == F.col("linked"), "left")
    linked = stage_table(tagged.filter("linked IS NOT NULL").drop("linked"), "linked")
    first = (F.col("key") * shards).cast("int").alias("shard")
    state = stage_table(linked.select("g", first).groupBy("g", "shard").agg(F.count("*").alias("c")), "state")
    state = propagate(state, caps)
    # a group's rows in a shard come one after another: what comes before them is a total
    # over the rows (g, shard, c), however many members a group has
    before = running_total(state.withColumn("gkey", uniform(F.hex("g"), seed="group")), ["shard"], "gkey", F.col("c"),
                           "before", 1024, ["g"])
    upto = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    places = (before.withColumn("upto", F.sum("c").over(upto))
              .withColumn("shift", F.col("before") - (F.col("upto") - F.col("c"))).groupBy(F.col("g").alias("pg"))
              .agg(F.array_sort(F.collect_list(F.struct("upto", "shard", "shift"))).alias("places")))
    member = running_total(linked, ["g"], "key", F.lit(1), "member", 256, ties)
    placed = stage_table(
        member.join(places, F.col("g") == F.col("pg"))
        .withColumn("place", F.filter("places", lambda p: p["upto"] > F.col("member"))[0])
        .withColumn("shard", F.col("place.shard"))
        .withColumn("over", F.col("member") + F.col("place.shift") >= _lookup(caps, "shard"))
        .drop("pg", "places", "place", "member"), "placed")
    kept = placed.filter(~F.col("over")).drop("over")
    free = [cap - n for cap, n in zip(caps, _per_shard(kept.withColumn("n1", F.lit(1)), "n1", shards), strict=True)]
    ends = [sum(free[:s + 1]) for s in range(shards)]
    rest = (tagged.filter("linked IS NULL").drop("linked")
            .unionByName(placed.filter("over").drop("over", "shard")).withColumn("every", F.lit(0)))
    number = running_total(rest, ["every"], "key", F.lit(1), "nth", 4096, ties)
    fill = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("nth")))
    level = number.withColumn("shard", fill.cast("int")).drop("nth", "every")
    every = stage_table(kept.unionByName(level), "sharded")
    out = running_total(every, ["shard"], "key", F.lit(1), "slot", 1024, ties)
    drop_stage(linked, groups, state, placed, rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
