"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Links are hyperedges ``(doc, hub)``: documents of one hub are neighbours of each other. Rounds of Spark joins
find for each linked document the shard with most of its hub's members that still has room, and move as many
as the quota of that shard allows. A last pass evens the sizes out exactly, taking unlinked documents first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, numbered, stage

#: Copies of a hub's row, and salts of its members: members of one hub meet in this many tasks.
SALT = 16


def _cases(column: Column, values: dict[int, float]) -> Column:
    """``values`` of the (few) shards as a lookup."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), F.lit(0).cast("double")) if pairs else F.lit(0.0)


def propagate(docs: DataFrame, shards: int, rounds: int = 5, seed: int = 11) -> DataFrame:
    """``docs (row, hub, ...)`` with ``shard``: rows linked by equal ``hub`` drawn together, quotas kept.

    ``row`` is any number of the row; rows with a NULL hub have no link and stay where their hash put them.
    """
    spread = lambda *c: F.pmod(F.xxhash64(*c, F.lit(seed)), F.lit(shards)).cast("int")
    state = stage(docs.withColumn("shard", spread("row")), "shards")
    quota = -(-state.count() // shards)
    sizes = state.groupBy("hub").agg(F.count(F.lit(1)).alias("hub_size")).where("hub is not null and hub_size > 1")
    linked = stage(_salted_join(state, sizes).select("row", "hub", "shard", "hub_size"), "linked")
    first = linked
    # Linked rows claim room first; unlinked ones make way in the last pass.
    for turn in range(rounds):
        # Large hubs are placed before the others, so that they find whole shards.
        asking = linked.where(F.col("hub_size") >= quota / 20) if turn == 0 else linked
        load = {r.shard: r.n for r in asking.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        room = {s: float(max(0, quota - load.get(s, 0))) for s in range(shards)}
        members = asking.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
        # Most members, then room, then an order of its own for each hub so that ties spread out.
        entry = F.struct(F.col("n"), (_cases(F.col("shard"), room) > 0).cast("int").alias("has_room"),
                         F.pmod(F.xxhash64("hub", "shard", F.lit(seed)), F.lit(1 << 20)).alias("tie"),
                         F.col("shard").alias("shard"), _cases(F.col("shard"), room).alias("room"))
        # At most one entry per shard. The first shards that can hold the hub are its places.
        ranked = members.groupBy("hub").agg(F.reverse(F.array_sort(F.collect_list(entry))).alias("list"),
                                            F.sum("n").alias("all"))

        def take(acc: Column, x: Column) -> Column:
            more = F.struct((acc["sum"] + x["n"] + x["room"]).alias("sum"),
                            F.concat(acc["picks"], F.array(F.struct(x["shard"].alias("shard"), x["room"].alias("room"))))
                            .alias("picks"))
            return F.when(acc["sum"] >= F.col("all"), acc).otherwise(more)

        zero = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<struct<shard:int,room:double>>").alias("picks"))
        places = F.aggregate("list", zero, take, lambda acc: acc["picks"])
        wish = ranked.select("hub", F.transform(places, lambda p: p["shard"]).alias("places"), F.transform(
            F.filter(places, lambda p: p["room"] > 0), lambda p: p["shard"]).alias("open"))
        # Rows in none of the places ask for one that has room.
        pick = F.pmod(F.xxhash64("row", F.lit(seed + 100 + turn)), F.size("open")).cast("int") + 1
        stays = F.array_contains("places", F.col("shard")) | (F.size("open") == 0)
        to = F.when(stays, F.col("shard")).otherwise(F.try_element_at("open", pick))
        asked = _salted_join(asking, wish).withColumn("to", to)
        moving = F.col("to") != F.col("shard")
        wanted = {r["to"]: r.n for r in asked.where(moving).groupBy("to").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not wanted and turn == 0:
            continue
        if not wanted:
            break
        # Each shard takes the share of its askers that it has room for, chosen by the row's hash.
        share = {s: min(1.0, room.get(s, 0.0) / n) for s, n in wanted.items()}
        luck = F.pmod(F.xxhash64("row", F.lit(seed + turn)), F.lit(1 << 30)) / float(1 << 30)
        after = asked.select("row", "hub", F.when(moving & (luck < _cases(F.col("to"), share)), F.col("to"))
                             .otherwise(F.col("shard")).alias("shard"), "hub_size")
        waiting = linked.where(F.col("hub_size") < quota / 20).select(*after.columns) if turn == 0 else None
        moved = stage(after if waiting is None else after.unionByName(waiting), "linked")
        if linked is not first:
            discard(linked)
        linked = moved
    extra = [c for c in docs.columns if c not in ("row", "hub")]
    told = linked.select("row", F.col("shard").alias("_to"), "hub_size")
    return (state.join(told, "row", "left")
            .select("row", "hub", F.coalesce("_to", "shard").alias("shard"), F.coalesce("hub_size", F.lit(0)).alias("hub_size"),
                    *extra))


def _salted_join(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Inner join on ``hub``; a hub with a third of all rows meets them in :data:`SALT` tasks."""
    salt = F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int")
    copies = hubs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("_salt", salt).join(copies, ["hub", "_salt"]).drop("_salt")


def even_out(labelled: DataFrame, shards: int) -> DataFrame:
    """Row counts at most one apart: adds ``slot``, gapless from 0 in each shard, and moves what is over quota.

    In each shard the rows of large hubs come first, hub by hub, so unlinked ones leave first.
    """
    order = [F.col("shard"), F.col("hub_size").desc(), F.col("hub"), F.col("row")]
    placed = stage(numbered(labelled, order, "_rank"), "placed")
    count = {r.shard: r.n for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(count.values())
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}
    start, at = {}, 0
    for s in range(shards):
        start[s] = at
        at += count.get(s, 0)
    slot = (F.col("_rank") - _cases(F.col("shard"), {s: float(v) for s, v in start.items()}).cast("bigint"))
    limit = _cases(F.col("shard"), {s: float(v) for s, v in quota.items()}).cast("bigint")
    slotted = placed.withColumn("slot", slot)
    stay = slotted.where(F.col("slot") < limit).drop("_rank")
    over = numbered(slotted.where(F.col("slot") >= limit), [F.col("_rank")], "_over")
    # The n-th row over quota takes the n-th gap: gaps lie shard after shard.
    gaps, at = [], 0
    for s in range(shards):
        if (room := quota[s] - count.get(s, 0)) > 0:
            gaps.append((at, s, quota[s] - room))
            at += room
    if not gaps:
        return stay
    table = F.array(*[F.struct(F.lit(a).cast("bigint").alias("at"), F.lit(s).alias("shard"),
                               F.lit(b).cast("bigint").alias("first")) for a, s, b in gaps])
    gap = F.element_at(F.filter(table, lambda g: g["at"] <= F.col("_over")), -1)
    filled = (over.withColumn("_gap", gap).withColumn("shard", F.col("_gap.shard"))
              .withColumn("slot", F.col("_gap.first") + F.col("_over") - F.col("_gap.at")))
    return stay.unionByName(filled.select(*stay.columns))


def assign(docs: DataFrame, shards: int = 40, rounds: int = 5) -> DataFrame:
    """Every document's shard and slot: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Neighbours are documents with equal texts. Law ``rows``: shard sizes are at most one row apart, so a group
    of copies larger than a shard fills whole shards and is cut only there. A NULL text has size 16, checksum 0
    and no neighbour; an empty text is a text. Repeated rows and doc_ids are rows of their own, other columns
    are ignored, an empty table gives an empty one.
    """
    text = F.col("text").cast("string")
    bare = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.when(text.isNotNull(), F.md5(F.encode(text, "UTF-8"))).alias("hub"))
    rows = numbered(bare, [F.col("doc_id"), F.col("text_crc32"), F.col("hub")], "row")
    done = even_out(propagate(rows, shards, rounds), shards)
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                       F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
