"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tourledger.llm.common import numbered, pick

BLOCK_TOKENS = 16
ROWS_PER_SHARD = 20_000
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def apportion(parties: DataFrame, within: list[str], key: str, weight: str, cap: str, seats: str) -> DataFrame:
    """Seats for each party by highest quotients weight / (2 k - 1), k up to ``cap``.

    ``parties`` has a row for each ``within`` group and ``key``; ``seats`` is the group's
    number. Adds ``quota``. Seats that every divisor near the group's mean gives a party are
    granted at once; only the few quotients around it, in all a small multiple of the number
    of parties, are ranked. Equal quotients go to the smaller key, null last. A group's caps
    may leave seats over; weights of 0 take none.
    """
    group = Window.partitionBy(*within)
    share = F.when(F.col("_total") > 0, F.col(weight) * F.col(seats) / F.col("_total")).otherwise(0.0)
    slack = F.col("_share") * 1.5 * F.col("_n") / F.greatest(F.col(seats), F.lit(1)) + 2
    bounded = (
        parties.withColumn("_total", F.sum(F.col(weight).cast("double")).over(group))
        .withColumn("_n", F.count(F.lit(1)).over(group))
        .withColumn("_share", share)
        .withColumn("_low", F.least(F.col(cap), F.greatest(F.lit(0), F.floor(F.col("_share") - slack))).cast("long"))
        .withColumn("_high", F.least(F.col(cap), F.ceil(F.col("_share") + slack)).cast("long"))
        .withColumn("_high", F.when(F.col(weight) > 0, F.col("_high")).otherwise(F.col("_low")))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(group))
    )
    quotients = bounded.where("_high > _low").withColumn("_k", F.explode(F.expr("sequence(_low + 1, _high)")))
    order = Window.partitionBy(*within).orderBy((F.col(weight) / (2 * F.col("_k") - 1)).desc(), F.col(key).asc_nulls_last(), "_k")
    won = quotients.withColumn("_rank", F.row_number().over(order)).where("_rank <= _left")
    names = [*within, key]
    won = won.groupBy(*names).agg(F.count(F.lit(1)).alias("_won"))
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"b.{name}").eqNullSafe(F.col(f"w.{name}"))
    kept = [F.col(f"b.{c}") for c in parties.columns]
    return bounded.alias("b").join(won.alias("w"), same, "left").select(*kept, (F.col("_low") + F.coalesce("_won", F.lit(0))).alias("quota"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Target tokens of each source: weights 1, 2, 3 repeating in code-point order, null last,
    share all tokens; a target stops at three times its source and the excess goes to the
    others by weight. With sources ordered by cap / weight those that stop come first. Setting
    them aside one by one raises the level per weight of the rest until the first that does
    not stop, and lowers it from there on, so the level sought is the greatest."""
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighted = sizes.withColumn("_weight", F.element_at(weights, ((place - 1) % len(WEIGHTS) + 1).cast("int")).cast("double"))
    cap = F.col("source_size") * float(MAX_REPEATS)
    order = Window.orderBy(cap / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    on = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("_weight").over(on)
    found = weighted.withColumn("_total", total).withColumn("_level", level)
    level = F.max("_level").over(Window.partitionBy())
    return found.withColumn("target", F.least(cap, F.col("_weight") * level)).drop("_weight", "_level")


def mix_sources(docs: DataFrame, seed: int = 1, block_tokens: int = BLOCK_TOKENS, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """How many tokens a mix of the documents' sources takes from each document.

    Rows: doc_id, size, source_size, target, taken. Sources are dealt over shards by a seeded
    hash. Blocks of ``block_tokens`` go to sources, then to each source's shards, by
    ``apportion``. A shard's documents, in seeded order, are a ring of tokens; its quota goes
    round the ring in whole turns and then takes a run of blocks from a seeded place, so that a
    document gives between zero and three times its size.

    A null text has size 0, a null source is a source of its own, a null id an id of its own.
    Rows equal in id, source and size are one entry until the end and give a row each.
    An empty table gives no rows.
    """
    rows = pick(docs, "doc_id", "text", "source")
    rows = rows.select("doc_id", "source", token_count(F.col("text")).alias("size"))
    entries = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    many = entries.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_per_shard)).alias("shards"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    number = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    entries = entries.withColumn("order", digest).crossJoin(F.broadcast(many))
    entries = entries.select("doc_id", "source", "size", "copies", "order", (number % F.col("shards")).alias("shard"))

    shards = entries.groupBy("source", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("shard_size"))
    sources = source_targets(shards.groupBy("source").agg(F.sum("shard_size").alias("source_size")))
    most = lambda size: F.ceil(F.col(size) * MAX_REPEATS / block_tokens)
    sources = sources.withColumn("cap", most("source_size")).withColumn("seats", F.floor(F.col("_total") / block_tokens)).withColumn("all", F.lit(0))
    sources = apportion(sources, ["all"], "source", "target", "cap", "seats")
    sources = sources.select("source", "source_size", "target", F.col("quota").alias("seats"))

    joined = shards.alias("s").join(sources.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    dealt = joined.select("s.source", "shard", "shard_size", "source_size", "target", "seats").withColumn("cap", most("shard_size"))
    dealt = apportion(dealt, ["source"], "shard", "shard_size", "cap", "seats")
    quota = F.least(F.col("quota") * block_tokens, F.col("shard_size") * MAX_REPEATS)
    seeded = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"start {seed}"), F.coalesce("source", F.lit("")), F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long")
    blocks = F.greatest(F.lit(1), F.floor(F.col("shard_size") / block_tokens))
    dealt = dealt.select(
        "source", "shard", "shard_size", "source_size", "target",
        F.floor(quota / F.greatest("shard_size", F.lit(1))).alias("turns"),
        (quota % F.greatest("shard_size", F.lit(1))).alias("run"),
        (seeded % blocks * block_tokens).alias("start"),
    )

    ring = Window.partitionBy("source", "shard").orderBy("order", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = entries.withColumn("at", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(ring), F.lit(0)))
    same = F.col("p.source").eqNullSafe(F.col("d.source")) & (F.col("p.shard") == F.col("d.shard"))
    placed = placed.alias("p").join(dealt.alias("d"), same).select("p.doc_id", "p.source", "size", "copies", "at", "shard_size", "source_size", "target", "turns", "run", "start")
    placed = placed.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).withColumn("at", F.col("at") + (F.col("copy") - 1) * F.col("size"))
    overlap = lambda low, high: F.greatest(F.lit(0), F.least(F.col("at") + F.col("size"), high) - F.greatest(F.col("at"), low))
    first = overlap(F.col("start"), F.least(F.col("start") + F.col("run"), F.col("shard_size")))
    wrapped = overlap(F.lit(0), F.greatest(F.lit(0), F.col("start") + F.col("run") - F.col("shard_size")))
    taken = (F.col("turns") * F.col("size") + first + wrapped).cast("long")
    return placed.select("doc_id", "source", "copy", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The documents, with their own columns, that the mix takes tokens from, and size,
    source_size, target and taken of each. Of rows equal in id, source and size, the first
    in order of their texts get the first shares."""
    plain, at = numbered(docs)
    keys = [F.col(at["doc_id"]), F.col(at["source"]), token_count(F.col(at["text"]))]
    order = Window.partitionBy("k0", "k1", "k2").orderBy(at["text"])
    rows = plain.withColumns({f"k{i}": key for i, key in enumerate(keys)}).withColumn("copy", F.row_number().over(order).cast("long"))
    taken = mix_sources(docs, seed).where("taken > 0")
    same = F.col("k0").eqNullSafe(F.col("doc_id")) & F.col("k1").eqNullSafe(F.col("source")) & (F.col("k2") == F.col("size")) & (F.col("r.copy") == F.col("t.copy"))
    joined = rows.alias("r").join(taken.alias("t"), same)
    figures = ["size", "source_size", "target", "taken"]
    return joined.select(*plain.columns, *figures).toDF(*docs.columns, *figures)
