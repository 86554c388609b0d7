"""Mix sources to target weights: exact block quotas split among output shards.

A source is cut into blocks by a hash of its rows, as many for every source as it can fill, never more
than BLOCKS. Its blocks in random order, gone through again and again, are its supply; its quota is the
part of that supply that holds its target number of words, the last block in part. The block draws of
all sources are put in one random order, and that order is halved again and again down to the shards.
Given what a node holds of each source, what its left half gets of each is then multivariate
hypergeometric, and quotas are used up exactly. Shards hold disjoint draws and are shuffled in themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, landed, ordinals, whole_text

#: Blocks per source at most: what one task orders and sums at a time.
BLOCKS = 1024
WEIGHTS = (3.0, 1.0, 2.0)


def n_words(text: Column) -> Column:
    """Words of a text: pieces between white space that are not empty."""
    pieces = F.split(text, SPACES)
    empty = (F.element_at(pieces, 1) == "").cast("int") + ((F.element_at(pieces, -1) == "") & (F.size(pieces) > 1)).cast("int")
    return (F.size(pieces) - empty).cast("long")


def source_targets(sizes: DataFrame, *, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, weight, target for a table of source and source_size (a row per source).

    Sources in code-point order, NULL last, weigh 3, 1, 2 and so on. ``share`` of all words is dealt by
    weight; a target stops at ``most`` times its source, and what is over goes to the others by weight
    until no target is above. Every pass is one sum over the sources; it ends when a pass stops nobody.
    """
    code_points = F.encode(F.coalesce("source", F.lit("")), "UTF-8")
    ranked = ordinals(sizes, F.col("source").isNull(), code_points, name="_rank")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = landed(ranked.withColumn("weight", weight).drop("_rank"), "weights")
    cap = F.col("source_size") * F.lit(most)
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped_before = None, -1
    while True:
        # Sources only move from open to stopped, for the level rises.
        stopped = F.lit(False) if level is None else F.col("weight") * level >= cap
        n, held, open_weight = ranked.agg(
            F.count_if(stopped), F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("weight")))
        ).first()
        if n == stopped_before or not open_weight:
            break
        level, stopped_before = max(0.0, total - (held or 0.0)) / open_weight, n
    target = F.least(cap, F.col("weight") * F.lit(level or 0.0))
    return ranked.withColumn("target", target.cast("double"))


def block_draws(blocks: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """source, block, turn, part: which part (0 to 1) of a block the quota takes in which turn through it."""
    key = ["source"]
    order = Window.partitionBy(*key).orderBy(F.xxhash64(F.lit(seed), "source", "block"), "block")
    # At most BLOCKS rows of a source.
    before = F.sum("block_size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.where("block_size > 0").withColumn("before", F.coalesce(before, F.lit(0)))
    wanted = targets.select(F.col("source").alias("_s"), "source_size", "target")
    placed = placed.join(wanted, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    turns = F.greatest(F.ceil(F.col("target") / F.col("source_size")).cast("int"), F.lit(1))
    drawn = placed.withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1)))
    left = F.col("target") - F.col("turn") * F.col("source_size") - F.col("before")
    part = F.least(F.lit(1.0), left / F.col("block_size"))
    return drawn.withColumn("part", part).where("part > 0").select("source", "block", "turn", "part")


def assign_shards(draws: DataFrame, shards: int, seed: int) -> DataFrame:
    """``draws`` with ``shard``: a random order of all draws, cut into ranges of equal length (to one)."""
    ordered = ordinals(draws, F.xxhash64(F.lit(seed + 1), "source", "block", "turn"), "source", "block", "turn", name="place")
    total = ordered.agg(F.count(F.lit(1))).first()[0]
    return ordered.withColumn("shard", F.floor(F.col("place") * shards / F.lit(max(total, 1))).cast("int"))


def split_tree(assigned: DataFrame, shards: int) -> DataFrame:
    """depth, node, source, n: what every node of the splitting tree holds of each source."""
    leaves = assigned.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("n"))
    depth = max(shards - 1, 0).bit_length()
    nodes = F.transform(
        F.sequence(F.lit(0), F.lit(depth)),
        lambda d: F.struct(d.alias("depth"), F.floor(F.col("shard") / F.pow(F.lit(2), depth - d)).cast("int").alias("node")),
    )
    levels = leaves.withColumn("_at", F.explode(nodes)).select("_at.*", "source", "n")
    return levels.groupBy("depth", "node", "source").agg(F.sum("n").alias("n"))


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    shards: int = 16,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of them, and the shards.

    First: a row per row of ``docs``: doc_id, size, source_size, target, taken, the columns ``keep``, and
    ``draws`` (array of shard, turn and words). Second: the draws with shard (see :func:`assign_shards`).
    ``taken`` counts words with repeats and is at most twice the size (``most``). A NULL text has size 0
    and is not taken; documents without a source are a source of their own; a NULL id is an id like any
    other; rows with equal id and source go to one block and are taken alike; an empty table gives an
    empty one. No row is collected and no group is ordered but the blocks of a source.
    """
    source = F.col(f"`{source_col}`").alias("source")
    extra = F.struct(F.lit(0).alias("_none"), *[F.col(f"`{c}`") for c in keep]).alias("row")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), source, n_words(whole_text(text_col)).alias("size"), extra)
    block = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(BLOCKS)).cast("int")
    sized = landed(rows.select("doc_id", "source", "size", block.alias("block")), "sizes")
    blocks = landed(sized.groupBy("source", "block").agg(F.sum("size").alias("block_size")), "blocks")
    targets = landed(source_targets(blocks.groupBy("source").agg(F.sum("block_size").alias("source_size"))), "targets")
    draws = landed(assign_shards(block_draws(blocks, targets, seed), shards, seed), "draws")

    drawn = draws.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "shard", "part"))).alias("_draws"))
    wanted = targets.select(F.col("source").alias("_s"), "source_size", "target")
    plan = blocks.drop("block_size").join(wanted, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    drawn = drawn.withColumnsRenamed({"source": "_s", "block": "_b"})
    plan = plan.join(drawn, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")), "left")
    plan = landed(plan.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "source_size", "target", "_draws"), "plan")

    def words(draw: Column) -> Column:
        return F.struct(
            draw["shard"].alias("shard"), draw["turn"].alias("turn"), F.floor(draw["part"] * F.col("size")).cast("long").alias("words")
        )

    joined = rows.withColumn("block", block).join(
        plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    )
    dealt = F.filter(F.transform(F.coalesce("_draws", F.array().cast(plan.schema["_draws"].dataType)), words), lambda d: d["words"] > 0)
    out = joined.withColumn("draws", dealt)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    columns = ["doc_id", "size", "source_size", "target", taken.alias("taken"), *[f"row.`{c}`" for c in keep], "draws"]
    return out.select(*columns), draws


def write_shards(mixed: DataFrame, path: str, *, seed: int = 17) -> None:
    """One folder per shard; the rows of a shard in a random order of its own, a row per draw."""
    rows = mixed.withColumn("_draw", F.explode("draws")).select(*[c for c in mixed.columns if c != "draws"], "_draw.*")
    place = F.xxhash64(F.lit(seed + 2), "shard", "doc_id", "turn")
    spread = rows.withColumn("_place", place).repartition("shard", F.pmod("_place", F.lit(64)))
    spread.sortWithinPartitions("shard", "_place").drop("_place").write.partitionBy("shard").parquet(path)


def mix_through_shards(docs: DataFrame, path: str, *, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The first table of :func:`mix_sources` without ``draws``, its ``taken`` summed over the shards as they are read
    back from ``path``, where :func:`write_shards` has put them.

    Rows of equal id, source and size are dealt alike, so a draw of theirs counts once for each.
    """
    keep = tuple(dict.fromkeys((source_col, *options.pop("keep", ()))))
    mixed = landed(mix_sources(docs, id_col=id_col, source_col=source_col, keep=keep, **options)[0], "mixed")
    name = ["doc_id", "source", "size"]
    drawn = mixed.select("doc_id", F.col(f"`{source_col}`").alias("source"), "size", "draws")
    write_shards(drawn, path)
    back = docs.sparkSession.read.schema(drawn.drop("draws").schema.add("turn", "integer").add("words", "long").add("shard", "integer")).parquet(path)
    draws = back.groupBy(*name, "shard", "turn").agg(F.max("words").alias("words"))
    sums = draws.groupBy(*name).agg(F.sum("words").alias("_words")).withColumnsRenamed({n: f"_{n}" for n in name})
    own = {"doc_id": F.col("doc_id"), "source": F.col(f"`{source_col}`"), "size": F.col("size")}
    same = own["doc_id"].eqNullSafe(F.col("_doc_id")) & own["source"].eqNullSafe(F.col("_source")) & (own["size"] == F.col("_size"))
    out = mixed.drop("draws", "taken").join(sums, same, "left").withColumn("taken", F.coalesce("_words", F.lit(0)).cast("long"))
    return out.drop("_doc_id", "_source", "_size", "_words")
