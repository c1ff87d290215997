"""Mixing sources to target weights.

The documents of each source are laid end to end and cut into blocks of ``block_words`` words. The
mix is a sequence of slots, ``slots_per_shard`` to a shard, and every slot takes one block.

The draw gives each shard its number of slots for each source: a multinomial draw with the targets
as weights, under the condition that the counts of all shards add up to the draws of each source
(which is a multivariate hypergeometric distribution). It is made by dealing the run's tickets, so
many for each source, to the shards by a pseudorandom permutation and counting them there. The
counts are written, and everything else follows from them: a source's slots are numbered by prefix
sums over the shards, the numbers walk through a pseudorandom permutation of the source's block
indexes, a new one for every pass, so that no block is used more than once oftener than another, and
slots and blocks meet in a join by source and index. No random numbers are drawn at run time:
permutations are keyed by hashes, so reruns agree.

Permutations are swap-or-not networks: in each round an index either stays or trades places with
its mirror image, as one hashed bit of the pair says. They need no state and no sort, so any task
can map any index.

Everything is DataFrame functions. A source of any size is spread: word offsets come from sums over
hash buckets and then inside a bucket, prefix sums over shards and tickets are made in two levels of
about the square root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.frames import BREAK_CLASS, pick
from reviewmill.sources.workspace import materialise

BLOCK_WORDS = 64
SLOTS_PER_SHARD = 4096
SHARE, MOST = 1.5, 2.0
WEIGHTS = (3, 1, 2)
ROUNDS = 16
SEED = 20


def permuted(index: Column, size: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of ``0 .. size - 1`` chosen by ``key``, applied to an index."""

    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        bit = F.xxhash64(*key, r, F.greatest(x, mirror)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), step)


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, row_hash, source, size``; a null text has size 0."""
    rows = pick(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")
    )
    return rows.select(
        "doc_id",
        F.xxhash64("doc_id", "source", "text").alias("row_hash"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(f"[^{BREAK_CLASS}]+")), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(
    sized: DataFrame, *, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row for each source: its rank by code point (null last), size, target and numbers of blocks and draws.

    The targets are the level at which ``min(most * size, weight * level)`` adds up to ``share`` of
    all words; that is where resharing the excess over ``most`` ends. With the sources in order of
    ``most * size / weight`` the level is the highest of the levels that follow from filling up the
    sources before each.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    ranked = totals.select(
        "*",
        (F.row_number().over(ordered) - 1).alias("rank"),
        F.sum("documents").over(everything).alias("all_documents"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("all_words"),
    )
    ranked = ranked.withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank"), F.lit(len(weights))))
    ).withColumn("cap", F.col("source_size") * F.lit(most))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    full = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    levelled = ranked.withColumn("level", (F.col("all_words") - full) / open_weight)
    target = F.least(F.col("cap"), F.col("weight") * F.max("level").over(everything))
    blocks = F.ceil(F.col("source_size") / F.lit(float(block_words)))
    with_draws = (
        levelled.withColumn("target", target)
        .withColumn("blocks", blocks)
        .withColumn("draws", F.coalesce(F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size"))), F.lit(0)).cast("long"))
    )
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return with_draws.select(
        "source", "rank", "source_size", "target", "blocks", "draws",
        F.coalesce(F.sum("draws").over(before), F.lit(0)).alias("first_ticket"),
        F.sum("draws").over(everything).alias("slots"),
        F.ceil(F.sqrt("all_documents")).cast("long").alias("buckets"),
    )


def placed_documents(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the rank of their source and the offset of their first word in its stream."""
    found = sources.select(F.col("source").alias("s"), "rank", "source_size", "target", "buckets")
    rows = sized.join(found, sized["source"].eqNullSafe(found["s"])).drop("s")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row_hash"), F.col("buckets")))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    below = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("rank", "bucket", F.coalesce(F.sum("words").over(below), F.lit(0)).alias("start"))
    inside = Window.partitionBy("rank", "bucket").orderBy("doc_id", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("local"))
    return local.join(starts, ["rank", "bucket"]).select(
        "doc_id", "row_hash", "source", "size", "rank", "source_size", "target", (F.col("start") + F.col("local")).alias("offset")
    )


def block_pieces(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The part of a document in each block: ``rank, block, offset, start, words``.

    ``rank`` and ``offset`` name the document; ``start`` is the part's first word in it.
    """
    width, size, offset = F.lit(block_words), F.col("size"), F.col("offset")
    last = F.floor((offset + size - 1) / width)
    rows = placed.where("size > 0").select("rank", "offset", "size", F.explode(F.sequence(F.floor(offset / width), last)).alias("block"))
    begin = F.greatest(offset, F.col("block") * width)
    end = F.least(offset + size, (F.col("block") + 1) * width)
    return rows.select("rank", "block", "offset", (begin - offset).alias("start"), (end - begin).alias("words"))


def shard_counts(sources: DataFrame, *, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """``shard, rank, blocks, shards, drawn``: the slots of each source in each shard that has any."""
    side = F.ceil(F.sqrt("draws"))
    chunk = sources.where("draws > 0").withColumn("side", side.cast("long"))
    chunk = chunk.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("draws") - 1) / F.col("side")))).alias("chunk"))
    first = F.col("chunk") * F.col("side")
    last = F.least(first + F.col("side"), F.col("draws")) - 1
    # By number, since rows that are a few bytes here become many: adaptive execution would put them into one task.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = chunk.repartition(tasks, "rank", "chunk").select(
        "rank", "blocks", "first_ticket", "slots", F.explode(F.sequence(first, last)).alias("draw")
    )
    ticket = F.col("first_ticket") + F.col("draw")
    shard = F.floor(permuted(ticket, F.col("slots"), F.lit(seed)) / F.lit(slots_per_shard))
    shards = F.ceil(F.col("slots") / F.lit(float(slots_per_shard)))
    return draws.groupBy(shard.alias("shard"), "rank", "blocks", shards.alias("shards")).agg(F.count(F.lit(1)).alias("drawn"))


def mix_slots(counts: DataFrame, *, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """``shard, slot, rank, pass, block``: what every slot of the mix takes, from the counts of the shards.

    A shard's slots are in pseudorandom order of sources.
    """
    rows = counts.withColumn("stretch", F.floor(F.col("shard") / F.ceil(F.sqrt("shards"))))
    sums = rows.groupBy("rank", "stretch").agg(F.sum("drawn").alias("total"))

    def before(*keys: str, order: str) -> Window:
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    starts = sums.select("rank", "stretch", F.coalesce(F.sum("total").over(before("rank", order="stretch")), F.lit(0)).alias("start"))
    seated = rows.select(
        "*",
        F.coalesce(F.sum("drawn").over(before("rank", "stretch", order="shard")), F.lit(0)).alias("local"),
        F.coalesce(F.sum("drawn").over(before("shard", order="rank")), F.lit(0)).alias("seat"),
        F.sum("drawn").over(Window.partitionBy("shard")).alias("seats"),
    )
    numbered = seated.join(starts, ["rank", "stretch"]).withColumn("first", F.col("start") + F.col("local"))
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = numbered.repartition(tasks, "rank", "shard").select(
        "shard", "rank", "blocks", "first", "seat", "seats", F.explode(F.sequence(F.lit(0).cast("long"), F.col("drawn") - 1)).alias("k")
    )
    draw = F.col("first") + F.col("k")
    turn = F.floor(draw / F.col("blocks"))
    place = permuted(F.col("seat") + F.col("k"), F.col("seats"), F.lit(seed), F.col("shard"))
    block = permuted(F.pmod(draw, F.col("blocks")), F.col("blocks"), F.lit(seed), F.col("rank"), turn)
    return slots.select(
        "shard", (F.col("shard") * F.lit(slots_per_shard) + place).alias("slot"), "rank", turn.alias("pass"), block.alias("block")
    )


class Mix:
    """The tables of one mix; the small ones are written once.

    Null and empty texts have size 0 and are never taken. A null source is a source of its own,
    last in order. Rows with equal id and text are documents of their own at neighbouring offsets.
    Other columns are ignored. An empty table gives an empty mix.
    """

    # What is generated from a small table looks small to the optimizer, which would broadcast it;
    # the joins by block and by offset are therefore asked to shuffle.

    def __init__(self, docs: DataFrame, *, block_words: int = BLOCK_WORDS, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED):
        self.docs = docs
        sized = materialise(sized_documents(docs), "sizes")
        self.sources = materialise(source_targets(sized, block_words=block_words), "mix-sources")
        self.placed = materialise(placed_documents(sized, self.sources), "mix-placed")
        self.shards = materialise(shard_counts(self.sources, slots_per_shard=slots_per_shard, seed=seed), "mix-shards")
        self.slots = mix_slots(self.shards, slots_per_shard=slots_per_shard, seed=seed)
        self.pieces = block_pieces(self.placed, block_words)

    def taken(self) -> DataFrame:
        """Documents with the number of words the mix takes from them, repeats counted, and the first and
        last shard that has any of them (null if none)."""
        times = self.slots.groupBy("rank", "block").agg(
            F.count(F.lit(1)).alias("times"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard")
        )
        words = self.pieces.join(times.hint("merge"), ["rank", "block"]).groupBy("rank", "offset").agg(
            F.sum(F.col("words") * F.col("times")).alias("taken"),
            F.min("first_shard").alias("first_shard"),
            F.max("last_shard").alias("last_shard"),
        )
        # Documents without words share an offset with the next one and take nothing.
        rows = self.placed.join(words.hint("merge"), ["rank", "offset"], "left")
        taken, first, last = (F.when(F.col("size") > 0, F.col(c)) for c in ("taken", "first_shard", "last_shard"))
        return rows.select(
            "doc_id", "source", "size", "source_size", "target",
            F.coalesce(taken, F.lit(0)).cast("long").alias("taken"), first.alias("first_shard"), last.alias("last_shard"),
        )

    def blocks(self) -> DataFrame:
        """The mix itself: ``shard, slot, rank, pass, block, parts`` with the document parts of each
        block in order; a block has at most ``block_words`` of them."""
        part = F.struct("offset", "start", "words")
        built = self.pieces.groupBy("rank", "block").agg(F.sort_array(F.collect_list(part)).alias("parts"))
        return self.slots.hint("merge").join(built, ["rank", "block"])

    def texts(self) -> DataFrame:
        """What each pass takes of each document: ``doc_id, text, lang, source, turn, pass``.

        Neighbouring parts stay as they are in the text, white space included.
        """
        part = F.struct("start", "words")
        used = self.slots.select("rank", "block", "pass").hint("merge").join(self.pieces, ["rank", "block"])
        used = used.groupBy("rank", "offset", "pass").agg(F.sort_array(F.collect_list(part)).alias("parts"))
        found = self.placed.where("size > 0").select("doc_id", "row_hash", "rank", "offset").join(used.hint("merge"), ["rank", "offset"])
        # Copies of a row are told apart by their turn among the rows of their key.
        turn = Window.partitionBy("doc_id", "row_hash")
        found = found.select("*", F.dense_rank().over(turn.orderBy("offset")).alias("turn"))
        by_row = found.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("turn", "pass", "parts")).alias("uses"))
        rows = pick(self.docs, "doc_id", "text", "lang", "source").select(
            F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("text", "lang", "source")]
        )
        rows = rows.select("*", F.xxhash64("doc_id", "source", "text").alias("row_hash")).dropDuplicates(["doc_id", "row_hash"])
        keyed = by_row.withColumnsRenamed({"doc_id": "d", "row_hash": "h"})
        joined = rows.join(keyed.hint("merge"), (rows["row_hash"] == keyed["h"]) & rows["doc_id"].eqNullSafe(keyed["d"]))
        # Every word with the white space after it; joining slices gives the text back.
        tokens = F.split(F.ltrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), f"(?<=[{BREAK_CLASS}])(?=[^{BREAK_CLASS}])")
        cut = joined.withColumn("tokens", tokens).select("doc_id", "lang", "source", "tokens", F.explode("uses").alias("use"))
        slices = F.transform("use.parts", lambda p: F.slice("tokens", (p.start + 1).cast("int"), p.words.cast("int")))
        return cut.select("doc_id", F.array_join(F.flatten(slices), "").alias("text"), "lang", "source", "use.turn", "use.pass")
