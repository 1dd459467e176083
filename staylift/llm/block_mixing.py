"""Sources mixed to target weights: fixed-length blocks, multinomial draws per output shard, permuted block indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.llm.shared import SPACES, checkpointed, running_total, trimmed, word_count
from staylift.sources.workspace import settle

#: Cells by which a drawn number finds its source; a lookup reads the sources of one cell.
CELLS = 4096
ROUNDS = 20
SLOTS_PER_TASK = 1 << 22


def targets(sized: DataFrame, weights: Sequence[int], percent: int, cap: int) -> DataFrame:
    """A row per source: source, rank (by code point, null last), source_size, weight, target.

    ``percent`` of all words is shared by weight; a target stops at ``cap`` times its source's size, and the excess is
    shared by weight among the others until none is above. In the order of size per weight the stopped sources come
    first, so that one running sum finds them.
    """
    sources = checkpointed(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = running_total(sources.withColumn("unnamed", F.col("source").isNull()), [], ["unnamed", "source"], F.lit(1), "rank")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    ranked = checkpointed(ranked.withColumn("per_weight", F.col("source_size") / F.col("weight")).drop("unnamed"))
    total, all_weights = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    ordered = running_total(ranked, [], ["per_weight", "rank"], F.col("source_size"), "size_before")
    ordered = checkpointed(running_total(ordered, [], ["per_weight", "rank"], F.col("weight"), "weight_before"))
    wide = "decimal(38,0)"
    room = F.lit(percent * total).cast(wide) - F.col("size_before").cast(wide) * (100 * cap)
    stopped = F.col("source_size").cast(wide) * (100 * cap) * (F.lit(all_weights) - F.col("weight_before")) <= room * F.col("weight")
    ordered = ordered.withColumn("stopped", stopped)
    held, held_weight = ordered.filter("stopped").agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = (percent * total - 100 * cap * held) / (100 * max(1, all_weights - held_weight))
    target = F.when(F.col("stopped"), F.col("source_size") * float(cap)).otherwise(F.col("weight") * F.lit(float(level)))
    return ordered.select("source", "rank", "source_size", "weight", target.alias("target"))


def _hash(seed: int, *parts: Column | str | int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.lit(p) if isinstance(p, int) else p for p in parts])


def permuted(rows: DataFrame, index: str, count: str, keys: list[str], seed: int) -> DataFrame:
    """Replace ``index`` in [0, count) by its place in a pseudorandom permutation of that range, one per key.

    A swap-or-not shuffle: each round pairs x with k - x modulo the count and swaps by a hash of the larger of the two,
    which permutes ranges of any length exactly and needs no table and no shuffle.
    """
    n = F.col(count)

    def swapped(x: Column, turn: Column) -> Column:
        other = F.pmod(F.pmod(_hash(seed, turn, *keys), n) - x, n)
        return F.when(_hash(seed, turn + ROUNDS, *keys, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return rows.withColumn(index, F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.col(index), swapped))


def draws(quotas: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """Block draws of all output shards: shard, rank, epoch, block. ``quotas``: rank, blocks, quota.

    Every slot of a shard draws its source with probability quota / all quotas, which makes the source counts of a shard
    multinomial. What a source is drawn beyond its quota, shard by shard, goes to the sources drawn too seldom, so
    that the totals meet the quotas. A source's draws, numbered through the shards, walk through a permutation of its
    blocks, another one in each epoch.
    """
    spark = quotas.sparkSession
    pool = checkpointed(running_total(quotas.filter("quota > 0"), [], ["rank"], F.col("quota"), "low"))
    slots = pool.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    width = max(1, -(-slots // CELLS))
    last = F.floor((F.col("low") + F.col("quota") - 1) / width)
    cells = pool.select("rank", "low", (F.col("low") + F.col("quota")).alias("high"), F.explode(F.sequence(F.floor(F.col("low") / width), last)).alias("cell"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-slots // SLOTS_PER_TASK))
    drawn = spark.range(0, slots, 1, tasks).select(
        F.floor(F.col("id") / shard_blocks).cast("long").alias("shard"), F.pmod(_hash(seed, "id"), F.lit(max(1, slots))).alias("number")
    ).withColumn("cell", F.floor(F.col("number") / width))
    found = drawn.join(cells, "cell").filter("low <= number AND number < high")
    counts = checkpointed(found.groupBy("shard", "rank").agg(F.count("*").alias("drawn")))
    placed = checkpointed(running_total(counts, ["rank"], ["shard"], F.col("drawn"), "start").join(pool.select("rank", "blocks", "quota"), "rank"))
    fits = F.greatest(F.lit(0), F.least(F.col("drawn"), F.col("quota") - F.col("start")))
    # A row stands for thousands of slots here, so that its size says nothing of the work: deal the rows out first.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = placed.select("shard", "rank", "blocks", "start", fits.alias("n")).filter("n > 0").repartition(parts, "shard", "rank")
    kept = kept.select("shard", "rank", "blocks", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("turn"))

    spare = placed.select("shard", "rank", (F.col("drawn") - fits).alias("n")).filter("n > 0")
    spare = spare.select("shard", "rank", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    spare = running_total(spare, [], ["shard", "rank", "copy"], F.lit(1), "number").select("shard", "number")
    totals = counts.groupBy("rank").agg(F.sum("drawn").alias("drawn"))
    short = pool.join(totals, "rank", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).filter("drawn < quota")
    short = short.select("rank", "blocks", F.explode(F.sequence(F.col("drawn"), F.col("quota") - 1)).alias("turn"))
    short = running_total(short, [], ["rank", "turn"], F.lit(1), "number")
    moved = spare.join(short, "number").select("shard", "rank", "blocks", "turn")

    turns = kept.unionByName(moved)
    turns = turns.select("shard", "rank", "blocks", F.floor(F.col("turn") / F.col("blocks")).alias("epoch"), (F.col("turn") % F.col("blocks")).alias("block"))
    return permuted(turns, "block", "blocks", ["rank", "epoch"], seed).drop("blocks")


def mixed(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, cap: int = 2, block_words: int = 64,
    shard_blocks: int = 4096, seed: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """Documents and the drawn pieces of them.

    Documents: row (names a row of ``docs``), doc_id, text_hash, size (words), source, source_size, target.
    Pieces: shard, epoch, row, first (word of the document), words, lead (words of its first block that come before the
    document); one per drawn block and document in it.

    The words of a source, its documents in the order of doc_id (null first) and text, are cut into blocks of ``block_words``;
    the last one may be shorter. A source's quota are the blocks whose words come nearest its target, each block at
    most ``cap`` times. ``draws`` picks them, and blocks are joined by index. A null source is a source of its own; a
    null or empty text has no words and no pieces; rows that repeat are documents of their own. Results depend on the
    rows and ``seed`` alone. Columns besides doc_id, text and source are not read. An empty table gives no rows.
    """
    return _mixed(docs.withColumn("row", F.monotonically_increasing_id()), weights, percent, cap, block_words, shard_blocks, seed)


def _mixed(numbered: DataFrame, weights: Sequence[int], percent: int, cap: int, block_words: int, shard_blocks: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``mixed``, given rows that have their number."""
    size, text_hash = word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")
    sized = checkpointed(numbered.select("doc_id", "source", size, text_hash, "row"))
    sources = checkpointed(targets(sized, weights, percent, cap))
    whole = sized.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "weight")

    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    epochs = F.floor(F.col("target") / F.col("source_size"))
    rest = F.round((F.col("target") / F.col("source_size") - epochs) * blocks)
    quota = F.least((epochs * blocks + rest).cast("long"), blocks * cap)
    quotas = checkpointed(sources.filter("source_size > 0").select("rank", blocks.alias("blocks"), quota.alias("quota")))
    picked = draws(quotas, shard_blocks, seed)

    ordered = running_total(whole.filter("size > 0").select("row", "rank", "doc_id", "text_hash", "size"), ["rank"], ["doc_id", "text_hash", "row"], F.col("size"), "start")
    reach = F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))
    spans = ordered.select("row", "rank", "start", "size", F.explode(reach).alias("block"))
    first = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    spans = spans.select("row", "rank", "block", (first - F.col("start")).alias("first"), (end - first).alias("words"), (F.col("start") % block_words).alias("lead"))
    pieces = picked.join(spans, ["rank", "block"]).select("shard", "epoch", "row", "first", "words", "lead")
    return whole, pieces


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """How much of each document the mix takes: doc_id, size, source_size, target (its source's), taken; see ``mixed``."""
    whole, pieces = mixed(docs, **options)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return whole.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def _in_blocks(text: Column, lead: Column, block_words: int) -> Column:
    """The text cut where its source's blocks begin, white space at the cuts dropped.

    ``lead`` words stand in for those of the first block that come before the document, so that one pattern cuts all texts
    at every ``block_words`` words.
    """
    word = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"
    led = F.concat(F.repeat(F.lit("- "), lead.cast("int")), F.ltrim(text, F.lit(SPACES)))
    parts = F.regexp_extract_all(led, F.lit(f"(?:{word}){{1,{block_words}}}+"), F.lit(0))
    return F.transform(parts, lambda part, k: trimmed(F.when(k == 0, F.substring(part, (2 * lead + 1).cast("int"), F.length(part))).otherwise(part)))


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, cap: int = 2, block_words: int = 64,
    shard_blocks: int = 4096, seed: int = 20,
) -> DataFrame:
    """The mix as documents, with all columns of ``docs``: a row per document and epoch that takes words of it.

    Where an epoch takes the whole document, the text is kept as it is; else it holds the drawn blocks' stretches in reading
    order, each as it stands in the text, one a line. Other columns are the row's own, but for n_chars, which follows the
    text; rows that repeat are documents of their own. See ``mixed``. An empty table gives no rows.

    Rows get their number in a stored copy, by which the stretches find the text: text is moved once, and only that of
    documents that are taken.
    """
    columns = docs.columns
    kept = settle(docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("row")))
    named = kept.select("row", "whole.doc_id", "whole.source", "whole.text")
    whole, pieces = _mixed(named, weights, percent, cap, block_words, shard_blocks, seed)
    block = F.floor((F.col("first") + F.col("lead")) / block_words).cast("int")
    runs = pieces.groupBy("row", "epoch").agg(F.sum("words").alias("taken"), F.first("lead").alias("lead"), F.sort_array(F.collect_list(block)).alias("runs"))
    parts = whole.select("row", "size").join(runs, "row").select("row", "lead", F.when(F.col("taken") < F.col("size"), F.col("runs")).alias("runs"))
    found = kept.join(parts, "row").withColumn("cuts", F.when(F.col("runs").isNotNull(), _in_blocks(F.col("whole.text"), F.col("lead"), block_words)))
    cut = F.array_join(F.transform("runs", lambda k: F.get("cuts", k)), "\n")
    text = F.when(F.col("runs").isNull(), F.col("whole.text")).otherwise(cut)
    found = found.select("whole", text.alias("mixed_text"))
    follow = {"text": F.col("mixed_text"), "n_chars": F.length("mixed_text").cast("long")}
    return found.select(*[follow.get(c, F.col(f"whole.`{c}`")).alias(c) for c in columns])
