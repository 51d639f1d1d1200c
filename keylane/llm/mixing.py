"""Mixing sources to target weights, with DataFrame functions only.

The words of a source form one line, cut into blocks of a fixed number of
words. A mix has as many slots as the targets have blocks. Each output shard
draws the source of each of its slots, which gives multinomial counts; draws
beyond a source's number of slots are dealt to the sources that drew too few,
so the counts of all shards meet the targets. The r-th slot of a source takes
block p(r mod n) of its n blocks, where p is a pseudorandom permutation of the
indexes, another one each time the source is gone through. Slots and blocks
then meet in a join by index. Every step is a hash of stored values, so a rerun
gives the same mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keylane.llm.shared import WORD, aside, documents, row_keys, running_totals, slices_for, text_or_empty, word_count
from keylane.session import stored

#: A word and the blank space after it.
PIECE = WORD + r"[\x20\x09-\x0D]*"


@dataclass(frozen=True)
class Mix:
    """Words of a block, slots of an output shard, most times a source is taken, weights by rank of the source, seed."""

    block_words: int = 64
    shard_slots: int = 4096
    most_times: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    seed: int = 11
    rounds: int = 12


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Rows (number, source, source_size, target, blocks, slots) from rows (source, source_size).

    Sources are ranked by code point, null last. Sources whose share would pass
    ``most_times`` their size stop there and the others share the rest by
    weight. In order of cap/weight the capped ones come first, and one is capped
    if its share of what the earlier ones leave reaches its cap; so sums over
    that order give the end of the resharing at once. There is one row a source,
    which is the only table here that is ordered as a whole.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in mix.weights]), (F.col("number") % len(mix.weights) + 1).cast("int"))
    held = ranked.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * float(mix.most_times))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    shared = held.select(
        "*", F.sum("source_size").over(everything).cast("double").alias("all_words"), F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0)).alias("weight_before"))
    capped = F.col("cap") * (F.col("all_weight") - F.col("weight_before")) <= F.col("weight") * (F.col("all_words") - F.col("cap_before"))
    shared = shared.withColumn("capped", capped | (F.col("source_size") == 0))
    left = shared.select(
        "*", (F.col("all_words") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))).alias("rest"),
        (F.col("all_weight") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(everything), F.lit(0.0))).alias("rest_weight"))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("rest") / F.col("rest_weight"))
    blocks = F.ceil(F.col("source_size") / mix.block_words).cast("long")
    slots = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), mix.most_times * F.col("blocks")))
    return left.withColumn("target", target).withColumn("blocks", blocks).select(
        "number", "source", "source_size", "target", "blocks", slots.cast("long").alias("slots"))


def _draws(spark: SparkSession, sources: DataFrame, total: int, mix: Mix) -> DataFrame:
    """Rows (shard, number, n): how many slots of each output shard drew each source."""
    wide = max(1, total // 4096)
    line = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    lots = sources.filter("slots > 0").select("number", "slots", F.coalesce(F.sum("slots").over(line), F.lit(0)).alias("low"))
    by_part = lots.select("number", "low", (F.col("low") + F.col("slots")).alias("high"), F.explode(F.sequence(
        F.expr(f"low div {wide}"), F.expr(f"(low + slots - 1) div {wide}"))).alias("part"))
    drawn = spark.range(total).select(F.expr(f"id div {mix.shard_slots}").alias("shard"),
                                      F.pmod(F.xxhash64(F.lit(mix.seed), "id"), F.lit(total)).alias("lot")).withColumn(
        "part", F.expr(f"lot div {wide}"))
    return drawn.join(by_part, (drawn["part"] == by_part["part"]) & (drawn["lot"] >= by_part["low"]) & (drawn["lot"] < by_part["high"])
                      ).groupBy("shard", "number").agg(F.count("*").alias("n"))


def _slots(spark: SparkSession, sources: DataFrame, total: int, mix: Mix) -> DataFrame:
    """Rows (shard, number, rank): every slot of the mix, and which slot of its source it is."""
    earlier = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = _draws(spark, sources, total, mix).join(sources.select("number", "slots"), "number").withColumn(
        "before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    kept = F.greatest(F.lit(0), F.least(F.col("n"), F.col("slots") - F.col("before")))
    counts = stored(drawn.select("shard", "number", "slots", "before", kept.alias("kept"), (F.col("n") - kept).alias("spilt")), "counts")
    # a count becomes as many rows, so the few counts are spread before that
    spread = counts.repartition(_tasks(spark), "shard", "number")

    per_source = sources.filter("slots > 0").select("number", "slots").join(
        counts.groupBy("number").agg(F.sum("kept").alias("kept"), F.sum("spilt").alias("spilt")), "number", "left").fillna(0)
    line = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_source.select("number", "slots", (F.col("slots") - F.col("kept")).alias("missing"),
                               F.coalesce(F.sum("spilt").over(line), F.lit(0)).alias("spilt_before"),
                               F.coalesce(F.sum(F.col("slots") - F.col("kept")).over(line), F.lit(0)).alias("missing_before"))

    def upto(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    own = spread.filter("kept > 0").select("shard", "number", "before", upto("kept").alias("i")).select(
        "shard", "number", (F.col("before") + F.col("i")).alias("rank"))
    spare = spread.filter("spilt > 0").join(placed.select("number", "spilt_before"), "number").select(
        "shard", (F.col("spilt_before") + F.greatest(F.col("before") - F.col("slots"), F.lit(0))).alias("from"), upto("spilt").alias("i")
    ).select("shard", (F.col("from") + F.col("i")).alias("at"))
    wanted = placed.filter("missing > 0").select("number", "slots", "missing", "missing_before", upto("missing").alias("i")).select(
        "number", (F.col("slots") - F.col("missing") + F.col("i")).alias("rank"), (F.col("missing_before") + F.col("i")).alias("at"))
    return own.unionByName(spare.join(wanted, "at").select("shard", "number", "rank"))


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def permuted(index: Column, n: Column, key: list[Column], rounds: int) -> Column:
    """A pseudorandom permutation of 0 to n-1 for any n: rounds that swap an index with its mirror image, or not.

    Round r mirrors x to y = (k - x) mod n with a key k of the round; a hash of
    the larger of both, hence the same for both, says whether they swap.
    """
    def one(x: Column, r: Column) -> Column:
        y = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        swap = F.xxhash64(*key, r, F.greatest(x, y)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, y).otherwise(x)

    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), index.cast("long"), one)


@dataclass
class Mixed:
    """``sizes`` has the documents on their source's line, ``sources`` the targets, ``takes`` what each slot takes.

    A row of ``takes`` is (shard, time, number, block) and a part of a document:
    its keys, its ``start`` on the line, the first word ``word`` and ``words``.
    """

    sizes: DataFrame
    sources: DataFrame
    takes: DataFrame


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> Mixed:
    """Draw a mix of all documents. Null and empty texts have no words; an empty table gives an empty mix."""
    spark = docs.sparkSession
    sized = stored(docs.select("doc_id", "source", *row_keys("doc_id", "source", "text"), word_count().alias("size")), "sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sources = stored(source_targets(by_source, mix), "targets")
    rows = sized.count()
    total = sources.agg(F.sum("slots")).first()[0] or 0

    named = sources.select("number", F.col("source").alias("_source"))
    numbered = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    lines = stored(running_totals(numbered, ["number"], F.col("k1"), [F.col("k2")], {"start": "size"}, slices_for(rows)), "lines")

    width = mix.block_words
    segments = lines.filter("size > 0").select("number", "k1", "k2", "start", "size", F.explode(F.sequence(
        F.expr(f"start div {width}"), F.expr(f"(start + size - 1) div {width}"))).alias("block")).select(
        "number", "block", "k1", "k2", "start", F.greatest(F.col("block") * width - F.col("start"), F.lit(0)).alias("word"),
        (F.least((F.col("block") + 1) * width, F.col("start") + F.col("size")) - F.greatest(F.col("block") * width, F.col("start"))
         ).alias("words"))
    ranked = _slots(spark, sources, total, mix).join(sources.select("number", "blocks"), "number").withColumn(
        "time", F.expr("rank div blocks"))
    taken = ranked.select("shard", "number", "time", permuted(
        F.expr("rank % blocks"), F.col("blocks"), [F.lit(mix.seed), F.col("number"), F.col("time")], mix.rounds).alias("block"))
    return Mixed(lines, sources, taken.join(segments, ["number", "block"]))


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents, with their columns: one row for each time that a document is gone through.

    The text is what the mix takes of it that time, in order, with its blank
    space; ``n_chars``, where there is one, is counted again. Documents of which
    nothing is taken, such as those without words, have no row.
    """
    result = mix_sources(docs, mix)
    parts = result.takes.groupBy("k1", "k2", "start", "time").agg(
        F.sort_array(F.collect_list(F.struct("word", "words"))).alias("parts"))
    held, names = aside(docs)
    rows = held.select("*", *row_keys(*[names[c] for c in ("doc_id", "source", "text")])).dropDuplicates(["k1", "k2"])
    joined = rows.join(parts, ["k1", "k2"])
    # one lambda argument holds the pieces, so the text is split once a row
    pieces = F.array(F.regexp_extract_all(text_or_empty(names["text"]), F.lit(PIECE), F.lit(0)))
    text = F.transform(pieces, lambda p: F.array_join(F.transform(
        "parts", lambda s: F.array_join(F.slice(p, (s["word"] + 1).cast("int"), s["words"].cast("int")), "")), ""))[0]
    changed = joined.withColumn(names["text"], text)
    if "n_chars" in names:
        changed = changed.withColumn(names["n_chars"], F.char_length(names["text"]).cast(docs.schema["n_chars"].dataType))
    return changed.select(*held.columns).toDF(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir))
    taken = mixed.takes.groupBy("number", "k1", "k2", "start").agg(F.sum("words").alias("taken"))
    per_document = mixed.sizes.join(taken, ["number", "k1", "k2", "start"], "left")
    targets = mixed.sources.select("number", "source_size", "target")
    return per_document.join(targets, "number").select(
        "doc_id", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"))
