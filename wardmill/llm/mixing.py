"""Mixing sources to target weights, with DataFrame functions only.

1. Targets. Sources in code-point order (null last) get the weights 3, 1, 2, 3, 1, 2, ... of ``share`` times all words; none
   gets more than ``cap`` times its own words, and what it can't take goes to the others by weight.
2. Packing. A source's documents, in pseudorandom order, are one stream of words, cut into blocks of ``block`` words. Places
   in the stream are sums over (source, part) plus sums inside one part, so a hot source is no single window.
3. Drawing. A source of n blocks gets round(target / words * n) slots. Every slot of every output shard draws its source
   independently with the sources' shares (alias method), so each shard's counts are multinomial. The totals are then
   settled: what a source drew beyond its slots goes, in order, to those that drew too few.
4. Indexing. A source's slots, numbered over all shards, pass through a pseudorandom permutation of its block numbers, a new
   one each time all blocks are used; so no block is used more than ceil(cap) times. Slots and blocks join on the index.

Tables of one row per source go through the driver; everything else stays in Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.shared import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 64
SHARD_SLOTS = 8192
PART_ROWS = 50_000
SEED = 42
#: ``[^\x20\x09-\x0D]+``
WORD = "[^\\x20\\x09-\\x0D]+"


def sizes(docs: DataFrame, id_: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``id``, ``source``, ``size`` in words; a null text has none."""
    return docs.select(F.col(id_).alias("id"), F.col(source).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source``, ``src`` (its place from 0), ``words``, ``target``: one row per source.

    A source is full if its cap over its weight is at most what a unit of weight still gets, in the order of that ratio.
    """
    one = sized.groupBy("source").agg(F.sum("size").alias("words"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    one = one.withColumn("src", place).withColumn("weight", F.element_at(kinds, (F.col("src") % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("words") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    one = one.withColumns({
        "left": share * F.sum("words").over(everything) - F.coalesce(cap * F.sum("words").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    one = one.withColumn("unit", F.col("left") / F.col("open"))
    one = one.withColumn("full", cap * F.col("words") <= F.col("unit") * F.col("weight"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("words") / F.col("weight"), F.col("src"), F.col("unit").alias("unit")))).over(everything)["unit"]
    return one.select("source", "src", "words", F.when(F.col("full"), cap * F.col("words")).otherwise(level * F.col("weight")).alias("target"))


@dataclass
class Source:
    words: int
    target: float
    blocks: int
    slots: int


def _alias(shares: list[float]) -> tuple[list[float], list[int]]:
    """Tables that draw a number with these shares from one uniform value."""
    n = len(shares)
    keep, other = [x * n for x in shares], list(range(n))
    small, large = [i for i in range(n) if keep[i] < 1], [i for i in range(n) if keep[i] >= 1]
    while small and large:
        low, high = small.pop(), large[-1]
        other[low] = high
        keep[high] -= 1 - keep[low]
        if keep[high] < 1:
            small.append(large.pop())
    for i in small + large:
        keep[i] = 1.0
    return keep, other


def pick(values: list, at: Column, kind: str) -> Column:
    return F.element_at(F.lit(values).cast(f"array<{kind}>"), (at + 1).cast("int"))


@dataclass
class Mixture:
    """``sources`` by place, ``plan`` (shard, slot, src, block), ``pieces`` (src, block, id, place, size, words of the block)."""

    sources: list[Source]
    plan: DataFrame
    pieces: DataFrame
    sized: DataFrame

    def spans(self) -> DataFrame:
        """What each output slot holds: shard, slot, id, first word in the document, number of words."""
        return self.plan.join(self.pieces, ["src", "block"]).select("shard", "slot", "id", F.col("first").alias("start"), "words")

    def taken(self) -> DataFrame:
        """A row per document: id, src, size, words that the mix takes, repeats counted."""
        uses = self.plan.groupBy("src", "block").agg(F.count(F.lit(1)).alias("uses"))
        used = self.pieces.join(uses, ["src", "block"], "left").groupBy("src", "place", "id", "size").agg(
            F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"))
        empty = self.sized.where("size = 0").select("src", "id", "size", F.lit(0).cast("long").alias("taken"))
        return used.select("src", "id", "size", "taken").unionByName(empty)


def mix(docs: DataFrame, *, id_: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
        share: float = SHARE, cap: float = CAP, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, part_rows: int = PART_ROWS, seed: int = SEED) -> Mixture:
    """Null sources are a source, null ids stay; documents without words are in no block; repeated rows are documents of their own."""
    spark = docs.sparkSession
    equal = stored(sizes(docs, id_, text, source).groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    kinds = stored(targets(equal.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, cap), "targets")
    rows = kinds.orderBy("src").collect()
    parts = max(1, -(-(equal.agg(F.sum("n")).first()[0] or 0) // part_rows))
    names = kinds.select(F.col("source").alias("name"), "src")
    sized = _each(equal, part_rows).join(names, F.col("source").eqNullSafe(F.col("name")))
    sized = sized.select("id", "source", "src", "size", F.xxhash64(F.lit(seed), "id", "size", "nth").alias("mark"))
    sized = stored(sized.withColumn("part", F.pmod(F.xxhash64("mark"), F.lit(parts)).cast("int")), "sized")

    sources = []
    for r in rows:
        blocks = -(-r["words"] // block)
        sources.append(Source(r["words"], float(r["target"] or 0.0), blocks, min(int(math.floor(cap * blocks)), round(r["target"] / r["words"] * blocks)) if blocks else 0))
    return Mixture(sources, _plan(spark, sources, shard_slots, seed), _pieces(sized, block), sized)


def _each(equal: DataFrame, run: int) -> DataFrame:
    """A row for each of ``n`` equal ones, told apart by ``nth``. Many equal rows are made by several tasks, ``run`` at a time."""
    columns = ["source", "id", "size"]
    few = equal.where(f"n <= {run}").select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth"))
    many = equal.where(f"n > {run}").select(*columns, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {run}"))).alias("run"))
    many = many.repartition(*columns, "run")
    nth = F.sequence(F.col("run") * run, F.least(F.col("n"), (F.col("run") + 1) * run) - 1)
    return few.unionByName(many.select(*columns, F.explode(nth).alias("nth")))


def _pieces(sized: DataFrame, block: int) -> DataFrame:
    some = sized.where("size > 0")
    sums = some.groupBy("src", "part").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("src", "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("src", "part").orderBy("mark", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = some.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(base, ["src", "part"]).select("src", "id", "size", (F.col("base") + F.col("inner")).alias("place"))
    end = F.col("place") + F.col("size")
    cut = placed.withColumn("block", F.explode(F.sequence(F.expr(f"place div {block}"), F.expr(f"(place + size - 1) div {block}"))))
    low = F.greatest("place", F.col("block") * block)
    return cut.select("src", "block", "id", "place", "size", (low - F.col("place")).alias("first"), (F.least(end, (F.col("block") + 1) * block) - low).alias("words"))


def _plan(spark, sources: list[Source], shard_slots: int, seed: int) -> DataFrame:
    total = sum(s.slots for s in sources)
    if not total:
        return spark.range(0).select(F.col("id").alias("shard"), F.col("id").alias("slot"), F.lit(0).alias("src"), F.col("id").alias("block"))
    keep, other = _alias([s.slots / total for s in sources])
    slot = spark.range(total).select((F.expr(f"id div {shard_slots}")).alias("shard"), (F.col("id") % shard_slots).alias("slot"),
                                     (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) * F.lit(2.0 ** -53) * len(sources)).alias("u"))
    column = F.least(F.floor("u").cast("int"), F.lit(len(sources) - 1))
    drawn = slot.select("shard", "slot", F.when(F.col("u") - column < pick(keep, column, "double"), column).otherwise(pick(other, column, "int")).alias("src"))

    counts = stored(drawn.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("n")), "draws")
    got = [0] * len(sources)
    for r in counts.groupBy("src").agg(F.sum("n").alias("n")).collect():
        got[r["src"]] = r["n"]
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "src", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("shard", "src").orderBy("slot")) - 1
    numbered = drawn.withColumn("rank", rank).join(base, ["shard", "src"]).withColumn("j", F.col("base") + F.col("rank"))

    over, lack, over_before, lack_upto = [], [], [], []
    for s, n in zip(sources, got, strict=True):
        over_before.append(sum(over))
        over.append(max(0, n - s.slots))
        lack.append(max(0, s.slots - n))
        lack_upto.append(sum(lack))
    limit = pick([s.slots for s in sources], F.col("src"), "bigint")
    spare = F.col("j") - limit + pick(over_before, F.col("src"), "bigint")
    taker = F.size(F.filter(F.lit(lack_upto).cast("array<bigint>"), lambda x: x <= F.col("spare"))).cast("int")
    settled = numbered.withColumn("spare", F.when(F.col("j") >= limit, spare)).withColumn("to", F.when(F.col("spare").isNotNull(), taker))
    first_lack = [u - n for u, n in zip(lack_upto, lack, strict=True)]
    settled = settled.select("shard", "slot", F.coalesce("to", "src").alias("src"), F.when(F.col("to").isNull(), F.col("j"))
                             .otherwise(pick(got, F.col("to"), "bigint") + F.col("spare") - pick(first_lack, F.col("to"), "bigint")).alias("j"))

    rounds = max(-(-s.slots // s.blocks) if s.blocks else 1 for s in sources)
    steps, shifts = [], []
    for i, s in enumerate(sources):
        for k in range(rounds):
            draw = Random(f"{seed}-{i}-{k}")
            n = max(s.blocks, 1)
            step = draw.randrange(1, n + 1)
            while math.gcd(step, n) != 1:
                step = draw.randrange(1, n + 1)
            steps.append(step)
            shifts.append(draw.randrange(n))
    n = pick([max(s.blocks, 1) for s in sources], F.col("src"), "bigint")
    indexed = settled.withColumn("n", n).withColumn("row", F.col("src") * rounds + F.expr("j div n").cast("int"))
    block = F.pmod(F.expr("j % n").cast("decimal(19,0)") * pick(steps, F.col("row"), "decimal(19,0)") + pick(shifts, F.col("row"), "decimal(19,0)"), F.col("n").cast("decimal(19,0)"))
    return indexed.select("shard", "slot", "src", block.cast("long").alias("block"))
