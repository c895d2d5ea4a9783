"""Mixing sources to target weights, by quotas of blocks split among output shards. DataFrame functions only.

Targets: sources in order of code point, null last, weigh WEIGHTS in turn and share BUDGET times all words; a target stops at EPOCHS
times its source's words, and what it leaves goes to the others by weight.

Draw: a hash puts each document into one of BLOCKS blocks of its source, in an order that is a random permutation. A source's quota is
as many blocks, epoch after epoch, as its target holds, the last one in part: its documents up to the target in hash order, then the
one document outside whose size is nearest to what is still missing, if it brings the sum nearer.

Splitting tree: the vector of quotas is split in two again and again, until each of SHARDS shards has its own: either half gets
a multivariate hypergeometric draw of the blocks that come to it, by selection sampling with hashed random numbers. A shard's
quota of a source is a run of the source's drawn blocks, so shards are disjoint and together hold exactly the draw.
Shards are shuffled each by itself, by a hash. The tree is one row of (source, quota) for each node, which grows with sources and
not with documents; sources are assumed to be few enough to list.

Cases: a null text has size 0. A null source is a source of its own, the last. Rows equal in doc_id, source and size are one unit and are taken
equally often; null ids are ids like any other. A source without words has target 0. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import saved

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
EPOCHS = 2
BLOCK_BITS = 10
BLOCKS = 1 << BLOCK_BITS
SHARDS = 16
SLICES = 4096
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
_UNIT = ("doc_id", "source", "size")


def _order() -> Column:
    """60 random bits of a unit."""
    text = F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _keys() -> list[Column]:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size]


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """For rows (source, source_size): adds place (from 0, by code point, null last) and target."""
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1).cast("double")
    ranked = (
        sources.withColumn("place", F.expr("row_number() over (order by source asc nulls last) - 1"))
        .withColumn("weight", weight)
        .withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
        .withColumn("total", F.lit(budget) * F.expr("sum(source_size) over ()"))
    )
    # By cap for each unit of weight, the capped sources come first; the others share what those leave.
    upto = "over (order by cap / weight, place rows between unbounded preceding and 1 preceding)"
    behind = "over (order by cap / weight, place rows between current row and unbounded following)"
    shared = ranked.withColumn("level", F.expr(f"(total - coalesce(sum(cap) {upto}, 0.0D)) / sum(weight) {behind}"))
    shared = shared.withColumn("capped", F.expr("cap / weight <= level"))
    level = F.expr("(total - coalesce(sum(if(capped, cap, 0.0D)) over (), 0.0D)) / nullif(sum(if(capped, 0.0D, weight)) over (), 0.0D)")
    return shared.withColumn("level", level).select(
        "source", "source_size", "place", F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("level"))).alias("target")
    )


def _split(quotas: DataFrame, shards: int) -> DataFrame:
    """For rows (place, quota): rows (place, shard, first, last): the run of the source's drawn blocks that a shard gets."""
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct(F.col("place").cast("int").alias("place"), F.col("quota").cast("int").alias("quota")))).alias("left"))
    nodes = nodes.select(F.lit(0).alias("first"), F.lit(shards).alias("width"), F.col("left").alias("has"))
    # Selection sampling: each block still to come is taken with the chance that fills the half exactly.
    chance = f"shiftrightunsigned(xxhash64('{SEED}', first, width, x.place, i), 11) / 9007199254740992.0D"
    one = f"""named_struct('rest', s.rest - 1, 'need', s.need - int({chance} * s.rest < s.need), 'k', s.k + int({chance} * s.rest < s.need))"""
    source = f"""aggregate(if(x.quota > 0, sequence(1, x.quota), cast(array() as array<int>)),
        named_struct('rest', state.rest, 'need', state.need, 'k', 0), (s, i) -> {one},
        s -> named_struct('rest', s.rest, 'need', s.need, 'got', array_append(state.got, s.k)))"""
    total = "aggregate(has, 0L, (n, x) -> n + x.quota)"
    draw = f"""aggregate(has,
        named_struct('rest', {total}, 'need', {total} * floor(width / 2) div width, 'got', cast(array() as array<int>)),
        (state, x) -> {source}).got"""
    halves = """inline(array(
        named_struct('first', first, 'width', cast(floor(width / 2) as int),
            'has', zip_with(has, got, (x, k) -> named_struct('place', x.place, 'quota', k))),
        named_struct('first', first + cast(floor(width / 2) as int), 'width', width - cast(floor(width / 2) as int),
            'has', zip_with(has, got, (x, k) -> named_struct('place', x.place, 'quota', x.quota - k)))))"""
    wide = shards
    while wide > 1:  # nodes of one shard pass unchanged: their left half is empty
        nodes = nodes.withColumn("got", F.expr(draw)).selectExpr(halves).where("width > 0")
        wide = -(-wide // 2)
    leaves = nodes.selectExpr("first as shard", "inline(has)")
    run = leaves.withColumn("last", F.expr("sum(quota) over (partition by place order by shard)"))
    return run.select("place", "shard", (F.col("last") - F.col("quota")).alias("first"), "last").where("first < last")


def plan(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per unit: doc_id, source, size, source_size, target, copies, and the shards its copies go to."""
    units = docs.select(*_keys()).groupBy(*_UNIT).agg(F.count("*").alias("rows"))
    units = units.withColumn("at", _order()).withColumn("words", F.col("size") * F.col("rows"))
    units = saved(units.withColumn("block", F.shiftright("at", 60 - BLOCK_BITS)), "mix-units")
    blocks = units.groupBy("source", "block").agg(F.sum("words").alias("words"))
    aims = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")))
    aims = aims.withColumn("epochs", F.expr("coalesce(floor(target / nullif(source_size, 0)), 0)")).withColumn("more", F.expr("target - epochs * source_size"))

    within = "over (partition by source order by block)"
    laid = blocks.withColumn("upto", F.expr(f"sum(words) {within}")).withColumn("pos", F.expr(f"row_number() {within} - 1"))
    laid = laid.withColumn("n_blocks", F.expr("count(*) over (partition by source)"))
    laid = laid.withColumnRenamed("source", "s").join(aims, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    laid = laid.withColumn("whole", F.expr("upto <= more")).withColumn("part", F.expr("upto > more and upto - words < more"))
    laid = saved(laid, "mix-blocks")
    quotas = laid.groupBy("place").agg((F.first("epochs") * F.first("n_blocks") + F.sum(F.expr("int(whole or part)"))).alias("quota"))
    runs = _split(quotas, shards)
    # The draws of a block: one in each full epoch, one more if it is drawn again whole or in part.
    epochs = F.expr("filter(sequence(0, int(epochs)), e -> e < epochs or whole or part)")
    draws = laid.select("place", "block", "pos", "n_blocks", F.explode(epochs).alias("epoch")).withColumn("index", F.expr("epoch * n_blocks + pos"))
    placed = draws.join(runs, "place").where("index >= `first` and index < `last`")
    placed = placed.groupBy("place", "block").agg(F.transform(F.sort_array(F.collect_list(F.struct("epoch", "shard"))), lambda x: x["shard"]).alias("shards"))
    laid = laid.join(placed, ["place", "block"], "left").withColumn("left_over", F.expr("if(part, more - (upto - words), null)"))

    keys = F.col("u.source").eqNullSafe(F.col("b.source")) & (F.col("u.block") == F.col("b.block"))
    drawn = units.alias("u").join(laid.alias("b"), keys).select(
        "u.doc_id", "u.source", "u.size", "u.at", F.col("u.words").alias("words"), "b.place", "b.source_size", "b.target", "b.epochs", "b.whole", "b.part", "b.left_over", "b.shards"
    )
    drawn = saved(drawn, "mix-drawn")
    edge = drawn.where("part").withColumn("upto", F.expr("sum(words) over (partition by place order by at, doc_id, size rows between unbounded preceding and current row)"))
    edge = edge.select(*_UNIT, "place", "words", "left_over", F.element_at("shards", -1).alias("edge_shard"), F.expr("upto <= left_over").alias("in_part"))
    missing = edge.groupBy("place").agg(F.first("edge_shard").alias("fill_shard"), (F.first("left_over") - F.sum(F.expr("if(in_part, words, 0)"))).alias("missing"))
    inside = edge.where("in_part").select("place", *_UNIT)
    outside = drawn.where("not whole").join(missing, "place").where("words > 0 and abs(words - missing) < missing")
    taken = inside.select("place", F.col("doc_id").alias("d"), F.col("size").alias("z"))
    same = (F.col("o.place") == F.col("t.place")) & F.col("o.doc_id").eqNullSafe(F.col("t.d")) & (F.col("o.size") == F.col("t.z"))
    outside = outside.alias("o").join(taken.alias("t"), same, "left_anti")
    fill = outside.groupBy("place").agg(F.min(F.struct(F.expr("abs(words - missing)").alias("off"), "at", "doc_id", "size")).alias("best"), F.first("fill_shard").alias("shard"))
    extra = fill.select("place", F.col("best.doc_id").alias("doc_id"), F.col("best.size").alias("size"), "shard")
    extra = extra.unionByName(edge.where("in_part").select("place", "doc_id", "size", F.col("edge_shard").alias("shard")))
    extra = extra.select(F.col("place").alias("p"), F.col("doc_id").alias("d"), F.col("size").alias("z"), "shard")

    same = (F.col("place") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z"))
    out = drawn.join(extra, same, "left")
    base = F.expr("if(part, slice(shards, 1, int(epochs)), coalesce(shards, cast(array() as array<int>)))")
    out = out.withColumn("shards", F.when(F.col("shard").isNotNull(), F.array_append(base, F.col("shard"))).otherwise(base))
    return out.select(*_UNIT, "source_size", "target", F.size("shards").alias("copies"), "shards")


def _with_plan(docs: DataFrame, shards: int) -> DataFrame:
    """docs with its columns named own_0, own_1, ..., and the columns of the plan."""
    found = plan(docs.select("doc_id", "text", "source"), shards).withColumnsRenamed({c: f"plan_{c}" for c in _UNIT})
    own = docs.select(*(F.col(c).alias(f"own_{i}") for i, c in enumerate(docs.columns)), *_keys())
    return own.join(found, F.expr("doc_id <=> plan_doc_id and source <=> plan_source and size = plan_size"))


def digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    found = _with_plan(docs.select("doc_id", "text", "source"), shards)
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, shards: int = SHARDS, shard: str | None = None) -> DataFrame:
    """The documents as often as they are drawn, with all their columns; each shard in an order of its own.

    `shard` names a column for the shard's number; a column of docs with that name is replaced.
    """
    found = _with_plan(docs, shards).select("*", F.posexplode("shards").alias("epoch", "shard"))
    found = found.withColumn("order", F.xxhash64(F.lit(SEED), "shard", "epoch", "doc_id", "size"))
    # A shard is dealt over as many tasks as the session's shuffles have; by slices of its order, each is a shuffled part of it.
    found = found.repartition("shard", F.pmod("order", F.lit(SLICES))).sortWithinPartitions("shard", "order")
    kept = [F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns) if c != shard]
    return found.select(*kept, *([F.col("shard").alias(shard)] if shard else []))
