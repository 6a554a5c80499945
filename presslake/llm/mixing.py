"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of a source are dealt to blocks by a hash. A source's target says how many of its blocks are drawn, in a
hashed order, a second round after the first. A binary tree splits all drawn blocks among the output shards: each
node's quotas of blocks per source go to its two children by a multivariate hypergeometric draw, so every shard gets
its exact share of blocks and, in expectation, the mixture's proportions. A shard takes the next blocks of a source's
order, so shards are disjoint; its rows are then ordered by a hash. What the target still wants after the last whole
block is filled with documents of the blocks behind it, in order, skipping those that do not fit, until none fits. Only
DataFrame functions are used, every random choice is a hash of names and the seed, and reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from presslake.llm.common import unused
from presslake.sources.workspace import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)


def _number(*parts: Column | str) -> Column:
    """A repeatable number from 0 to 2^60 - 1 of some values."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``; ``size`` counts the words of the whole text (null: 0).

    Rows that share ``doc_id`` and ``source`` are one document, of their sizes together.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    return rows.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, rows, target`` of each source of ``sized`` rows.

    All targets together are ``share`` of all sizes, in proportion to weights dealt to the sources by name (code
    points, null last), but none above ``most`` times its source: what is above goes to the others by weight, until
    none is above. That point is found in closed form: sources are capped in the order of size over weight. There is
    one row per source, so the windows over all of them are small.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight.cast("double")).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    # With the sources before this one capped, the words per weight that this one and the later ones would get.
    level = (share * total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    reached = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(Window.partitionBy(F.lit(1)))
    target = F.least(F.col("cap"), F.coalesce(reached["level"] * F.col("weight"), F.col("cap")))
    return levels.select("source", "source_size", "rows", target.alias("target"))


def _log_factorial(n: Column) -> Column:
    """Stirling's series; below 2 exactly 0."""
    m = F.greatest(n, F.lit(2.0))
    series = m * F.log(m) - m + 0.5 * F.log(2 * math.pi * m) + 1 / (12 * m) - 1 / (360 * m * m * m) + 1 / (1260 * m * m * m * m * m)
    return F.when(n < 2, F.lit(0.0)).otherwise(series)


def _hypergeometric(u: Column, total: Column, good: Column, drawn: Column) -> Column:
    """How many of ``good`` among ``total`` things are in a draw of ``drawn``, by inversion at the uniform ``u``.

    The sum runs over twelve standard deviations either way; the mass beyond is below the precision of a double.
    """
    t, g, d = (c.cast("double") for c in (total, good, drawn))
    mean = d * g / F.greatest(t, F.lit(1.0))
    spread = 12 * F.sqrt(F.greatest(mean * (1 - g / F.greatest(t, F.lit(1.0))), F.lit(0.0))) + 12
    least = F.greatest(F.lit(0.0), d - (t - g), F.floor(mean - spread).cast("double"))
    most = F.least(g, d, F.ceil(mean + spread).cast("double"))
    lf = _log_factorial
    first = F.exp(lf(g) - lf(least) - lf(g - least) + lf(t - g) - lf(d - least) - lf(t - g - d + least) - lf(t) + lf(d) + lf(t - d))

    def step(acc: Column, k: Column) -> Column:
        x = k.cast("double")
        after = acc["p"] * (g - x) * (d - x) / ((x + 1) * F.greatest(t - g - d + x + 1, F.lit(1.0)))
        return F.struct((acc["below"] + acc["p"]).alias("below"), after.alias("p"), F.when(acc["below"] + acc["p"] < u, x + 1).otherwise(acc["k"]).alias("k"))

    start = F.struct(F.lit(0.0).alias("below"), first.alias("p"), least.alias("k"))
    found = F.aggregate(F.sequence(least.cast("long"), F.greatest(least, most - 1).cast("long")), start, step, lambda acc: acc["k"])
    return F.when(most <= least, least).otherwise(F.least(found, most)).cast("long")


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """``source, shard, n, offset`` from ``source, quota``: how many of a source's draws go to each shard, and from where.

    A node is one row with the quotas of all sources, so a level of the tree is a projection, without a shuffle. The
    number of sources bounds a row. Deep levels are spread over tasks.
    """
    root = quotas.agg(F.sort_array(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("null"), F.col("quota").alias("n")))).alias("q"))
    nodes = root.select(F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("many"), "q")
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        half = F.floor(F.col("many") / 2)
        total = F.aggregate("q", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
        left = F.when(F.col("many") > 1, F.floor(total * half / F.col("many"))).otherwise(total).cast("long")
        uniform = lambda x: (_number(seed, "split", F.col("first"), F.col("many"), x["key"], x["null"]) + 0.5) / float(1 << 60)

        def draw(acc: Column, x: Column) -> Column:
            got = _hypergeometric(uniform(x), acc["total"], x["n"], acc["left"])
            # Bound once, as the draw is used three times.
            return F.element_at(
                F.transform(
                    F.array(got),
                    lambda k: F.struct((acc["total"] - x["n"]).alias("total"), (acc["left"] - k).alias("left"), F.concat(acc["got"], F.array(k)).alias("got")),
                ),
                1,
            )

        start = F.struct(total.alias("total"), left.alias("left"), F.array().cast("array<bigint>").alias("got"))
        taken = F.aggregate("q", start, draw, lambda acc: acc["got"])
        nodes = nodes.select("first", "many", "q", taken.alias("taken"), half.cast("long").alias("half"))
        part = lambda pick: F.transform(F.arrays_zip("q", "taken"), lambda z: F.struct(z["q"]["key"].alias("key"), z["q"]["null"].alias("null"), pick(z).cast("long").alias("n")))
        lower = F.struct(F.col("first"), F.col("half").alias("many"), part(lambda z: z["taken"]).alias("q"))
        upper = F.struct((F.col("first") + F.col("half")).alias("first"), (F.col("many") - F.col("half")).alias("many"), part(lambda z: z["q"]["n"] - z["taken"]).alias("q"))
        only = F.struct("first", "many", "q")
        nodes = nodes.select(F.explode(F.when(F.col("many") > 1, F.array(lower, upper)).otherwise(F.array(only))).alias("node")).select("node.*")
        if level % 3 == 2:  # keeps the plan short
            nodes = materialize(nodes.repartition("first") if level > 5 else nodes, "mix-nodes")
    leaves = nodes.select(F.col("first").alias("shard"), F.inline("q")).select("shard", F.when(~F.col("null"), F.col("key")).alias("source"), "n")
    by_source = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("offset", F.coalesce(F.sum("n").over(by_source), F.lit(0)))


def plan_mix(sizes: DataFrame, seed: str = "mix", block_rows: int = 512, shard_rows: int = 20_000, share: float = 1.5) -> tuple[DataFrame, DataFrame, int]:
    """Targets per source, the draws, and the number of buckets that a block is a source's part of.

    Draws are ``source, bucket, round, shard, limit`` of every block that the mix takes; ``limit`` is null for a whole
    block, the last block of a source has the words still wanted, which blocks behind it may give too. Blocks have ``block_rows`` rows in the largest
    source, or more where that would make over 100,000 of them.
    """
    goals = materialize(targets(sizes, share), "mix-targets")
    most, rows = goals.agg(F.max("rows"), F.sum("rows")).first()
    buckets = min(100_000, max(1, math.ceil((most or 0) / block_rows)))
    shards = max(1, math.ceil((rows or 0) * share / shard_rows))
    blocks = sizes.groupBy("source", _bucket(seed, buckets)).agg(F.sum("size").alias("words"))
    rounds = blocks.withColumn("round", F.explode(F.array(F.lit(0), F.lit(1))))
    by_source = Window.partitionBy("source").orderBy("round", _block_order(seed), "bucket")
    before = F.sum("words").over(by_source.rowsBetween(Window.unboundedPreceding, -1))
    running = rounds.withColumns({"place": F.row_number().over(by_source) - 1, "before": F.coalesce(before, F.lit(0))})
    limit = F.when(F.col("before") + F.col("words") > F.col("target"), F.col("target") - F.col("before"))
    wanted = running.alias("r").join(goals.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source"))).filter("before < target")
    drawn = materialize(wanted.select("r.source", "bucket", "round", "place", limit.alias("limit")), "mix-draws")
    leaves = split_quotas(drawn.groupBy("source").agg(F.count(F.lit(1)).alias("quota")), shards, seed).filter("n > 0")
    # A leaf is a run of places in its source's order.
    places = leaves.select("source", "shard", F.explode(F.sequence("offset", F.col("offset") + F.col("n") - 1)).alias("place"))
    same = F.col("d.source").eqNullSafe(F.col("l.source")) & (F.col("d.place") == F.col("l.place"))
    plan = drawn.alias("d").join(places.alias("l"), same).select("d.source", "bucket", "round", "shard", "limit")
    return goals, materialize(plan, "mix-plan"), buckets


def _block_order(seed: str) -> Column:
    return _number(seed, "order", F.col("round"), F.col("source"), F.col("bucket"))


def _bucket(seed: str, buckets: int) -> Column:
    return F.pmod(_number(seed, "block", F.col("doc_id")), F.lit(buckets)).alias("bucket")


def mix(docs: DataFrame, seed: str = "mix", block_rows: int = 512, shard_rows: int = 20_000, share: float = 1.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of ``docs`` (``doc_id, text, source``): ``(sizes, targets, taken)``.

    ``taken`` has ``doc_id, source, size, round, shard, position`` for each copy of a document that the mix takes;
    ``position`` orders a shard's rows. No document is taken more than twice. Whole documents are taken, and
    a source stays below its target by less than the smallest copy with words that it leaves out. Rows that share
    ``doc_id`` and ``source`` are one document. A null source is a source like others; documents without words are
    taken with their block, the last one included, at no cost.
    """
    sizes = materialize(sized(docs), "mix-sizes")
    goals, plan, buckets = plan_mix(sizes, seed, block_rows, shard_rows, share)
    keyed = sizes.withColumn("bucket", _bucket(seed, buckets))
    same = F.col("k.source").eqNullSafe(F.col("p.source")) & (F.col("k.bucket") == F.col("p.bucket"))
    position = _number(seed, "position", F.col("round"), F.col("k.doc_id")).alias("position")
    rows = keyed.alias("k").join(plan.filter("limit IS NULL").alias("p"), same)
    whole = rows.select("k.doc_id", "k.source", "size", "round", "shard", position)
    return sizes, goals, whole.unionByName(_fill(keyed, plan, seed))


def _fill(keyed: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Documents of the blocks that are not taken whole, up to the words that each source still wants.

    A pass takes, in the order of blocks and positions, up to the first that does not fit; the next pass goes over those
    not taken that still fit, until none does. Whatever stops a pass is larger than what is wanted then, so the wanted
    words shrink and there are few passes. Sums run over blocks first and inside a block then, so no task has a source's
    rows. Documents without words come from the last block only.
    """
    last = plan.filter("limit IS NOT NULL").select("source", F.col("bucket").alias("last_bucket"), F.col("round").alias("last_round"), "shard", F.col("limit").alias("rest"))
    copies = keyed.withColumn("round", F.explode(F.array(F.lit(0), F.lit(1))))
    with_last = copies.alias("k").join(last.alias("l"), F.col("k.source").eqNullSafe(F.col("l.source"))).select("k.*", "last_bucket", "last_round", "shard", "rest")
    is_last = (F.col("bucket") == F.col("last_bucket")) & (F.col("round") == F.col("last_round"))
    wanted = with_last.filter((F.col("size") <= F.col("rest")) & (is_last | (F.col("size") > 0))).drop("last_bucket", "last_round")
    drawn = plan.filter("limit IS NULL").select("source", "bucket", "round").alias("p")
    own = F.col("w.source").eqNullSafe(F.col("p.source")) & (F.col("w.bucket") == F.col("p.bucket")) & (F.col("w.round") == F.col("p.round"))
    left = wanted.alias("w").join(drawn, own, "left_anti").withColumns({"order": _block_order(seed), "position": _number(seed, "position", F.col("round"), F.col("doc_id"))})
    taken = None
    while True:
        marked = materialize(_fill_pass(left), "mix-fill")
        more = marked.filter("in").select("doc_id", "source", "size", "round", "shard", "position")
        taken = more if taken is None else taken.unionByName(more)
        spent = more.groupBy("source").agg(F.sum("size").alias("spent"))
        rest = F.col("rest") - F.coalesce("spent", F.lit(0))
        still = marked.filter("NOT in").drop("in").alias("m").join(spent.alias("s"), F.col("m.source").eqNullSafe(F.col("s.source")), "left")
        left = still.withColumn("now", rest).select(*[f"m.{c}" for c in left.columns if c != "rest"], F.col("now").alias("rest")).filter("size <= rest")
        if left.isEmpty():
            return taken


def _fill_pass(left: DataFrame) -> DataFrame:
    """``left`` with ``in``: whether a row is before the first one that exceeds its source's ``rest``, by the running sum."""
    blocks = left.groupBy("source", "round", "order", "bucket").agg(F.sum("size").alias("words"))
    by_source = Window.partitionBy("source").orderBy("round", "order", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.withColumn("before", F.coalesce(F.sum("words").over(by_source), F.lit(0))).drop("words", "order").alias("b")
    same = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.round") == F.col("b.round")) & (F.col("r.bucket") == F.col("b.bucket"))
    inside = Window.partitionBy("source", "round", "bucket").orderBy("position", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = left.alias("r").join(before, same).select("r.*", "before")
    return rows.withColumn("in", F.col("before") + F.sum("size").over(inside) <= F.col("rest")).drop("before")


def _same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken``; ``taken`` are the words the mix takes of it."""
    sizes, goals, taken = mix(docs, **settings)
    copies = taken.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("copies"))
    counted = sizes.alias("s").join(copies.alias("c"), _same_document("s", "c"), "left").select("s.*", F.coalesce("copies", F.lit(0)).alias("copies"))
    with_goals = counted.alias("w").join(goals.alias("g"), F.col("w.source").eqNullSafe(F.col("g.source")), "left")
    return with_goals.select("doc_id", "w.source", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as rows of ``docs``, with all their columns: a row for each time it is taken, by shard, in shuffled order."""
    _, _, taken = mix(docs, **settings)
    columns = [F.col(f"x.`{c}`") for c in docs.columns]
    met = docs.alias("x").join(taken.select("doc_id", "source", "shard", "position").alias("t"), _same_document("x", "t"))
    shard, position = unused(docs.columns, "shard", "position")
    placed = met.select(*columns, F.col("t.shard").alias(shard), F.col("t.position").alias(position))
    # Ranges, so that a shard stays together and large ones still are several tasks.
    return placed.repartitionByRange(shard, position).sortWithinPartitions(shard, position).drop(shard, position)
