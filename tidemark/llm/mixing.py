"""Mixing sources to target weights: exact block quotas, split among output shards.

Every document is cut into blocks of words. A source's blocks stand in a keyed random
order; its target says how many of them are drawn, whole rounds first. A splitting tree
over the output shards then halves the vector of quotas again and again, each time by
one draw from the multivariate hypergeometric distribution, as a random cut of the
shuffled mix would. Each shard takes its own run of the order, so no block is drawn
twice in a round, and shuffles it locally. All of it is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.sampling import unused
from tidemark.session import write_through

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def unit(*columns) -> Column:
    """A keyed random number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def source_targets(
    sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """(source, source_size, target) from one row per source with its ``source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn. A target stops
    at ``most`` times its source, and the excess is shared anew by weight. That ends
    at min(cap, level * weight) with one level for all, which running sums over the
    sources by cap / weight give directly.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weigh = sizes.withColumn(
        "w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    ahead = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(ahead), F.lit(0.0))
    )
    # The level with the first sources at their caps holds from the first one that stays below its own.
    below = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("place"))
    return weigh.select("*", level.alias("level"), F.row_number().over(by_ratio).alias("place")).select(
        "source",
        "source_size",
        F.coalesce(F.least("cap", F.min_by("level", below).over(everything) * F.col("w")), "cap").alias("target"),
    )


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _log_factorial(x: Column) -> Column:
    """ln(x!) to about 12 digits: Stirling's series at x + 9, less the factors in between."""

    def series(y: Column) -> Column:
        inverse = 1 / y
        square = inverse * inverse
        tail = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
        factors = y - 8.0
        for k in range(1, 8):
            factors = factors * (y - float(k))
        return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - F.log(factors)

    return _bind(x + F.lit(9.0), series)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, by inverting its distribution at ``u``.

    The search covers the mean and 12 standard deviations on both sides.
    """
    known = F.struct(
        total.cast("double").alias("n"), marked.cast("double").alias("m"), drawn.cast("double").alias("d"), u.alias("u")
    )

    def bounds(s: Column) -> Column:
        part = s["m"] / F.greatest(s["n"], F.lit(1.0))
        mean = s["d"] * part
        reach = 12 * F.sqrt(mean * (1 - part) + 1) + 8
        return F.struct(
            *[s[c].alias(c) for c in ("n", "m", "d", "u")],
            F.greatest(F.lit(0.0), s["d"] + s["m"] - s["n"], F.floor(mean - reach).cast("double")).alias("lo"),
            F.least(s["d"], s["m"], F.ceil(mean + reach).cast("double")).alias("hi"),
        )

    def step(acc: Column, k: Column) -> Column:
        odds = (acc["m"] - k) * (acc["d"] - k) / ((k + 1) * (acc["n"] - acc["m"] - acc["d"] + k + 1))
        over = (acc["u"] < acc["sum"]) | (k >= acc["hi"])
        return F.when(over, acc).otherwise(
            F.struct(
                *[acc[c].alias(c) for c in ("n", "m", "d", "u", "lo", "hi")],
                (acc["p"] * odds).alias("p"),
                (acc["sum"] + acc["p"] * odds).alias("sum"),
                (k + 1).alias("k"),
            )
        )

    def search(s: Column) -> Column:
        p = F.exp(_log_choose(s["m"], s["lo"]) + _log_choose(s["n"] - s["m"], s["d"] - s["lo"]) - _log_choose(s["n"], s["d"]))
        start = lambda p: F.struct(
            *[s[c].alias(c) for c in ("n", "m", "d", "u", "lo", "hi")], p.alias("p"), p.alias("sum"), s["lo"].alias("k")
        )
        steps = F.transform(F.sequence(s["lo"].cast("long"), s["hi"].cast("long")), lambda k: k.cast("double"))
        return F.aggregate(steps, _bind(p, start), step, lambda acc: acc["k"].cast("long"))

    return _bind(_bind(known, bounds), search)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, shard, quota, before) from (source_no, quota): a splitting tree of draws.

    The quotas of all sources stand in one array at each node of the tree: its length
    is the number of sources, never of rows. ``before`` counts the source's draws in
    the shards ahead.
    """
    node = quotas.agg(
        F.sort_array(F.collect_list(F.struct("source_no", "quota"))).alias("q")
    ).select(
        F.lit(0).alias("lo"),
        F.lit(shards).alias("hi"),
        F.expr("aggregate(q, 0L, (a, x) -> a + x.quota)").alias("n"),
        "q",
    )
    share = lambda at: F.floor(F.col("all") * at / shards)
    node = node.withColumn("all", F.col("n"))
    while shards > 1:
        wide = node.filter("hi - lo > 1").withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"))
        wide = wide.withColumn("left_n", share(F.col("mid")) - share(F.col("lo")))

        def draw(acc: Column, x: Column) -> Column:
            k = hypergeometric(
                acc["n"], x["quota"], acc["d"], unit(F.lit(seed), F.col("lo"), F.col("hi"), x["source_no"])
            )
            return F.struct(
                (acc["n"] - x["quota"]).alias("n"),
                (acc["d"] - k).alias("d"),
                F.concat(acc["out"], F.array(k)).alias("out"),
            )

        begin = F.struct(
            F.col("n").alias("n"), F.col("left_n").alias("d"), F.expr("cast(array() as array<bigint>)").alias("out")
        )
        drawn = wide.withColumn("k", F.aggregate("q", begin, draw, lambda acc: acc["out"]))
        one = lambda x, k: F.struct(x["source_no"].alias("source_no"), k.alias("quota"))
        rest = lambda x, k: F.struct(x["source_no"].alias("source_no"), (x["quota"] - k).alias("quota"))
        left = drawn.select("lo", F.col("mid").alias("hi"), F.col("left_n").alias("n"), F.zip_with("q", "k", one).alias("q"), "all")
        right = drawn.select(F.col("mid").alias("lo"), "hi", (F.col("n") - F.col("left_n")).alias("n"), F.zip_with("q", "k", rest).alias("q"), "all")
        node = write_through(node.filter("hi - lo = 1").unionByName(left).unionByName(right), "mix-tree")
        if node.filter("hi - lo > 1").isEmpty():
            break
    leaves = node.select(F.col("lo").alias("shard"), F.inline("q"))
    ahead = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.select(
        "source_no", "shard", "quota", F.coalesce(F.sum("quota").over(ahead), F.lit(0)).alias("before")
    )


def mix_sources(
    docs: DataFrame,
    shards: int = 8,
    block_words: int = 256,
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 7,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    row: Column | None = None,
    tree_seed: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: the documents with their targets, and the draws that make up the mix.

    Documents: (row, id, source, size, source_size, target), a row for every row of
    ``docs``; ``size`` counts words, a null text has none. Draws: (row, id, source,
    block, round, words, shard, position): ``words`` words of block ``block`` are
    taken in round ``round``; the last block that a target needs may be taken in part,
    so every source's words add up to its rounded target. ``position`` orders a
    shard's blocks at random.

    A null source is one source, last in order. Documents without words are never
    drawn. Rows that repeat are documents of their own. Ids may be null; they take
    part only in the random order, so a rerun draws the same. Columns with other names
    are ignored. An empty table gives two empty tables. ``row`` may name a number that
    tells the rows of ``docs`` apart; else they are numbered here. ``tree_seed`` is that of
    the splitting tree alone, which decides the shards and not what is drawn.
    """
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long")
    base = write_through(
        docs.select(
            (F.monotonically_increasing_id() if row is None else row).alias("row"),
            F.col(f"`{id}`").alias("id"),
            F.col(f"`{source}`").alias("source"),
            words.alias("size"),
        ),
        "mix-documents",
    )
    sums = base.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.ceil(F.col("size") / block_words)).cast("long").alias("blocks"),
    )
    targets = source_targets(sums.select("source", "source_size"), share, most, weights)
    plan = targets.join(
        sums.select(F.col("source").alias("s"), "blocks"), F.col("source").eqNullSafe(F.col("s"))
    ).select(
        "source", "source_size", "target", "blocks",
        F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("source_no"),
        F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(int(most))).cast("long").alias("rounds"),
    )
    plan = plan.withColumn(
        "rest", F.least(F.greatest(F.round(F.col("target") - F.col("rounds") * F.col("source_size")).cast("long"), F.lit(0)), F.col("source_size"))
    ).withColumn("buckets", F.greatest(F.floor(F.sqrt("blocks")), F.lit(1)).cast("long"))
    plan = write_through(plan, "mix-plan")

    known = base.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    blocks = (
        known.filter("size > 0")
        .select(
            "row", "id", "source", "size", "source_no", "rounds", "rest", "buckets",
            F.explode(F.sequence(F.lit(0), (F.ceil(F.col("size") / block_words) - 1).cast("int"))).alias("block"),
        )
        .withColumn("held", F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words))
        .withColumn("u", unit(F.lit(seed), "id", "block"))
        .withColumn("bucket", F.floor(F.col("u") * F.col("buckets")))
        .drop("size", "buckets")
    )
    blocks = write_through(blocks, "mix-blocks")
    cut = ["source_no", "bucket"]
    ahead = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy(*cut)
        .agg(F.sum("held").alias("w"), F.count("*").alias("n"))
        .select(
            *cut,
            F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("words_ahead"),
            F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
        )
    )
    inside = Window.partitionBy(*cut).orderBy("u", "id", "block", "row")
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        blocks.withColumn("k", F.row_number().over(inside) - 1)
        .withColumn("w", F.coalesce(F.sum("held").over(so_far), F.lit(0)))
        .join(starts, cut)
        .withColumn("rank", F.col("ahead") + F.col("k"))
        .withColumn(
            "partial", F.greatest(F.least(F.col("rest") - F.col("words_ahead") - F.col("w"), F.col("held")), F.lit(0))
        )
    )
    ranked = write_through(
        ranked.select("row", "id", "source", "source_no", "block", "rounds", "held", "partial", "rank"), "mix-order"
    )
    drawn = ranked.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("rounds").cast("int"))).alias("round")
    ).withColumn("words", F.when(F.col("round") < F.col("rounds"), F.col("held")).otherwise(F.col("partial"))).filter("words > 0")
    quotas = drawn.groupBy("source_no").agg(F.count("*").alias("quota"))
    leaves = split_quotas(quotas, shards, seed if tree_seed is None else tree_seed)
    runs = leaves.groupBy("source_no").agg(F.sort_array(F.collect_list(F.struct("before", "shard"))).alias("runs"))
    per_round = plan.select("source_no", "blocks")
    place = F.col("round") * F.col("blocks") + F.col("rank")
    draws = (
        drawn.join(per_round, "source_no")
        .join(runs, "source_no")
        .withColumn("place", place)
        .withColumn("shard", F.element_at(F.filter("runs", lambda r: r["before"] <= F.col("place")), -1)["shard"])
        .select(
            "row", "id", "source", "block", "round", "words", "shard",
            F.xxhash64(F.lit(seed), F.lit("local"), "id", "block", "round").alias("position"),
        )
    )
    return known.select("row", "id", "source", "size", "source_size", "target"), draws


def mixed_documents(docs: DataFrame, block_words: int = 256, text: str = "text", **options) -> DataFrame:
    """The mix as documents: a row of ``docs``, all columns, for each round that draws from it.

    A text that is drawn whole is left as it is; of one that is drawn in part the words
    of the drawn blocks remain, single spaces between. ``n_chars`` follows the text.

    Documents without words, null texts among them, are in no mix. Repeated rows are
    documents of their own, a null id or source is a value like others. Columns may have
    any names; an empty table gives no rows. Texts are cut whole, however long.
    """
    row, left, split = unused(docs, "row", "blocks", "words")
    held = write_through(docs.withColumn(row, F.monotonically_increasing_id()), "mix-texts")
    known, draws = mix_sources(held, block_words=block_words, text=text, row=F.col(row), **options)
    rounds = (
        draws.groupBy("row", "round")
        .agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("block", "words"))).alias("blocks"))
        .join(known.select("row", "size"), "row")
        .select(F.col("row").alias(row), F.when(F.col("words") < F.col("size"), F.col("blocks")).alias(left))
    )
    body = F.col(f"`{text}`")
    pieces = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    part = F.array_join(
        F.flatten(
            F.transform(left, lambda b: F.slice(split, b["block"] * block_words + 1, b["words"].cast("int")))
        ),
        " ",
    )
    out = (
        held.join(rounds, row)
        .withColumn(split, F.when(F.col(left).isNotNull(), pieces))
        .withColumn(text, F.when(F.col(left).isNull(), body).otherwise(part))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(body).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
