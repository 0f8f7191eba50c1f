"""Temperature mixing: source shares to a power, realised as block permutations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import WORD, fresh, save, text_of

# Exponents that one pass over the source table tries, and the passes: 64**4 steps in all.
GRID, PASSES = 64, 4
# Rows of a source that one running sum covers.
ROWS_PER_RUN = 4096


def word_tokens(text: str = "text") -> Column:
    """Words of the whole text, plus one for its end: every row has a size."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint") + 1


@dataclass(frozen=True)
class Target:
    """What the mix must meet.

    ``entropy``: the least entropy of the weights, as a share of the largest possible one.
    ``repeats``: the most often a source may be repeated. It wins where both can't be met.
    ``budget``: tokens of the mix; None is the least with which every row occurs.
    ``block``: tokens of a block of the mix.
    """

    entropy: float = 0.9
    repeats: float = 4.0
    budget: int | None = None
    block: int = 1 << 18


def _weight(exponent: Column) -> Column:
    """The weight before scaling: the token share to the power."""
    return F.exp(exponent * F.ln(F.col("share")))


def fit_exponent(sources: DataFrame, target: Target) -> float:
    """The largest exponent in [0, 1] that meets the target entropy, then lowered or raised no
    further than the repetition limit allows.

    Entropy falls and repetition (the budget's part of a source over its tokens) falls as the
    exponent rises, so each has one crossing. Bisected many ways at a time: a pass over the source
    table tries ``GRID`` exponents and narrows the range to one of their gaps.
    """
    totals = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens")).first()
    if totals.n < 2:
        return 1.0

    def tried(low: float, high: float) -> list:
        steps = F.array(*[F.lit(low + (high - low) * i / GRID) for i in range(GRID + 1)])
        each = sources.select("share", F.posexplode(steps).alias("i", "exponent"))
        each = each.withColumns({"w": _weight(F.col("exponent")), "log": F.col("exponent") * F.ln("share")})
        sums = each.groupBy("i", "exponent").agg(
            F.sum("w").alias("w"),
            F.sum(F.col("w") * F.col("log")).alias("wlog"),
            F.min(F.col("w") / F.col("share")).alias("least"),
            F.max(F.col("w") / F.col("share")).alias("most"),
        )
        entropy = (F.ln("w") - F.col("wlog") / F.col("w")) / F.ln(F.lit(float(totals.n)))
        if target.budget:
            repeats = F.col("most") / F.col("w") * F.lit(target.budget / totals.tokens)
        else:  # the source that is weighted down most is shown once
            repeats = F.col("most") / F.col("least")
        return sums.select("i", "exponent", entropy.alias("entropy"), repeats.alias("repeats")).orderBy("i").collect()

    def crossing(holds, rising: bool) -> float:
        """The end of the range in which ``holds`` is true: its top, or its bottom if ``rising``."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            rows = tried(low, high)
            good = [r for r in rows if holds(r)]
            if not good:
                return 1.0 if rising else 0.0
            at = good[0].i if rising else good[-1].i
            here = next(r.exponent for r in rows if r.i == at)
            beside = at - 1 if rising else at + 1
            other = next((r.exponent for r in rows if r.i == beside), None)
            if other is None:
                return here
            low, high = sorted((here, other))
        return high if rising else low

    by_entropy = crossing(lambda r: r.entropy >= target.entropy - 1e-12, rising=False)
    by_repeats = crossing(lambda r: r.repeats <= target.repeats + 1e-12, rising=True)
    return max(by_entropy, by_repeats)


@dataclass
class Mix:
    """A plan: per source (source, n_rows, n_tokens, share, weight, quota, epochs, cut); rows up to
    the hash ``cut`` occur once more than ``epochs`` times."""

    rows: DataFrame
    sources: DataFrame
    exponent: float
    budget: int


def order_key(id_column: str, text: str, seed: int) -> Column:
    """A row's place in its source's permutation."""
    return F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), text_of(text))


def plan_mix(
    docs: DataFrame,
    target: Target = Target(),
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    tokens: Column | None = None,
    seed: int = 5,
) -> Mix:
    """Weights of the sources and how often each row occurs. Texts are read once and not moved.

    The running token sums that place the cut are taken in runs of a source's permutation that hold
    about ``ROWS_PER_RUN`` rows: sums of runs add up first, then rows within their run, so no source
    is summed by one task.
    """
    size = tokens if tokens is not None else word_tokens(text)
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.greatest(size.cast("bigint"), F.lit(1)).alias("n"),
        order_key(id_column, text, seed).alias("key"),
    )
    rows = save(rows, "mix-rows")
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_tokens"))
    sources = save(sources, "mix-totals")
    total = sources.agg(F.sum("n_tokens")).first()[0] or 0
    sources = sources.withColumn("share", F.col("n_tokens") / F.lit(float(total or 1)))
    exponent = fit_exponent(sources, target)
    raw = _weight(F.lit(exponent))
    scale = sources.agg(F.sum(raw).alias("w"), F.min(raw / F.col("share")).alias("least")).first()
    # The source that is weighted down most is shown once.
    budget = target.budget or round(total * (scale.w or 1.0) / (scale.least or 1.0))
    sources = sources.withColumn("weight", raw / F.lit(scale.w or 1.0))
    quota = F.round(F.col("weight") * F.lit(float(budget))).cast("bigint")
    sources = sources.withColumn("quota", quota if target.budget else F.greatest(quota, "n_tokens"))
    sources = sources.withColumns(
        {
            "epochs": F.floor(F.col("quota") / F.col("n_tokens")).cast("int"),
            "rest": F.expr("quota % n_tokens"),
            "run_bits": F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_rows") / ROWS_PER_RUN))).cast("int"),
        }
    )
    sources = save(sources, "mix-sources")
    # A run is a range of the permutation's keys.
    run = F.expr("shiftrightunsigned(shiftrightunsigned(key ^ (-9223372036854775807 - 1), 1), 63 - run_bits)")
    placed = rows.join(sources.select("source", "run_bits"), "source").withColumn("run", run).drop("run_bits")
    placed = save(placed, "mix-placed")
    runs = placed.groupBy("source", "run").agg(F.sum("n").alias("run_tokens"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = save(runs.withColumn("before", F.coalesce(F.sum("run_tokens").over(before), F.lit(0))), "mix-runs")
    within = Window.partitionBy("source", "run").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("up_to", F.sum("n").over(within)).join(runs.drop("run_tokens"), ["source", "run"])
    summed = save(
        summed.select("id", "source", "n", "key", (F.col("before") + F.col("up_to") - F.col("n")).alias("position")),
        "mix-positions",
    )
    last = summed.join(sources.select("source", "rest"), "source").where(F.col("position") < F.col("rest"))
    cuts = save(last.groupBy("source").agg(F.max("key").alias("cut")), "mix-cuts")
    sources = save(sources.drop("rest", "run_bits").join(cuts, "source", "left"), "mix-plan")
    return Mix(summed, sources, exponent, budget)


def _times(key: Column) -> Column:
    """How often a row occurs: ``epochs``, and once more up to the cut."""
    return F.col("epochs") + F.coalesce(key <= F.col("cut"), F.lit(False)).cast("int")


def mix_order(mix: Mix, target: Target = Target(), seed: int = 5) -> DataFrame:
    """(id, source, n_tokens, epoch, block, place): the occurrences in the order of the mix.

    A source's occurrences lie along its quota, epoch after epoch in the order of its permutation;
    the quota is cut into as many equal parts as there are blocks, and a block takes one part of
    each source. So every block has the weights of the whole, and about ``target.block`` tokens. Within a
    block the occurrences are permuted by hash.
    """
    blocks = max(1, -(-mix.budget // target.block))
    rows = mix.rows.join(mix.sources.select("source", "n_tokens", "quota", "epochs", "cut"), "source")
    each = rows.withColumn("epoch", F.explode(F.expr("sequence(0, epochs)"))).where(F.col("epoch") < _times(F.col("key")))
    at = F.col("epoch") * F.col("n_tokens") + F.col("position")
    block = F.least(F.floor(at / F.greatest("quota", F.lit(1)) * blocks), F.lit(blocks - 1))
    each = each.select("id", "source", F.col("n").alias("n_tokens"), "epoch", block.alias("block"), "key")
    shuffled = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "key", "epoch"), "source", "id")
    return each.withColumn("place", F.row_number().over(shuffled) - 1).drop("key")


def mix_sources(
    docs: DataFrame,
    target: Target = Target(),
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    tokens: Column | None = None,
    seed: int = 5,
) -> DataFrame:
    """The occurrences of all rows in the mix: (id, source, n_tokens, epoch, block, place).

    A source's weight is its share of tokens to a power, scaled: the largest power that gives the
    target entropy, raised if a source would be repeated too often (``Target``). Without a budget
    the source that is weighted down most is shown once, so no row is lost; with one, a source may
    get less than an epoch, and its rows up to the quota along a permutation by hash are in. A quota is
    met by the row that reaches it.

    Sizes are words plus one unless ``tokens`` says otherwise; less than 1 counts as 1. A null
    source is the source with the empty name. Null ids and null texts are rows like others. Rows
    that repeat id and text share one place in the permutation and are in or out together. One
    source alone has weight 1. An empty table gives an empty table. Other columns are not read.
    """
    return mix_order(plan_mix(docs, target, id_column, text, source, tokens, seed), target, seed)


def mixed_rows(
    docs: DataFrame,
    target: Target = Target(),
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 5,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix has it; texts stay where they are.

    Whether a row is in an epoch depends on its own key and its source's plan alone.
    """
    mix = plan_mix(docs, target, id_column, text, source, None, seed)
    name, key, epoch = fresh(docs, "mix_source"), fresh(docs, "mix_key"), fresh(docs, "mix_epoch")
    plan = mix.sources.select(F.col("source").alias(name), "epochs", "cut")
    plan = plan.withColumnsRenamed({"epochs": fresh(docs, "mix_epochs"), "cut": fresh(docs, "mix_cut")})
    epochs, cut = plan.columns[1:]
    named = docs.withColumns(
        {
            name: F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")),
            key: order_key(id_column, text, seed),
        }
    )
    # A source table of a proven size would do for a broadcast; Spark decides by its measured size.
    planned = named.join(plan, name, "left")
    times = F.col(epochs) + F.coalesce(F.col(key) <= F.col(cut), F.lit(False)).cast("int")
    shown = planned.where(times > 0).withColumn(epoch, F.explode(F.sequence(F.lit(1), times)))
    return shown.select(docs.columns)


def in_blocks(
    docs: DataFrame,
    block: str,
    target: Target = Target(),
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 5,
) -> DataFrame:
    """The rows of a mix with a further column ``block``: which part of the mix each occurrence is in.

    As in ``mix_order``, a source's occurrences lie epoch after epoch in the order of its permutation,
    and every block takes an equal part of each source. Here that is read off the mixed rows themselves:
    copies of a row are numbered by epoch, a row's place in an epoch is that of its key among all keys, and a source
    ends with the last place in its last epoch. There are as many blocks as ``target.block`` words fit in, at
    six bytes a word, and more than any row has copies, so copies lie in different blocks.

    Only rows of sources that have repeated rows are shuffled with their texts; the copies of one row, as many as
    the mix has made, meet in one task. Rows with null ids, sources or texts are rows like others. An empty
    table gives an empty table.
    """
    name, key, extent, copy = (fresh(docs, f"mix_{c}") for c in ("source", "key", "extent", "copy"))
    keyed = docs.withColumns(
        {name: F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")), key: order_key(id_column, text, seed)}
    )
    within = (F.col(key).cast("double") + 2.0**63) / 2.0**64
    sizes = keyed.select(name, key, F.octet_length(text_of(text)).cast("bigint").alias("n"))
    rows = sizes.groupBy(name, key).agg(F.count(F.lit(1)).alias("copies"), F.sum("n").alias("n"))
    last = F.max(F.struct("copies", within.alias("within"))).alias("last")
    sources = rows.groupBy(name).agg(last, F.sum("n").alias("n"))
    ends = F.when(F.col("last.copies") > 1, F.col("last.copies") - 1 + F.col("last.within")).otherwise(1.0)
    sources = save(sources.select(name, F.col("last.copies").alias(copy), ends.alias(extent), "n"), "mix-extents")
    whole = sources.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max(copy), F.lit(1)).alias("most")).first()
    blocks = max(-(-whole.n // (6 * target.block)), whole.most + 1 if whole.most > 1 else 1)
    planned = keyed.join(sources.drop("n"), name)
    numbered = F.row_number().over(Window.partitionBy(name, key).orderBy(F.lit(0))) - 1
    placed = planned.where(F.col(copy) == 1).withColumn(copy, F.lit(0)).unionByName(
        planned.where(F.col(copy) > 1).withColumn(copy, numbered)
    )
    at = (F.col(copy) + within) / F.col(extent)
    return placed.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.least(F.floor(at * blocks), F.lit(blocks - 1)).cast("bigint").alias(block),
    )
