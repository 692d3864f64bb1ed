"""Mixing sources to target weights, in DataFrame operations only.

Weights propagate down a domain - language - source tree. Every node shares
its budget among its children by weight, but none gets more than it can supply
(its tokens times ``max_epochs``): what one cannot use goes to its siblings,
and only what all of them cannot use is left to the ancestors' level. Each
leaf then takes whole epochs and a prefix, by tokens, of one more epoch whose
order is seeded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise, row_key, text_of

LEVELS = ("domain", "lang", "source")
SALTS = 16
_WORD = r"[^\x20\x09-\x0D]+"
_BIG = "decimal(20,0)"
# Production parameters: relative weights by node; 1 where none is given.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
MAX_EPOCHS = 3
SEED = 17


def words(text: Column) -> Column:
    """Number of words, without a list of them."""
    marks = F.regexp_replace(F.regexp_replace(text, _WORD, "x"), r"[\x20\x09-\x0D]+", "")
    return F.length(marks).cast("long")


def domain_of(source: Column) -> Column:
    """The production domains: the source's number modulo four."""
    number = F.try_to_number(F.regexp_extract(source, r"(\d{1,9})$", 1), F.lit("999999999"))
    return F.coalesce(F.concat(F.lit("d"), F.pmod(number.cast("long"), F.lit(4)).cast("string")), F.lit("other"))


def weight(key: Column, weights: dict[str, int]) -> Column:
    pairs = [F.lit(x) for kv in weights.items() for x in kv]
    found = F.create_map(*pairs)[key] if pairs else F.lit(None)
    return F.coalesce(found, F.lit(1)).cast(_BIG)


def share(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds ``share``: the part of ``budget`` (the parent's, on each child) by
    ``weight``, none above ``cap``. Children that cannot use their part are
    those of the smallest cap for their weight; the others divide the rest.
    Whole numbers; fewer tokens than children may stay undivided."""
    ratio = F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight").cast("double"))
    order = Window.partitionBy(*parent).orderBy(ratio.asc_nulls_last(), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = children.withColumns({
        "place": F.row_number().over(order),
        "left": F.greatest(F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)), F.lit(0)).cast(_BIG),
        "weights": F.sum("weight").over(onward).cast(_BIG)})
    full = F.col("cap") * F.col("weights") <= F.col("weight") * F.col("left")
    level = F.min(F.when(~full, F.struct("place", "left", "weights"))).over(Window.partitionBy(*parent))
    rows = rows.withColumn("level", level)
    part = F.expr("coalesce(cast(weight * level.left as decimal(38,0)) div nullif(level.weights, 0), 0)")
    return rows.withColumn("share", F.when(
        F.col("level").isNull() | (F.col("place") < F.col("level.place")), F.col("cap")).otherwise(
        part).cast("decimal(20,0)")).drop("place", "left", "weights", "level")


def leaf_budgets(leaves: DataFrame, budget: Column | None, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """(domain, lang, source, supply, share) of each leaf (domain, lang,
    source, supply). Without a budget, the whole supply is the budget."""
    rows = leaves.withColumn("cap", (F.col("supply") * max_epochs).cast(_BIG))
    levels = []
    for depth in range(1, len(LEVELS)):
        level = rows.groupBy(*LEVELS[:depth]).agg(F.sum("cap").cast(_BIG).alias("cap"), F.sum("supply").alias("supply"))
        levels.append(level)
    levels.append(rows)
    total = leaves.agg(F.sum("supply").cast(_BIG)).scalar() if budget is None else budget.cast(_BIG)
    up, parent = None, ["root"]
    for depth, level in enumerate(levels):
        key = LEVELS[depth]
        rows = level.withColumn("root", F.lit(0)).withColumn("weight", weight(F.col(key), weights.get(key, {})))
        rows = rows.withColumn("budget", total) if up is None else rows.join(up, parent)
        rows = share(rows, parent, key)
        parent = ["root", *LEVELS[:depth + 1]]
        up = rows.select(*parent, F.col("share").alias("budget"))
    return rows.select(*LEVELS, "supply", F.col("share").cast("long").alias("share"))


def select_mix(docs: DataFrame, weights: dict[str, dict[str, int]] | None = None, budget: int | None = None,
               max_epochs: int = MAX_EPOCHS, seed: int = SEED, key: Column | None = None) -> DataFrame:
    """One row per chosen document and epoch: doc_id, row_key (``key``, or 0),
    domain, lang, source, tokens, epoch (from 0), leaf_budget.

    ``docs``: doc_id, text, lang, source; others are ignored. Null lang or source is a node of its own name ""; null and blank
    texts have no tokens and come along with any epoch that reaches them. An
    epoch's order is the MD5 of seed, epoch and doc_id; the prefix ends before
    the first document that would exceed the budget. Its running sum is taken
    inside 4096 slices of the order, so that no task sees a whole leaf.
    """
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS} if weights is None else weights
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.lit(0) if key is None else key).cast("long").alias("row_key"),
                       domain_of(source).alias("domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       source.alias("source"), words(text_of("text")).alias("tokens"))
    rows = materialise(rows, "mix_rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply"))
    plan = leaf_budgets(leaves, None if budget is None else F.lit(budget), max_epochs, weights)
    plan = materialise(plan.select(*LEVELS, F.col("share").alias("leaf_budget"),
                                   F.expr("if(supply > 0, share div supply, if(share > 0, 1, 0))").alias("whole"),
                                   F.expr("if(supply > 0, share % supply, 0)").alias("rest")), "mix_plan")
    salted = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = (rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(SALTS)).cast("int"))
            .join(salted, [*LEVELS, "salt"]).drop("salt"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), "whole", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("order", order).withColumn("slice", F.substring("order", 1, 3))
    slices = rows.groupBy(*LEVELS, "slice").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*LEVELS, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*LEVELS, "slice").orderBy("order", "doc_id", "row_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("sum", F.sum("tokens").over(inside)).join(slices, [*LEVELS, "slice"])
    none = F.array().cast("array<bigint>")
    whole = F.when(F.col("whole") > 0, F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).otherwise(none)
    last = F.when((F.col("base") + F.col("sum") <= F.col("rest")) & (F.col("rest") > 0), F.array("whole")).otherwise(none)
    return rows.withColumn("epoch", F.explode(F.concat(whole, last))).select(
        "doc_id", "row_key", *LEVELS, "tokens", "epoch", "leaf_budget")


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """The chosen rows of ``docs`` in its own layout, once per epoch."""
    names = docs.columns
    key = row_key("doc_id", "text", "lang", "source")
    chosen = select_mix(docs, key=key, **options)
    # rows that repeat id and content are chosen together: each stands for its own epochs
    counts = chosen.groupBy("doc_id", "row_key").agg(F.countDistinct("epoch").alias("times"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").alias("_id"), key.alias("_key"))
    rows = rows.join(counts, (F.col("_key") == F.col("row_key")) & F.col("_id").eqNullSafe(F.col("doc_id")))
    rows = rows.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names])
