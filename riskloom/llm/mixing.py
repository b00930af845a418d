"""Mixing sources to target weights: hierarchical token budgets, seeded epoch prefixes.

The budget goes down the tree domain, language, source by weight. A node can take at most
``max_epochs`` times the tokens below it; what it can't take goes to its siblings by
their weights, and only if all of them are full does the parent stay short and its own
siblings share the rest. A leaf whose budget is q times its tokens and a rest takes q
whole epochs, and of the next one the prefix that fits, in the order of
md5(seed|epoch|doc_id).

All steps are DataFrame operations. Texts are never shuffled: the prefix of a leaf is found
as a cut in the md5 order, first among buckets of equal leading digits, then inside the
one bucket that the cut falls in; choosing rows is then a filter.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, word_count
from riskloom.session import written

LEVELS = ("domain", "lang", "source")
# A bucket of the md5 order holds about so many rows of the largest leaf.
BUCKET_ROWS = 4096
_WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Target:
    """Weights by level and name; names that are not listed weigh ``other``.

    ``domains`` is the number of domains that ``domain_of`` makes. A weight of 0 leaves a
    node out.
    """

    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    other: int = 1
    budget_percent: int = 80
    max_epochs: int = 2
    seed: int = 42
    domains: int = 3


# Weights of the registered query and of the pipeline.
TARGET = Target(
    weights={
        "domain": {"domain0": 3, "domain1": 2, "domain2": 2},
        "lang": {"en": 4, "de": 2, "fr": 2, "es": 1},
        "source": {"src0": 2},
    }
)


def leaf_columns(target: Target) -> dict[str, Column]:
    """Names of a row's leaf by level. The domain follows from the number at the end of the
    source; rows without language, source or number go by ``unknown``."""
    source = F.coalesce(F.col("source").cast("string"), F.lit("unknown"))
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    domain = F.when(number == "", F.lit("unknown")).otherwise(
        F.concat(F.lit("domain"), number.try_cast("int") % target.domains)
    )
    return {
        "domain": domain,
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit("unknown")),
        "source": source,
    }


def _weight(level: str, target: Target) -> Column:
    out = F.lit(target.other)
    for name, weight in target.weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(weight)).otherwise(out)
    return out.cast(_WIDE)


def _shared(nodes: DataFrame, parents: list[str], level: str, target: Target) -> DataFrame:
    """``nodes`` (parents, level, capacity, given: the parent's budget) with their budget.

    Siblings are ordered by capacity for each unit of weight. In that order a node is full
    if its fair share of what the full ones before it have left is at least its capacity;
    the others share the rest by weight, rounded down.
    """
    siblings = Window.partitionBy(*parents)
    order = siblings.orderBy(F.col("capacity").cast("double") / F.col("weight").cast("double"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    nodes = nodes.withColumn("weight", _weight(level, target)).where("weight > 0")
    nodes = nodes.withColumns(
        {
            "taken": F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(_WIDE),
            "weights": F.sum("weight").over(onward).cast(_WIDE),
        }
    ).withColumn("full", F.expr("capacity * weights <= weight * (given - taken)"))
    nodes = nodes.withColumns(
        {
            "taken": F.sum(F.expr("if(full, capacity, 0)")).over(siblings).cast(_WIDE),
            "weights": F.sum(F.expr("if(full, 0, weight)")).over(siblings).cast(_WIDE),
        }
    )
    budget = F.expr(
        "if(full, capacity, cast((weight * (given - taken)) div greatest(weights, 1) as decimal(38,0)))"
    )
    return nodes.select(*parents, level, "capacity", budget.cast(_WIDE).alias("budget"))


def budgets(leaves: DataFrame, target: Target) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with their token budgets."""
    leaves = leaves.select(
        *LEVELS, (F.col("tokens").cast(_WIDE) * target.max_epochs).cast(_WIDE).alias("capacity")
    )
    for level in LEVELS:
        leaves = leaves.where(_weight(level, target) > 0)
    total = leaves.agg(F.sum("capacity")).first()[0] or Decimal(0)
    wanted = int(total) * target.budget_percent // (100 * target.max_epochs)
    given, parents = F.lit(Decimal(min(int(total), wanted))).cast(_WIDE), []
    for depth, level in enumerate(LEVELS):
        nodes = leaves.groupBy(*LEVELS[: depth + 1]).agg(F.sum("capacity").cast(_WIDE).alias("capacity"))
        # the total is one number; below, a node's budget is what its children are given
        nodes = nodes.join(given, parents) if parents else nodes.withColumn("given", given)
        shared = _shared(nodes, parents, level, target)
        parents = list(LEVELS[: depth + 1])
        given = shared.select(*parents, F.col("budget").alias("given"))
    return shared


def _order(target: Target, epoch: str, doc_id: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(target.seed)), F.col(epoch), F.col(doc_id)).cast("binary"))


def plan(docs: DataFrame, target: Target) -> DataFrame:
    """Per leaf: budget, whole epochs, and the md5 cut of the epoch after them.

    Rows without tokens belong to no leaf.
    """
    rows = written(
        docs.select(
            F.col("doc_id").cast("string").alias("doc_id"),
            *[c.alias(n) for n, c in leaf_columns(target).items()],
            word_count().alias("n_tokens"),
        ).where("n_tokens > 0"),
        "mix-rows",
    )
    leaves = written(
        rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")), "leaves"
    )
    largest = leaves.agg(F.max("n")).first()[0] or 1
    digits = max(1, ceil(log(max(largest / BUCKET_ROWS, 1), 16)))
    keys = list(LEVELS)
    leaf = written(
        budgets(leaves, target)
        .join(leaves, keys)
        .selectExpr(
            *keys,
            "cast(budget as bigint) as budget",
            "tokens",
            "cast(budget div tokens as bigint) as epochs",
            "cast(budget % tokens as bigint) as rest",
        ),
        "budgets",
    )
    ordered = rows.join(leaf, keys).withColumn("at", _order(target, "epochs", "doc_id"))
    bucket = F.substring("at", 1, digits)
    sums = ordered.groupBy(*keys, bucket.alias("bucket")).agg(
        F.sum("n_tokens").alias("in_bucket"), F.first("rest").alias("rest")
    )
    upto = F.sum("in_bucket").over(Window.partitionBy(*keys).orderBy("bucket"))
    edge = (
        sums.withColumn("upto", upto)
        .where("upto > rest")
        .groupBy(*keys)
        .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("in_bucket")).alias("before")), "bucket").alias("e"))
        .select(*keys, "e.bucket", "e.before")
    )
    edge = written(edge, "edges")
    # rows of equal order count together, so the cut depends on the order alone
    running = Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    cut = (
        ordered.withColumn("bucket", bucket)
        .join(edge, [*keys, "bucket"])
        .withColumn("upto", F.col("before") + F.sum("n_tokens").over(running))
        .where("upto <= rest")
        .groupBy(*keys)
        .agg(F.max("at").alias("cut"))
    )
    return written(
        leaf.join(edge, keys)
        .join(cut, keys, "left")
        .select(*keys, "budget", "tokens", "epochs", F.coalesce("cut", "bucket").alias("cut")),
        "mix-plan",
    )


def mix(docs: DataFrame, target: Target = TARGET) -> DataFrame:
    """Chosen rows of ``docs``, all columns, and ``mix_epoch``, 0 for the first time.

    A row that is chosen in several epochs comes once for each. Rows without words are left
    out, as are those of nodes with a weight of 0. Rows of one doc_id in a leaf stay
    together; those without a doc_id count as one. An empty table gives no rows. The names
    that this adds meanwhile avoid those of ``docs``.
    """
    names = {n: fresh(docs.columns, f"mix_{n}") for n in (*LEVELS, "n", "cut", "epochs", "epoch")}
    chosen = plan(docs, target).select(
        *[F.col(n).alias(names[n]) for n in LEVELS],
        F.col("epochs").alias(names["epochs"]),
        F.col("cut").alias(names["cut"]),
    )
    columns = {names[n]: c for n, c in leaf_columns(target).items()}
    at = _order(target, names["epochs"], "doc_id")
    times = F.col(names["epochs"]) + (at <= F.col(names["cut"])).cast("long")
    return (
        docs.withColumns(columns)
        .where(word_count() > 0)
        .join(chosen, [names[n] for n in LEVELS])
        .withColumn(names["n"], times)
        .where(F.col(names["n"]) > 0)
        .withColumn(names["epoch"], F.explode(F.sequence(F.lit(0), (F.col(names["n"]) - 1).cast("int"))))
        .select(*docs.columns, F.col(names["epoch"]).alias(fresh(docs.columns, "mix_epoch")))
    )


def mixed(docs: DataFrame, target: Target = TARGET) -> DataFrame:
    """Chosen rows as doc_id, domain, lang, source, n_tokens, epoch; others are left out."""
    rows = docs.select("doc_id", "text", "lang", "source")
    chosen = mix(rows, target)
    leaf = leaf_columns(target)
    return chosen.select(
        "doc_id",
        *[leaf[n].alias(n) for n in LEVELS],
        word_count().alias("n_tokens"),
        F.col("mix_epoch").alias("epoch"),
    )
