"""Mixing sources to target weights by hierarchical budgets.

The corpus is a tree: domain, language, source.  The token budget goes down
the tree in proportion to the weights of siblings.  No node gets more than its
subtree can give (its tokens times ``max_epochs``); what a node cannot take is
spread over its siblings by weight, and only what all of them together cannot
take reaches the siblings of their parent.  A leaf with quota q and h tokens
gives q div h whole epochs and, of one more epoch in a seeded order, the
longest prefix within the remaining tokens.

All sums are of whole tokens, and only DataFrame functions are used.  The tree
is a small stored table, so Spark broadcasts it after seeing its size.  A leaf
is never sorted as one group: the seeded keys fall in 4,096 buckets, sums by
bucket show which single one the prefix ends in, and only that is ordered.

Defined cases: a null domain, language or source counts as the empty string; a
row without tokens (null, empty or blank text) is never taken; repeated rows
each count; a weight of 0 excludes the subtree; an empty table gives an empty
result; other columns are carried along whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, staged

BUCKET_DIGITS = 3


def word_tokens(text: Column) -> Column:
    """The token measure of this operator: runs without ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


@dataclass(frozen=True)
class Mix:
    """Whole-number weights of siblings by level (``default`` for others), and the budget."""

    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    default: int = 1
    #: the budget as so many hundredths of all tokens
    percent: int = 60
    max_epochs: int = 2
    seed: str = "mix-1"

    def weight(self, level: str, name: Column) -> Column:
        out = F.lit(self.default).cast("long")
        for value, w in self.weights.get(level, {}).items():
            out = F.when(name == value, F.lit(w).cast("long")).otherwise(out)
        return out


def _share(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """``nodes`` (weight, cap, and its parent's budget) with the own quota as ``budget``.

    Siblings stand in the order in which they run full.  The first that does
    not run full fixes the rate for itself and all after it.
    """
    among = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    turn = among.orderBy(F.col("cap") / F.col("weight"), "name")
    left = F.col("budget") - F.coalesce(F.sum("cap").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(turn.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    placed = nodes.withColumns({"left": left, "rest": rest, "place": F.row_number().over(turn)})
    open_ = F.col("cap") * F.col("rest") >= F.col("weight") * F.col("left")
    rate = F.min(F.when(open_, F.struct("place", "left", "rest"))).over(among)
    return (
        placed.withColumn("rate", rate)
        .withColumn(
            "budget",
            F.when(
                F.col("place") >= F.col("rate.place"), F.expr("weight * rate.left div rate.rest")
            ).otherwise(F.col("cap")),
        )
        .drop("left", "rest", "place", "rate")
    )


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, have, quota) for the leaves that get a share of the budget.

    ``leaves`` has domain, lang, source and have, its tokens.
    """
    total = leaves.agg(F.sum("have")).first()[0] or 0
    usable = leaves.where("have > 0").withColumn("cap", F.col("have") * mix.max_epochs)
    for level in ("domain", "lang", "source"):
        usable = usable.withColumn(f"w_{level}", mix.weight(level, F.col(level)))
    usable = usable.where("w_domain > 0 and w_lang > 0 and w_source > 0")
    out, parents = None, []
    for level in ("domain", "lang", "source"):
        path = [*parents, level]
        nodes = usable.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first(f"w_{level}").alias("weight"))
        if out is None:
            nodes = nodes.withColumn(
                "budget",
                F.least(F.lit(total * mix.percent // 100), F.sum("cap").over(Window.partitionBy(F.lit(0)))),
            )
        else:
            nodes = nodes.join(out.select(*parents, "budget"), parents)
        out = _share(nodes.withColumn("name", F.col(level)), parents).drop("name", "cap", "weight")
        parents = path
    return usable.select(*parents, "have").join(out.withColumnRenamed("budget", "quota"), parents)


def mix_sources(
    docs: DataFrame, domain: Column, mix: Mix, id: str = "doc_id", lang: str = "lang", source: str = "source", text: str = "text"
) -> tuple[DataFrame, list[str]]:
    """``docs`` with added columns, and their names in order: domain, tokens, quota, copies.

    ``copies`` says how often the row is taken, 0 for a row left out.
    """
    dom, lng, src, tok, quota, copies, key, bucket, plan, cut = names = fresh(
        docs, "domain", "mixlang", "mixsource", "tokens", "quota", "copies", "key", "bucket", "plan", "cut"
    )
    tree = [dom, lng, src]
    tagged = docs.withColumns(
        {
            dom: F.coalesce(domain, F.lit("")),
            lng: F.coalesce(F.col(lang), F.lit("")),
            src: F.coalesce(F.col(source), F.lit("")),
            tok: word_tokens(F.col(text)),
        }
    )
    keys = staged(
        tagged.select(
            F.col(id).alias("id"), F.col(dom).alias("domain"), F.col(lng).alias("lang"), F.col(src).alias("source"), F.col(tok).alias("tokens")
        ),
        "mix-keys",
    )
    leaves = staged(keys.groupBy("domain", "lang", "source").agg(F.sum("tokens").alias("have")), "leaves")
    quotas = staged(
        budgets(leaves, mix).withColumns(
            {"epochs": F.expr("quota div have"), "extra": F.expr("quota % have")}
        ),
        "quotas",
    )

    def seeded(epoch: Column, id: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(mix.seed), epoch.cast("string"), id.cast("string")).cast("binary"))

    on = ["domain", "lang", "source"]
    sums = (
        keys.join(quotas, on)
        .where("tokens > 0")
        .withColumn("bucket", F.substring(seeded(F.col("epochs"), F.col("id")), 1, BUCKET_DIGITS))
        .groupBy(*on, "bucket")
        .agg(F.sum("tokens").alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy(*on).orderBy("bucket"))
    ends = (
        sums.withColumn("upto", upto)
        .join(quotas, on)
        .where("upto > extra")
        .groupBy(*on)
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("end"))
    )
    # one row a leaf; Spark sees its stored size before it chooses to broadcast it
    table = staged(
        quotas.join(ends, on).select(
            F.col("domain").alias(dom),
            F.col("lang").alias(lng),
            F.col("source").alias(src),
            F.struct("quota", "epochs", "extra", "end.bucket", "end.before").alias(plan),
        ),
        "mix-plan",
    )
    taken = tagged.join(table, tree, "left").where(F.lit(True)).withColumns(
        {quota: F.coalesce(F.col(f"{plan}.quota"), F.lit(0)), key: seeded(F.col(f"{plan}.epochs"), F.col(id))}
    )
    taken = taken.withColumn(bucket, F.substring(key, 1, BUCKET_DIGITS))
    at_end = F.coalesce((F.col(tok) > 0) & (F.col(bucket) == F.col(f"{plan}.bucket")), F.lit(False))
    clear = taken.where(~at_end).withColumn(
        copies,
        F.when(
            F.col(tok) > 0,
            F.coalesce(F.col(f"{plan}.epochs") + (F.col(bucket) < F.col(f"{plan}.bucket")).cast("long"), F.lit(0)),
        ).otherwise(F.lit(0)),
    )
    running = F.sum(tok).over(Window.partitionBy(*tree).orderBy(key, id, tok).rowsBetween(Window.unboundedPreceding, 0))
    ordered = (
        taken.where(at_end)
        .withColumn(cut, running)
        .withColumn(
            copies,
            F.col(f"{plan}.epochs") + (F.col(f"{plan}.before") + F.col(cut) <= F.col(f"{plan}.extra")).cast("long"),
        )
        .drop(cut)
    )
    added = [dom, tok, quota, copies]
    columns = [*docs.columns, *added]
    return clear.select(columns).unionByName(ordered.select(columns)), added


def take_copies(mixed: DataFrame, columns: list[str], copies: str) -> DataFrame:
    """Each taken row as often as it was taken."""
    (turn,) = fresh(mixed, "turn")
    return (
        mixed.where(F.col(copies) > 0)
        .withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select(columns)
    )
