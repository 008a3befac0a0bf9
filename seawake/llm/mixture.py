"""Mixing sources to target weights: budgets down a tree, then token prefixes of seeded epochs. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.llm.common import written

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"
NONE = "(none)"
EXACT = "decimal(38,0)"
BEFORE = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Mix:
    """Integer weights by name for each level (others weigh ``default``), the budget as a share of the corpus' tokens,
    the most epochs of a document and the seed of their orders. ``domains`` maps the last digit of a source to its
    domain."""
    domains: Mapping[str, str] = field(default_factory=dict)
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    default: int = 1
    budget_percent: int = 60
    epochs: int = 2
    seed: int = 20240101


def by_name(column: Column, values: Mapping, default) -> Column:
    found = F.lit(default)
    for name, value in values.items():
        found = F.when(column == name, F.lit(value)).otherwise(found)
    return found


def tree_columns(mix: Mix) -> list[Column]:
    """The three levels and the number of tokens (words) of a document."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(NONE))
    return [
        by_name(F.regexp_extract(source, "([0-9])$", 1), mix.domains, "other").alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), source.alias("source"),
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens")]


def shares(nodes: DataFrame, parent: tuple[str, ...], name: str) -> DataFrame:
    """Divides each parent's ``budget`` among its children by weight, none beyond its capacity.

    Children are taken in the order of capacity over weight: one is full if, of what the fuller ones before it leave,
    its part is no less than its capacity. The rest is divided by weight, rounded on running sums, so that the parts add
    up to the budget. As a node's capacity is that of its whole subtree, a shortage is made up by siblings before it
    is felt above.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("capacity").cast("double") / F.col("weight").cast("double"), name)
    earlier, whole = order.rowsBetween(*BEFORE), Window.partitionBy(*parent)
    zero = F.lit(0).cast(EXACT)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(earlier), zero)
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), zero)
    nodes = nodes.withColumn("full", F.col("capacity") * weight_left <= left * F.col("weight"))
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), zero)
    open_weight = F.when(~F.col("full"), F.col("weight")).otherwise(zero)
    nodes = nodes.withColumns({"rest": F.col("budget") - taken, "open": F.sum(open_weight).over(whole),
                               "upto": F.sum(open_weight).over(order), "own": open_weight})
    part = F.expr("(rest * upto) div open - (rest * (upto - own)) div open")
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(part).cast(EXACT)).drop(
        "full", "rest", "open", "upto", "own")


def leaf_budgets(docs: DataFrame, mix: Mix) -> DataFrame:
    """domain, lang, source, tokens and docs of each leaf, and its budget.

    Only sums by leaf are windowed. A name with weight 0 has no capacity, nor has what is below it.
    """
    leaves = docs.groupBy(*LEVELS).agg(F.sum("n_tokens").cast(EXACT).alias("tokens"), F.count("*").alias("docs"))
    weights = {level: by_name(F.col(level), mix.weights.get(level, {}), mix.default).cast(EXACT) for level in LEVELS}
    some = weights["domain"] * weights["lang"] * weights["source"] > 0
    leaves = leaves.withColumn("capacity", F.when(some, F.col("tokens") * mix.epochs).otherwise(0).cast(EXACT))
    nodes = None
    for depth in range(1, len(LEVELS) + 1):
        path = LEVELS[:depth]
        level = leaves.groupBy(*path).agg(*[F.sum(c).cast(EXACT).alias(c) for c in ("capacity", "tokens")]).withColumn(
            "weight", F.greatest(weights[path[-1]], F.lit(0)).cast(EXACT))
        if nodes is None:  # a row for each domain
            every = Window.partitionBy()
            asked = F.floor(F.sum("tokens").over(every) * mix.budget_percent / 100)
            level = level.withColumn("budget", F.least(asked, F.sum("capacity").over(every)).cast(EXACT))
        else:
            level = level.join(nodes.select(*path[:-1], "budget"), list(path[:-1]))
        nodes = shares(level.filter("capacity > 0"), path[:-1], path[-1])
    return leaves.drop("capacity").join(nodes.select(*LEVELS, "budget"), list(LEVELS), "left").withColumn(
        "budget", F.coalesce("budget", F.lit(0)).cast("long"))


def _place(mix: Mix) -> Column:
    """Where a document stands in its leaf's last epoch: a hash of seed, epoch and doc_id."""
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), (F.col("whole") + 1).cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(NONE))).cast("binary"))


BUCKET_DIGITS = 4


def leaf_plans(rows: DataFrame, mix: Mix) -> DataFrame:
    """For each leaf: ``whole`` epochs, then ``rest`` tokens of the next, which end inside the bucket ``cut`` after
    ``cut_before`` tokens.

    Places are dealt to at most 16 ** BUCKET_DIGITS buckets by their first digits, and only the buckets' sums are run
    up, so that no task sees a leaf's documents together.
    """
    leaves = written(leaf_budgets(rows, mix).filter("budget > 0").select(
        *LEVELS, F.expr("cast(budget div tokens as long)").alias("whole"),
        F.expr("cast(budget % tokens as long)").alias("rest")).repartition(1), "leaves")  # one file: its size is seen
    buckets = rows.join(leaves.filter("rest > 0"), list(LEVELS)).groupBy(
        *LEVELS, F.substring(_place(mix), 1, BUCKET_DIGITS).alias("cut")).agg(
        F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    order = Window.partitionBy(*LEVELS).orderBy("cut").rowsBetween(*BEFORE)
    ends = buckets.withColumn("cut_before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    ends = ends.filter("cut_before < rest and rest <= cut_before + n").select(*LEVELS, "cut", "cut_before")
    return written(leaves.join(ends, list(LEVELS), "left").repartition(1), "plans")


def select_prefixes(rows: DataFrame, mix: Mix) -> DataFrame:
    """Columns of ``rows`` and, for each epoch that a document is taken in, ``epoch`` and ``taken``, its first tokens.

    The plans are read from a table, so Spark knows their size when it picks the join; documents are not shuffled as
    long as the plans are small enough to be sent. Only the bucket that holds a leaf's end is put in order.
    """
    rows = rows.filter("n_tokens > 0")
    plans = leaf_plans(rows, mix)
    placed = rows.join(plans, list(LEVELS)).withColumn("place", _place(mix))
    bucket = F.substring("place", 1, BUCKET_DIGITS)
    columns = [*rows.columns, "epoch", "taken"]
    epochs = F.col("whole") + F.coalesce((bucket < F.col("cut")).cast("long"), F.lit(0))
    full = placed.withColumn("epochs", epochs).filter("epochs > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int")))).withColumn("taken", F.col("n_tokens"))
    order = Window.partitionBy(*LEVELS).orderBy("place", F.col("doc_id").asc_nulls_first(), "n_tokens").rowsBetween(*BEFORE)
    last = placed.filter(bucket == F.col("cut"))
    before = F.col("cut_before") + F.coalesce(F.sum("n_tokens").over(order), F.lit(0))
    last = last.withColumn("taken", F.least(F.col("n_tokens"), F.col("rest") - before)).filter("taken > 0").withColumn(
        "epoch", (F.col("whole") + 1).cast("int"))
    return full.select(*columns).unionByName(last.select(*columns))


def mixture(docs: DataFrame, mix: Mix) -> DataFrame:
    """What is taken of every document: doc_id, domain, lang, source, n_tokens, epoch, taken.

    The tree is domain, language, source. The budget (``budget_percent`` of the corpus' tokens) is divided from the
    root down by weight; what a node lacks goes to its siblings, and only what all of them lack to its parent's. Each
    leaf then takes whole epochs, and of the next epoch, whose order is a seeded hash, the documents up to its budget;
    the last one is taken in part. A leaf gives at most ``epochs`` epochs; if the whole tree lacks tokens, all it has
    is taken.

    A null lang or source is a name of its own, as is a source without a final digit ("other"). Null and empty texts
    have no tokens and are never taken. Null doc_ids share a place; repeated rows are taken one by one. Other
    columns are ignored. An empty table gives an empty result.
    """
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *tree_columns(mix)), "tokens")
    return select_prefixes(rows, mix)


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mixture as documents: a row for each epoch with doc_id, text, lang, source and n_chars. A document taken in
    part ends after its last token; n_chars is then counted anew."""
    kept = [F.col(c).alias(f"given_{c}") for c in ("lang", "source", "n_chars")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *kept, *tree_columns(mix))
    taken = select_prefixes(rows, mix)
    word_ends = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    part = F.col("taken") < F.col("n_tokens")
    text = F.when(part, F.array_join(F.slice(word_ends, F.lit(1), F.col("taken").cast("int")), "")).otherwise(F.col("text"))
    taken = taken.withColumn("text", text)
    n_chars = F.when(part, F.length("text").cast("long")).otherwise(F.col("given_n_chars").cast("long"))
    return taken.select("doc_id", "text", F.col("given_lang").alias("lang"), F.col("given_source").alias("source"),
                        n_chars.alias("n_chars"))
