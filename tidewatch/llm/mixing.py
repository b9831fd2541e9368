"""Mixing sources to target weights by hierarchical budgeting.

Documents form a tree of domain, language and source.  A token budget is
handed down it: at each node the children share their parent's budget by
weight; what a child cannot use (it offers its tokens times ``max_epochs``)
goes to its siblings, and only what all of them cannot use to the siblings of
an ancestor.  Each source then takes whole epochs of its documents, and of the
next epoch the longest prefix, in that epoch's seeded order, whose tokens fit.

DataFrame operations only.  Sources are measured by pre-aggregated counts, and
the last prefix is found by the sums of hash ranges and then inside one hash
range, so no source is sorted or gathered whole.  Budgets are whole tokens and
rounded down, at most one token a node being lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.llm.frames import stored

LEVELS = ["domain", "language", "origin"]
#: hash ranges of a source's epoch: this many hexadecimal digits
DIGITS = 3


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """Default domain: last digits of the source's name, modulo 4 (`other` without)."""
    digits = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(digits == "", "other").otherwise(
        F.concat(F.lit("d"), (F.when(digits != "", digits).cast("int") % 4).cast("string")))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in the seeded order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _weight(name: Column, weights: dict[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv]) if weights else None
    return F.lit(1).cast("long") if known is None else F.coalesce(F.try_element_at(known, name), F.lit(1)).cast("long")


def _share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes (parent keys, name, cap, weight, total: the parent's budget) with
    ``budget``: total shared by weight, none above its cap."""
    key = parent or [F.lit(0)]
    before = Window.partitionBy(*key).orderBy("ratio", name).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(*key).orderBy("ratio", name).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight"))
                            .otherwise(0.0)) \
        .withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        .withColumn("rest", F.sum("weight").over(onward))
    # sorted by cap / weight, the children that reach their cap come first
    full = F.col("cap").cast("double") * F.col("rest") <= F.col("weight").cast("double") * (F.col("total") - F.col("used"))
    rows = rows.withColumn("full", full)
    every = Window.partitionBy(*key)
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0))
    open_ = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    part = F.floor((F.col("total") - spent).cast("double") * F.col("weight") / F.when(open_ > 0, open_))
    return rows.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(
        F.least("cap", part)).cast("long")).drop("ratio", "used", "rest", "full", "total")


def budgets(leaves: DataFrame, total: Column, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """leaves (domain, language, origin, tokens) with ``budget`` tokens; total:
    the whole budget, in terms of ``every`` (the tokens of all leaves)."""
    cap = F.col("tokens") * max_epochs
    for level in LEVELS:
        leaves = leaves.withColumn(f"w_{level}", _weight(F.col(level), weights.get(level, {})))
    useful = (F.col("w_domain") > 0) & (F.col("w_language") > 0) & (F.col("w_origin") > 0)
    leaves = leaves.withColumn("cap", F.when(useful, cap).otherwise(0))
    out = None
    for depth in range(3):
        keys, level = LEVELS[:depth + 1], LEVELS[depth]
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.max(f"w_{level}").alias("weight"), F.sum("tokens").alias("tokens"))
        if out is None:
            nodes = nodes.withColumn("every", F.sum("tokens").over(Window.partitionBy(F.lit(0)))).withColumn("total", total)
        else:
            nodes = nodes.join(out.withColumnRenamed("budget", "total"), keys[:-1])
        out = _share(nodes, keys[:-1], level).select(*keys, "budget")
    return leaves.select(*LEVELS, "tokens").join(out, LEVELS)


def mix(docs: DataFrame, share: tuple[int, int] = (1, 1), weights: dict[str, dict[str, int]] | None = None,
        max_epochs: int = 4, seed: int = 0, domain=domain_of, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang", source: str = "source") -> DataFrame:
    """The selected documents: columns of docs, and domain, n_tokens (long) and
    epoch (int, from 1); one row for each epoch that uses a document.

    share: the budget as a fraction of all tokens.  weights: whole numbers by
    level (``domain``, ``language``, ``origin``) and name, 1 where none is
    given, 0 to leave out.  A null language or source counts as the empty
    name; texts without words have no tokens and come along where the prefix
    reaches them; rows that share a doc_id are taken or left together in a
    prefix.  Input columns named domain, n_tokens or epoch are replaced.  An
    empty table gives an empty result.
    """
    docs = docs.drop("domain", "n_tokens", "epoch")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    tree = [domain(F.col(source)).alias("domain"), name(lang).alias("language"), name(source).alias("origin")]
    narrow = stored(docs.select(F.col(doc_id).alias("id"), *tree, n_words(F.col(text).cast("string")).alias("n")), "tokens")
    leaves = stored(narrow.groupBy(*LEVELS).agg(F.sum("n").alias("tokens")), "leaves")
    total = F.floor(F.col("every").cast("double") * share[0] / share[1]).cast("long")
    plan = budgets(leaves, total, weights or {}, max_epochs) \
        .withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div nullif(tokens, 0)")).otherwise(0).cast("int")) \
        .withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") % F.expr("nullif(tokens, 0)")).otherwise(0))
    plan = stored(plan, "plan")

    # hash range in which the last prefix of each source ends
    key = order_key(seed, F.col("whole") + 1, F.col("id"))
    last = narrow.join(plan.where("rest > 0"), LEVELS).withColumn("key", key) \
        .withColumn("range", F.substring("key", 1, DIGITS))
    sums = last.groupBy(*LEVELS, "range", "rest").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*LEVELS).orderBy("range")
    sums = sums.withColumn("upto", F.sum("n").over(upto))
    # the first range that does not fit; all before it do
    ends = sums.where("upto > rest").groupBy(*LEVELS).agg(
        F.min("range").alias("cut_range"), F.min(F.col("upto") - F.col("n")).alias("before"))
    # joined by source and range, so that the rows of one source go to many tasks
    inside = last.join(ends.withColumnRenamed("cut_range", "range"), [*LEVELS, "range"])
    reach = Window.partitionBy(*LEVELS, "range").orderBy("key")
    cut = inside.withColumn("reach", F.col("before") + F.sum("n").over(reach)).where("reach <= rest") \
        .groupBy(*LEVELS).agg(F.max("key").alias("cut_key"))
    plan = stored(plan.join(ends.select(*LEVELS, "cut_range"), LEVELS, "left").join(cut, LEVELS, "left"), "cuts")

    columns = docs.columns
    own = docs.select(F.struct(*columns).alias("row"), F.col(doc_id).alias("id"), *tree,
                      n_words(F.col(text).cast("string")).alias("n_tokens")).join(plan, LEVELS)
    key = order_key(seed, F.col("whole") + 1, F.col("id"))
    # a range's bare digits sort before every key in it
    more = (F.col("rest") > 0) & (key <= F.coalesce("cut_key", "cut_range"))
    count = F.col("whole") + F.when(more, 1).otherwise(0)
    out = own.withColumn("epoch", F.explode(F.when(count > 0, F.sequence(F.lit(1), count))))
    return out.select("row.*", "domain", "n_tokens", "epoch")
