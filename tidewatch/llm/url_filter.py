"""URL filter: rules first, then a character language-model ratio.

Two variable-order Markov models of the characters of host and path, one of
accepted and one of rejected URLs, are smoothed from order 0 up to ORDER: a
context that was seen gives its counts and passes the mass of as many events
as it has different continuations on to the next shorter context (Witten and
Bell); an unseen context leaves the shorter one's estimate as it is.  A URL's
score is the mean difference of the two log-probabilities per character.  The
score from which URLs are accepted is calibrated on a held-out fifth of the
labelled URLs, at the least mean error of the two classes.

DataFrame and SQL operations only.  Everything is counted over distinct URLs
with their number of rows, so a URL or host that holds a large part of the
table is one row; each character position is one row of an aggregation that is
combined before it is shuffled.  Log-ratios are summed as whole millionths, so
that results do not depend on the order of summation.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.frames import stored

#: characters of the longest context
ORDER = 4
#: characters assumed possible, for the uniform estimate below order 0
ALPHABET = 256
BEFORE, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: labelled URLs whose MD5 begins with one of these digits calibrate
HELD_OUT = "012"

Rule = tuple[str, str, str]     # host, path, verdict
#: rules up to which one expression tells the rule; more are a table
INLINE_RULES = 200
#: rows up to which the ratios, and the counts of one order, are broadcast; more are shuffled
RATIO_ROWS, COUNT_ROWS = 500_000, 100_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    get = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(get(1), UPPER, LOWER), get(2)


def rule_columns(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (ties: first by text,
    then in the order given)."""
    text = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, h + p) if text is None else text.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as rows: position, host, path, verdict."""
    listed = json.dumps([{"position": i, "host": h, "path": p, "verdict": v} for i, (h, p, v) in enumerate(rules)])
    kind = "array<struct<position:int,host:string,path:string,verdict:string>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(listed), kind)))


def judged_by_table(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows (with host and path) with ``rule`` and ``label`` as `rule_columns`
    gives them, by joins, for any number of rules.

    Each distinct host and path asks for its domains, one a label of the host,
    and of each domain's rules only for the lengths of path that occur there:
    equal domain and equal start of path is then a plain equi-join, so neither
    many rules of one domain nor many URLs of one host meet as all pairs.
    Rows of one host and path are one row until the verdict comes back.
    """
    rules = rules.select(F.col("host").alias("domain"), F.col("path").alias("start"), "verdict", "position")
    lengths = rules.groupBy("domain").agg(F.collect_set(F.length("start")).alias("lengths"))
    # the host, and what follows each of its dots
    labels = F.split("host", "[.]")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = rows.select("host", "path").distinct().withColumn("domain", F.explode(domains)).join(lengths, "domain") \
        .withColumn("size", F.explode("lengths")).where(F.length("path") >= F.col("size")) \
        .withColumn("start", F.substring("path", F.lit(1), F.col("size")))
    text = F.concat("domain", "start")
    best = F.min_by(F.struct(text.alias("rule"), F.col("verdict").alias("label")),
                    F.struct(-F.length(text), text, "position"))
    found = asked.join(rules, ["domain", "start"]).groupBy("host", "path").agg(best.alias("best"))
    return rows.join(found, ["host", "path"], "left") \
        .select(*rows.columns, F.col("best.rule").alias("rule"), F.col("best.label").alias("label"))


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """One row for each character of ``s`` and its end: ``keep``, and as
    ``gram`` ORDER characters before it and itself."""
    padded = F.concat(F.lit(BEFORE * ORDER), F.col("s"), F.lit(END))
    at = F.sequence(F.lit(1), F.length("s") + 1)
    return urls.select(*keep, padded.alias("padded"), F.explode(at).alias("i")) \
        .select(*keep, F.col("padded").substr(F.col("i"), F.lit(ORDER + 1)).alias("gram"))


def _side(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Side of a join whose rows were counted: what grows with the input never
    reaches the driver, whatever size Spark estimates from compressed files."""
    return F.broadcast(df) if rows <= most else df.hint("merge")


def log_ratios(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """gram with ``ratio``: millionths of ln P(accepted) - ln P(rejected) of
    its last character after the others.  counts: gram, a, r."""
    out = grams.select("gram", F.lit(1.0 / ALPHABET).alias("pa"), F.lit(1.0 / ALPHABET).alias("pr"))
    tail = lambda c, k: F.substring(c, ORDER + 1 - k, k + 1)
    rows = [counts.select(tail("gram", k)).distinct().count() for k in range(ORDER + 1)]
    for k in range(ORDER + 1):
        seen = counts.groupBy(tail("gram", k).alias("t")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
        context = seen.groupBy(F.substring("t", 1, k).alias("c")).agg(
            F.sum("na").alias("ca"), F.sum("nr").alias("cr"),
            F.sum((F.col("na") > 0).cast("long")).alias("da"), F.sum((F.col("nr") > 0).cast("long")).alias("dr"))
        out = out.withColumn("t", tail("gram", k)).withColumn("c", F.substring("gram", ORDER + 1 - k, k)) \
            .join(_side(seen, rows[k], COUNT_ROWS), "t", "left").join(_side(context, rows[k], COUNT_ROWS), "c", "left")
        for x in "ar":
            n, c, d, p = F.coalesce(f"n{x}", F.lit(0)), F.col(f"c{x}"), F.col(f"d{x}"), F.col(f"p{x}")
            out = out.withColumn(f"p{x}", F.when(c > 0, (n + d * p) / (c + d)).otherwise(p))
        out = out.select("gram", "pa", "pr")
    return out.select("gram", F.round((F.ln("pa") - F.ln("pr")) * 1e6).cast("long").alias("ratio"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row, ``bar``: the score (in thousandths) from which URLs are
    accepted.  scored: held-out rows with label, n and score; 0 if a class is
    missing.  Ties go to the bar nearest 0, then to the smaller one."""
    bins = scored.groupBy("score").agg(F.sum(F.when(F.col("label") == "allow", F.col("n")).otherwise(0)).alias("a"),
                                       F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("r"))
    # scores are cut to +-20, so there are at most 40,001 bins
    below = Window.partitionBy(F.lit(0)).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    low = F.coalesce(F.sum("a").over(below), F.lit(0))      # accepted ones below the bar
    high = F.sum("r").over(every) - F.coalesce(F.sum("r").over(below), F.lit(0))
    ta, tr = F.sum("a").over(every), F.sum("r").over(every)
    bins = bins.select("score", (low * tr + high * ta).alias("error"), ((ta > 0) & (tr > 0)).alias("both"))
    best = bins.where("both").agg(F.min(F.struct("error", F.abs("score").alias("size"), "score")).alias("b"))
    return best.select(F.coalesce("b.score", F.lit(0)).cast("long").alias("bar"))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """pages with host, path, rule, verdict (allow or block), score (thousandths
    of a nat per character) and bar; input columns of these names are replaced.

    A rule's verdict stands; other URLs are accepted when their score reaches
    the bar.  Up to INLINE_RULES rules are one expression, more are joined as a
    table; their number is not limited.  URLs that rules judge are the models' training rows.  Null URLs
    and those without ``://`` have an empty host and path and are scored as
    the empty string.  Repeated rows get the same verdict; without any
    labelled row every score and the bar are 0, and the verdict is allow.
    """
    made = ["host", "path", "rule", "verdict", "score", "bar"]
    pages = pages.drop(*made)
    host, path = parts(F.col(url))
    rows = pages.select(F.struct(*pages.columns).alias("row"), host.alias("host"), path.alias("path"))
    if len(rules) > INLINE_RULES:
        rows = judged_by_table(rows, rule_table(pages.sparkSession, rules))
    else:
        rule, label = rule_columns(F.col("host"), F.col("path"), rules)
        rows = rows.withColumn("rule", rule).withColumn("label", label)
    rows = rows.withColumn("s", F.concat("host", "path"))
    # the number that a URL gets when it is stored stands for it in the shuffles
    urls = rows.groupBy("s", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("u", F.monotonically_increasing_id())
    urls = stored(urls, "urls")

    held = F.md5("s").substr(1, 1).isin(list(HELD_OUT))
    counts = _grams(urls.where(F.col("label").isNotNull() & ~held), "label", "n").groupBy("gram").agg(
        F.sum(F.when(F.col("label") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("r"))
    counts = stored(counts, "grams")
    every = _grams(urls, "u")
    ratio = stored(log_ratios(every.select("gram").distinct(), counts), "ratios")
    total = every.join(_side(ratio, ratio.count(), RATIO_ROWS), "gram").groupBy("u").agg(F.sum("ratio").alias("sum"))
    mean = F.floor(F.col("sum") / ((F.length("s") + 1) * F.lit(1000)))
    scored = urls.join(total.hint("merge"), "u") \
        .withColumn("score", F.greatest(F.least(mean, F.lit(20000)), F.lit(-20000)).cast("long"))
    scored = stored(scored.select("s", "label", "n", "score"), "scores")
    bar = threshold(scored.where(F.col("label").isNotNull() & held)).withColumn("one", F.lit(1))
    verdicts = scored.withColumn("one", F.lit(1)).join(F.broadcast(bar), "one").select("s", "score", "bar")
    out = rows.join(verdicts.hint("merge"), "s")
    model = F.when(F.col("score") >= F.col("bar"), "allow").otherwise("block")
    return out.select("row.*", "host", "path", "rule", F.coalesce("label", model).alias("verdict"), "score", "bar")
