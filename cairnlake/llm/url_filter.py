"""URL filter: rules first, then the ratio of two character Markov models. Built-in functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cairnlake.llm.common import pick, table

#: (verdict, host and path the rule fits)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Characters the models tell apart: digits count as 0, anything else as *.
MARKS = "./-_?=&%#:~+@"
START, END = "^", "$"
ALPHABET = len(string.ascii_lowercase) + len(MARKS) + len("0*" + END)
#: Longest context. A model has at most ALPHABET ** (CONTEXT + 1) entries, so its size is bounded.
CONTEXT = 3
#: Scores are compared with a threshold out of steps of this width, up to this size.
STEP, WIDEST = 0.01, 20.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule whose host is the url's or a parent of it and whose path starts the url's."""
    names, verdicts = [], []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        rule_host, slash, tail = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + tail)
        names.append(F.when(fits, F.lit(rule)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    none = F.lit(None).cast("string")
    return F.coalesce(*names, none), F.coalesce(*verdicts, none)


def model_text(url: Column) -> Column:
    """What the models read: the url behind ``://`` (all of it without), folded to the alphabet."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(url)
    rest = F.translate(rest, string.ascii_uppercase + "123456789", string.ascii_lowercase + "0" * 9)
    return F.regexp_replace(rest, r"[^a-z0./\-_?=&%#:~+@]", "*")


def positions(texts: DataFrame) -> DataFrame:
    """One row per character and the end: ``text``, the row's other columns, ``gram`` (context and character)."""
    padded = F.concat(F.lit(START * CONTEXT), "text", F.lit(END))
    return texts.withColumn("padded", padded).select(
        *texts.columns,
        F.explode(F.expr(f"transform(sequence(1, length(padded) - {CONTEXT}), i -> substring(padded, i, {CONTEXT + 1}))")).alias("gram"),
    )


def gram_scores(grams: DataFrame) -> DataFrame:
    """log10 of the accepted over the rejected model's probability for each gram.

    grams: ``gram`` with its counts ``good`` and ``bad``. Both models interpolate all context
    lengths: a context seen n times with t different followers gives t / (n + t) of its weight
    to the next shorter one (Witten-Bell), a context never seen gives all; below the empty
    context all characters are alike. So the effective order varies with what was seen.
    """
    scored = grams.select("gram", F.right("gram", F.lit(1)).alias("next"))
    ratio = {side: F.lit(1.0 / ALPHABET) for side in ("good", "bad")}
    for length in range(CONTEXT + 1):
        tail = F.right(F.col("gram"), F.lit(length + 1))
        counts = grams.groupBy(tail.alias("tail")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        context = F.expr(f"substring(tail, 1, {length})")
        totals = counts.groupBy(context.alias("context")).agg(
            *[F.sum(s).alias(f"n_{s}") for s in ("good", "bad")],
            *[F.sum((F.col(s) > 0).cast("long")).alias(f"t_{s}") for s in ("good", "bad")],
        )
        level = counts.withColumn("context", context).join(totals, "context").drop("context")
        level = level.toDF(*[f"{c}_{length}" for c in level.columns])
        scored = scored.join(level, F.right(F.col("gram"), F.lit(length + 1)) == F.col(f"tail_{length}"), "left")
        for side in ratio:
            n, t, c = (F.coalesce(F.col(f"{x}_{length}"), F.lit(0)) for x in (f"n_{side}", f"t_{side}", side))
            ratio[side] = F.when(n + t > 0, (c + t * ratio[side]) / F.greatest(n + t, F.lit(1))).otherwise(ratio[side])
    return scored.select("gram", (F.log10(ratio["good"]) - F.log10(ratio["bad"])).alias("llr"))


def threshold(scored: DataFrame) -> float:
    """The step that parts good from bad best: least sum of both error shares, then nearest to 0.

    scored: ``score``, ``label``. At most 2 * WIDEST / STEP + 1 sums are compared.
    """
    step = F.floor(F.greatest(F.least(F.col("score"), F.lit(WIDEST)), F.lit(-WIDEST)) / STEP).cast("int")
    sums = (
        scored.groupBy(step.alias("step"))
        .agg(F.sum((F.col("label") == "allow").cast("long")).alias("good"), F.sum((F.col("label") == "block").cast("long")).alias("bad"))
        .orderBy("step")
        .collect()
    )
    good, bad = sum(r.good for r in sums), sum(r.bad for r in sums)
    if not good or not bad:
        return 0.0
    best, lost, passed = None, 0, bad
    for row in sums:  # everything from this step on is accepted
        errors = lost / good + passed / bad
        if best is None or (round(errors, 12), abs(row.step)) < best[:2]:
            best = (round(errors, 12), abs(row.step), row.step)
        lost, passed = lost + row.good, passed - row.bad
    return best[2] * STEP


def judge_urls(df: DataFrame, id_column: str, url_column: str, rules=RULES) -> DataFrame:
    """Each url's host, path, fitting rule and verdict, with the score of the method.

    Both models learn from the different urls that a rule decides: allowed ones are accepted,
    blocked ones rejected. The score is the mean log10 ratio per character; a url without
    rule is allowed from the calibrated threshold on. Without accepted or without rejected
    urls the threshold is 0. Equal texts are scored once, so a url that fills the table is
    one row of the models; a gram that is in every url is joined to a broadcast table of at
    most ALPHABET ** (CONTEXT + 1) rows, never shuffled by its value.

    Returns one row per input row: the id, ``host``, ``path``, ``rule``, ``verdict``, ``score``.
    A NULL url counts as an empty text without rule and is judged like any other; a NULL id
    stays NULL; repeated rows get equal results; an empty table gives an empty result; further
    columns are ignored.
    """
    rows = pick(df, id=id_column, url=url_column)
    host, path = host_and_path(F.col("url"))
    rows = rows.select("id", host.alias("host"), path.alias("path"), model_text(F.col("url")).alias("text"))
    rule, label = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "label": label})
    # A text can carry both labels, as rules look at more than the models do.
    texts = rows.groupBy("text").agg(F.max((F.col("label") == "allow").cast("int")).alias("good"), F.max((F.col("label") == "block").cast("int")).alias("bad"))
    texts = texts.select("text", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))
    grams = positions(texts).groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    scores = (
        positions(texts).join(F.broadcast(gram_scores(grams)), "gram")
        .groupBy("text", "good", "bad")
        .agg(F.avg("llr").alias("score"))
        .select("text", "good", "bad", F.round("score", 6).alias("score"))
    )
    labelled = scores.select("score", F.explode(F.expr("filter(array(if(good = 1, 'allow', null), if(bad = 1, 'block', null)), x -> x is not null)")).alias("label"))
    least = threshold(labelled)
    by_method = F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return rows.join(scores.select("text", "score"), "text").select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("label", by_method).alias("verdict"), "score"
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), "page_id", "url").drop("score")
