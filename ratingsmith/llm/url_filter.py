"""URL filter by character language models, DataFrame functions only (operator 3).

Rules of the form host/path (longest fitting rule wins) accept or reject some URLs.
All others are judged by two smoothed variable-order Markov models over characters,
one trained on the accepted and one on the rejected URLs: the probability of a
character given the last j ones is interpolated with that given j - 1,
p_j = (count(context, c) + STRENGTH p_{j-1}) / (count(context) + STRENGTH), from the
uniform p_{-1} up to order ORDER.  The score is the mean log-likelihood difference
per character, and the threshold is the one that best separates the accepted and
rejected URLs of a held-out fifth (the middle of the best range of score bins).

Scope.  Rules look at host and path; the models see the whole URL, scheme, query and fragment
included, in training and scoring.

Scale.  The models count distinct URLs.  A model's value depends
only on the last ORDER + 1 characters, so the counts are aggregated by such grams,
the log ratio is computed once per distinct gram, and URLs are joined with that
table.  Spark sizes a staged table by its compressed files, a small part of what its rows take in
the driver, so the joins say how they run: tables of grams are broadcast up to BROADCAST_GRAMS
counted rows, tables of URLs never.
Judged URLs are staged before they are joined back to the rows, so the partition of
a hot URL can be split.

Defined cases.  No held-out URL of either kind: the threshold is 0.  NULL or empty URL: host and path are empty, no rule
fits, the score is 0.  A URL without ``://``: host and path are empty, no rule fits, the models score it.  No accepted or no rejected URLs: all scores are 0 and the
threshold is 0, so the verdict is allow.  Repeated rows get equal verdicts.  URLs
of any length are scored whole.  Other columns pass through; result columns
replace input columns of the same name.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

#: Longest context, weight of the shorter context's probability, size of the alphabet, score bins per unit.
ORDER, STRENGTH, ALPHABET, BINS = 3, 2.0, 128, 50
#: Rows of a table of grams that may be broadcast (some 100 bytes each).
BROADCAST_GRAMS = 100_000
#: (host, path, verdict): a rule fits its host and all subdomains, and paths that start with its path.
Rule = tuple[str, str, str]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule (as ``host/path``) and its verdict; NULL if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):      # a longer rule overrides
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def fold_of(s: Column) -> Column:
    """One of five folds by the first 32 bits of MD5; fold 0 is held out."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long") % 5


def grams(urls: DataFrame) -> DataFrame:
    """The columns of ``urls`` and ``g``: the grams of ORDER + 1 characters that end at each character of URL ``s``, and at its end."""
    padded = F.concat(F.lit("\x02" * ORDER), F.col("s"), F.lit("\x03"))
    at = F.sequence(F.lit(1), F.char_length("s") + 1)
    return urls.select(*urls.columns, F.explode(at).alias("i"), padded.alias("t")).select(
        *urls.columns, F.substring("t", F.col("i"), F.lit(ORDER + 1)).alias("g"))


def ratios(counts: DataFrame, stages: common.Stages, join: str) -> DataFrame:
    """``g, allow, block`` (training counts, 0 for grams to be scored only) -> ``g, llr``; ``join`` is the hint of the joins."""
    out = counts.select("g")
    p = {c: F.lit(1.0 / ALPHABET) for c in ("allow", "block")}
    for j in range(ORDER + 1):
        end = F.substring("g", ORDER + 1 - j, j + 1)              # context of j characters, and the character
        ctx = F.substring("g", ORDER + 1 - j, j) if j else F.lit("")
        seen = counts.filter("allow > 0 OR block > 0")
        hit = seen.groupBy(end.alias(f"e{j}")).agg(*(F.sum(c).alias(f"{c}_n{j}") for c in p))
        base = seen.groupBy(ctx.alias(f"x{j}")).agg(*(F.sum(c).alias(f"{c}_t{j}") for c in p))
        out = (out.withColumns({f"e{j}": end, f"x{j}": ctx}).join(hit.hint(join), f"e{j}", "left").join(base.hint(join), f"x{j}", "left"))
        for c in p:
            n, t = (F.coalesce(F.col(f"{c}_{k}{j}"), F.lit(0)) for k in "nt")
            out = out.withColumn(f"{c}_p{j}", (n + F.lit(STRENGTH) * p[c]) / (t + F.lit(STRENGTH)))
            p[c] = F.col(f"{c}_p{j}")
    return stages.put(out.select("g", (F.log(p["allow"]) - F.log(p["block"])).alias("llr")), "ratios")


def threshold(scored: DataFrame) -> float:
    """Best split of held-out accepted and rejected URLs (0 if there are none of either); scores from it on are accepted."""
    bins = scored.groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.count(F.when(F.col("label") == "allow", 1)).alias("a"), F.count(F.when(F.col("label") == "block", 1)).alias("b"))
    upto = W.orderBy("bin")                     # a mean of log ratios of smoothed counts has few bins of 1 / BINS
    every = W.partitionBy()
    good = (F.try_divide(F.sum("a").over(every) - F.sum("a").over(upto), F.sum("a").over(every))
            + F.try_divide(F.sum("b").over(upto), F.sum("b").over(every)))
    marks = bins.filter("a > 0 OR b > 0").withColumns({"good": good, "next": F.lead("bin").over(upto)})
    best = (marks.withColumn("best", F.max("good").over(every)).filter("good = best AND next IS NOT NULL")
            .agg(F.min("bin").alias("low"), F.max("next").alias("high")).first())
    return 0.0 if best is None or best.low is None else (best.low + 1 + best.high) / 2 / BINS


def judge(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``df`` with ``host, path, rule, verdict`` and the model's ``score``."""
    stages = common.Stages(df.sparkSession, "urls")
    host, path = parts(F.col(common.quoted(url)))
    whole = F.coalesce(F.col(common.quoted(url)), F.lit(""))
    rows = df.select(common.others(df).alias("row"), host.alias("host"), path.alias("path"), whole.alias("s"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "given": verdict})
    urls = rows.filter("s <> ''").select("s", F.col("given").alias("label")).distinct()       # a URL has one label
    urls = stages.put(urls.withColumn("fold", fold_of(F.col("s"))), "urls")
    spread = grams(urls)
    train = lambda label: F.count(F.when((F.col("fold") > 0) & (F.col("label") == label), 1)).alias(label)
    every = stages.put(spread.groupBy("g").agg(train("allow"), train("block")), "grams")
    both = every.agg(F.sum("allow"), F.sum("block"), F.count("*")).first()
    if both[0] and both[1]:
        join = "broadcast" if both[2] <= BROADCAST_GRAMS else "merge"
        scored = (spread.join(ratios(every, stages, join).hint(join), "g").groupBy("s", "label", "fold")
                  .agg(F.avg("llr").alias("score")).select("s", "score", "label", "fold"))
        scored = stages.put(scored, "scored")
        least = threshold(scored.filter((F.col("fold") == 0) & F.col("label").isNotNull()))
    else:
        scored, least = urls.withColumn("score", F.lit(0.0)), 0.0
    score = F.coalesce("score", F.lit(0.0))
    done = (rows.join(scored.select("s", "score").hint("merge"), "s", "left")
            .withColumn("verdict", F.coalesce("given", F.when(score >= least, F.lit("allow")).otherwise(F.lit("block"))))
            .withColumn("score", score))
    return common.restore(df, done, {c: c for c in ("host", "path", "rule", "verdict", "score")})
