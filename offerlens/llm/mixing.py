"""Mixing to target weights by soft domain membership, in DataFrame operations only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm.common import fresh, name, text_key
from offerlens.session import stage

BUCKETS = 1 << 16
PER_DOMAIN = 3000  # labelled documents of each domain in the fitted sample, about
RIDGE = 1e-8  # weight of small steps, which settles what the targets leave open
LEAST_STEP = 1e-6
TOLERANCE = 1e-6
SEED = 23


def tokens(text: Column) -> Column:
    """Words between white space; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def _features(words: Column) -> Column:
    """Buckets of a document's distinct words, in lower case, and of their distinct endings of three characters."""
    bucket = lambda kind, x: F.pmod(F.xxhash64(F.lit(kind), x), F.lit(BUCKETS)).cast("int")
    return F.array_distinct(F.concat(
        F.transform(words, lambda w: bucket(0, F.lower(w))), F.transform(words, lambda w: bucket(1, F.right(w, F.lit(3))))))


def fit(docs: DataFrame, labelled: DataFrame, per_domain: int = PER_DOMAIN, seed: int = SEED) -> tuple[list[str], DataFrame]:
    """(domains, table of log-likelihood ratios per bucket): naive Bayes over word and ending buckets.

    ``labelled`` has (doc_id, domain). Fitted on about ``per_domain`` labelled
    documents of each domain, chosen by a seeded hash of the id, which bounds
    what is broadcast. A document with several domains is an example of each.
    Labels of unknown documents and NULLs in either column are ignored.
    """
    rows = labelled.select(name("doc_id").alias("doc_id"), name("domain").alias("domain")).dropna().distinct()
    counts = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = sorted(counts)
    if not domains:
        return domains, docs.sparkSession.createDataFrame([], "bucket int")
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_domain / n))]), F.col("domain"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.where(draw < share)
    texts = docs.select(name("doc_id").alias("doc_id"), name("text").alias("text")).join(F.broadcast(sample), "doc_id")
    seen = texts.select("domain", F.explode(_features(tokens(F.col("text")))).alias("bucket"))
    table = stage(seen.groupBy("bucket").pivot("domain", domains).count().na.fill(0), "domain-counts")
    every = [name(k) for k in domains]
    totals = table.agg(*[F.sum(c).alias(f"n{i}") for i, c in enumerate(every)]).first()
    totals = [t or 0 for t in totals]
    smooth = 0.5
    overall = sum(every[1:], every[0])
    weights = [
        (F.log((c + smooth) / (totals[i] + smooth * BUCKETS))
         - F.log((overall + smooth) / (sum(totals) + smooth * BUCKETS))).alias(f"w{i}") for i, c in enumerate(every)]
    return domains, stage(table.select("bucket", *weights), "domain-weights")


def posteriors(docs: DataFrame, domains: list[str], weights: DataFrame) -> DataFrame:
    """(t, tokens, rows, p0, p1, ...): per distinct text its words, its rows and the probability of every domain.

    The sum of ratios is divided by the fourth root of the number of features:
    words of a text are not independent, and memberships stay soft. Texts
    without a word have equal probabilities. The weight table has ``BUCKETS``
    rows at most and is broadcast.
    """
    k = len(domains)
    texts = docs.select(text_key(F.coalesce(name("text"), F.lit(""))).alias("t"), F.coalesce(name("text"), F.lit("")).alias("text"))
    split = texts.select("t", tokens(F.col("text")).alias("words")).select(
        "t", F.size("words").alias("tokens"), F.monotonically_increasing_id().alias("row"), _features(F.col("words")).alias("f"))
    one = split.select("t", "row", "tokens", F.size("f").alias("n"), F.explode_outer("f").alias("bucket"))
    score = one.join(F.broadcast(weights), "bucket", "left").groupBy("t", "row", "tokens", "n").agg(
        *[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(k)])
    scaled = score.groupBy("t").agg(
        F.max("tokens").cast("long").alias("tokens"), F.count(F.lit(1)).alias("rows"),
        *[F.first(F.col(f"s{i}") / F.pow(F.greatest(F.col("n"), F.lit(1)), F.lit(0.25))).alias(f"s{i}") for i in range(k)])
    top = F.greatest(*[F.col(f"s{i}") for i in range(k)]) if k > 1 else F.col("s0")
    raised = scaled.select("t", "tokens", "rows", *[F.exp(F.col(f"s{i}") - top).alias(f"e{i}") for i in range(k)])
    total = sum((F.col(f"e{i}") for i in range(1, k)), F.col("e0"))
    return raised.select("t", "tokens", "rows", *[(F.col(f"e{i}") / total).alias(f"p{i}") for i in range(k)])


def fitted_rates(members: DataFrame, goal: list[float], tolerance: float = TOLERANCE) -> tuple[Column, float]:
    """Nonnegative rates of the rows of ``members`` whose expected domain totals come nearest to ``goal`` shares, and the largest miss.

    Least squares of the K totals, the rates nearest to 1 among equal ones, by projected
    gradient with lazy projection: steps add up before the projection, so a rate is always max(0, 1 + p .
    y) for K numbers y, and no state is kept between rounds. The gradient in y is
    the residual; a round goes along it in the metric of the second moments of the memberships
    of rows with a rate, which is the curvature, so few rounds are needed. A step
    that does not lower the objective enough is shortened. Rounds go on until the miss is within
    ``tolerance``, or nothing is gained any more: then no rates reach the targets, or not within
    the numbers' precision. Each round is one aggregate of about K * K / 2 sums.
    """
    k = len(goal)
    p = [F.col(f"p{i}") for i in range(k)]
    mass = F.col("tokens") * F.col("rows")

    def rates(y: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), sum((x * float(v) for x, v in zip(p, y)), F.lit(1.0)))

    def measured(y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Objective, residual, and curvature at ``y``."""
        rate = rates(y)
        active = F.when(rate > 0, mass).otherwise(F.lit(0))
        row = members.agg(F.sum(mass), F.sum(mass * rate * rate), *[F.sum(mass * x * rate) for x in p],
                          *[F.sum(active * p[i] * p[j]) for i in range(k) for j in range(i, k)]).first()
        if not row[0]:
            return 0.0, np.zeros(k), np.eye(k)
        sums = np.array(row[1:], float) / float(row[0])
        second = np.zeros((k, k))
        second[np.triu_indices(k)] = sums[1 + k:]
        second += np.triu(second, 1).T + RIDGE * np.eye(k)
        return sums[0] / 2 - y @ goal + RIDGE / 2 * (y @ y), sums[1:1 + k] - goal, second

    goal, y = np.array(goal), np.zeros(k)
    value, residual, second = measured(y)
    while np.abs(residual).max() > tolerance:
        gradient, size = residual + RIDGE * y, 1.0
        step = np.linalg.solve(second, gradient)
        while size >= LEAST_STEP:
            tried = measured(y - size * step)
            if tried[0] <= value - 0.25 * size * (gradient @ step):
                break
            size /= 4
        else:
            break
        if value - tried[0] <= 1e-15 * abs(value):
            break
        y = y - size * step
        value, residual, second = tried
    return rates(y), float(np.abs(residual).max())


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> tuple[list[str], DataFrame]:
    """(domains, table of t, tokens, rows, p0.., rate, miss) for the distinct texts of ``docs``.

    ``targets`` gives the wanted share of tokens per domain; the total stays
    that of ``docs``. Shares are scaled to 1 over the domains that have labels;
    a labelled domain without a target gets 0. Without any labelled domain, or
    without a positive target, every rate is 1. A NULL text counts as empty.
    ``miss`` is the largest difference that is left between a domain's share and its
    target, the same in all rows: near 0 unless no rates reach the targets.
    """
    domains, weights = fit(docs, labelled, **options)
    wanted = [max(0.0, targets.get(k, 0.0)) for k in domains]
    if not sum(wanted):
        domains, wanted = domains or ["all"], None
        if weights.columns == ["bucket"]:
            weights = weights.withColumn("w0", F.lit(0.0))
    members = stage(posteriors(docs, domains, weights), "members")
    if not wanted:
        return domains, stage(members.withColumns({"rate": F.lit(1.0), "miss": F.lit(None).cast("double")}), "rates")
    rate, miss = fitted_rates(members, [w / sum(wanted) for w in wanted])
    return domains, stage(members.withColumns({"rate": rate, "miss": F.lit(miss)}), "rates")


def _copies(rate: Column, seed: int) -> Column:
    """Whole copies of a rate: its floor, and one more with the fraction's probability by a seeded hash of id and text."""
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("t")), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(rate + draw).cast("int")


def membership(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], seed: int = SEED, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, tokens, p_<domain> ..., rate, copies, miss. Repeated rows each have a row."""
    domains, rates = document_rates(docs, labelled, targets, seed=seed, **options)
    keyed = docs.select(name("doc_id").cast("long").alias("doc_id"), text_key(F.coalesce(name("text"), F.lit(""))).alias("t"))
    return keyed.join(rates, "t").select(
        "doc_id", "tokens", *[F.col(f"p{i}").alias(f"p_{k}") for i, k in enumerate(domains)], "rate", _copies(F.col("rate"), seed).alias("copies"), "miss")


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], seed: int = SEED, **options) -> DataFrame:
    """``docs`` with every row as many times as its rate says, columns unchanged."""
    _, rates = document_rates(docs, labelled, targets, seed=seed, **options)
    names = [fresh(docs, f"_c{i}") for i in range(len(docs.columns))]
    keyed = docs.select(
        *[name(c).alias(n) for c, n in zip(docs.columns, names)], name("doc_id").cast("long").alias("doc_id"),
        text_key(F.coalesce(name("text"), F.lit(""))).alias("t"))
    taken = keyed.join(rates.select("t", "rate"), "t").withColumn("copies", _copies(F.col("rate"), seed)).where("copies > 0")
    repeated = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[name(n).alias(c) for c, n in zip(docs.columns, names)])
