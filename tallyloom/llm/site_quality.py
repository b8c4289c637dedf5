"""Document quality from the text and from where it was published, by hierarchical empirical Bayes.

Evidence of a text: a logistic regression on a few ratios of its characters and words, fitted by Newton steps whose sums are
grouped aggregates over all labelled rows. Evidence of a site: for every host, and every section of a host, the share of
good labelled documents, shrunk towards the level above (section to host, host to all). How strongly is estimated from
how much the shares of a level differ beyond chance (moments of the beta-binomial), so a site with few labels stays near
its parent. The two are added as log-odds. Column functions only; a section's sums come from per-section groups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import saved

#: Rounds of Newton steps, and the penalty on each coefficient.
ROUNDS, RIDGE = 6, 1.0
FEATURES = ("symbols", "capitals", "digits", "bars", "distinct", "word_length", "size")


def _share(pattern: str) -> Column:
    """Share of the characters that match, over whole texts."""
    n = F.length("text")
    return F.when(n > 0, (n - F.length(F.regexp_replace("text", pattern, ""))) / n).otherwise(0.0)


def with_features(rows: DataFrame, *kept: str) -> DataFrame:
    """Adds the features of the column ``text``: shares, the share of different words, and logarithms of sizes."""
    words = F.split("text", r"\s+")
    sized = rows.select(*kept, "text", words.alias("_words"))
    return sized.select(
        *kept,
        F.sqrt(_share(r"[^\p{L}\p{N}\s.,]+")).alias("symbols"),
        F.sqrt(_share(r"\p{Lu}+")).alias("capitals"),
        F.sqrt(_share(r"\p{N}+")).alias("digits"),
        F.sqrt(_share(r"\|+")).alias("bars"),
        (F.size(F.array_distinct("_words")) / F.size("_words")).alias("distinct"),
        F.log1p(F.length("text") / F.size("_words")).alias("word_length"),
        F.log1p(F.size("_words")).alias("size"),
    )


@dataclass
class Evidence:
    """Coefficients of the standardized features, and the log-odds of label 1 among the rows learned from."""

    means: list[float]
    deviations: list[float]
    coefficients: list[float]
    bias: float
    prior: float

    def log_odds(self) -> Column:
        out = F.lit(self.bias)
        for name, mean, deviation, c in zip(FEATURES, self.means, self.deviations, self.coefficients):
            z = (F.col(name) - mean) / deviation
            out = out + z * c
        return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), out))


def fit_evidence(rows: DataFrame) -> Evidence:
    """Newton steps on ``rows`` (FEATURES, label of 0 or 1); each step is one aggregate of fixed size."""
    moments = rows.agg(F.count("*").alias("n"), F.sum("label").alias("good"), *(f(c).alias(f"{k}_{c}") for c in FEATURES for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    n, good = moments["n"], moments["good"] or 0
    prior = float(np.log((good + 0.5) / (n - good + 0.5)))
    if good in (0, n):
        return Evidence([0.0] * len(FEATURES), [1.0] * len(FEATURES), [0.0] * len(FEATURES), prior, prior)
    means = [moments[f"m_{c}"] for c in FEATURES]
    deviations = [moments[f"s_{c}"] or 1.0 for c in FEATURES]
    beta = np.zeros(len(FEATURES) + 1)
    beta[0] = prior
    names = [f"z{i}" for i in range(len(beta))]
    scaled = rows.select("label", F.lit(1.0).alias("z0"), *(((F.col(c) - m) / d).alias(f"z{i + 1}") for i, (c, m, d) in enumerate(zip(FEATURES, means, deviations))))
    for _ in range(ROUNDS):
        margin = sum((F.col(z) * float(b) for z, b in zip(names, beta)), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), margin))))
        judged = scaled.select("*", (F.col("label") - p).alias("error"), (p * (1 - p)).alias("spread"))
        sums = judged.agg(
            *(F.sum(F.col(z) * F.col("error")).alias(f"g{z}") for z in names),
            *(F.sum(F.col(a) * F.col(b) * F.col("spread")).alias(f"{a}{b}") for i, a in enumerate(names) for b in names[i:]),
        ).first()
        slope = np.array([sums[f"g{z}"] for z in names]) - RIDGE * np.concatenate([[0], beta[1:]])
        curve = np.array([[sums[f"{names[min(i, j)]}{names[max(i, j)]}"] for j in range(len(names))] for i in range(len(names))]) + RIDGE * np.diag([1e-6] + [1.0] * len(FEATURES))
        move = np.linalg.solve(curve, slope)
        beta = beta + move * min(1.0, 4.0 / max(1e-9, float(np.abs(move).max())))
    return Evidence(means, deviations, [float(b) for b in beta[1:]], float(beta[0]), prior)


def _strength(groups: DataFrame, parent: str) -> float:
    """Pseudo-count of the level's prior: what the spread of the groups' shares around their parents' leaves beyond chance."""
    p = F.greatest(F.lit(1e-3), F.least(F.lit(1 - 1e-3), F.col(parent)))
    sums = groups.where("n > 0").agg(
        F.sum(F.pow(F.col("good") - F.col("n") * p, 2)).alias("seen"),
        F.sum(F.col("n") * p * (1 - p)).alias("chance"),
        F.sum(F.col("n") * (F.col("n") - 1) * p * (1 - p)).alias("beyond"),
    ).first()
    if not sums["beyond"]:
        return 100.0
    share = (sums["seen"] - sums["chance"]) / sums["beyond"]
    return float(min(1e6, max(1.0, 1 / share - 1))) if share > 1e-6 else 1e6


def site_quality(docs: DataFrame, labels: DataFrame, host: Column, section: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, host, section, evidence (log-odds of the text alone), host_prior, section_prior, score, keep.

    Labels other than 0 and 1 and labels without an id are passed over; a repeated label counts each time, as does a repeated
    row. A null text counts as empty; a null host or section is a site of its own. Sites without labels have their parent's
    prior; without labels of both kinds scores are the share of good labels (one half without any).
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(section.cast("string"), F.lit("")).alias("section"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = saved(with_features(rows, "id", "host", "section"), "quality-features")  # numbers only
    known = labels.where(F.col(label_column).isin(0, 1)).select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    labelled = saved(rows.join(known, "id"), "quality-labelled")
    evidence = fit_evidence(labelled)

    per_section = saved(labelled.groupBy("host", "section").agg(F.count("*").alias("n"), F.sum("label").alias("good")), "sections")
    total = per_section.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    overall = (total["good"] + 0.5) / (total["n"] + 1)
    hosts = per_section.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("overall", F.lit(overall))
    weight = _strength(hosts, "overall")
    hosts = hosts.select("host", ((F.col("good") + weight * overall) / (F.col("n") + weight)).alias("host_prior"))
    sections = per_section.join(hosts, "host")
    weight = _strength(sections, "host_prior")
    sections = sections.select("host", "section", ((F.col("good") + weight * F.col("host_prior")) / (F.col("n") + weight)).alias("section_prior"))
    prior = F.coalesce("section_prior", "host_prior", F.lit(overall))
    judged = rows.select("id", "host", "section", (evidence.log_odds() - evidence.prior).alias("evidence")).join(hosts, "host", "left").join(sections, ["host", "section"], "left")
    odds = F.log(prior / (1 - prior)) + F.col("evidence")
    return judged.select(
        F.col("id").alias(id_column), "host", "section", "evidence", F.coalesce("host_prior", F.lit(overall)).alias("host_prior"), prior.alias("section_prior"),
        (1 / (1 + F.exp(-odds))).alias("score"), (1 / (1 + F.exp(-odds)) >= threshold).alias("keep"),
    )
