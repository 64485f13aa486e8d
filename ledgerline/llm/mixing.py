"""Mixing to target weights with soft membership: DataFrame, SQL and Spark ML expressions only.

A naive Bayes text classifier, trained on the labelled table, gives every document a posterior over
domains. Nonnegative document rates are fitted so that the expected tokens of each domain,
``sum(rate * tokens * posterior)``, meet the targets: projected gradient on the least-squares distance.
Each step is one aggregate of a few sums for each pair of domains.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.base import cut, unused

#: Hash buckets of the words; the model has one weight for each bucket and domain.
BUCKETS = 1 << 14
#: Labelled rows that the classifier is fitted on (about).
FIT_ROWS = 20_000


def words_of(text: Column) -> Column:
    """Words of a whole text (null: none)."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+"), lambda w: w != "")


def with_words(df: DataFrame, text_col: str, out: str) -> DataFrame:
    return df.withColumn(out, words_of(df[text_col]))


@dataclass
class Mixture:
    """A fitted mixture: posteriors from ``model``, rates from the gradients of each step."""

    domains: list[str]
    model: NaiveBayesModel | None
    targets: dict[str, float] = field(default_factory=dict)
    gradients: list[list[float]] = field(default_factory=list)
    sums: list[float] = field(default_factory=list)
    gap: float = 0.0

    def posterior(self, docs: DataFrame, text_col: str, t: str, p: str) -> DataFrame:
        """Adds tokens (words, at least 1) as ``t`` and the posterior (array by domain) as ``p``.

        The log odds are divided by the square root of the number of words, as words of a text aren't
        independent: a short or mixed text has soft membership. Without words it is the prior.
        """
        w, f = unused(docs, "_mix_words"), unused(docs, "_mix_tf")
        df = with_words(docs, text_col, w).withColumn(t, F.greatest(F.size(w), F.lit(1)).cast("double"))
        if self.model is None:
            return df.withColumn(p, F.array(F.lit(1.0))).drop(w)
        df = HashingTF(inputCol=w, outputCol=f, numFeatures=BUCKETS).transform(df).drop(w)
        raw = f"{f}_raw"
        model = self.model.copy().setFeaturesCol(f).setRawPredictionCol(raw).setProbabilityCol("") \
            .setPredictionCol("")
        df = model.transform(df).drop(f).withColumn(raw, vector_to_array(raw))
        prior = [float(x) for x in self.model.pi]
        scaled = F.transform(raw, lambda x, i: (x - F.get(F.array(*map(F.lit, prior)), i)) / F.sqrt(t)
                             + F.get(F.array(*map(F.lit, prior)), i))
        df = df.withColumn(raw, scaled).withColumn(raw, F.transform(raw, lambda x: F.exp(x - F.array_max(raw))))
        total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
        return df.withColumn(p, F.transform(raw, lambda x: x / total)).drop(raw)

    def rate(self, p: str) -> Column:
        """The fitted rate of a document with posterior column ``p``: the steps replayed from rate 1."""
        if not self.gradients:
            return F.lit(1.0)
        steps = F.array(*[F.array(*map(F.lit, g)) for g in self.gradients])
        return F.aggregate(steps, F.lit(1.0), lambda r, g: step(r, F.col(p), g))


def step(rate: Column, p: Column, gradient: Column) -> Column:
    """One projected step: down the gradient, then back to rates of at least 0."""
    along = F.aggregate(F.zip_with(p, gradient, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return F.greatest(F.lit(0.0), rate - along)


def copies(rate: Column, *salt: Column) -> Column:
    """Whole copies whose expected number is ``rate``: the fraction is decided by a hash, so a rerun or
    a recomputed task decides alike."""
    u = F.pmod(F.xxhash64(F.lit(20), *salt), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def smoothed(sums: dict[str, float], alpha: float, keep_all: bool) -> dict[str, float]:
    """Target tokens: shares proportional to ``sums ** alpha``. ``keep_all``: the smallest total at which
    no domain is cut, so that rates stay at 1 or more; else the total stays as it is."""
    weight = {d: s ** alpha for d, s in sums.items() if s > 0}
    norm = sum(weight.values())
    total = max((sums[d] * norm / w for d, w in weight.items()), default=0.0) if keep_all else sum(sums.values())
    return {d: total * w / norm for d, w in weight.items()}


def fit_mixture(docs: DataFrame, labelled: DataFrame, domain_col: str = "domain", text_col: str = "text",
                id_cols: tuple[str, ...] = (), weights: dict[str, float] | None = None, alpha: float = 0.7,
                keep_all: bool = False, tolerance: float = 1e-6) -> tuple[Mixture, DataFrame]:
    """Fit on all rows; returns the mixture and ``id_cols``, tokens, posterior, rate for each row.

    ``labelled``: rows with ``text_col`` and ``domain_col``; null domains are left out. Domains must be
    few: each row carries a number for each. ``weights``: target share by domain (default: shares
    proportional to expected tokens to the power ``alpha``). Null and empty texts have the prior as
    posterior and one token. With fewer than two labelled domains, or no documents, all rates are 1.
    Targets are met to ``tolerance`` relative to a domain's tokens, or as near as nonnegative rates allow;
    what is left is the mixture's ``gap``. Repeated rows are documents of their own; a text of any length is
    read whole, in its row.
    """
    rows = labelled.select(F.col(domain_col).cast("string").alias("domain"), F.col(text_col).alias("text")) \
        .where("domain IS NOT NULL")
    known = sorted(r["domain"] for r in rows.select("domain").distinct().collect())
    mix = Mixture(known or ["all"], None)
    if len(known) > 1:
        train = HashingTF(inputCol="words", outputCol="tf", numFeatures=BUCKETS).transform(
            rows.select((F.array_position(F.array(*map(F.lit, known)), F.col("domain")) - 1).cast("double")
                        .alias("label"), words_of(F.col("text")).alias("words")))
        mix.model = NaiveBayes(featuresCol="tf", labelCol="label").fit(train)
    else:
        mix.domains = ["all"]
    scored = mix.posterior(docs.select(*id_cols, text_col), text_col, "tokens", "posterior")
    state = cut(scored.select(*id_cols, "tokens", "posterior", F.lit(1.0).alias("rate")))

    mix.sums, _ = totals(state, len(mix.domains))
    sums = dict(zip(mix.domains, mix.sums, strict=True))
    if weights is None:
        mix.targets = smoothed(sums, alpha, keep_all)
    else:
        norm = sum(weights.get(d, 0.0) for d in mix.domains) or 1.0
        mix.targets = {d: sum(mix.sums) * weights.get(d, 0.0) / norm for d in mix.domains}
    if mix.model is None or not sum(mix.sums):
        return mix, state
    state, mix.gradients, mix.gap = fit_rates(state, mix.sums, [mix.targets.get(d, 0.0) for d in mix.domains], tolerance)
    return mix, state


def totals(df: DataFrame, n: int) -> tuple[list[float], np.ndarray]:
    """Expected tokens of each of ``n`` domains, and the matrix of how a step changes them: sums of tokens
    times two posteriors, over documents whose rate isn't 0. One aggregate of n + n (n + 1) / 2 sums."""
    p = [F.get("posterior", F.lit(i)) for i in range(n)]
    t = F.col("tokens")
    free = F.when(F.col("rate") > 0, t)
    row = df.agg(*[F.sum(F.col("rate") * t * p[i]) for i in range(n)],
                 *[F.sum(free * p[i] * p[j]) for i in range(n) for j in range(i, n)]).first()
    values = [float(x or 0.0) for x in row]
    matrix, rest = np.zeros((n, n)), iter(values[n:])
    for i in range(n):
        for j in range(i, n):
            matrix[i, j] = matrix[j, i] = next(rest)
    return values[:n], matrix


def fit_rates(state: DataFrame, sums: list[float], targets: list[float], tolerance: float = 1e-6,
              most_steps: int = 500) -> tuple[DataFrame, list[list[float]], float]:
    """``state`` (tokens, posterior, rate) with fitted rates, the step taken each time, and the gap that is left,
    relative to a domain's tokens ``sums``.

    Projected gradient: rates move against a gradient, then back to 0 where they fell below. The gradient is
    scaled by the matrix of :func:`totals`, so that as long as no rate meets 0 one step meets the targets,
    however alike the domains' posteriors are; a scaled step that doesn't lessen the squared gap is halved,
    then left for the plain gradient. Ends where the gap is below ``tolerance``, or where the plain gradient
    moves nothing any more: then targets lie beyond what nonnegative rates reach and the gap says by how
    much. If ``most_steps`` don't settle it, that is an error.
    """
    n = len(sums)
    scale = np.array([s if s else 1.0 for s in sums])
    target = np.array(targets)
    now, matrix = totals(state, n)
    gap = (np.array(now) - target) / scale
    steps: list[list[float]] = []
    tried = 0
    while np.abs(gap).max() >= tolerance:
        ridge = 1e-12 * np.trace(matrix) / n + 1e-300
        plain = gap / (scale * max(1e-300, np.linalg.eigvalsh(matrix / scale[:, None] / scale[None, :]).max()))
        scaled = np.linalg.solve(matrix + ridge * np.eye(n), np.array(now) - target)
        for g in [*(scaled * 0.5 ** k for k in range(6)), plain]:
            tried += 1
            if tried > most_steps:
                raise RuntimeError(f"rates did not settle in {most_steps} steps; the gap is {np.abs(gap).max():.3g}")
            trial = state.withColumn("rate", step(F.col("rate"), F.col("posterior"), F.array(*map(F.lit, map(float, g)))))
            got, matrix_ = totals(trial, n)
            less = (np.array(got) - target) / scale
            if (less ** 2).sum() < (gap ** 2).sum() * (1 - 1e-9):
                break
        else:  # not even the plain gradient lessens the gap: as near as nonnegative rates come
            return state, steps, float(np.abs(gap).max())
        steps.append([float(x) for x in g])
        state, now, matrix, gap = trial, got, matrix_, less
        if len(steps) % 6 == 5:
            state = cut(state)
    return state, steps, float(np.abs(gap).max())


def mix_rows(docs: DataFrame, mix: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its rate says; columns are those of ``docs``. Null and empty
    texts have the prior's rate; rows alike in id and text are repeated alike; an empty table gives none."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    t, p, n = (unused(docs, x) for x in ("_mix_tokens", "_mix_posterior", "_mix_copy"))
    scored = mix.posterior(docs, text_col, t, p)
    times = copies(mix.rate(p), docs[id_col], docs[text_col])
    return scored.withColumn(n, F.explode(F.array_repeat(F.lit(0), times))).select(*columns)
