"""Mix documents to target weights of their domains, by soft membership. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import stored, whole_text

DOMAINS = ("clean", "junk", "toxic")
# Labelled documents the classifier is fitted on, chosen by the hash of their id.
LABELLED = 20_000
FEATURES = 1 << 14
# Strength of the pull of the classifier's weights to zero, over the root of the number of labels.
PULL = 0.17


@dataclass(frozen=True)
class Classifier:
    """Posteriors of `domains` for a text; without a model all mass is on the only domain seen."""

    model: PipelineModel | None
    domains: tuple[str, ...]
    only: int = 0

    def posteriors(self, docs: DataFrame, text_column: str = "text") -> DataFrame:
        """The documents with __n (words) and __p (posterior of each domain)."""
        read = _shapes(docs, text_column)
        if self.model is None:
            sure = F.array(*[F.lit(1.0 if k == self.only else 0.0) for k in range(len(self.domains))])
            found = read.withColumn("__p", sure)
        else:
            found = self.model.transform(read)
            found = found.withColumn("__p", vector_to_array("__probability"))
        return found.select(*docs.columns, "__n", "__p")


def _shapes(docs: DataFrame, text_column: str) -> DataFrame:
    """The text and its word count, with shares of symbols, bars, exclamation marks and capitals."""
    text = whole_text(text_column)
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda chars: F.regexp_count(text, F.lit(f"[{chars}]")) / n
    return docs.withColumns(
        {
            "__text": text,
            "__n": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"),
            "__symbols": share("#*$%&<>"),
            "__bars": share("|"),
            "__shouts": share("!"),
            "__capitals": share("A-Z"),
        }
    )


def fit_classifier(
    docs: DataFrame,
    labels: DataFrame,
    labelled: int = LABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Classifier:
    """Logistic regression of the domain on hashed words and text shape, from the labelled table.

    Of the labels, toxic 1 means toxic, else quality 0 means junk, else clean. At most `labelled`
    labelled ids are used (a bounded sample by hash of the id, small enough to broadcast); an id with
    several labels takes the worst, null ids and labels are none. Repeated documents of an id count once.
    """
    known = labels.select("doc_id", "quality", "toxic").dropna().groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    domain = F.when(F.col("toxic") == 1, 2.0).when(F.col("quality") == 0, 1.0).otherwise(0.0)
    known = known.select(F.col("doc_id").alias("__id"), domain.alias("__domain"))
    read = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text"))
    sample = read.join(F.broadcast(known), "__id").dropDuplicates(["__id"])
    sample = stored(_shapes(sample, "text"), "labelled")
    seen = sorted(r[0] for r in sample.select("__domain").distinct().collect())
    if len(seen) < 2:
        return Classifier(None, DOMAINS, int(seen[0]) if seen else 0)
    words = RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"\W+")
    counted = HashingTF(inputCol="__words", outputCol="__tf", numFeatures=FEATURES, binary=True)
    shape = ["__symbols", "__bars", "__shouts", "__capitals"]
    joined = VectorAssembler(inputCols=[*shape, "__tf"], outputCol="__features")
    stages = [words, counted, joined]
    ready = sample
    for stage in stages:
        ready = stage.transform(ready)
    ready = stored(ready.select("__features", "__domain"), "features")
    fit = LogisticRegression(
        featuresCol="__features",
        labelCol="__domain",
        probabilityCol="__probability",
        rawPredictionCol="__raw",
        predictionCol="__prediction",
        family="multinomial",
        # Few words tell a domain, so weights are drawn to zero, the less so the more labels there are.
        regParam=PULL / max(1, sample.count()) ** 0.5,
        elasticNetParam=1.0,
        maxIter=60,
    ).fit(ready.coalesce(1))
    return Classifier(PipelineModel([*stages, fit]), DOMAINS[: fit.numClasses])


@dataclass(frozen=True)
class Rates:
    """Document rates as the steps that lead to them: a rate depends on the posteriors alone."""

    steps: list[list[float]] = field(default_factory=list)
    pull: float = 1e-3

    def rate(self, p: Column) -> Column:
        """Start at 1; each step goes down the gradient and back to the nonnegative rates."""
        rate: Column = F.lit(1.0)
        if not self.steps:
            return rate
        steps = F.array(*[F.array(*map(F.lit, s)) for s in self.steps])

        def step(r: Column, errors: Column) -> Column:
            slope = F.aggregate(F.zip_with(p, errors, lambda a, e: a * e), F.lit(0.0), lambda s, x: s + x)
            return F.greatest(F.lit(0.0), r - slope - F.lit(self.pull) * (r - 1))

        return F.aggregate(steps, rate, step)


def fit_rates(
    scored: DataFrame,
    targets: list[float],
    pull: float = 1e-3,
    tolerance: float = 1e-3,
    rounds: int = 40,
) -> Rates:
    """Nonnegative document rates whose expected domain token totals come nearest to `targets`.

    `targets` are multiples of each domain's present expected tokens. Least squares in the relative
    errors of the domains, with a slight pull to rate 1, by projected gradient: a round sums the
    tokens of every domain at the present rates over all documents (a few numbers return), and
    its errors are one more step. Scaled by the domains' sizes, steps of length one converge.
    """
    k = len(targets)
    p = [F.get("__p", F.lit(j)) for j in range(k)]
    size = lambda rate: [F.sum(rate * F.col("__n") * x).alias(f"s{j}") for j, x in enumerate(p)]
    mass = [x or 0.0 for x in scored.agg(*size(F.lit(1.0))).head()]
    rates = Rates([], pull)
    for _ in range(rounds):
        now = [x or 0.0 for x in scored.agg(*size(rates.rate(F.col("__p")))).head()]
        errors = [n / m - t if m > 1e-9 else 0.0 for n, m, t in zip(now, mass, targets, strict=True)]
        if max(map(abs, errors), default=0.0) < tolerance:
            break
        if rates.steps and max(abs(a - b) for a, b in zip(errors, rates.steps[-1], strict=True)) < tolerance / 100:
            break
        rates.steps.append(errors)
    return rates


def target_multiples(scored: DataFrame, weights: dict[str, float], domains: tuple[str, ...]) -> list[float]:
    """For wanted shares of all tokens, the multiples of each domain's present expected tokens."""
    sums = [F.sum(F.col("__n") * F.get("__p", F.lit(j))) for j in range(len(domains))]
    mass = [x or 0.0 for x in scored.agg(*sums).head()]
    whole, wanted = sum(mass), sum(weights[d] for d in domains)
    return [weights[d] / wanted * whole / m if m > 1e-9 else 1.0 for d, m in zip(domains, mass, strict=True)]


def mix_sources(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, n_tokens (words), the posterior of each domain, and its rate.

    A rate below 1 is the share with which to sample the document, above 1 how often to repeat it;
    sampled so, the expected tokens of the domains have the shares `weights`. A null text has no
    words and adds nothing to any total. Repeated rows and null ids each give their own row; without
    labels of two domains, all mass is on the one seen. Only the two named columns are read.
    """
    read = docs.select(id_column, text_column)
    classifier = fit_classifier(docs, labels, id_column=id_column, text_column=text_column)
    scored = classifier.posteriors(read, text_column).select(F.col(id_column).alias("__id"), "__n", "__p")
    scored = stored(scored, "posteriors")
    rates = fit_rates(scored, target_multiples(scored, weights, classifier.domains))
    named = [F.coalesce(F.get("__p", F.lit(j)), F.lit(0.0)).alias(f"p_{d}") for j, d in enumerate(DOMAINS)]
    return scored.select(
        F.col("__id").alias(id_column), F.col("__n").alias("n_tokens"), *named, rates.rate(F.col("__p")).alias("rate")
    )


def take_share(
    docs: DataFrame,
    labels: DataFrame,
    multiples: dict[str, float],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows that stay when each domain's expected tokens become `multiples` of what they are.

    A document stays if the hash of its id and text, as a number below 1, is below its rate; so those
    with a rate of 1 or more all stay, once, and of those with a rate of 0 none. All columns are returned,
    whatever their names; null ids and texts are rows like others, repeated rows stay or go together, and
    texts of any length count whole. An empty table gives no rows.
    """
    classifier = fit_classifier(docs, labels, id_column=id_column, text_column=text_column)
    # The row is one column, so that no name of its columns can clash, and is scored once.
    read = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), docs[text_column].alias("__own"))
    scored = stored(classifier.posteriors(read, "__own").select("__row", "__n", "__p"), "posteriors")
    rates = fit_rates(scored, [multiples[d] for d in classifier.domains])
    own = F.xxhash64(F.col("__row")[id_column], F.col("__row")[text_column])
    chance = F.pmod(own, F.lit(1 << 53)) / F.lit(float(1 << 53))
    return scored.where(chance < rates.rate(F.col("__p"))).select("__row.*")
