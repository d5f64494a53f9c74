"""Soft-membership mixing: document rates whose expected domain token totals match targets.

A classifier fitted on a labelled table predicts for every document the posterior of each
domain.  With tokens n_i and posteriors p_id, rates r_i >= 0 minimise the weighted squares

    sum over d of (sum over i of p_id n_i r_i - target_d)^2 / target_d

by projected gradient steps from rate 1.  The gradient needs one total per domain, so a
step is one pass that follows every rate through the steps so far and sums; steps are taken per token
of a document, so documents of equal posterior get equal rates whatever their length.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

LABELLED_ROWS, VOCABULARY, MIN_DOCS = 8_000, 20_000, 5
STEPS, TOLERANCE = 60, 1e-4
EPSILON = 0.01

# Target shares of the registered query.
DOMAINS = ("clean", "toxic", "junk")
SHARES = {"clean": 0.90, "toxic": 0.04, "junk": 0.06}


def domains_of(labels: DataFrame) -> DataFrame:
    """The labels table as doc_id and domain: junk, toxic or clean; rows without a quality are not labelled."""
    domain = (
        F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
    )
    return labels.select("doc_id", domain.alias("domain")).filter("domain IS NOT NULL AND doc_id IS NOT NULL")


def _words(text: Column) -> Column:
    """Lower-case words; the first and the last may be empty."""
    return F.split(F.lower(text), r"[\s.,;:]+")


def _count(words: Column) -> Column:
    blank = F.when(words[0] == "", 1).otherwise(0) + F.when(F.element_at(words, -1) == "", 1).otherwise(0)
    return F.greatest(F.size(words) - blank, F.lit(0))


def posteriors(docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...], held: list[str]) -> DataFrame:
    """_doc (a struct of the columns ``held``), _tokens and _p: the number of words, a posterior per domain.

    The classifier is a multinomial logistic regression on the words that occur in the
    labelled documents; about 8,000 labelled rows at most, chosen by a hash of doc_id, are
    used and, being so few, broadcast to find their texts.  With one domain among them it is certain; with none all are equally likely.
    """
    share = max(1, -(-labelled.count() // LABELLED_ROWS))
    index = F.create_map(*[F.lit(x) for k, d in enumerate(domains) for x in (d, float(k))])
    known = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select(
        F.col("doc_id").cast("bigint").alias("_id"), index[F.col("domain")].alias("_label")
    )
    known = known.filter("_label IS NOT NULL").groupBy("_id").agg(F.min("_label").alias("_label"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), text_of().alias("_text"))
    texts = texts.filter(F.pmod(F.xxhash64("_id"), F.lit(share)) == 0)
    sample = materialize(texts.join(F.broadcast(known), "_id").select("_label", "_text"), "labelled")
    sample = sample.select("_label", _words(F.col("_text")).alias("_words"))
    row = F.struct(*[F.col(f"`{c}`") for c in held]).alias("_doc")
    rows = docs.select(row, _words(text_of()).alias("_words"))
    tokens = _count(F.col("_words")).alias("_tokens")
    seen = [r["_label"] for r in sample.select("_label").distinct().collect()]
    if len(seen) < 2:
        even = [float(k == seen[0]) if seen else 1 / len(domains) for k in range(len(domains))]
        return rows.select("_doc", tokens, F.array(*[F.lit(x) for x in even]).alias("_p"))
    counter = CountVectorizer(
        inputCol="_words", outputCol="_vector", vocabSize=VOCABULARY, minDF=MIN_DOCS, binary=True
    ).fit(sample)
    model = LogisticRegression(
        featuresCol="_vector", labelCol="_label", family="multinomial", maxIter=30, regParam=1e-3,
        rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_guess",
    ).fit(counter.transform(sample))
    scored = model.transform(counter.transform(rows))
    p = vector_to_array("_probability")
    # A domain that no labelled row has comes after the highest label seen, with posterior 0.
    padded = F.slice(F.concat(p, F.array_repeat(F.lit(0.0), len(domains))), 1, len(domains))
    return scored.select("_doc", tokens, padded.alias("_p"))


Step = tuple[float, list[float]]


def _slopes(steps: list[Step]) -> Column:
    """Per step its length times the gradient.

    Read from one text, which Spark folds to a constant: a plan of any number of steps has the same few
    expressions, and its compiled code is the same.
    """
    slopes = [[length * g for g in gradient] for length, gradient in steps]
    return F.from_json(F.lit(json.dumps(slopes)), "array<array<double>>")


def _moved(rate: Column, p: Column, slope: Column, size: int, most: float | None) -> Column:
    moved = F.greatest(F.lit(0.0), rate - sum((p[d] * slope[d] for d in range(1, size)), p[0] * slope[0]))
    return moved if most is None else F.least(F.lit(float(most)), moved)


def _followed(steps: list[Step], most: float | None, p: str, tokens: str) -> Column:
    """Struct of ``rate``, the rate after the steps, from rate 1, and ``before``, that before the last; a row without tokens keeps 1.

    Rates of one posterior are equal, so a step's length and gradient say all about it.
    """
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("before"))
    if not steps:
        return start
    size = len(steps[0][1])

    def step(at: Column, slope: Column) -> Column:
        return F.struct(_moved(at["rate"], F.col(p), slope, size, most).alias("rate"), at["rate"].alias("before"))

    return F.when(F.col(tokens) > 0, F.aggregate(_slopes(steps), start, step)).otherwise(start)


def rate_of(steps: list[Step], most: float | None = None, p: str = "_p", tokens: str = "_tokens") -> Column:
    """The rate after the steps, from rate 1; a row without tokens keeps 1."""
    return _followed(steps, most, p, tokens)["rate"]


def _totals(rows: DataFrame, steps: list[Step], most: float | None, size: int) -> tuple[list[float], float]:
    """Per domain the expected tokens after the steps; the tokens times squared change of the rates in the last one.

    One plan whatever the steps are: every row's rate is followed through the steps, and tasks send one row of sums.
    """
    both = rows.select("_tokens", "_p", _followed(steps, most, "_p", "_tokens").alias("_at")).select("_tokens", "_p", "_at.*")
    sums = [f"coalesce(sum(_tokens * _p[{d}] * rate), 0D) AS s{d}" for d in range(size)]
    [row] = both.selectExpr(*sums, "coalesce(sum(_tokens * (rate - before) * (rate - before)), 0D) AS c").collect()
    return list(row)[:size], row[size]


def fit_steps(rows: DataFrame, targets: list[float], most: float | None = None) -> list[Step]:
    """Steps to the rates over rows with _tokens and _p, a written table; each step reads it once.

    Projected gradient with the step length of two successive gradients; of all steps
    those up to the smallest weighted squares are returned.  A domain whose target is 0
    is weighed as if its target were a hundredth of all.
    """
    size = len(targets)
    floor = max(sum(targets), 1.0) * EPSILON
    weights = [1 / max(t, floor) for t in targets]
    steps: list[Step] = []
    totals, _ = _totals(rows, steps, most, size)
    best: tuple[float, int] | None = None
    length = sum(max(t, floor) for t in targets) / max(sum(totals), 1.0) / size
    for step in range(STEPS + 1):
        gradient = [w * (a - t) for w, a, t in zip(weights, totals, targets)]
        loss = sum(w * (a - t) ** 2 for w, a, t in zip(weights, totals, targets))
        if best is None or loss < best[0]:
            best = loss, len(steps)
        if step == STEPS or all(abs(a - t) <= TOLERANCE * max(t, floor) for a, t in zip(totals, targets)):
            break
        steps.append((float(length), gradient))
        after, change = _totals(rows, steps, most, size)
        # <s, s> / <s, y> of the step s and the change y of the gradient, both summed over documents.
        curve = sum(w * (b - a) ** 2 for w, a, b in zip(weights, totals, after))
        if change == 0 or curve == 0:
            break
        length, totals = change / curve, after
    return steps[: best[1]]


def fit_rates(rows: DataFrame, targets: list[float], most: float | None = None) -> DataFrame:
    """Add _rate >= 0 (and <= ``most``) to rows with _tokens and _p, a written table."""
    return rows.withColumn("_rate", rate_of(fit_steps(rows, targets, most), most))


def mixed(
    docs: DataFrame, labelled: DataFrame, shares: dict[str, float], tokens: float | None = None, most: float | None = None
) -> DataFrame:
    """_doc (with doc_id), _tokens, _p and _rate of every row; ``tokens`` is the total to reach, the present one if None.

    A target total that no rates can reach is approached in least squares.
    """
    domains = tuple(shares)
    rows = materialize(posteriors(docs, labelled, domains, ["doc_id"]), "posteriors")
    total = tokens if tokens is not None else rows.agg(F.coalesce(F.sum("_tokens"), F.lit(0))).first()[0]
    whole = sum(shares.values())
    return fit_rates(rows, [total * shares[d] / whole for d in domains], most)


def rates(docs: DataFrame, labelled: DataFrame, shares: dict[str, float] = SHARES) -> DataFrame:
    """doc_id, tokens, a posterior p_<domain> for each domain and the rate of every document.

    Null and empty texts have no tokens, the posterior of a text without known words, and
    rate 1.  Repeated rows get equal rates, an empty table gives no rows, and columns
    other than doc_id and text are not looked at.
    """
    rows = mixed(docs.select(F.col("doc_id").cast("bigint"), "text"), labelled, shares)
    p = [F.col("_p")[k].alias(f"p_{d}") for k, d in enumerate(shares)]
    return rows.select("_doc.doc_id", F.col("_tokens").cast("bigint").alias("tokens"), *p, F.col("_rate").alias("rate"))


def resample(
    docs: DataFrame,
    labelled: DataFrame,
    shares: dict[str, float],
    keep: str,
    most: float = 1.0,
    headroom: float = 0.02,
) -> DataFrame:
    """Each row of ``docs`` as often as its rate says: the whole part, and once more if a hash falls below the rest.

    The total is set so that the domain ``keep`` has its share with all its present
    tokens and a little more (``headroom``), so that its documents stay; with the default
    ``most`` no document is repeated.  A row without tokens stays.
    """
    domains = tuple(shares)
    rows = materialize(posteriors(docs, labelled, domains, docs.columns), "posteriors")
    # Every step reads these two columns: without the documents they are few tasks.
    narrow = materialize(rows.select("_tokens", "_p"), "memberships")
    place = domains.index(keep)
    present = narrow.agg(F.coalesce(F.sum(F.col("_tokens") * F.col("_p")[place]), F.lit(0.0))).first()[0]
    targets = [present * (1 + headroom) * shares[d] / shares[keep] for d in domains]
    fitted = rows.withColumn("_rate", rate_of(fit_steps(narrow, targets, most), most))
    draw = F.pmod(F.xxhash64(F.col("_doc.doc_id"), F.col("_doc.text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = F.floor(F.col("_rate") + draw).cast("int")
    if most <= 1:
        return fitted.filter(times >= 1).select("_doc.*")
    return fitted.filter(times >= 1).select("_doc", F.explode(F.sequence(F.lit(1), times))).select("_doc.*")
