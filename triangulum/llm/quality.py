"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document.
Expectation-maximisation estimates each labeller's accuracy from the counts of all vote
patterns, without a true label, and gives every pattern a posterior.  The posteriors
label a bounded sample on which a linear scorer over hashed word shapes is trained; it
then scores every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

SAMPLE_DOCS, SAMPLE_FILES = 12_000, 6
FEATURES = 1 << 12
ROUNDS, TOLERANCE = 200, 1e-9
GOOD, BAD = 1, 2

# Frequent function words of the four languages.
FUNCTION_WORDS = (
    "the of and to in a is that for it as with on are this was be by at from "
    "der die und das von den mit ist im für auf nicht ein eine des dem zu sich auch als "
    "de la le et les des en un du une que est pour dans par sur au avec ce il "
    "el los del las con una por su para al lo como más"
).split()


# So much plain text is thought beside every text: a few words tell little.
PLAIN_CHARS, PLAIN_WORDS = 60, 10


def measures(text: Column, words: Column) -> dict[str, Column]:
    """Plain figures of a text: shares of kinds of characters and words."""

    def _share(part: Column, whole: Column) -> Column:
        return part / (whole + (PLAIN_CHARS if whole is length else PLAIN_WORDS))

    length = F.length(text)
    count = F.size(words)
    signs = F.regexp_replace(text, r"[\p{L}\p{M}\p{N}\s]+", "")

    def number(of: str) -> Column:
        return F.length(signs) - F.length(F.translate(signs, of, ""))

    return {
        "symbols": _share(number("*#$%&~^=<>{}@_\\"), length),
        "bars": _share(number("|"), length),
        "shouts": _share(number("!"), count),
        "capitals": _share(length - F.length(F.regexp_replace(text, r"\p{Lu}+", "")), length),
        "stops": _share(number(".,;:?"), count),
        "distinct": _share(F.size(F.array_distinct(words)) + PLAIN_WORDS, count),
        "function": F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in sorted(set(FUNCTION_WORDS))]))),
        "words": count,
    }


# Each labeller: bad when, good when, else abstain.
LABELLERS = {
    "symbols": ("symbols > 0.06", "symbols < 0.01"),
    "bars": ("bars > 0.05", "bars < 0.005"),
    "shouts": ("shouts > 0.15", "shouts < 0.02"),
    "capitals": ("capitals > 0.30", "capitals < 0.08"),
    "stops": ("words >= 40 AND stops < 0.01", "stops BETWEEN 0.03 AND 0.5"),
    "repeats": ("words >= 20 AND distinct < 0.25", "words < 20 OR distinct > 0.30"),
    "function": ("words >= 40 AND function < 2", "function >= 3"),
}


def votes() -> Column:
    """The vote pattern as text, one digit per labeller: 0 abstains, 1 good, 2 bad."""
    digits = [f"CASE WHEN {bad} THEN '{BAD}' WHEN {good} THEN '{GOOD}' ELSE '0' END" for bad, good in LABELLERS.values()]
    return F.expr(f"concat({', '.join(digits)})")


@dataclass(frozen=True)
class WeakLabels:
    """What expectation-maximisation found: the share of bad documents, and P(vote | class)."""

    prior: float
    rates: np.ndarray  # labeller x class (good, bad) x vote (abstain, good, bad)

    def posterior(self, pattern: str) -> float:
        """P(bad | votes)."""
        picked = self.rates[np.arange(len(pattern)), :, [int(c) for c in pattern]]
        good, bad = np.array([1 - self.prior, self.prior]) * picked.prod(axis=0)
        return float(bad / (good + bad)) if good + bad > 0 else self.prior


def estimate(counts: dict[str, int]) -> WeakLabels:
    """Expectation-maximisation over the counts of vote patterns (at most 3^labellers of them)."""
    patterns = sorted(counts)
    votes_of = np.array([[int(c) for c in p] for p in patterns]).reshape(len(patterns), -1)
    weight = np.array([counts[p] for p in patterns], float)
    bad, good = (votes_of == BAD).sum(axis=1), (votes_of == GOOD).sum(axis=1)
    # Junk is junk in one way: a start in which one bad vote weighs as much as three good ones.
    belief = (bad + 0.2) / (bad + good / 3 + 0.6)
    onehot = votes_of[:, :, None] == np.arange(3)
    prior, rates = 0.5, np.full((votes_of.shape[1], 2, 3), 1 / 3)
    for _ in range(ROUNDS):
        classes = np.stack([1 - belief, belief], axis=1) * weight[:, None]
        fresh = np.einsum("pc,plv->lcv", classes, onehot) + 0.1
        fresh /= fresh.sum(axis=2, keepdims=True)
        prior = float((classes[:, 1].sum() + 0.1) / (weight.sum() + 0.2))
        moved, rates = np.abs(fresh - rates).max(), fresh
        logs = np.log(rates)[np.arange(votes_of.shape[1])[None], :, votes_of].sum(axis=1)
        logs += np.log([1 - prior, prior])
        belief = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if moved < TOLERANCE:
            break
    return WeakLabels(prior, rates)


def _shapes(text: Column) -> Column:
    """The words with letters folded to a (with a small one) or A, digits to 0."""
    folded = F.regexp_replace(text, r"\p{Lu}*\p{Ll}[\p{L}\p{M}]*", "a")
    shapes = F.split(F.regexp_replace(F.regexp_replace(folded, r"\p{Lu}+", "A"), r"[0-9]+", "0"), r"\s+")
    return F.concat(shapes, F.array_repeat(F.lit("a"), PLAIN_WORDS))


DENSE = ["distinct", "capitals", "symbols", "bars", "shouts", "stops"]


def _measured(docs: DataFrame) -> DataFrame:
    """_doc (the whole row), _text, the measures and the vote pattern."""
    rows = docs.select(F.struct("*").alias("_doc"), text_of().alias("_text"))
    rows = rows.withColumn("_words", F.filter(F.split("_text", r"\s+"), lambda w: w != ""))
    return rows.withColumns(measures(F.col("_text"), F.col("_words"))).drop("_words").withColumn("_votes", votes())


def _vectors(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_shapes", _shapes(F.col("_text"))).drop("_text")
    rows = HashingTF(numFeatures=FEATURES, inputCol="_shapes", outputCol="_tf").transform(rows)
    rows = Normalizer(p=1.0, inputCol="_tf", outputCol="_norm").transform(rows.drop("_shapes"))
    return VectorAssembler(inputCols=["_norm", *DENSE], outputCol="_vector").transform(rows).drop("_tf", "_norm")


def classify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Every row as _doc (a struct of its columns) with _votes, _weak (posterior) and _bad (score).

    About ``sample_docs`` rows, chosen by a hash of the text, train the scorer; votes,
    accuracies and scores cover all rows.  When the votes leave only one class, the
    posterior is the score.
    """
    measured = _measured(docs)
    counts = {r["_votes"]: r["count"] for r in measured.groupBy("_votes").count().collect()}
    if not counts:
        return measured.select("_doc", "_votes", F.lit(0.0).alias("_weak"), F.lit(0.0).alias("_bad"))
    found = estimate(counts)
    posterior = {p: found.posterior(p) for p in counts}
    weak = F.create_map(*[F.lit(x) for p, q in posterior.items() for x in (p, q)])[F.col("_votes")]
    measured = measured.withColumn("_weak", weak)
    share = max(1, sum(counts.values()) // sample_docs)
    picked = measured.filter(F.pmod(F.xxhash64("_text"), F.lit(share)) == 0).drop("_doc")
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("_weak").alias("w")),
                             F.struct(F.lit(0.0).alias("y"), (1 - F.col("_weak")).alias("w"))))
    sample = _vectors(picked).select("_vector", both.alias("_l")).select("_vector", "_l.*").filter("w > 0.001")
    # Bounded whatever the input: few files, and not one from every task that scans the texts.
    sample = materialize(sample.repartition(SAMPLE_FILES), "weak-labels")
    if sample.select("y").distinct().count() < 2:
        return measured.select("_doc", "_votes", "_weak", F.col("_weak").alias("_bad"))
    model = LogisticRegression(
        featuresCol="_vector", labelCol="y", weightCol="w", maxIter=60, regParam=1e-4,
        rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_guess",
    ).fit(sample)
    scored = model.transform(_vectors(measured))
    return scored.select("_doc", "_votes", "_weak", vector_to_array("_probability")[1].alias("_bad"))


def score(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, votes, weak (posterior of bad), bad (score) and keep of every row.

    Null and empty texts have no words; only the labellers for characters vote on them.
    Repeated rows give repeated results, an empty table none; columns other than doc_id
    and text are not looked at.
    """
    rows = classify(docs.select(F.col("doc_id").cast("bigint"), "text"))
    return rows.select(
        "_doc.doc_id", F.col("_votes").alias("votes"), F.col("_weak").alias("weak"), F.col("_bad").alias("bad"),
        (F.col("_bad") < threshold).alias("keep"),
    )


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the scorer does not reject, with all their columns."""
    return classify(docs).filter(F.col("_bad") < threshold).select("_doc.*")
