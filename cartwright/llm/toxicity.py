"""Toxicity by weak supervision.

Many voters look at a text: folds of a lexicon mined from labelled texts, folds
of word beginnings mined the same way, a fixed list of insults, and patterns.
A generative label model estimates from their votes how often texts are toxic,
how accurate each voter is and which voters repeat each other, and turns votes
into posterior labels. A linear classifier is trained on these posteriors and
scores every text.

The label that people gave counts as one more voter, of a stated accuracy, which
tells the model which class is which; a single wrong label need not be believed.

Words are mined from all labelled texts, and the label model reads all of their
votes. Labelled texts are stored when they have met their labels. What reaches
the driver is the model: the entries that pass the significance test (``min_z``),
one count per combination of votes, and a sample of ``max_rows`` labelled rows
for the linear classifier.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.text import uniform, whole
from cartwright.runtime import materialize

# fixed values: common insults
INSULTS = """
    idiot moron imbecile stupid dumb fool loser scum trash garbage worthless pathetic disgusting clown
    coward vermin filth pig bastard bitch asshole retard shut hate
    dumm dummkopf arschloch abschaum wertlos erbärmlich widerlich versager
    débile crétin connard ordure minable dégoûtant nul
    estúpido imbécil basura inútil patético asqueroso escoria
""".split()
# fixed values: words that address a reader
ADDRESS = "you your du dich dein tu toi vous tú ti usted".split()

WORD_FOLDS, PREFIX_FOLDS = 6, 3
PREFIX_LENGTHS = (4, 5, 6)
PATTERNS = ("insult", "several", "dense", "address", "shouting")
VOTERS = WORD_FOLDS + PREFIX_FOLDS + len(PATTERNS)
#: Voters' votes, then the logarithms of their hits, then hits per word.
FEATURES = VOTERS + WORD_FOLDS + PREFIX_FOLDS + 2

MIN_Z = 3.0
MIN_RATIO = 20.0
MIN_FAMILY = 4
MAX_ROWS = 20_000
#: Accuracy that the label model gives to a human label.
TRUST = 0.98
SEED = 6

_WORDS = re.compile(r"\w+")


def held_out(modulus: int = 5, remainder: int = 0):
    """Whether the CRC-32 of the id's text has this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


@dataclass
class Lexicon:
    """Mined words and word beginnings with the fold each belongs to."""

    words: dict[str, int] = field(default_factory=dict)
    prefixes: dict[str, int] = field(default_factory=dict)


def _log_odds(t: Column, c: Column, totals: Row) -> tuple[Column, Column]:
    """Log ratio of the two rates, and how many standard errors it is from 0."""
    odds = F.log((t + 0.5) / (totals["t"] + 1)) - F.log((c + 0.5) / (totals["c"] + 1))
    return odds, odds / F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))


def mine_lexicon(labelled: DataFrame, *, min_z: float = MIN_Z, min_ratio: float = MIN_RATIO) -> Lexicon:
    """Words that mark toxic texts, and word beginnings that many of them share.

    ``labelled`` holds (text, toxic). A word is a candidate if the share of
    toxic texts that have it is ``min_ratio`` times that of other texts and
    ``min_z`` standard errors above it. Copies of one text would make all of
    its words candidates, so a word must also do so in the number of different
    words it follows. A beginning marks toxic texts if at least ``MIN_FAMILY``
    different words with it, and nine of ten, were found in toxic texts alone,
    and these are ``min_z`` standard deviations more than such a draw from all
    words would hold. Every word and beginning that passes is an entry.
    """
    is_toxic = F.col("toxic") == 1
    totals = labelled.agg(F.count_if(is_toxic).alias("t"), F.count_if(~is_toxic).alias("c")).first()
    words_of = F.split(F.lower(whole()), r"[^\p{L}\p{N}_]+")
    words = (
        labelled.select("toxic", F.explode(F.array_distinct(words_of)).alias("entry"))
        .filter("entry != ''")
        .groupBy("entry").agg(F.count_if(is_toxic).alias("t"), F.count_if(~is_toxic).alias("c"))
    )
    words = materialize(words, "words")

    def marking(table: DataFrame) -> DataFrame:
        odds, z = _log_odds(F.col("t"), F.col("c"), totals)
        return table.withColumns({"odds": odds, "z": z}).filter(
            (F.col("odds") >= float(np.log(min_ratio))) & (F.col("z") >= min_z)
        )

    candidates = materialize(marking(words).select("entry"), "candidates")
    contexts = (
        labelled.select("toxic", words_of.alias("w"))
        .select("toxic", F.inline(F.arrays_zip(F.concat(F.array(F.lit("")), "w").alias("before"), F.col("w").alias("entry"))))
        .groupBy("entry", "before").agg(F.max(is_toxic).alias("t"), F.max(~is_toxic).alias("c"))
        .join(candidates, "entry", "left_semi")
        .groupBy("entry").agg(F.sum(F.col("t").cast("int")).alias("t"), F.sum(F.col("c").cast("int")).alias("c"))
    )
    chosen = materialize(marking(contexts).select("entry"), "marking")
    beginnings = F.explode(F.array_distinct(F.array(*[F.substring("entry", 1, n) for n in PREFIX_LENGTHS])))
    only_toxic = ((F.col("t") > 0) & (F.col("c") == 0)).cast("int")
    long_enough = words.filter(F.length("entry") >= min(PREFIX_LENGTHS))
    usual = long_enough.agg(F.avg(only_toxic).alias("share")).first()["share"] or 0.0
    spread = F.sqrt(F.col("n") * (usual * (1 - usual)))
    prefixes = (
        long_enough.select(only_toxic.alias("hit"), beginnings.alias("prefix"))
        .groupBy("prefix").agg(F.sum("hit").alias("hits"), F.count("*").alias("n"))
        .filter((F.col("hits") >= MIN_FAMILY) & (10 * F.col("hits") >= 9 * F.col("n")))
        .filter(F.col("hits") - F.col("n") * usual >= min_z * spread)
        .select(F.col("prefix").alias("entry"))
    )

    def folds(table: DataFrame, n: int) -> dict[str, int]:
        rows = table.select("entry", F.pmod(F.xxhash64("entry"), F.lit(n)).cast("int").alias("fold")).collect()
        return {r["entry"]: r["fold"] for r in rows}

    return Lexicon(folds(chosen, WORD_FOLDS), folds(prefixes, PREFIX_FOLDS))


def features_of(text: str, lexicon: Lexicon) -> list[float]:
    """Votes (0 or 1), logarithms of hits per fold, and hits per 100 words of one text."""
    words = _WORDS.findall(text.lower())
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    hits, prefixes = [0] * (WORD_FOLDS + PREFIX_FOLDS), lexicon.prefixes
    found, mined, insults = set(), 0, 0
    for w, n in counts.items():
        fold = lexicon.words.get(w)
        if fold is not None:
            hits[fold] += n
            mined += n
            found.add(w)
        for length in PREFIX_LENGTHS:
            fold = prefixes.get(w[:length])
            if fold is not None:
                hits[WORD_FOLDS + fold] += n
                found.add(w)
        if w in _INSULTS:
            insults += n
            found.add(w)
    total = sum(counts[w] for w in found)
    n_words = max(1, len(words))
    upper = sum(map(str.isupper, text)) if "!" in text else 0
    votes = [float(h > 0) for h in hits] + [
        float(insults > 0),
        float(len(found) > 1),
        float(100 * total >= n_words and total > 0),
        float(any(w in counts for w in ADDRESS)),
        float(upper * 10 >= 3 * len(text) and upper > 0),
    ]
    return [*votes, *np.log1p(hits).tolist(), float(np.log1p(total)), min(1.0, 10 * total / n_words)]


_INSULTS = frozenset(INSULTS)


# --------------------------------------------------------------- label model


@dataclass
class LabelModel:
    """How often texts are toxic, P(vote | class) of every voter, and how much each voter's word is worth."""

    prior: float
    positive: np.ndarray
    weight: np.ndarray
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) for rows of 0, 1 or nan (abstains)."""
        known = ~np.isnan(votes)
        v = np.where(known, votes, 0)
        scores = []
        for y in (0, 1):
            p = self.positive[y]
            each = v * np.log(p) + (1 - v) * np.log(1 - p)
            scores.append((each * known * self.weight).sum(axis=1) + np.log(self.prior if y else 1 - self.prior))
        return 1 / (1 + np.exp(np.clip(scores[0] - scores[1], -50, 50)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, *, trust: float = TRUST, rounds: int = 40) -> LabelModel:
    """Accuracies and correlations by expectation maximisation over counted vote patterns.

    The last voter is the label that people gave, whose accuracy in either
    class is ``trust``; that of all others is estimated. Voters that agree
    within both classes more than chance share their weight: a voter's weight
    is one over one plus its positive correlations with the others.
    """
    n_voters = votes.shape[1]
    known = ~np.isnan(votes)
    v = np.where(known, votes, 0)
    weight, correlation = np.ones(n_voters), np.eye(n_voters)
    posterior = np.where(votes[:, -1] == 1, trust, 1 - trust)
    model = None
    for step in range(rounds):
        shares = np.stack([counts * (1 - posterior), counts * posterior])
        seen = shares @ known
        positive = np.clip((shares @ v + 0.5) / (seen + 1), 1e-3, 1 - 1e-3)
        positive[:, -1] = 1 - trust, trust
        prior = float(np.clip(shares[1].sum() / counts.sum(), 1e-3, 0.5))
        if step in (rounds // 3, 2 * rounds // 3):
            covariance = np.zeros((n_voters, n_voters))
            for y in (0, 1):
                centred = np.where(known, v - positive[y], 0)
                covariance += (centred * shares[y][:, None]).T @ centred
            scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
            correlation = covariance / np.outer(scale, scale)
            others = np.clip(correlation - np.diag(np.diag(correlation)), 0, 1)
            weight = 1 / (1 + np.where(others > 0.1, others, 0).sum(axis=1))
            weight[-1] = 1
        model = LabelModel(prior, positive, weight, correlation)
        posterior = model.posterior(votes)
    return model


# ---------------------------------------------------------------- classifier


def fit_linear(x: np.ndarray, y: np.ndarray, *, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels; the last weight is the intercept, which is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _without_labels() -> np.ndarray:
    """Weights where nothing can be learnt: an insult makes a text toxic."""
    w = np.zeros(FEATURES + 1)
    w[WORD_FOLDS + PREFIX_FOLDS], w[-1] = 4.0, -2.0
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, *, min_z: float = MIN_Z, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``.

    ``labels`` (doc_id, toxic) must hold the training labels only. All of them
    teach the lexicon and the label model; the weights of the linear classifier
    are fitted on ``max_rows`` of them, chosen by a hash of their ids. A document
    with several labels is toxic if any says so; rows that repeat a ``doc_id`` with
    other texts all train under its label; null labels and labels of unknown
    documents teach nothing. If there are not two classes to learn
    from, the fixed insults decide. Scores depend on the text alone; a null or
    empty text has the score of a text without any vote.
    """
    gold = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("gold_id")).agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select("doc_id", whole().alias("text"))
    # One join form at every size, so that its cost grows in proportion: it builds on the labels, one row per id.
    labelled = texts.join(gold.hint("shuffle_hash"), F.col("doc_id") == F.col("gold_id"))
    labelled = materialize(labelled.select("doc_id", "text", "toxic"), "labelled")
    lexicon = mine_lexicon(labelled, min_z=min_z)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([features_of(t, lexicon) for t in batch], dtype=object)

    stored = materialize(texts.select("doc_id", features("text").alias("x")), "features")
    weights = _train(labelled.select("doc_id", "toxic", features("text").alias("x")), max_rows)
    score = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        score = score + F.col("x")[i] * float(w)
    score = 1 / (1 + F.exp(-score))
    return stored.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _train(known: DataFrame, max_rows: int) -> np.ndarray:
    """Weights from the features of all labelled texts (doc_id, toxic, x)."""
    known = materialize(known, "labelled-features")
    votes = F.slice("x", 1, VOTERS).cast("array<tinyint>").alias("votes")
    patterns = known.groupBy(votes, "toxic").agg(F.count("*").alias("n")).collect()
    if len({p["toxic"] for p in patterns}) < 2:
        return _without_labels()
    votes = np.array([[*p["votes"], p["toxic"]] for p in patterns], float)
    counts = np.array([p["n"] for p in patterns], float)
    model = fit_label_model(votes, counts)
    draw = uniform(F.col("doc_id"), SEED)
    # Some more than ``max_rows`` are drawn inside the tasks, so that few rows are sorted.
    share = (max_rows + 10 * max_rows**0.5) / counts.sum()
    sample = known.filter(draw < float(share)).orderBy(draw, "doc_id").limit(max_rows).select("x", "toxic").toPandas()
    x = np.array(sample["x"].tolist(), float)
    posterior = model.posterior(np.hstack([x[:, :VOTERS], sample[["toxic"]].to_numpy(float)]))
    return fit_linear(x, posterior)
