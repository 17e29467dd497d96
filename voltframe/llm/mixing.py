"""Soft-membership mixing to target weights.

A classifier learnt from the labelled documents gives each document a posterior
over domains; nonnegative document rates are then fitted so that the expected
domain token totals, sum over documents of rate * tokens * posterior, match the
targets. Everything is DataFrame expressions: no Python touches a row.

Classifier: multinomial naive Bayes over the first and the last ``PART``
characters of each word, hashed to ``BUCKETS`` buckets; white space separates
words, marks around them don't count. The buckets of every document are stored
once, as small numbers: its text is neither dealt out nor read again. The
parameters are one grouped sum per domain and bucket over all labelled
documents, so a hot domain is combined map-side, whatever the domains are called
and whichever column holds them. Log odds are divided by the square root of the
number of features to keep posteriors soft on long texts.

Rates: of all rates of at least 1 whose totals are in the targets' proportions,
those nearest 1 (least squares weighted by tokens; the mixture's size is free).
They have the form max(1, 1 + sum_k force_k * posterior_k), the projection of an
unbounded rate onto its bound, so the fit looks for one force per domain: least
squares whose gradient is how far the domain totals are off. Projected gradient
steps are scaled by the curvature of the documents that the bound doesn't hold
(as in Newton's method) and shortened until the objective falls; a handful
settle it. A step is one aggregate of a few numbers per pair of domains, so the
driver sees those sums and nothing else; a document's rate follows from the
forces: no rate table is shuffled. A single document can't drive the others'
rates, since none is divided by another.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import KEY, WORD_SEPARATOR, checkpointed, row_key, stored, table

#: Share of the mixture's tokens that each domain is to have.
TARGETS = {"en": 0.58, "de": 0.15, "fr": 0.15, "es": 0.12}
#: A power of two, below 2 ** 15.
BUCKETS = 2048
PART = 3
#: Stripped from both ends of a word before its parts are taken.
AROUND = ".,;:!?()[]{}<>\"'`*_-/\\|\u2026\u2013\u2014\u00ab\u00bb\u201c\u201d\u201e\u2018\u2019\u00a1\u00bf"
#: Most steps of one fit; a fit that hasn't settled by then is an error.
STEPS = 60
#: How far a domain's share of the mixture may be from its target.
TOLERANCE = 1e-3
#: Weights of the forces in the objective, tried in turn until the targets are met.
#: They keep the fit bounded where no rates can meet them.
RIDGES = (1e-3, 1e-4, 1e-5)


def words(text: Column) -> Column:
    """The lower-case words between ASCII white space; empty for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_SEPARATOR, -1), "")


def buckets(words: Column) -> Column:
    """Buckets, 0 to ``BUCKETS`` - 1, of the beginnings and the ends of ``words``."""
    def hashed(part: Column) -> Column:
        return F.xxhash64(part).bitwiseAND(F.lit(BUCKETS - 1)).cast("smallint")
    def stripped(w: Column) -> Column:  # a word that begins with a letter has marks at its end only
        plain = (w >= F.lit("a")) & (w < F.lit("{"))
        return F.when(plain, F.rtrim(w, F.lit(AROUND))).otherwise(F.trim(w, F.lit(AROUND)))
    bare = F.transform(words, stripped)
    return _once(bare, lambda b: F.concat(F.transform(b, lambda w: hashed(F.substring(w, 1, PART))),
                                          F.transform(b, lambda w: hashed(F.substring(w, -PART, PART)))))


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once, not wherever it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def domain_model(labelled: DataFrame, domains: list[str]) -> tuple[list[float], np.ndarray]:
    """Log priors and log probabilities of the buckets (a row for each) of
    ``domains`` from rows with ``domain`` and ``at`` (``buckets``); Laplace-smoothed, so a
    domain without labelled rows gets a flat one."""
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")).cast("int") - 1
    # bucket BUCKETS counts the rows; one number stands for domain and bucket
    at = F.explode(F.concat(F.array(F.lit(BUCKETS).cast("smallint")), F.col("at"))).alias("at")
    got = (labelled.where(F.col("domain").isin(domains)).select(number.alias("k"), at)
           .groupBy((F.col("k") * (BUCKETS + 1) + F.col("at")).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())
    n, counts = np.zeros(len(domains)), np.ones((BUCKETS, len(domains)))
    for r in got:
        k, b = divmod(r["cell"], BUCKETS + 1)
        if b == BUCKETS:
            n[k] = r["n"]
        else:
            counts[b, k] += r["n"]
    priors = np.log((n + 1) / (n.sum() + len(domains)))
    return [float(p) for p in priors], np.log(counts / counts.sum(axis=0))


def posteriors(at: Column, model: tuple[list[float], np.ndarray]) -> Column:
    """Array of the domains' posteriors of a document with the buckets ``at``."""
    priors, logs = model

    def numbers(values) -> Column:  # one literal, folded by the optimiser
        return F.split(F.lit(" ".join(f"{x:.6g}" for x in values)), " ").cast("array<double>")

    def logit(prior: float, logs) -> Column:
        table = numbers(logs)
        total = F.aggregate(at, F.lit(0.0), lambda a, b: a + F.get(table, b))
        return F.lit(prior) + total / F.sqrt(F.size(at) + 1.0)

    def share(logits: Column) -> Column:
        raised = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
        return _once(raised, lambda r: F.transform(
            r, lambda x: x / F.aggregate(r, F.lit(0.0), lambda a, y: a + y)))
    # odds against the last domain: one lookup less for each feature
    odds = [logit(p - priors[-1], logs[:, k] - logs[:, -1]) for k, p in enumerate(priors[:-1])]
    return _once(F.array(*odds, F.lit(0.0)), share)


def _wanted(post: Column, targets: Mapping[str, float]) -> Column:
    """Whether the likeliest domain has a share in the mixture."""
    shares = F.array(*[F.lit(float(t)) for t in targets.values()])
    return F.get(shares, (F.array_position(post, F.array_max(post)) - 1).cast("int")) > 0


def _pull(force: np.ndarray, post: Column) -> Column:
    terms = [F.lit(float(f)) * F.get(post, F.lit(k)) for k, f in enumerate(force)]
    return sum(terms[1:], terms[0])


def _rate(force: np.ndarray, targets: Mapping[str, float], tokens: Column, post: Column) -> Column:
    rate = F.greatest(F.lit(1.0), 1.0 + _pull(force, post))
    return F.when(tokens <= 0, F.lit(1.0)).when(_wanted(post, targets), rate).otherwise(F.lit(0.0))


class _Fit:
    """The objective over the wanted documents with tokens: half the sum of tokens *
    max(0, pull)^2, plus what the rates of 1 give, plus the ridge."""

    def __init__(self, members: DataFrame, targets: Mapping[str, float]):
        self.members = members.where((F.col("tokens") > 0) & _wanted(F.col("post"), targets))
        self.target = np.array([float(t) for t in targets.values()]) / sum(targets.values())
        self.k = len(targets)
        start = self.sums(np.zeros(self.k))
        self.size = start[1].sum()  # all posteriors of a document add up to 1
        self.base = start[1] / self.size if self.size else start[1]

    def sums(self, force: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Half the squares, the domain totals and the curvature at ``force``."""
        tokens, post = F.col("tokens"), F.col("post")
        pull = _pull(force, post)
        at = [F.get(post, F.lit(k)) for k in range(self.k)]
        free = F.when(pull >= 0, tokens).otherwise(0.0)  # the bound doesn't hold these
        got = self.members.agg(
            F.sum(free * pull * pull / 2), *[F.sum((tokens + free * pull) * p) for p in at],
            *[F.sum(free * at[i] * at[j]) for i in range(self.k) for j in range(i + 1)]).first()
        got = [float(x or 0.0) for x in got]
        curve = np.zeros((self.k, self.k))
        curve[np.tril_indices(self.k)] = got[1 + self.k:]
        return got[0], np.array(got[1:1 + self.k]), curve + np.tril(curve, -1).T

    def settle(self, force: np.ndarray, ridge: float, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forces at the least of the objective, those of domains out of ``use``
        staying 0, and by how much the share of each domain in use is too small."""
        aim, base = self.target, self.base
        weight = np.maximum(base, 1e-9)

        def value(half: float, force: np.ndarray) -> float:
            return half / self.size + base @ force + ridge / 2 * (weight * force ** 2).sum()
        half, totals, curve = self.sums(force)
        now = value(half, force)
        for _ in range(STEPS):
            slope = totals / self.size + ridge * weight * force
            # forces stay at right angles to the targets: that leaves the size free
            n = int(use.sum())
            system = np.zeros((n + 1, n + 1))
            system[:n, :n] = (curve / self.size + ridge * np.diag(weight) + 1e-12 * np.eye(self.k))[np.ix_(use, use)]
            system[:n, n] = system[n, :n] = -aim[use]
            found = np.linalg.lstsq(system, np.append(-slope[use], 0.0), rcond=None)[0]
            step = np.zeros(self.k)
            step[use] = found[:n]
            if abs(slope @ step) < 1e-12:
                break
            length = 1.0
            while True:
                half, totals, curve = self.sums(force + length * step)
                then = value(half, force + length * step)
                if then <= now + 1e-4 * length * (slope @ step) or length < 1e-6:
                    break
                length /= 2
            force, before, now = force + length * step, now, then
            if before - now < 1e-12 * max(1.0, abs(now)):
                break
        else:
            raise RuntimeError(f"mixing rates did not settle in {STEPS} steps")
        short = np.zeros(self.k)
        short[use] = aim[use] / aim[use].sum() - totals[use] / totals[use].sum()
        return force, short


def fit_forces(members: DataFrame, targets: Mapping[str, float]) -> np.ndarray:
    """One force a domain (order of ``targets``) for ``members`` (``tokens``,
    ``post``). If no rates can meet the targets (no document is of some domain,
    say), the domain that falls shortest is given up with a warning, and the
    others are fitted to their targets among themselves."""
    fit = _Fit(members, targets)
    use = fit.target > 0
    while fit.size and use.sum() > 1:
        force = np.zeros(len(targets))
        for ridge in RIDGES:
            force, short = fit.settle(force, ridge, use)
            if np.abs(short).max() <= TOLERANCE:
                return force
        worst = int(short.argmax())
        warnings.warn(f"mixing: no rates give {list(targets)[worst]!r} its share; it is {short[worst]:.3f} too small",
                      stacklevel=2)
        use = use & (np.arange(len(use)) != worst)
    return np.zeros(len(targets))


def fitted_rate(members: DataFrame, targets: Mapping[str, float]) -> Column:
    """Rate of each of ``members`` (``tokens``, ``post``): 1 at least. Documents
    whose likeliest domain has target 0 get 0, those without tokens 1."""
    return _rate(fit_forces(members, targets), targets, F.col("tokens"), F.col("post"))


def mixture(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS,
            id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """One row per row key of ``docs`` (id and text): ``tokens``, ``post`` (posteriors in the
    order of ``targets``), ``rate`` and ``copies``, the rate rounded up or down
    by a hash of the row so that its expectation is the rate. No rate is below 1
    unless a target is 0 (``fitted_rate``), so ``copies`` is 1 at least.

    ``labels`` names the labelled documents by ``doc_id``; their ``domain_col``
    teaches the classifier. A label outside ``targets`` or a null one teaches
    nothing. A null or empty text has no words and no tokens: posterior equal
    to the prior, rate 1, one copy. Null ids and repeated rows take part like
    others. Without labelled documents all domains are alike. An empty table
    gives an empty result."""
    names = list(targets)
    known = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    read = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), F.col(domain_col).alias("domain"), _once(
        words(F.col(text_col)), lambda w: F.struct(F.size(w).cast("long").alias("tokens"), buckets(w).alias("at"))).alias("read"))
    read = stored(read.select(*KEY, "id", "domain", "read.*"), "mixing-buckets")
    # always by a shuffle, as the labels grow with the documents
    labelled = read.where(F.col("domain").isin(names)).select("id", "domain", "at").join(known.hint("merge"), "id", "left_semi")
    model = domain_model(labelled, names)
    members = checkpointed(read.select(*KEY, F.col("id").alias(id_col), "tokens", posteriors(F.col("at"), model).alias("post")))
    rate = fitted_rate(members, targets)
    draw = (F.pmod(F.xxhash64(*KEY), F.lit(1 << 30)) / float(1 << 30))
    return (members.withColumn("rate", rate)
            .withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long"))))


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, id_col: str = "doc_id",
        text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """``docs`` with each row as often as its ``copies`` says."""
    copies = (mixture(docs, labels, targets, id_col, text_col, domain_col)
              .select(*KEY, F.col("copies").cast("int").alias("__copies")).distinct())
    keyed = docs.withColumns(dict(zip(KEY, row_key(id_col, text_col)))).join(copies, KEY)
    again = keyed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies"))))
    return again.drop(*KEY, "__copies", "__copy")


def op6_soft_mixing(spark, sf_dir: str) -> DataFrame:
    got = mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    post = [F.get("post", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(TARGETS)]
    return got.select("doc_id", "tokens", *post, "rate", "copies")
