"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model over their votes, and a
linear classifier trained on the model's posterior labels."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import documents_of, held_out, written

#: At most about this many labelled documents train the voters and the classifier (chosen by a hash of their id).
LABELLED_SAMPLE = 20_000
#: Voters of the label model, and features of the classifier (the voters among them).
VOTERS = 64
FEATURES = 256
#: Texts whose words are counted together in a task, which bounds its memory.
TOGETHER = 400
#: Letters of the word beginnings that can be a voter.
STEMS = (4, 5, 6)
#: Two voters are taken as correlated if their votes agree by more than this beyond what the label explains.
CORRELATED = 0.1

#: Fixed patterns that vote beside the lexicon.
PATTERNS = {"!!": re.compile(r"[!?]{2}"), "CAPS": re.compile(r"\b[A-Z]{4,} [A-Z]{4,}\b")}
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class LabelModel:
    """Class-conditional voting rates: ``fires[j]`` given label 1, ``misfires[j]`` given label 0, the share of label 1,
    and ``weight[j]``, less than 1 for voters that repeat what correlated ones say."""

    prior: float
    fires: np.ndarray
    misfires: np.ndarray
    weight: np.ndarray
    correlated: np.ndarray

    @classmethod
    def fit(cls, n: float, ones: np.ndarray, both: np.ndarray, marked: np.ndarray, prior: float) -> LabelModel:
        """From the number of texts, each voter's votes, each pair's joint votes, and ``marked``, each voter's covariance
        with the given labels on the sample. The given labels count as one more voter, which is what ties together
        voters that never vote on the same texts.

        Given the true label, independent voters have covariance a_i * a_j with a_i = sqrt(p(1-p)) * (fires_i -
        misfires_i). The rank-one part is fitted to all pairs not known to be correlated; pairs that it leaves far
        off are marked as correlated, and the fit is repeated without them.
        """
        k, n = len(ones), max(n, 1)
        p = min(max(prior, 1e-4), 1 - 1e-4)
        mean = np.append(ones / n, p)
        cov = np.zeros((k + 1, k + 1))
        cov[:k, :k] = both / n - np.outer(mean[:k], mean[:k])
        cov[k, :k] = cov[:k, k] = marked
        sd = np.sqrt(np.clip(mean * (1 - mean), 1e-9, None))
        scale = np.outer(sd, sd)
        pairs = ~np.eye(k + 1, dtype=bool)
        trust = np.ones((k + 1, k + 1))
        trust[k, :] = trust[:, k] = k  # one label against k voters
        free, a = pairs.copy(), sd * 0.5
        for _ in range(8):
            for _ in range(60):
                top, low = (free * trust * cov / scale) @ (a / sd), (free * trust) @ (a / sd) ** 2
                a = 0.5 * a + 0.5 * sd * np.clip(top / np.maximum(low, 1e-12), 1e-6, 1)
            now = pairs & (np.abs(cov - np.outer(a, a)) / scale <= CORRELATED)
            now[k, :k] = now[:k, k] = True
            if (now == free).all():
                break
            free = now
        mean, together = mean[:k], (pairs & ~free)[:k, :k]
        gap = a[:k] / np.sqrt(p * (1 - p))
        least = 0.5 / n
        fires = np.clip(mean + (1 - p) * gap, least, 1 - 1e-6)
        misfires = np.clip(mean - p * gap, least, 1 - 1e-6)
        overlap = np.where(together, np.clip(cov[:k, :k] / scale[:k, :k], 0, 1), 0).sum(axis=1)
        return cls(p, fires, misfires, 1 / (1 + overlap), together)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.fires / self.misfires) * self.weight
        no = np.log((1 - self.fires) / (1 - self.misfires)) * self.weight
        odds = np.log(self.prior / (1 - self.prior)) + votes @ yes + (1 - votes) @ no
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


@dataclass
class ToxicityModel:
    features: list[str] = field(default_factory=list)  # "word", "stem*" or the name of a pattern
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -30.0
    labels: LabelModel | None = None

    def score(self, texts: list[str]) -> np.ndarray:
        odds = np.full(len(texts), self.bias)
        find = finder(self.features)
        for i, text in enumerate(texts):
            odds[i] += sum(self.weights[j] for j in sorted(find(text)))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def finder(features: list[str]):
    """A function from a text to the set of positions of the features it holds; one pass over the text."""
    automaton = ahocorasick.Automaton()
    at: dict[str, list[tuple[int, bool]]] = {}
    for j, name in enumerate(features):
        if name not in PATTERNS:
            at.setdefault(name.rstrip("*"), []).append((j, name.endswith("*")))
    for word, which in at.items():
        automaton.add_word(word, (len(word), which))
    automaton.make_automaton()
    patterns = [(j, PATTERNS[name]) for j, name in enumerate(features) if name in PATTERNS]

    def find(text: str) -> set[int]:
        low = text.lower()
        found = {j for j, pattern in patterns if pattern.search(text)}
        if not at:
            return found
        for end, (length, which) in automaton.iter(low):
            start = end - length
            if start < 0 or not low[start].isalpha():
                whole = end + 1 == len(low) or not low[end + 1].isalpha()
                found.update(j for j, stem in which if stem or whole)
        return found

    return find


def _candidates(text: str) -> set[str]:
    words = set(LETTERS.findall(text.lower()))
    found = {name for name, pattern in PATTERNS.items() if pattern.search(text)}
    found |= {w for w in words if len(w) <= 40}
    return found | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_SAMPLE) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most about ``bound`` labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("label_id is not null and toxic in (0, 1)").where(~held_out("label_id"))
    n = known.count()
    share = int(1_000_000 * min(1.0, bound / max(n, 1)))
    chosen = lambda c: F.pmod(F.xxhash64(c), F.lit(1_000_000)) < share
    known = known.where(chosen("label_id")).groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    # the bound holds for what is broadcast: an id and a label for each row of the sample
    sample = documents_of(docs).where(chosen("doc_id")).join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    return written(sample.select("doc_id", "text", "toxic"), "sample")


def _best_features(sample: DataFrame, n0: int, n1: int) -> list[str]:
    """Words, stems and patterns that occur more often in toxic texts than chance explains, best first."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), TOGETHER):
                part, seen = frame.iloc[at : at + TOGETHER], {0: Counter(), 1: Counter()}
                for text, toxic in zip(part["text"], part["toxic"], strict=True):
                    seen[toxic].update(_candidates(text))
                names = list(seen[0] | seen[1])
                yield pd.DataFrame({"name": names, "n0": [seen[0][x] for x in names], "n1": [seen[1][x] for x in names]})

    counts = sample.mapInPandas(count, "name string, n0 long, n1 long").groupBy("name").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    rate1, rate0 = (F.col("n1") + 0.1) / (n1 + 0.2), (F.col("n0") + 0.1) / (n0 + 0.2)
    z = (rate1 - rate0) / F.sqrt(rate1 * (1 - rate1) / n1 + rate0 * (1 - rate0) / n0)
    ranked = counts.where("n1 >= 2").withColumns({"z": z, "lift": F.log(rate1 / rate0)}).where("z > 2 and lift > 2.5")
    rows = ranked.orderBy(F.desc("z"), "name").limit(4 * FEATURES).collect()
    # a stem with the counts of a longer stem or of a word says nothing that this does not say
    longer = {(name[:n] + "*", r["n0"], r["n1"]) for r in rows for name in [r["name"].rstrip("*")] for n in STEMS if n < len(name) or n == len(name) and r["name"] == name}
    chosen: list[str] = []
    for r in rows:
        if (r["name"], r["n0"], r["n1"]) not in longer and not any(r["name"][:n] + "*" in chosen for n in STEMS):
            chosen.append(r["name"])  # what begins with a chosen stem adds no text to it
    return chosen[:FEATURES]


def _moments(docs: DataFrame, voters: list[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """Texts, votes and joint votes, counted over all documents; a task sends one matrix of fixed size."""
    k = len(voters)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, total, n = finder(voters), np.zeros((k, k), dtype=np.int64), 0
        for frame in frames:
            n += len(frame)
            for text in frame["text"]:
                if hits := sorted(find(text)):
                    total[np.ix_(hits, hits)] += 1
        i, j = np.nonzero(total)
        yield pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1), "n": np.append(total[i, j], n)})

    rows = docs.select("text").mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, n = np.zeros((k, k)), 0
    for r in rows:
        if r["i"] < 0:
            n = r["n"]
        else:
            both[r["i"], r["j"]] = r["n"]
    return float(n), np.diag(both).copy(), both


def _linear(hits: list[list[int]], k: int, target: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by accelerated gradient descent with a small ridge."""
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.array([j for h in hits for j in h], dtype=np.int64)
    w, b, n = np.zeros(k), np.log(max(target.mean(), 1e-4) / max(1 - target.mean(), 1e-4)), len(hits)
    seen = np.bincount(col, minlength=k) + 1.0
    v, c = w.copy(), b
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(c + np.bincount(row, v[col], n), -30, 30)))
        g = np.bincount(col, (p - target)[row], k) / seen * 2 + 1e-3 * v
        w2, b2 = v - g, c - 2 * (p - target).mean()
        m = t / (t + 3)
        v, c, w, b = w2 + m * (w2 - w), b2 + m * (b2 - b), w2, b2
    return w, float(b)


def _cut(odds: np.ndarray, given: np.ndarray) -> float:
    """The odds that split the given labels with the fewest errors; of several such, the middle one."""
    values = np.unique(odds)
    edges = np.concatenate(([values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]))
    at = np.searchsorted(values, odds)
    ones, zeros = np.bincount(at[given == 1], minlength=len(values)), np.bincount(at[given == 0], minlength=len(values))
    errors = np.concatenate(([0], np.cumsum(ones))) + zeros.sum() - np.concatenate(([0], np.cumsum(zeros)))
    best = edges[errors == errors.min()]
    return float(best[len(best) // 2])


def fit(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_SAMPLE) -> ToxicityModel:
    """Train on ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    Only the bounded labelled sample chooses the voters and gives the share of toxic texts; the label model is fitted
    to the votes on all documents, and the classifier to its posterior on the sample, whose labels then place its
    threshold. Without a labelled text of each
    kind nothing can be learnt: every score is then the share of toxic labels, zero if there are none.
    """
    sample = labelled_sample(docs, labels, bound)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return ToxicityModel(bias=30.0 if n1 else -30.0)
    prior = n1 / (n0 + n1)
    features = _best_features(sample, n0, n1)
    if not features:
        return ToxicityModel(bias=float(np.log(prior / (1 - prior))))
    voters = features[:VOTERS]
    def find_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = finder(features)
        for frame in frames:
            yield pd.DataFrame({"toxic": frame["toxic"], "hits": [sorted(find(x)) for x in frame["text"]]})

    found = sorted(sample.select("text", "toxic").mapInPandas(find_all, "toxic int, hits array<int>").collect())
    hits = [list(r["hits"]) for r in found]
    votes = np.zeros((len(hits), len(voters)))
    for i, h in enumerate(hits):
        votes[i, [j for j in h if j < len(voters)]] = 1
    given = np.array([r["toxic"] for r in found], dtype=float)
    marked = (votes * (given - prior)[:, None]).mean(axis=0)
    model = LabelModel.fit(*_moments(documents_of(docs), voters), marked, prior)
    weights, bias = _linear(hits, len(features), model.posterior(votes))
    odds = np.array([bias + sum(weights[j] for j in h) for h in hits])
    return ToxicityModel(features, weights, bias - _cut(odds, given), model)


def scorer(model: ToxicityModel):
    """A column function: the score of each whole text, null and empty ones included."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(model.score([x or "" for x in part]))

    return score


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; null texts count as empty, repeated rows are each
    scored, further columns are ignored, an empty table gives no rows."""
    scored = documents_of(docs).select("doc_id", held_out().alias("held_out"), scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    model = fit(docs, labels)
    return docs.where(scorer(model)(F.col("text").cast("string")) < 0.5)
