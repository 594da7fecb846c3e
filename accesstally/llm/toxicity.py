"""Toxicity by weak supervision.

Voters are words (a lexicon) and beginnings of words (patterns) that stand out in documents labelled
toxic, and a few that look at how many of those a text holds. A generative model of two classes
estimates how often each voter fires in either class, by expectation maximisation over the votes of all
documents, and how far voters that fire together repeat each other; a repeated vote weighs less. A
linear classifier is then trained on the posterior labels and scores every document.

Labels enter in two places, both from at most ``LABELLED`` rows outside the held-out fold: voters are
chosen on them, and they start the model and stay in its counts. The classifier is trained on the votes
of at most ``TRAINED`` documents outside the fold; votes and their statistics cover whole texts of all
documents. The driver sees voters, their statistics and these bounded samples.

Cases: null and empty texts have no votes and get the score of a text without any. Without labels of
both kinds there are no voters from them and every score is the prior. A number labelled twice counts
as toxic if any label says so; rows that repeat a number are scored one by one, and extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from accesstally.llm.text import fold, held_out
from accesstally.llm.workers import importable, released
from accesstally.sources.scratch import discard, scratch_path, written

#: Labelled rows that voters are chosen on, and documents the classifier is trained on, at most.
LABELLED, TRAINED = 30_000, 30_000
#: Lengths of beginnings in characters, and terms that a round looks at; what it leaves comes up in a later one.
PREFIXES, LOOKED_AT = (3, 4, 5, 6, 7), 2_000
#: A term votes if it is so many times likelier in toxic documents, in at least so many of them.
LIKELIER, SUPPORT = 12.0, 6
#: Rounds of expectation maximisation.
ROUNDS = 6
THRESHOLD = 0.7

_words = re.compile(r"[^\W\d_]+").findall


def terms(text: str | None) -> tuple[set[str], set[str], Counter]:
    """The words of a text, their beginnings (marked by ``*``) and how often each word occurs."""
    counts = Counter(_words(text.lower())) if text else Counter()
    starts = {w[:n] + "*" for w in counts for n in PREFIXES if len(w) >= n}
    return set(counts), starts, counts


def _sample(rows: DataFrame, doc_id: Column, most: int) -> DataFrame:
    """At most so many rows, those with the smallest hashes of their number; a count says which are small."""
    n = rows.count()
    at = F.xxhash64(doc_id)
    bound = -(2**63) + int(2**64 * min(1.0, 1.2 * most / max(1, n))) - 1
    return rows.withColumn("_at", at).filter(F.col("_at") <= bound).orderBy("_at").limit(most).drop("_at")


def labelled_texts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the labelled rows that are learned from."""
    known = labels.select(F.col("doc_id").alias("_id"), "toxic").filter("toxic IS NOT NULL").groupBy("_id").agg(F.max("toxic").alias("_toxic"))
    known = _sample(known.filter(fold(F.col("_id")) != 1), F.col("_id"), LABELLED)
    joined = documents.join(F.broadcast(known), documents["doc_id"] == F.col("_id"))
    return joined.select(F.col("text"), F.col("_toxic").cast("int").alias("toxic"))


def term_counts(texts: DataFrame, voters: tuple[str, ...] = ()) -> DataFrame:
    """term, toxic documents and documents that have it, of those in which no voter fires; ``''`` counts them all."""
    out = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("n", pa.int64())])

    def counted(batches):
        known = set(voters)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, bad = Counter(), Counter()
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words, starts, _ = terms(text)
                    found = words | starts
                    if known and not known.isdisjoint(found):
                        continue
                    found.add("")
                    n.update(found)
                    if toxic:
                        bad.update(found)
                names = list(n)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([bad[t] for t in names], pa.int64()), pa.array([n[t] for t in names], pa.int64())], schema=out)

    return texts.mapInArrow(released(counted), "term string, toxic long, n long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def choose_voters(texts: DataFrame) -> list[str]:
    """Words and beginnings of words that stand out, in rounds.

    A round looks at the toxic documents in which no voter of an earlier one fires, so what merely comes along
    in copies of a toxic document is not taken for a sign. It takes the terms that a third as many of them have
    as have the commonest; a beginning only where no shorter one stands for it.
    """
    path = scratch_path(texts.sparkSession, "terms")
    counts = written(term_counts(texts), path)
    total = counts.filter("term = ''").first()
    if total is None or not 0 < total["toxic"] < total["n"]:
        return []
    bad, good = total["toxic"], total["n"] - total["toxic"]
    ratio = ((F.col("toxic") + 0.5) / (bad + 1)) / ((F.col("n") - F.col("toxic") + 0.5) / (good + 1))
    signs = counts.withColumn("ratio", ratio).filter((F.col("term") != "") & (F.col("ratio") >= LIKELIER) & (F.col("toxic") >= SUPPORT))
    words: list[str] = []
    patterns: list[str] = []
    passed: list[str] = []  # beginnings of which a shorter or longer one votes
    while True:
        left = term_counts(texts.filter("toxic = 1"), (*words, *patterns)).select("term", F.col("n").alias("left"))
        found = signs.join(left.filter(F.col("left") >= SUPPORT), "term").withColumn("gain", F.col("left") * F.log("ratio"))
        best = found.filter(~F.col("term").isin(passed)).orderBy(F.desc("gain"), "term").limit(LOOKED_AT).collect()
        if not best:
            break
        most = max(r["left"] for r in best)
        for term in (r["term"] for r in best if 3 * r["left"] >= most):
            stem = term[:-1]
            if not term.endswith("*"):
                words.append(term)
            elif any(stem.startswith(p[:-1]) or p[:-1].startswith(stem) for p in patterns):
                passed.append(term)
            else:
                patterns.append(term)
    discard(texts.sparkSession, path)
    return words + patterns


#: Voters that look at the number of hits: two terms, four hits, one word in a hundred, none at all.
COUNTED = ("two", "four", "dense", "none")


def cast_votes(documents: DataFrame, voters: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, the voters that fire, and the hits in logarithm and in share, of every row."""
    place = {v: i for i, v in enumerate(voters)}
    words = {v for v in voters if not v.endswith("*")}
    starts = {v[:-1] for v in voters if v.endswith("*")}
    sizes = sorted({len(s) for s in starts})
    first = len(voters)
    out = pa.schema([("doc_id", pa.int64()), ("fired", pa.list_(pa.int32())), ("hits", pa.float64()), ("share", pa.float64())])

    def vote(text):
        if not text:
            return [first + 3], 0.0, 0.0
        found = Counter(_words(text.lower()))
        fired, hits = set(), 0
        for word, n in found.items():
            own = {place[word]} if word in words else set()
            own.update(place[word[:size] + "*"] for size in sizes if word[:size] in starts)
            if own:
                fired |= own
                hits += n
        share = hits / max(1, found.total())
        rules = (len(fired) >= 2, hits >= 4, share >= 0.01, not hits)
        return sorted(fired) + [first + i for i, yes in enumerate(rules) if yes], float(np.log1p(hits)), min(1.0, 20 * share)

    def cast(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                got = [vote(t) for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(released(cast), "doc_id long, fired array<int>, hits double, share double")


class LabelModel:
    """How often each voter fires in either class, the classes' shares, and the weight of each vote."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float):
        self.given = (toxic, clean, n_toxic, n_clean)
        self.weight = np.ones(len(toxic))
        self.estimate(np.zeros_like(toxic), np.zeros_like(clean), 0.0, 0.0)

    def estimate(self, toxic, clean, n_toxic, n_clean) -> None:
        """Rates from posterior counts of all documents, with the labelled ones beside them."""
        t, c, nt, nc = (a + b for a, b in zip(self.given, (toxic, clean, n_toxic, n_clean), strict=True))
        self.toxic = np.clip((t + 0.5) / (nt + 1), 1e-6, 1 - 1e-6)
        self.clean = np.clip((c + 0.5) / (nc + 1), 1e-6, 1 - 1e-6)
        self.prior = (nt + 1) / (nt + nc + 2)

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        on = self.weight * np.log(self.toxic / self.clean)
        off = self.weight * np.log((1 - self.toxic) / (1 - self.clean))
        odds = np.log(self.prior / (1 - self.prior)) + off.sum() + fired @ (on - off)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))

    def weigh(self, together: np.ndarray, n_toxic: float, n_clean: float) -> None:
        """Votes of voters that fire together beyond what the classes explain weigh less."""
        share = n_toxic / max(1e-9, n_toxic + n_clean)
        mean = share * np.outer(self.toxic, self.toxic) + (1 - share) * np.outer(self.clean, self.clean)
        var = share * self.toxic * (1 - self.toxic) + (1 - share) * self.clean * (1 - self.clean)
        rho = (together / max(1e-9, n_toxic + n_clean) - mean) / np.sqrt(np.outer(var, var))
        np.fill_diagonal(rho, 0)
        self.weight = 1 / (1 + np.clip(rho, 0, 1).sum(axis=1))


def _matrix(fired: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros((len(fired), n))
    for i, f in enumerate(fired):
        out[i, f] = 1
    return out


def _sums(patterns: DataFrame, model: LabelModel, n: int) -> np.ndarray:
    """Posterior counts over all patterns: by voter in both classes, the classes, and pairs of voters."""
    out = pa.schema([("at", pa.int32()), ("value", pa.float64())])

    def summed(batches):
        total = np.zeros(2 * n + 2 + n * n)
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                x = _matrix(part.column(0).to_pylist(), n)
                weight = np.asarray(part.column(1).to_pylist(), float)
                p = model.posterior(x)
                bad, good = weight * p, weight * (1 - p)
                total += np.concatenate([bad @ x, good @ x, [bad.sum(), good.sum()], ((x * weight[:, None]).T @ x).ravel()])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], schema=out)

    found = np.zeros(2 * n + 2 + n * n)
    for row in patterns.mapInArrow(released(summed), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        found[row["at"]] = row["value"]
    return found


def label_model(votes: DataFrame, labelled_votes: DataFrame, n: int) -> LabelModel:
    rows = labelled_votes.groupBy("toxic").agg(F.count("*").alias("n")).collect()
    sizes = {r["toxic"]: float(r["n"]) for r in rows}
    rates = {0: np.zeros(n), 1: np.zeros(n)}
    for r in labelled_votes.select("toxic", F.explode("fired").alias("v")).groupBy("toxic", "v").count().collect():
        rates[r["toxic"]][r["v"]] = r["count"]
    model = LabelModel(rates[1], rates[0], sizes.get(1, 0.0), sizes.get(0, 0.0))
    path = scratch_path(votes.sparkSession, "patterns")
    patterns = written(votes.groupBy("fired").agg(F.count("*").alias("n")), path)
    for _ in range(ROUNDS):
        found = _sums(patterns, model, n)
        n_toxic, n_clean = found[2 * n], found[2 * n + 1]
        model.estimate(found[:n], found[n : 2 * n], n_toxic, n_clean)
        model.weigh(found[2 * n + 2 :].reshape(n, n), n_toxic, n_clean)
    discard(votes.sparkSession, path)
    return model


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression on posterior labels by Newton steps, with a small ridge; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.05)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of every row."""
    spark = importable(documents.sparkSession)
    documents = documents.select("doc_id", "text")
    texts_path, votes_path = scratch_path(spark, "labelled"), scratch_path(spark, "votes")
    texts = written(labelled_texts(documents, labels), texts_path)
    voters = choose_voters(texts)
    n = len(voters) + len(COUNTED)
    votes = written(cast_votes(documents, voters), votes_path)
    own = cast_votes(texts.select(F.col("toxic").alias("doc_id"), "text"), voters).withColumnRenamed("doc_id", "toxic")
    model = label_model(votes, own.withColumn("toxic", F.col("toxic").cast("int")), n)
    rows = _sample(votes.filter(fold(F.col("doc_id")) != 1), F.col("doc_id"), TRAINED)
    rows = rows.groupBy("fired", "hits", "share").agg(F.count("*").alias("n")).collect()
    weights = np.zeros(n + 3)
    if rows:
        fired = _matrix([r["fired"] for r in rows], n)
        x = np.column_stack([fired, [r["hits"] for r in rows], [r["share"] for r in rows]])
        weights = train(x, model.posterior(fired), np.array([r["n"] for r in rows], float))
    each = F.array(*[F.lit(float(w)) for w in weights[:n]])
    total = F.aggregate("fired", F.lit(float(weights[-1])), lambda a, i: a + F.get(each, i))
    total = total + F.col("hits") * float(weights[n]) + F.col("share") * float(weights[n + 1])
    return votes.select("doc_id", (1 / (1 + F.exp(-total))).alias("score"))


def op2_toxicity(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = score(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
