"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

1. Terms - whole words, word beginnings of 3 to 7 letters, and beginnings that two or four different words of a text
   share - that labelled toxic texts use more than others are mined. The clearest make lexicons: words, short
   beginnings, long beginnings and shared ones, each once from either half of the labelled rows, so that lists differ. A lexicon voter says "toxic" if a text has one of its terms. Pattern
   voters look for second-person address, repeated marks, masked spelling, capitals and drawn-out letters.
2. The votes of all rows are counted by their pattern. A generative model of them is fitted to these counts by
   expectation-maximisation over the unknown label: each voter's rates in toxic and in clean texts, and the voters'
   correlations given the label as a tree of dependent pairs, chosen anew each round by the mutual information that
   the present labels leave. Given labels only set the first rates and the share of toxic texts.
3. A linear classifier over all mined terms is trained on the posterior labels of all rows, by a quasi-Newton method
   whose gradients Spark sums; labelled rows left aside calibrate its score.

Only the mining and the calibration use a sample: `sample` labelled rows of each class, in the order of a hash of the
id, with their whole texts. The driver holds vote patterns (2 to the number of voters at most) and the vocabulary,
which that sample bounds.

Defined results: null or empty text has no terms and scores the classifier's intercept. Without labelled rows of
both classes every text scores the share of toxic labels (0 without labels). Rows are scored one by one, so
repeated ids and extra columns stay; `score` is replaced. A row of a null id is scored and voted on. Long texts take
memory in proportion to their words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, settled, written
from .quality import fit_curve, labelled_sample

WORDS = re.compile(r"[^\W\d_]+")
SHORT, LONG = 3, 7
#: Words that address the reader, in English, German, French and Spanish.
ADDRESS = frozenset("you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split())
PATTERNS = (
    lambda text, words: bool(ADDRESS & words),
    lambda text, words: re.search(r"([!?*#$%&])\1", text) is not None,
    lambda text, words: re.search(r"[^\W\d_][*@$#%&]+[^\W\d_]", text) is not None,
    lambda text, words: 2 * sum(map(str.isupper, text)) > sum(map(str.isalpha, text)),
    lambda text, words: re.search(r"([^\W\d_])\1{3}", text) is not None,
)


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


def parts_of(word: str) -> list[str]:
    """The word as "=word" and its beginnings as "begin"."""
    return ["=" + word, *(word[:k] for k in range(SHORT, min(len(word), LONG) + 1))]


def shared(counts: dict[str, int]) -> set[str]:
    """Terms, and the beginnings that at least two or four words share as "2begin" and "4begin"."""
    return {*counts, *(f"{k}{t}" for t, n in counts.items() for k in (2, 4) if n >= k)}


def terms_of(text: str | None) -> set[str]:
    return shared(Counter(t for w in words_of(text) for t in parts_of(w)))


class Finder:
    """Places of the terms of a vocabulary that a text has; what a word has is remembered."""

    def __init__(self, terms: list[str], most: int = 400_000):
        self.index, self.most, self.known = {t: k for k, t in enumerate(terms)}, most, {}
        self.parts = {t.lstrip("24") for t in terms}

    def __call__(self, words: set[str]) -> list[int]:
        known, parts = self.known, self.parts
        if len(known) > self.most:
            known.clear()
        counts: Counter = Counter()
        for w in words:
            found = known.get(w)
            if found is None:
                found = known[w] = tuple(t for t in parts_of(w) if t in parts)
            if found:
                counts.update(found)
        return sorted(self.index[t] for t in shared(counts) if t in self.index)


@F.pandas_udf(T.LongType())
def smallest_shingle(texts: pd.Series) -> pd.Series:
    """The smallest hash of three words in a row (of the text itself where it has fewer)."""
    out = []
    for t in texts:
        w = (t or "").encode("utf-8", "surrogatepass").lower().split()
        out.append(min((zlib.crc32(b" ".join(w[k : k + 3])) for k in range(len(w) - 2)), default=zlib.crc32(b" ".join(w))))
    return pd.Series(out, dtype="int64")


def mine_terms(rows: DataFrame, least: float, evidence: float) -> pd.DataFrame:
    """(term, toxic, clean, ratio, ratio0, ratio1): what texts of either class weigh that have a term, for terms that lean to toxic ones.

    rows: _text, y, part. Copies of one text are one witness: a row weighs one over the rows of its class that share
    its smallest shingle. `ratio` is the likelihood ratio against equal use in both classes, which must be `evidence`
    or more; ratio0 and ratio1 are those within either half of the rows (even and odd parts).
    """
    rows = rows.withColumn("_sig", smallest_shingle("_text"))
    rows = rows.join(rows.groupBy("_sig", "y").agg((1 / F.count("*")).alias("w")), ["_sig", "y"]).select("_text", "y", (F.col("part") % 2).alias("half"), "w")

    def counted(of: DataFrame, terms) -> DataFrame:
        """(term, half, w) over rows of one class; terms: null for all, else the ones looked for."""

        def count(batches):
            seen, find = Counter(), Finder(terms.value) if terms else None
            for pdf in batches:
                for t, half, w in zip(pdf["_text"], pdf["half"], pdf["w"]):
                    for term in [terms.value[k] for k in find(words_of(t))] if find else terms_of(t):
                        seen[term, half] += w
            if seen:
                yield pd.DataFrame({"term": [t for t, _ in seen], "half": [int(h) for _, h in seen], "w": list(seen.values())})

        return of.select("_text", "half", "w").mapInPandas(count, "term string, half int, w double").groupBy("term").pivot("half", [0, 1]).agg(F.sum("w")).na.fill(0.0)

    toxic = counted(rows.where("y = 1"), None).where(F.col("0") + F.col("1") >= least).toPandas()  # terms of at most `sample` texts
    sent = rows.sparkSession.sparkContext.broadcast(toxic["term"].tolist())
    clean = counted(rows.where("y = 0"), sent).toPandas()
    seen = toxic.merge(clean, "left", "term", suffixes=("t", "c")).fillna(0.0)
    sizes = {r["of"]: r["w"] for r in rows.groupBy((2 * F.col("half") + F.col("y")).alias("of")).agg(F.sum("w").alias("w")).collect()}

    def ratio(t: np.ndarray, c: np.ndarray, nt: float, nc: float) -> np.ndarray:
        share, both = min(max(nt / max(nt + nc, 1e-9), 1e-6), 1 - 1e-6), t + c
        part = lambda n, p: np.where(n > 0, n * np.log(np.maximum(n, 1e-9) / np.maximum(both * p, 1e-12)), 0)
        return np.where(t > both * share, 2 * (part(t, share) + part(c, 1 - share)), 0)

    size = lambda *of: sum(sizes.get(k, 0.0) for k in of)
    for half in (0, 1):
        seen[f"ratio{half}"] = ratio(seen[f"{half}t"].to_numpy(), seen[f"{half}c"].to_numpy(), size(2 * half + 1), size(2 * half))
    seen["toxic"], seen["clean"] = seen["0t"] + seen["1t"], seen["0c"] + seen["1c"]
    seen["ratio"] = ratio(seen["toxic"].to_numpy(), seen["clean"].to_numpy(), size(1, 3), size(0, 2))
    found = seen[seen["ratio"] >= evidence].sort_values(["ratio", "term"], ascending=[False, True])
    return found[["term", "toxic", "clean", "ratio", "ratio0", "ratio1"]].reset_index(drop=True)


def lexicons(mined: pd.DataFrame, clear: float) -> list[list[int]]:
    """Places of the terms of each lexicon voter: of one form, and clearly toxic in one half of the labelled rows."""
    form = [0 if t[0] == "=" else 3 if t[0] in "24" else 1 if len(t) <= 4 else 2 for t in mined["term"]]
    clean = mined["clean"] <= 0.02 * mined["toxic"]
    return [[k for k, ok in enumerate(clean & (mined[f"ratio{half}"] >= clear)) if ok and form[k] == f] for f in range(4) for half in (0, 1)]


class LabelModel:
    """Votes (0 or 1) given a hidden label: a tree of dependent voters for each label, all from weighted vote patterns.

    parent[i]: the voter that voter i depends on, or -1; rate[y, i, v]: how often i votes given label y and the vote v
    of its parent. `accuracy` has each voter's rates by label alone.
    """

    def __init__(self, prior: float, dependent: float = 5e-3):
        self.prior, self.dependent = prior, dependent

    def fit(self, votes: np.ndarray, count: np.ndarray, first: np.ndarray, rounds: int = 100) -> "LabelModel":
        """votes: patterns x voters; count: rows of each; first: a first guess of each pattern's posterior."""
        p, dependent = first, self.dependent
        for self.dependent in (np.inf, dependent):  # settled as if independent, then with the tree
            for _ in range(rounds):
                self._learn(votes, count, p)
                new = self.posterior(votes)
                moved = float((count * np.abs(new - p)).sum() / max(count.sum(), 1e-9))
                p = new
                if moved < 1e-7:
                    break
            if dependent == np.inf:
                break
        return self

    def _learn(self, votes: np.ndarray, count: np.ndarray, p: np.ndarray) -> None:
        m = votes.shape[1]
        both = np.zeros((2, m, m))  # expected rows with both votes, by label
        size = np.zeros(2)
        for y, w in ((0, count * (1 - p)), (1, count * p)):
            both[y], size[y] = (votes * w[:, None]).T @ votes, w.sum()
        one = np.einsum("yii->yi", both)
        self.accuracy = (one + 0.5) / (size[:, None] + 1)
        self.information = np.zeros((m, m))
        for y in (0, 1):
            n = max(size[y], 1e-9)
            for a in (0, 1):
                for b in (0, 1):
                    seen = (both[y] if a and b else one[y][:, None] - both[y] if a else one[y][None, :] - both[y] if b else n - one[y][:, None] - one[y][None, :] + both[y]) / n
                    alone = (one[y] / n if a else 1 - one[y] / n)[:, None] * (one[y] / n if b else 1 - one[y] / n)[None, :]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        self.information += size[y] / max(size.sum(), 1e-9) * np.where(seen > 1e-15, seen * np.log(seen / alone), 0)
        self.parent = self._tree(self.information)
        self.rate = np.zeros((2, m, 2))
        for i, j in enumerate(self.parent):
            for y in (0, 1):
                base = self.accuracy[y, i]
                for v, (n, k) in enumerate([(size[y], one[y, i])] * 2 if j < 0 else [(size[y] - one[y, j], one[y, i] - both[y, i, j]), (one[y, j], both[y, i, j])]):
                    self.rate[y, i, v] = np.clip((k + base) / (n + 1), 1e-6, 1 - 1e-6)

    def _tree(self, information: np.ndarray) -> list[int]:
        """Each voter's parent in the forest of the most informative pairs above `dependent`."""
        m = len(information)
        root, links = list(range(m)), [[] for _ in range(m)]

        def find(x: int) -> int:
            while root[x] != x:
                x = root[x]
            return x

        for _, i, j in sorted((-information[i, j], i, j) for i in range(m) for j in range(i) if information[i, j] > self.dependent):
            if find(i) != find(j):
                root[find(i)] = find(j)
                links[i].append(j)
                links[j].append(i)
        parent, seen = [-1] * m, [False] * m
        for start in range(m):
            stack = [] if seen[start] else [start]
            while stack:
                i = stack.pop()
                seen[i] = True
                for j in links[i]:
                    if not seen[j]:
                        parent[j] = i
                        stack.append(j)
        return parent

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logit = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for i, j in enumerate(self.parent):
            at = votes[:, j].astype(int) if j >= 0 else np.zeros(len(votes), int)
            yes, no = (self.rate[y, i][at] for y in (1, 0))
            logit += np.where(votes[:, i] > 0, np.log(yes / no), np.log((1 - yes) / (1 - no)))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def linear_fit(facts: DataFrame, width: int, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic classifier over present terms, the intercept last, for facts (places, p, n): n rows of one
    posterior label p that have the terms at `places`. Limited-memory BFGS; each step is one aggregate of `width` rows."""
    spark = facts.sparkSession
    total = max(facts.agg(F.sum("n")).first()[0] or 0, 1)

    def evaluate(beta: np.ndarray) -> tuple[float, np.ndarray]:
        sent = spark.sparkContext.broadcast(beta)

        def add_up(batches):
            beta, out = sent.value, np.zeros(width + 2)
            for pdf in batches:
                size = pdf["places"].str.len().to_numpy(np.int64)
                cols = np.concatenate([np.zeros(0, np.int64), *pdf["places"]]).astype(np.int64)
                rows, p, n = np.repeat(np.arange(len(pdf)), size), pdf["p"].to_numpy(), pdf["n"].to_numpy(float)
                z = np.clip(np.bincount(rows, beta[cols], len(pdf)) + beta[-1], -30, 30)
                off = n * (1 / (1 + np.exp(-z)) - p)
                out[:width] += np.bincount(cols, off[rows], width)
                out[width] += off.sum()
                out[width + 1] += (n * (np.logaddexp(0, z) - p * z)).sum()
            yield pd.DataFrame({"j": np.flatnonzero(out), "g": out[out != 0]})

        found = facts.mapInPandas(add_up, "j int, g double").groupBy("j").agg(F.sum("g").alias("g")).toPandas()
        sent.destroy()
        out = np.zeros(width + 2)
        out[found["j"]] = found["g"]
        held = np.append(beta[:-1], 0)
        return (out[-1] + ridge * held @ held / 2) / total, (out[:-1] + ridge * held) / total

    beta = np.zeros(width + 1)
    loss, gradient = evaluate(beta)
    steps: deque = deque(maxlen=8)
    for _ in range(rounds):
        way, along = gradient.copy(), []
        for s, y in reversed(steps):
            a = s @ way / (s @ y)
            along.append(a)
            way -= a * y
        if steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ y)
        else:
            way *= 1 / max(np.abs(gradient).max(), 1e-12)
        for (s, y), a in zip(steps, reversed(along)):
            way += (a - y @ way / (s @ y)) * s
        size = 1.0
        for _ in range(6):
            new_loss, new_gradient = evaluate(beta - size * way)
            if new_loss <= loss - 1e-4 * size * (gradient @ way):
                break
            size /= 4
        else:
            break
        s, y = -size * way, new_gradient - gradient
        if s @ y > 1e-12:
            steps.append((s, y))
        done = loss - new_loss < 1e-4 * loss
        beta, loss, gradient = beta + s, new_loss, new_gradient
        if done:
            break
    return beta


def calibrated(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """(slope, intercept, floor): P(toxic) is floor + (1 - floor) * curve; the floor takes up labels that no text explains."""
    slope, intercept, floor = *fit_curve(margin, y, weight), 0.005
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + intercept, -30, 30)))
        told = y * p / (floor + (1 - floor) * p)
        slope, intercept = fit_curve(margin, told, weight)
        floor = float(np.clip((weight * (y - told)).sum() / max((weight * (1 - told)).sum(), 1e-9), 0, 0.05))
    return slope, intercept, floor


class ToxicityModel:
    """Terms with weights, a bounded vocabulary, and a calibration curve."""

    def __init__(self, terms: list[str], weights: np.ndarray, slope: float, intercept: float, floor: float = 0.0):
        self.terms, self.weights, self.slope, self.intercept, self.floor = terms, weights, slope, intercept, floor

    def margins(self, spark):
        sent = spark.sparkContext.broadcast((self.terms, self.weights))

        @F.pandas_udf("double")
        def margin(texts: pd.Series) -> pd.Series:
            terms, weights = sent.value
            find = Finder(terms)
            return pd.Series([float(weights[find(words_of(t))].sum() + weights[-1]) for t in texts], dtype="float64")

        return margin

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        if not self.terms:
            return docs.withColumn("score", F.lit(self.intercept))
        return docs.withColumn("score", self.probability(self.margins(docs.sparkSession)(F.col(text))))

    def probability(self, margin: Column) -> Column:
        return self.floor + (1 - self.floor) / (1 + F.exp(-(F.lit(self.slope) * margin + F.lit(self.intercept))))

    def of_places(self, votes: DataFrame) -> DataFrame:
        """The documents of a table of votes with their score, from the places of their terms."""
        sent = votes.sparkSession.sparkContext.broadcast(self.weights)

        @F.pandas_udf("double")
        def margin(places: pd.Series) -> pd.Series:
            weights = sent.value
            return pd.Series([float(weights[np.asarray(p, np.int64)].sum() + weights[-1]) for p in places], dtype="float64")

        return votes.select("row.*", self.probability(margin("places")).alias("score"))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
    sample: int = 4000, least: float = 2, evidence: float = 9.0, clear: float = 12.0, seed: int = 5,
) -> tuple[ToxicityModel, DataFrame | None]:
    """Learn from the labelled rows given (doc_id, label in 0/1) and the texts of all docs.

    Returns the model and the written votes of all docs (row: their other columns, places, pattern), None without terms.
    """
    counts = {r["y"]: r["n"] for r in labels.groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).where("y in (0, 1)").collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return ToxicityModel([], np.zeros(1), 0.0, counts.get(1, 0) / total if total else 0.0), None
    share = counts[1] / total
    chosen = F.broadcast(labelled_sample(labels, label, doc_id, sample, seed))
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    rows = settled(texts.join(chosen, "_id").select("_text", "y", "part"), "labelled")  # at most 2 * sample ids
    mined = mine_terms(rows.where("part < 7"), least, evidence)
    found = mined["term"].tolist()
    if not found:
        return ToxicityModel([], np.zeros(1), 0.0, share), None
    lists = [x for x in lexicons(mined, clear) if x]
    sent = docs.sparkSession.sparkContext.broadcast((found, lists))

    @F.pandas_udf("struct<places:array<int>,pattern:int>")
    def vote(batch: pd.Series) -> pd.DataFrame:
        terms, lists = sent.value
        find = Finder(terms)
        voter = np.zeros(len(terms), np.int64)
        for k, own in enumerate(lists):
            voter[own] |= 1 << k
        out = {"places": [], "pattern": []}
        for t in batch:
            words = words_of(t)
            own = find(words)
            bits = int(np.bitwise_or.reduce(voter[own])) if own else 0
            out["places"].append(own)
            out["pattern"].append(bits | sum(p(t or "", words) << (len(lists) + k) for k, p in enumerate(PATTERNS)))
        return pd.DataFrame(out)

    voters = len(lists) + len(PATTERNS)
    votes_of = lambda patterns: (np.asarray(patterns, np.int64)[:, None] >> np.arange(voters) & 1).astype(float)
    voted = lambda df, *more: df.select(vote("_text").alias("v"), *more).select("v.places", "v.pattern", *more)
    others = F.struct(*[F.col(c) for c in docs.columns if c not in (text, "score")]).alias("row")
    cast = written(voted(docs.select(F.col(text).alias("_text"), others), "row"), "votes")
    facts = settled(cast.groupBy("places", "pattern").agg(F.count("*").alias("n")), "facts")
    seen = facts.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()  # at most 2 ** voters rows
    known = voted(rows, "y", "part").toPandas()  # at most 2 * sample ids
    # first rates from the labelled rows, as if voters were independent
    learn = known[known["part"] < 7]
    votes, y = votes_of(learn["pattern"]), learn["y"].to_numpy(float)
    start = LabelModel(min(max(share, 1e-4), 1 - 1e-4), dependent=np.inf)
    start._learn(votes, np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y), y)
    every = votes_of(seen["pattern"])
    model = LabelModel(start.prior).fit(every, seen["n"].to_numpy(float), start.posterior(every))
    told = docs.sparkSession.createDataFrame(pd.DataFrame({"pattern": seen["pattern"].astype("int32"), "p": model.posterior(every)}), "pattern int, p double")
    weights = linear_fit(facts.join(F.broadcast(told), "pattern").select("places", "p", "n"), len(found))
    forget(rows, facts)
    rest = known[known["part"] >= 7]
    margin = np.array([weights[np.asarray(p, np.int64)].sum() + weights[-1] for p in rest["places"]])
    y = rest["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(found, weights, 1.0, 0.0), cast
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum()) * len(y)
    return ToxicityModel(found, weights, *calibrated(margin, y, weight)), cast


def judge(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns of docs but the text, and `score`, the probability of label 1, learned from `labels` and from the votes on docs.

    Texts are gone through once: the places of their terms are written with the votes, and scored from there.
    """
    model, cast = fit(docs, labels, label, doc_id, text, **options)
    return model.of_places(cast) if cast else model.score(docs, text).drop(text)
