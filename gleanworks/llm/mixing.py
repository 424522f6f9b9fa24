"""Soft-membership mixing of documents to target weights.

A classifier learned from a bounded sample of the labelled table gives each document a posterior
over domains. Each document gets a rate r >= 0, near 1, such that the expected domain token totals
sum(r * tokens * posterior) match targets. The rates solve a least-squares problem by accelerated
projected gradient: a pass over the documents sums the domain totals in each partition, the driver
adds those few numbers and forms the next residual. A document's rate is a function of its tokens,
its posterior and the residuals so far, so rates are computed where they are used; they are written
only every few passes, which bounds what a pass has to replay, and a lost executor loses nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import free_name, having, labelled_texts, materialise, matrix, small_batches

SAMPLE_DOCS = 2000
SAMPLE_BYTES = 12 << 20
VOCABULARY = 20_000
TOLERANCE = 1e-4
PASSES = 2000
STALL = 20
REPLAY = 12
#: Production targets: shares of the tokens by (quality, toxic) domain.
TARGETS = {"q0t0": 0.04, "q0t1": 0.005, "q1t0": 0.92, "q1t1": 0.04}


def words(text: bytes | None) -> list[bytes]:
    """The lower-cased words between ASCII white space of whole ``text``."""
    return text.lower().split() if text else []


class Domains:
    """Naive-Bayes word weights and a softmax curve over their mean and greatest value by domain."""

    def __init__(self, names: list[str], weights: dict[bytes, np.ndarray], curve: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> None:
        self.names, self.weights, self.curve, self.centre, self.scale = names, weights, curve, centre, scale

    def features(self, found: list[bytes]) -> np.ndarray:
        k = len(self.names)
        counts = Counter(found)
        rows = [(w, n) for x, n in counts.items() if (w := self.weights.get(x)) is not None]
        if not rows:
            return np.zeros(2 * k)
        each, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
        return np.r_[n @ each / len(found), each.max(axis=0)]

    def posterior(self, features: np.ndarray) -> np.ndarray:
        z = np.c_[(features - self.centre) / self.scale, np.ones(len(features))] @ self.curve
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit_domains(texts: list[list[bytes]], names: list[str], prior: np.ndarray, vocabulary: int = VOCABULARY) -> Domains:
    """Learn from sampled ``texts``, a list for each domain; ``prior`` are the domains' shares of labels.

    Every second text of a domain gives word weights and the others fit the curve, each domain
    weighted by its prior. A domain without texts has no weight.
    """
    split = [([words(t) for t in part[::2]], [words(t) for t in part[1::2] or part]) for part in texts]
    totals = [Counter(w for doc in learn for w in doc) for learn, _ in split]
    seen: Counter = Counter()
    for learn, _ in split:
        for doc in learn:
            seen.update(set(doc))
    kept = sorted(w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:vocabulary])
    table = np.array([[t[w] for t in totals] for w in kept], float).reshape(len(kept), len(names)) + 0.5
    logs = np.log(table / table.sum(axis=0)) if len(kept) else table
    weights = logs - logs.mean(axis=1, keepdims=True) if len(kept) else logs
    k = len(names)
    model = Domains(names, {w: weights[i] for i, w in enumerate(kept)}, np.zeros((2 * k + 1, k)), np.zeros(2 * k), np.ones(2 * k))
    x, y, share = [], [], []
    for d, (_, held) in enumerate(split):
        x += [model.features(doc) for doc in held]
        y += [d] * len(held)
        share += [prior[d] / max(1, len(held))] * len(held)
    if not x:
        model.curve[-1] = np.log(np.maximum(prior, 1e-9))
        return model
    x, y, share = np.array(x), np.eye(k)[y], np.array(share) / max(1e-12, sum(share))
    model.centre, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.c_[(x - model.centre) / model.scale, np.ones(len(x))]
    curve, pull = model.curve, model.curve.copy()
    step = 1 / (0.5 * np.linalg.norm((a * share[:, None]).T @ a, 2) + 1e-4)
    for t in range(600):  # accelerated gradient on a convex loss
        z = a @ pull
        e = np.exp(z - z.max(axis=1, keepdims=True))
        new = pull - step * (a.T @ (share[:, None] * (e / e.sum(axis=1, keepdims=True) - y)) + 1e-4 * pull)
        pull, curve = new + t / (t + 3) * (new - curve), new
    model.curve = curve
    return model


def learn_domains(docs: DataFrame, labels: DataFrame, domain: Column, names: list[str], id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Domains:
    """Sample at most ``sample_docs`` labelled rows and ``sample_bytes`` bytes for each domain and learn.

    A domain's sample is in the order of a hash of the id, without texts of more than an eighth of
    the bytes, and ends before the first text that would exceed them.
    """
    known = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id_"), domain.alias("domain_")).where(F.col("domain_").isin(names))
    known = known.groupBy("id_").agg(F.min("domain_").alias("domain_"))
    counts = {r["domain_"]: r["count"] for r in known.groupBy("domain_").count().collect()}  # a row for each domain
    total = max(1, sum(counts.values()))
    prior = np.array([max(counts.get(n, 0), 1) / total for n in names])
    picked = None
    for n in names:
        some = known.where(F.col("domain_") == n).select(F.col("domain_").alias("group_"), F.xxhash64("id_").alias("at_"), "id_").orderBy("at_", "id_").limit(sample_docs)
        picked = some if picked is None else picked.unionAll(some)
    texts = labelled_texts(docs, picked, id_col, text_col, sample_bytes)
    return fit_domains([texts.get(n, []) for n in names], names, prior / prior.sum())


def with_posterior(docs: DataFrame, model: Domains, text_col: str, tokens: str, posterior: str) -> DataFrame:
    """``docs`` with its number of words and its posterior; no words: the posterior of no evidence."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<n:long,p:array<double>>")
    def judged(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        found, n = [], []
        for t in texts:
            got = words(bytes(t) if t is not None else None)
            n.append(len(got))
            found.append(held.value.features(got))
        p = held.value.posterior(np.array(found).reshape(len(n), -1)) if n else np.zeros((0, 0))
        return pd.DataFrame({"n": n, "p": list(p)})

    both = free_name(docs, "judged_")
    marked = docs.withColumn(both, judged(F.col(text_col).cast("binary")))
    return marked.withColumn(tokens, F.col(both)["n"]).withColumn(posterior, F.col(both)["p"]).drop(both)


def rates_of(p: np.ndarray, history: list[tuple[np.ndarray, float]], step: float, rate: np.ndarray | None = None, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each row's rate and the point of its next gradient, after the passes in ``history`` from those given.

    A pass is (residual of the domain totals, momentum). Rates start at 1; the gradient is taken in
    the metric of the tokens, in which projecting on r >= 0 is cutting at 0.
    """
    r = np.ones(len(p)) if rate is None else rate
    at = r if at is None else at
    for residual, momentum in history:
        new = np.maximum(0, at - step * (p @ residual))
        at, r = new + momentum * (new - r), new
    return r, at


def _advanced(judged: DataFrame, posterior: str, rate: str, point: str, history: list, step: float) -> DataFrame:
    """``judged`` with its rates and points after the passes in ``history``."""
    both = free_name(judged, "moved_")

    @F.pandas_udf("struct<r:double,x:double>")
    def moved(p, r, x):  # noqa: ANN001, ANN202
        import pandas as pd

        got = rates_of(np.array(p.tolist(), float).reshape(len(p), -1), history, step, r.to_numpy(), x.to_numpy())
        return pd.DataFrame({"r": got[0], "x": got[1]})

    df = judged.withColumn(both, moved(F.col(posterior), F.col(rate), F.col(point)))
    return df.withColumns({rate: F.col(both)["r"], point: F.col(both)["x"]}).drop(both)


def fit_rates(
    judged: DataFrame, tokens: str, posterior: str, targets: np.ndarray, rate: str = "rate", tolerance: float = TOLERANCE, passes: int = PASSES, replay: int = REPLAY
) -> tuple[DataFrame, np.ndarray, int, bool]:
    """(``judged`` with ``rate``, residual by domain, passes, met).

    Passes go on until the largest residual is below ``tolerance`` of all target tokens (met), or
    until the weighed residual has not become smaller by a thousandth in STALL passes: then the
    targets are out of reach and the rates are the nearest, within that. More than ``passes`` are an
    error. A pass replays the steps since rates were last written, which is every ``replay`` passes,
    so that work grows with the number of passes and not its square.
    """
    k = len(targets)
    point = free_name(judged, "point_")
    judged = judged.withColumn(rate, F.lit(1.0)).withColumn(point, F.lit(1.0))

    def total(history: list, step: float, gram: bool = False) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((k + 1, k) if gram else (2, k))
            for batch in batches:
                t, p = batch.column(0).to_numpy(), matrix(batch.column(1)).reshape(batch.num_rows, k)
                r, at = rates_of(p, history, step, batch.column(2).to_numpy(), batch.column(3).to_numpy())
                out[0] += (r * t) @ p
                if gram:
                    out[1:] += (p * t[:, None]).T @ p
                else:
                    out[1] += (at * t) @ p
            yield pa.RecordBatch.from_arrays([pa.array([out.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

        rows = judged.select(F.col(tokens).cast("double"), F.col(posterior), F.col(rate), F.col(point))
        parts = rows.mapInArrow(run, "s array<double>").collect()  # a few numbers for each partition
        return np.sum([np.array(x["s"]) for x in parts], axis=0).reshape(-1, k) if parts else np.zeros((k + 1 if gram else 2, k))

    first = total([], 0.0, gram=True)
    top = float(np.linalg.eigvalsh(first[1:])[-1])
    residual = first[0] - targets
    if top <= 0:
        return judged.drop(point), residual, 0, bool(np.abs(residual).max(initial=0) <= tolerance)
    # Residuals are weighed by the damped inverse of the domains' Gram matrix, so that small domains converge like large ones.
    metric = np.linalg.inv(first[1:] + 1e-3 * top * np.eye(k))
    step, history, at, momentum_t = 1.0, [], first[0], 1.0
    whole = max(1.0, float(targets.sum()))
    losses, n = [float(residual @ metric @ residual)], 0
    while (met := bool(np.abs(residual).max() <= tolerance * whole)) is False:
        if len(losses) > STALL and min(losses[-STALL:]) > 0.999 * min(losses[:-STALL]):
            break
        if n >= passes:
            raise RuntimeError(f"rates have not settled in {passes} passes: residual {residual.tolist()}")
        t = (1 + np.sqrt(1 + 4 * momentum_t**2)) / 2
        history.append((metric @ (at - targets), (momentum_t - 1) / t))
        momentum_t, n = t, n + 1
        now, at = total(history, step)
        residual = now - targets
        losses.append(float(residual @ metric @ residual))
        if losses[-1] > losses[-2]:
            momentum_t = 1.0  # restart
        if len(history) == replay:
            judged, history = materialise(_advanced(judged, posterior, rate, point, history, step), "rates"), []
    return (_advanced(judged, posterior, rate, point, history, step) if history else judged).drop(point), residual, n, met


def budget_for(totals: np.ndarray, shares: np.ndarray) -> float:
    """The budget of which the tokens of the largest share's domain are its share."""
    main = max(range(len(shares)), key=lambda d: (shares[d], totals[d]))
    return float(totals[main] / shares[main])


def targets_for(totals: np.ndarray, shares: np.ndarray, budget: float | None = None) -> np.ndarray:
    """Target tokens by domain, ``shares`` of ``budget``.

    Without a budget the domain of the largest share (of equal ones that of the most tokens) keeps
    all its own tokens, and the budget is the one of which they are its share. The shares of others
    are upper bounds: a domain that has less keeps what it has and takes nothing from the others.
    """
    return shares * budget if budget is not None else np.minimum(shares * budget_for(totals, shares), totals)


def mix(
    docs: DataFrame, labels: DataFrame, domain: Column, shares: dict[str, float], id_col: str = "doc_id", text_col: str = "text", budget: float | None = None
) -> tuple[DataFrame, dict]:
    """``docs`` without its text but with tokens_, posterior_, rate_ and copies_ (names made longer on a clash), and a report.

    shares: the wanted share of tokens for each domain, a value of ``domain``, a column of
    ``labels``; they are scaled to sum 1. Other domains of labels are learned too and their share
    is 0. copies_ is the rate rounded up or down by a hash of the id, so that expected copies equal
    rates. The report has, by domain, targets, totals, residual (expected tokens at the rates, less
    the target) and unfilled (what a target lacks of its share of the budget), the passes and
    whether the targets were met. Null and empty texts have no tokens and the posterior of no
    evidence. Null ids round alike. Repeated rows have equal rates. Without labels the
    posterior is the same for all. An empty table gives no rows.
    """
    seen = labels.where(F.col(id_col).isNotNull()).select(domain.alias("domain_")).distinct().where(F.col("domain_").isNotNull())
    names = sorted({*shares, *(r["domain_"] for r in seen.collect())})  # a row for each domain
    want = np.array([shares.get(n, 0) for n in names], float)
    want = want / want.sum()
    model = learn_domains(docs, labels, domain, names, id_col, text_col)
    cols = {k: free_name(docs, f"{k}_") for k in ("tokens", "posterior", "rate", "copies")}
    judged = materialise(with_posterior(docs, model, text_col, cols["tokens"], cols["posterior"]).drop(text_col), "judged")
    sums = judged.agg(*[F.coalesce(F.sum(F.col(cols["tokens"]) * F.col(cols["posterior"])[k]), F.lit(0.0)).alias(n) for k, n in enumerate(names)]).first()
    totals = np.array([sums[n] for n in names], float)
    targets = targets_for(totals, want, budget)
    unfilled = want * (budget_for(totals, want) if budget is None else budget) - targets
    rated, residual, passes, met = fit_rates(judged, cols["tokens"], cols["posterior"], targets, cols["rate"])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    rated = rated.withColumn(cols["copies"], F.floor(F.col(cols["rate"]) + draw).cast("int"))
    return rated, {"columns": cols, "domains": names, "targets": targets, "totals": totals, "unfilled": unfilled, "residual": residual, "passes": passes, "met": met}


def mixed(docs: DataFrame, labels: DataFrame, domain: Column, shares: dict[str, float], id_col: str = "doc_id", text_col: str = "text", budget: float | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` says; columns as they are.

    Texts are not written: rows whose copies are not one are told by a hash of id and text and
    joined. ``docs`` is read four times and must give the same rows each time.
    """
    keys = [free_name(docs, "k1_"), free_name(docs, "k2_")]
    text = F.col(text_col).cast("binary")
    keyed = docs.select("*", F.xxhash64(F.col(id_col), text).alias(keys[0]), F.xxhash64(F.lit("second"), F.col(id_col), text).alias(keys[1]))
    rated, told = mix(keyed.select(id_col, text_col, *keys), labels, domain, shares, id_col, text_col, budget)
    copies = free_name(docs, told["columns"]["copies"])
    other = rated.withColumnRenamed(told["columns"]["copies"], copies).where(F.col(copies) != 1).groupBy(*keys).agg(F.max(copies).alias(copies))
    joined = having(keyed, materialise(other, "copies"), keys, "left").withColumn(copies, F.coalesce(copies, F.lit(1)))
    return joined.where(F.col(copies) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies)).select(*docs.columns)


def domain_of_labels() -> Column:
    """The (quality, toxic) domain of a row of ``labels``; null if either is."""
    return F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior, rate and copies of all documents; targets and residuals by domain in each row."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rated, told = mix(docs.select("doc_id", "text"), labels, domain_of_labels(), TARGETS)
    c = told["columns"]
    each = []
    for k, n in enumerate(told["domains"]):
        each += [F.col(c["posterior"])[k].alias(f"p_{n}"), F.lit(float(told["targets"][k])).alias(f"target_{n}"), F.lit(float(told["residual"][k])).alias(f"residual_{n}")]
    return rated.select("doc_id", F.col(c["tokens"]).alias("tokens"), *each, F.col(c["rate"]).alias("rate"), F.col(c["copies"]).alias("copies"))
