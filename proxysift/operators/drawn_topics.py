"""Online topic model whose iterations read the documents they draw, and topic mixes by joins.

Every document's iterations are drawn once, by a seeded hash of its name, and the drawn
documents are stored in a folder per iteration. A word's weights are needed only where the word
occurs, and that is known beforehand: an iteration writes the new weights of its words into
the folder of the iteration that uses each of them next. So an iteration reads its own
documents and the weights of their words, and neither the corpus nor the vocabulary.

Weights of words that an iteration does not touch shrink by the same factor and grow by the
same amount; both are known for any span of iterations, so nothing has to be rewritten for it.
What the driver holds are a few numbers per topic and iteration.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proxysift import constants as C
from proxysift.functions import dot, widen
from proxysift.operators.lookup import lookup_join
from proxysift.params import AnalysisParams
from proxysift.session import durable, shared_folder

# The learning rate of iteration t is (OFFSET + t) ** -DECAY, as in Spark's own online fit.
OFFSET, DECAY = 1024.0, 0.51
# Shape of the gamma distribution that first weights are drawn from; its mean is 1.
SHAPE = 100.0
# A document's mix is settled when its shares change by less than this on average.
SETTLED = 1e-3
MOST_STEPS = 100
# Words of a document up to which its steps are made in one task; 16 MB of numbers for 20 topics.
LOCAL_WORDS = 100_000
# Rows of documents that share one array of numbers while their mixes are settled; 1 MB of numbers for 20 topics.
BLOCK_ROWS = 8192
# Rows of documents in a task and in each of the groups that it settles one after the other, about; least groups per task.
TASK_ROWS, GROUP_ROWS, LEAST_GROUPS = 500_000, 60_000, 3
_END = 0


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the logarithm of the gamma function, for positive numbers."""
    x = np.array(x, dtype=float)
    # Six steps for every number: to choose those that need them takes longer.
    total = np.zeros_like(x)
    for _ in range(6):
        total -= 1 / x
        x += 1
    inverse = 1 / (x * x)
    return total + np.log(x) - 0.5 / x - inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse / 240)))


def trigamma(x: np.ndarray) -> np.ndarray:
    """Second derivative of the logarithm of the gamma function, for positive numbers."""
    x = np.array(x, dtype=float)
    total = np.zeros_like(x)
    while (small := x < 6).any():
        total[small] += 1 / x[small] ** 2
        x[small] += 1
    inverse = 1 / (x * x)
    return total + 1 / x + inverse / 2 + inverse / x * (1 / 6 - inverse * (1 / 30 - inverse * (1 / 42 - inverse / 30)))


def document_topics(
    counts: np.ndarray, beta: np.ndarray, alpha: np.ndarray, tolerance: float = SETTLED, most_steps: int = MOST_STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """A document's topic weights, and the share of each of its words that each topic takes.

    ``beta`` has a row of exponentiated expectations per word.
    """
    gamma = np.ones_like(alpha)
    theta = np.exp(digamma(gamma) - digamma(gamma.sum()[None]))
    change = math.inf
    for _ in range(most_steps):
        if change <= tolerance:
            break
        new = alpha + theta * ((counts / (beta @ theta + 1e-100)) @ beta)
        change = np.abs(new - gamma).mean()
        gamma = new
        theta = np.exp(digamma(gamma) - digamma(gamma.sum()[None]))
    return gamma, (counts / (beta @ theta + 1e-100))[:, None] * beta * theta


def _blocks(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of documents that are settled together, of similar sizes and ``BLOCK_ROWS`` rows or one document."""
    order = np.argsort(sizes, kind="stable")[::-1]
    at = 0
    while at < len(order):
        # The first is the largest, and the others are filled up to its size.
        end = at + max(1, BLOCK_ROWS // max(1, int(sizes[order[at]])))
        yield order[at:end]
        at = end


def many_document_topics(
    sizes: np.ndarray, counts: np.ndarray, beta: np.ndarray, alpha: np.ndarray, tolerance: float = SETTLED, most_steps: int = MOST_STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """``document_topics`` of documents that follow each other in ``counts`` and ``beta``, ``sizes`` rows each.

    Documents step side by side, so that a step costs a few calls for all of them; one that
    is settled takes no further step. A row of topic weights per document, and one of shares
    per word.
    """
    starts = np.cumsum(sizes) - sizes
    gammas, shares = np.empty((len(sizes), len(alpha))), np.empty_like(beta)
    for block in _blocks(sizes):
        length = int(sizes[block].max())
        here = np.arange(length) < sizes[block][:, None]
        rows = (starts[block][:, None] + np.arange(length))[here]
        n, b = np.zeros(here.shape), np.zeros((*here.shape, len(alpha)))
        n[here], b[here] = counts[rows], beta[rows]
        gamma = np.ones((len(block), len(alpha)))
        theta = np.exp(digamma(gamma) - digamma(gamma.sum(axis=1))[:, None])
        live, live_n, live_b = np.arange(len(block)), n, b
        for _ in range(most_steps):
            part = live_n / ((live_b @ theta[live][:, :, None])[:, :, 0] + 1e-100)
            new = alpha + theta[live] * (part[:, None, :] @ live_b)[:, 0, :]
            moving = np.abs(new - gamma[live]).mean(axis=1) > tolerance
            gamma[live] = new
            theta[live] = np.exp(digamma(new) - digamma(new.sum(axis=1))[:, None])
            if not moving.all():
                live, live_n, live_b = live[moving], live_n[moving], live_b[moving]
                if not len(live):
                    break
        gammas[block] = gamma
        part = n / ((b @ theta[:, :, None])[:, :, 0] + 1e-100)
        shares[rows] = (part[:, :, None] * b * theta[:, None, :])[here]
    return gammas, shares


def by_documents(entries: DataFrame, rows: int) -> GroupedData:
    """``entries`` in groups of whole documents, more of them than cores and of a bounded number of rows.

    A group is of documents whose ``clientip`` has the same hash, unless one document is larger.
    """
    tasks = max(3 * entries.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS)
    groups = tasks * max(LEAST_GROUPS, rows // tasks // GROUP_ROWS)
    group = F.pmod(F.xxhash64("clientip"), F.lit(groups))
    # A number is named, so that few bytes, which take long here, are not merged into few tasks.
    return entries.withColumn("_group", group).repartition(tasks, "_group").groupBy("_group")


def _documents(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows sorted by document, and each document's number of them."""
    codes, names = pd.factorize(rows.column("clientip").to_pandas(), use_na_sentinel=False)
    return rows.take(pa.array(np.argsort(codes, kind="stable"))), np.bincount(codes, minlength=len(names))


def _matrix(arrays: pa.ChunkedArray, topics: int) -> np.ndarray:
    """A row per array; each has a number per topic."""
    return arrays.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, topics)


def _arrays(matrix: np.ndarray) -> pa.Array:
    """An array per row of a matrix."""
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def first_weights(word: int, topics: int, seed: int) -> np.ndarray:
    """The weights that a word starts with; they depend on word and seed alone."""
    return np.random.default_rng((seed, word)).gamma(SHAPE, 1 / SHAPE, topics)


def drawn_iterations(document: Column, iterations: int, fraction: float, seed: int) -> Column:
    """The iterations from 1 that draw a document, each with a chance of ``fraction``.

    The gaps between them have a geometric distribution, so a document that is never drawn
    costs one number and not one per iteration.
    """
    if fraction >= 1:
        return F.sequence(F.lit(1), F.lit(iterations))

    def gap(nth: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(document, F.lit(seed), nth), 11)
        uniform = (bits.cast("double") + 0.5) * 0.5**53
        # More than all iterations are as good as any number beyond them.
        return F.least(F.floor(F.ln(uniform) / math.log1p(-fraction)), F.lit(iterations).cast("bigint")).cast("int") + 1

    def later(drawn: Column, nth: Column) -> Column:
        last = F.element_at(drawn, -1)
        return F.when(last <= iterations, F.concat(drawn, F.array(last + gap(nth)))).otherwise(drawn)

    first = gap(F.lit(0))
    every = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), F.array(first), later)
    none = F.array().cast("array<int>")
    return F.when(first > iterations, none).otherwise(F.filter(every, lambda i: i <= iterations))


@dataclass(frozen=True)
class DrawnTopics:
    """A fitted model: ``word_number, weights`` as a table, and a number per topic beside it."""

    weights: DataFrame
    alpha: tuple[float, ...]
    totals: tuple[float, ...]
    # Rows read and documents drawn by each iteration, from 1.
    rows_read: tuple[int, ...]
    documents: tuple[int, ...]


def draw_batches(entries: DataFrame, iterations: int, fraction: float, seed: int) -> tuple[str, dict[int, tuple[int, int]]]:
    """A table in the shared folder with a folder per iteration, and its documents and rows.

    ``entries`` has ``clientip, word_number, word_count``. A row says which iteration uses its
    word next (0 none) and whether none did before. It is as large as what the iterations
    read together. The same seed draws the same documents.
    """
    drawn = entries.select(
        "clientip", "word_number", "word_count",
        F.explode(drawn_iterations(F.col("clientip"), iterations, fraction, seed)).alias("iteration"),
    )
    drawn = durable(drawn)
    # A word has at most one row per iteration here.
    order = Window.partitionBy("word_number").orderBy("iteration")
    uses = drawn.select("word_number", "iteration").distinct().select(
        "word_number", "iteration", F.lead("iteration", 1, _END).over(order).alias("next"),
        (F.row_number().over(order) == 1).alias("first"),
    )
    path = f"{shared_folder(entries.sparkSession)}/drawn-{uuid4().hex}"
    linked = drawn.join(uses, ["word_number", "iteration"])
    # Rows of an iteration meet, so it is a few files and not one per task.
    linked.hint("rebalance", "iteration").write.partitionBy("iteration").parquet(f"{path}/batches")
    sizes = drawn.groupBy("iteration").agg(F.countDistinct("clientip").alias("documents"), F.count(F.lit(1)).alias("rows"))
    return path, {row.iteration: (row.documents, row["rows"]) for row in sizes.collect()}


def _updated_alpha(alpha: np.ndarray, log_shares: np.ndarray, documents: int, rate: float) -> np.ndarray:
    """One Newton step of the prior of topics, left out if it would make it negative."""
    expected = digamma(alpha) - digamma(alpha.sum()[None])
    gradient = documents * (log_shares / documents - expected)
    curve = -documents * trigamma(alpha)
    common = documents * trigamma(alpha.sum()[None])[0]
    shift = (gradient / curve).sum() / (1 / common + (1 / curve).sum())
    new = alpha - rate * (gradient - shift) / curve
    return new if (new > 0).all() else alpha


def fit_drawn(entries: DataFrame, words: DataFrame, documents: int, params: AnalysisParams, fraction: float) -> DrawnTopics:
    """Fit a topic model on ``clientip, word_number, word_count`` by drawn documents.

    ``words`` has every ``word_number`` of the vocabulary. One document's distinct words meet
    in a task; a batch of any size is spread by document.
    """
    spark, k = entries.sparkSession, params.topics
    alpha = np.full(k, params.alpha if params.alpha and params.alpha > 0 else 1 / k)
    eta = params.beta if params.beta and params.beta > 0 else 1 / k
    seed = params.seed
    names = [f"s{i}" for i in range(k)]
    path, sizes = draw_batches(entries, params.iterations, fraction, seed)

    def beginnings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "word_number": batch["word_number"], "weights": [first_weights(int(w), k, seed) for w in batch["word_number"]],
            })

    starts = words.select(F.col("word_number").cast("bigint")).mapInPandas(beginnings, "word_number bigint, weights array<double>")
    start = starts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("weights", F.lit(i))).alias(names[i]) for i in range(k)]).first()
    totals, vocabulary = np.array([start[name] or 0.0 for name in names]), start["n"]
    # After iteration t an untouched weight w is w * exp(shrink[t]) + growth[t].
    shrink, growth = [0.0], [0.0]
    state_schema = "word_number bigint, weights array<double>, at int, next int"
    read = []

    def aged(weights: np.ndarray, since: int, now: int) -> np.ndarray:
        factor = math.exp(shrink[now] - shrink[since])
        return weights * factor + growth[now] - growth[since] * factor

    def learner(now: int, expected_total: np.ndarray, prior: np.ndarray):
        def learn(rows: pa.Table) -> pa.Table:
            rows, sizes = _documents(rows)
            words, first_row, number = np.unique(rows.column("word_number").to_numpy(), return_index=True, return_inverse=True)
            # A word's rows hold the same weights.
            held = rows.select(["first", "next", "weights", "at"]).take(pa.array(first_row))
            first, at = held.column("first").to_numpy(), held.column("at").fill_null(0).to_numpy()
            weights = np.empty((len(words), k))
            weights[~first] = _matrix(held.column("weights").filter(pa.array(~first)), k)
            weights[first] = np.array([first_weights(int(w), k, seed) for w in words[first]]).reshape(-1, k)
            for since in np.unique(at):
                weights[at == since] = aged(weights[at == since], int(since), now)
            beta = np.exp(digamma(weights) - expected_total)
            counts = rows.column("word_count").to_numpy().astype(float)
            gamma, shares = many_document_topics(sizes, counts, beta[number], prior)
            # The group's sums: a row per word, and one of the documents' own numbers.
            order = np.argsort(number, kind="stable")
            sums = np.add.reduceat(shares[order], np.searchsorted(number[order], np.arange(len(words))))
            own = (digamma(gamma) - digamma(gamma.sum(axis=1))[:, None]).sum(axis=0)
            sums = np.vstack([sums, own])
            return pa.table([
                pa.array(np.append(words, -1)), pa.array(np.append(held.column("next").to_numpy(), -1).astype(np.int32)),
                _arrays(np.vstack([weights, np.zeros(k)])), *[pa.array(np.ascontiguousarray(column)) for column in sums.T],
            ], names=["word_number", "next", "weights", *names])

        return learn

    for t in range(1, params.iterations + 1):
        rate = (OFFSET + t) ** -DECAY
        drawn, rows = sizes.get(t, (0, 0))
        gained, log_shares = np.zeros(k), np.zeros(k)
        if drawn:
            batch = spark.read.schema("clientip string, word_number bigint, word_count bigint, next int, first boolean").parquet(
                f"{path}/batches/iteration={t}"
            )
            told = None
            if any_state := (t > 1 and _there(spark, f"{path}/state/next={t}")):
                told = spark.read.schema("word_number bigint, weights array<double>, at int").parquet(f"{path}/state/next={t}")
            joined = lookup_join(batch, told, "word_number") if any_state else batch.select(
                "*", F.lit(None).cast("array<double>").alias("weights"), F.lit(None).cast("int").alias("at")
            )
            learn = learner(t - 1, digamma(totals), alpha.copy())
            doubles = ", ".join(f"{name} double" for name in names)
            learned = by_documents(joined, rows).applyInArrow(learn, f"word_number bigint, next int, weights array<double>, {doubles}")
            sums = learned.groupBy("word_number", "next").agg(F.first("weights").alias("weights"), *[F.sum(n).alias(n) for n in names])
            seen = Observation()
            is_word = F.col("word_number") >= 0
            sums = sums.observe(
                seen, *[F.sum(F.when(is_word, F.col(n))).alias(n) for n in names],
                *[F.sum(F.when(~is_word, F.col(n))).alias(f"log_{n}") for n in names],
            )
            scale = documents / drawn
            new = F.transform(
                F.arrays_zip(F.col("weights").alias("w"), F.array(*names).alias("s")),
                lambda x: x["w"] * (1 - rate) + (x["s"] * scale + eta) * rate,
            )
            sums.where(is_word).select("word_number", new.alias("weights"), F.lit(t).alias("at"), "next").coalesce(
                max(1, min(spark.sparkContext.defaultParallelism, rows // 50_000))
            ).write.mode("append").partitionBy("next").parquet(f"{path}/state")
            gained = np.array([seen.get[n] for n in names]) * scale
            log_shares = np.array([seen.get[f"log_{n}"] for n in names])
        read.append(rows)
        totals = totals * (1 - rate) + rate * (gained + eta * vocabulary)
        shrink.append(shrink[-1] + math.log1p(-rate))
        growth.append(growth[-1] * (1 - rate) + eta * rate)
        if drawn:
            alpha = _updated_alpha(alpha, log_shares, drawn, rate)

    now = params.iterations
    if sizes and _there(spark, f"{path}/state/next={_END}"):
        last = spark.read.schema(state_schema.replace(", next int", "")).parquet(f"{path}/state/next={_END}")
    else:
        last = spark.createDataFrame([], state_schema.replace(", next int", ""))
    never = starts.join(last.select("word_number"), "word_number", "left_anti").select("word_number", "weights", F.lit(0).alias("at"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weights = [aged(np.asarray(w), int(at), now) for w, at in zip(batch["weights"], batch["at"], strict=True)]
            yield pd.DataFrame({"word_number": batch["word_number"], "weights": weights})

    weights = durable(last.unionByName(never).mapInPandas(finish, "word_number bigint, weights array<double>"))
    return DrawnTopics(
        weights, tuple(alpha), tuple(totals), tuple(read), tuple(sizes.get(t, (0, 0))[0] for t in range(1, now + 1))
    )


def _there(spark, path: str) -> bool:
    """Whether a folder exists, in whatever file system its path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def expected_rows(weights: DataFrame, topics: int) -> DataFrame:
    """``word_number, beta``: exponentiated expectations of a table ``word_number, weights``."""
    sums = weights.agg(*[F.sum(F.get("weights", F.lit(i))).alias(f"s{i}") for i in range(topics)]).first()
    # Summed over all words, so one number per topic.
    total = digamma(np.array([value or 1.0 for value in sums]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = digamma(np.array(batch["weights"].tolist(), dtype=float).reshape(-1, topics))
            yield pd.DataFrame({"word_number": batch["word_number"], "beta": list(np.exp(found - total))})

    return weights.select("word_number", "weights").mapInPandas(run, "word_number bigint, beta array<double>")


def mix_by_joins(
    entries: DataFrame, weights: DataFrame, alpha: tuple[float, ...], tolerance: float = SETTLED, most_steps: int = MOST_STEPS,
    limit_bytes: int = C.BROADCAST_LIMIT_BYTES, local_words: int = LOCAL_WORDS,
) -> DataFrame:
    """``document_name, topic_prob_mix`` of ``clientip, word_number, word_count`` and a table of
    ``word_number, weights``.

    The rows of a document's words meet their word's weights by a join; the vocabulary is
    broadcast only where it is measured to be small. A document of up to ``local_words``
    distinct words is settled in one task. A larger one stays spread over many: each of its
    steps is a join with the present mixes and a sum per document and topic, and documents
    that are settled leave the steps. Both ways give the same numbers.
    """
    topics = len(alpha)
    prior = np.array(alpha)
    beta = durable(expected_rows(weights, topics))
    entries = entries.select(
        "clientip", F.col("word_number").cast("bigint").alias("word_number"), F.col("word_count").cast("double").alias("n")
    )

    def with_beta(some: DataFrame) -> DataFrame:
        return lookup_join(some, beta, "word_number", "inner", limit_bytes).select("clientip", "n", "beta")

    def settle(rows: pa.Table) -> pa.Table:
        rows, sizes = _documents(rows)
        gamma, _ = many_document_topics(sizes, rows.column("n").to_numpy(), _matrix(rows.column("beta"), topics), prior, tolerance, most_steps)
        firsts = rows.column("clientip").take(pa.array(np.cumsum(sizes) - sizes))
        return pa.table([firsts, _arrays(gamma)], names=["clientip", "gamma"])

    sizes = durable(entries.groupBy("clientip").agg(F.count(F.lit(1)).alias("words")))
    large = durable(sizes.where(F.col("words") > local_words).select("clientip"))
    small = entries
    found = []
    if not large.isEmpty():
        marked = durable(lookup_join(entries, large.withColumn("large", F.lit(True)), "clientip", "left", limit_bytes))
        small = marked.where("large IS NULL").select("clientip", "word_number", "n")
        spread = durable(with_beta(marked.where("large").select("clientip", "word_number", "n")))
        found += _stepwise(spread, large, alpha, tolerance, most_steps, limit_bytes)
    rows = sizes.where(F.col("words") <= local_words).agg(F.sum("words")).first()[0] or 0
    found.append(by_documents(with_beta(small), rows).applyInArrow(settle, "clientip string, gamma array<double>"))
    whole = found[0]
    for one in found[1:]:
        whole = whole.unionByName(one)
    total = F.aggregate("gamma", F.lit(0.0), lambda a, b: a + b)
    return whole.select(F.col("clientip").alias("document_name"), F.transform("gamma", lambda g: g / total).alias("topic_prob_mix"))


def _stepwise(
    joined: DataFrame, names: DataFrame, alpha: tuple[float, ...], tolerance: float, most_steps: int, limit_bytes: int
) -> list[DataFrame]:
    """``clientip, gamma`` of documents whose words are spread, a table per step that settles some."""
    topics = len(alpha)

    def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gamma = np.array(batch["gamma"].tolist(), dtype=float).reshape(-1, topics)
            theta = np.exp(digamma(gamma) - digamma(gamma.sum(axis=1))[:, None])
            yield pd.DataFrame({"clientip": batch["clientip"], "gamma": list(gamma), "theta": list(theta)})

    schema = "clientip string, gamma array<double>, theta array<double>"
    now = durable(names.select("clientip", F.array(*[F.lit(1.0)] * topics).alias("gamma")).mapInPandas(shares, schema))
    settled = []
    for _ in range(most_steps):
        met = lookup_join(joined, now, "clientip", "inner", limit_bytes)
        part = F.col("n") / (dot(F.col("beta"), F.col("theta"), topics) + 1e-100)
        sums = met.select("clientip", "gamma", "theta", part.alias("part"), "beta").groupBy("clientip").agg(
            F.first("gamma").alias("old"), F.first("theta").alias("theta"),
            *[F.sum(F.col("part") * F.get("beta", F.lit(i))).alias(f"g{i}") for i in range(topics)],
        )
        new = F.array(*[F.lit(a) + F.get("theta", F.lit(i)) * F.col(f"g{i}") for i, a in enumerate(alpha)])
        stepped = sums.select("clientip", new.alias("gamma"), "old")
        moved = F.aggregate(F.zip_with("gamma", "old", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: a + b) / topics
        stepped = durable(stepped.withColumn("moved", moved))
        settled.append(stepped.where(F.col("moved") <= tolerance).select("clientip", "gamma"))
        now = durable(stepped.where(F.col("moved") > tolerance).select("clientip", "gamma").mapInPandas(shares, schema))
        if now.isEmpty():
            break
    return [*settled, now.select("clientip", "gamma")]


def log_likelihood(entries: DataFrame, mix: DataFrame, weights: DataFrame, topics: int) -> float:
    """Mean natural log probability of a word of ``entries`` under a mix and a table of weights."""
    sums = weights.agg(*[F.sum(F.get("weights", F.lit(i))).alias(f"s{i}") for i in range(topics)]).first()
    shares = F.array(*[F.get("weights", F.lit(i)) / F.lit(float(sums[i])) for i in range(topics)])
    rows = weights.select(F.col("word_number").cast("bigint").alias("word_number"), shares.alias("beta"))
    by_client = mix.select(F.col("document_name").alias("clientip"), widen(F.col("topic_prob_mix")).alias("theta"))
    # The clients come first: where one of the tables is large, the entries are shuffled without the other's arrays.
    mixed = lookup_join(entries.withColumn("word_number", F.col("word_number").cast("bigint")), durable(by_client), "clientip", "inner")
    met = lookup_join(mixed, durable(rows), "word_number", "inner")
    log = F.ln(dot(F.col("beta"), F.col("theta"), topics))
    return met.agg((F.sum(log * F.col("word_count")) / F.sum("word_count")).alias("x")).first().x
