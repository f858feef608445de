"""A small multilayer regressor: numpy on Arrow batches inside the tasks, Spark around it.

Training keeps the feature rows distributed. `mlp_descend` takes synchronous steps: Spark
sums the gradient over all rows of a step, and one optimiser outside the partitions moves
the weights. `mlp_fit` lets each partition run mini-batch steps of its own and averages the
weights once an epoch: fewer jobs, but a result that depends on the number of parts. Either
way only as many numbers as the net has parameters come to the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.session import kept, scratch_dir

# Different rows of one training block, about, and the unit in which gradients are summed.
BLOCK_ROWS = 4096
UNIT = 2.0**-44
WEIGHTS = "layer int, i int, j int, value double"  # j = -1 is the bias of output i


def _unpack(vector: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        layers.append((vector[at : at + a * b].reshape(b, a), vector[at + a * b : at + a * b + b]))
        at += a * b + b
    return layers


def initial_vector(sizes: list[int], seed: int) -> np.ndarray:
    """Uniform weights and biases within ±1/√inputs."""
    rng = np.random.default_rng(seed)
    return np.concatenate(
        [rng.uniform(-1, 1, a * b + b) / np.sqrt(a) for a, b in zip(sizes, sizes[1:])]
    )


def forward(x: np.ndarray, layers: list, out: str = "linear") -> list[np.ndarray]:
    """Activations of all layers, ReLU in between."""
    acts = [x]
    for k, (w, b) in enumerate(layers):
        z = acts[-1] @ w.T + b
        if k < len(layers) - 1:
            z = np.maximum(z, 0.0)
        elif out == "sigmoid":
            z = 1.0 / (1.0 + np.exp(-z))
        acts.append(z)
    return acts


def gradient(
    x: np.ndarray, y: np.ndarray, vector: np.ndarray, sizes: list[int], out: str = "linear", times: np.ndarray | None = None
) -> np.ndarray:
    """Gradient of the mean squared error; `times` says how often each row counts."""
    layers = _unpack(vector, sizes)
    acts = forward(x, layers, out)
    share = np.full(len(x), 1.0 / len(x)) if times is None else times / times.sum()
    delta = 2.0 * (acts[-1] - y[:, None]) * share[:, None]
    if out == "sigmoid":
        delta = delta * acts[-1] * (1.0 - acts[-1])
    grads = []
    for k in range(len(layers) - 1, -1, -1):
        grads.append(np.concatenate([(delta.T @ acts[k]).ravel(), delta.sum(axis=0)]))
        if k:
            delta = (delta @ layers[k][0]) * (acts[k] > 0)
    return np.concatenate(grads[::-1])


def mlp_fit(
    df: DataFrame,
    features: list[str],
    label: str,
    hidden: tuple[int, ...] = (100, 100),
    out: str = "linear",
    lr: float = 0.01,
    epochs: int = 30,
    batch: int = 32,
    seed: int = 0,
    partitions: int = 16,
) -> DataFrame:
    """Weights table (layer, i, j, value) of a net fitted to the rows.

    Each epoch every partition runs mini-batch Adam over its rows and the weights are averaged;
    the rate falls as 1 / (1 + 0.1 * epoch). Rows go to `partitions` parts by their hash and
    are sorted there, so the result does not depend on the cluster's settings.
    """
    spark = df.sparkSession
    sizes = [len(features), *hidden, 1]
    path = scratch_dir(spark, "mlp")
    # stored once: every epoch scans the same rows, whichever executors are left
    mixed = F.xxhash64(*features, label, F.lit(seed))
    rows = df.select(*features, label).na.drop().withColumn("_mixed", mixed)
    rows.repartition(partitions, "_mixed").sortWithinPartitions("_mixed", *features, label).drop("_mixed").write.parquet(path)
    rows = spark.read.parquet(path)
    vector = initial_vector(sizes, seed)

    for epoch in range(epochs):
        start = vector

        def train(batches, start=start, rate=lr / (1.0 + 0.1 * epoch)):
            v, m, s, t, seen = start.copy(), np.zeros_like(start), np.zeros_like(start), 0, 0
            for pdf in batches:
                x, y = pdf[features].to_numpy(float), pdf[label].to_numpy(float)
                for i in range(0, len(x), batch):
                    g = gradient(x[i : i + batch], y[i : i + batch], v, sizes, out)
                    t += 1
                    m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
                    v -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
                seen += len(x)
            if seen:
                yield pd.DataFrame({"pos": np.arange(len(v)), "wv": v * seen, "w": float(seen)})

        trained = rows.mapInPandas(train, "pos int, wv double, w double")
        averaged = trained.groupBy("pos").agg((F.sum("wv") / F.sum("w")).alias("v")).orderBy("pos").toPandas()
        if averaged.empty:
            raise ValueError("no complete rows to train on")
        vector = averaged["v"].to_numpy()

    return weights_table(spark, vector, sizes)


def training_blocks(df: DataFrame, features: list[str], label: str, batches: int = 1, seed: int = 0) -> DataFrame:
    """(step, block, x, y, times): the complete rows packed by hash into blocks of about BLOCK_ROWS, and blocks into steps.

    Equal rows become one that counts as often, so no block grows with copies. A block's
    content and order depend on the rows alone. Written to the scratch folder, by step.
    """
    numbers = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    names = [f"x{i}" for i in range(len(features))]
    rows = df.select(*numbers, F.col(label).cast("double").alias("y")).na.drop()
    folded = kept(rows.groupBy(*names, "y").agg(F.count("*").alias("times")), "folded")
    blocks = max(1, -(-folded.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64(*names, "y", F.lit(seed)), F.lit(blocks)).alias("block")
    packed = folded.groupBy(block).agg(F.array_sort(F.collect_list(F.struct(*names, "y", "times"))).alias("rows"))
    packed = packed.select(
        F.pmod("block", F.lit(batches)).cast("int").alias("step"),
        "block",
        F.flatten(F.transform("rows", lambda r: F.array(*[r[n] for n in names]))).alias("x"),
        F.transform("rows", lambda r: r["y"]).alias("y"),
        F.transform("rows", lambda r: r["times"].cast("double")).alias("times"),
    )
    path = scratch_dir(df.sparkSession, "blocks")
    packed.write.partitionBy("step").parquet(path)
    return df.sparkSession.read.schema(packed.schema).parquet(path)


def step_gradient(blocks: DataFrame, rows: float, vector: np.ndarray, sizes: list[int], out: str = "linear") -> np.ndarray:
    """Gradient of the mean squared error over all `rows` rows of the blocks.

    A block's share is rounded to whole units before it is summed, so the sum is the same
    in any order and under any partitioning. Shares beyond 2^17 are held there.
    """

    def shares(batches, vector=vector):
        total = np.zeros(len(vector), np.int64)
        for pdf in batches:
            for x, y, times in zip(pdf["x"], pdf["y"], pdf["times"]):
                g = gradient(x.reshape(len(y), -1), y, vector, sizes, out, times) * (times.sum() / rows)
                total += np.rint(np.clip(g, -(2.0**17), 2.0**17) / UNIT).astype(np.int64)
        yield pd.DataFrame({"pos": np.arange(len(total)), "units": total})

    parts = blocks.select("x", "y", "times").mapInPandas(shares, "pos int, units long")
    summed = parts.groupBy("pos").agg(F.sum("units").alias("units")).orderBy("pos").toPandas()
    return summed["units"].to_numpy() * UNIT


def mlp_descend(
    df: DataFrame,
    features: list[str],
    label: str,
    hidden: tuple[int, ...] = (100, 100),
    out: str = "linear",
    lr: float = 0.01,
    epochs: int = 30,
    batches: int = 8,
    seed: int = 0,
) -> DataFrame:
    """Weights table (layer, i, j, value) of a net fitted to the complete rows by synchronous Adam steps.

    An epoch takes `batches` steps, each over its share of the row blocks (fewer if there are
    fewer blocks); the rate falls as 1 / (1 + 0.1 * epoch). One job per step: each sums the
    gradient where the rows are, and the weights travel with the next. The result depends on
    the rows alone.
    """
    sizes = [len(features), *hidden, 1]
    blocks = training_blocks(df, features, label, batches, seed)
    counted = blocks.groupBy("step").agg(F.sum(F.aggregate("times", F.lit(0.0), lambda a, b: a + b)).alias("rows"))
    rows_of = {r["step"]: r["rows"] for r in counted.collect()}
    if not rows_of:
        raise ValueError("no complete rows to train on")
    vector = initial_vector(sizes, seed)
    m, s, t = np.zeros_like(vector), np.zeros_like(vector), 0
    for epoch in range(epochs):
        for step in sorted(rows_of):
            g = step_gradient(blocks.where(F.col("step") == step), rows_of[step], vector, sizes, out)
            t += 1
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            vector = vector - lr / (1 + 0.1 * epoch) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return weights_table(df.sparkSession, vector, sizes)


def weights_table(spark, vector: np.ndarray, sizes: list[int]) -> DataFrame:
    entries = []
    for layer, (w, b) in enumerate(_unpack(vector, sizes)):
        entries += [(layer, i, j, float(w[i, j])) for i in range(w.shape[0]) for j in range(w.shape[1])]
        entries += [(layer, i, -1, float(b[i])) for i in range(len(b))]
    return spark.createDataFrame(pd.DataFrame(entries, columns=["layer", "i", "j", "value"]), WEIGHTS)


def mlp_score(
    df: DataFrame, features: list[str], weights: DataFrame, out: str = "linear", name: str = "score"
) -> DataFrame:
    """Rows with the net's output. The weights, as small as the net, travel with the task."""
    table = weights.toPandas()
    layers = []
    for _, part in table.groupby("layer"):
        shape = (part["i"].max() + 1, part["j"].max() + 1)
        w, b = np.zeros(shape), np.zeros(shape[0])
        bias = part["j"] == -1
        w[part["i"][~bias], part["j"][~bias]] = part["value"][~bias]
        b[part["i"][bias]] = part["value"][bias]
        layers.append((w, b))

    @F.pandas_udf("double")
    def net(x: pd.DataFrame) -> pd.Series:
        return pd.Series(forward(x.to_numpy(float), layers, out)[-1][:, 0])

    return df.withColumn(name, net(F.struct(*features)))
