"""A feed-forward network (M12, M13): data-parallel mini-batch training, and a
forward pass in column expressions.

Training: the table is read once and kept as blocks of BLOCK_ROWS rows, in the
cache, whose rows are the bytes of a block; every pass over them is one Spark
job.  A task walks the blocks of its partition, shuffles each by a seed of pass,
partition and block, and takes one Adam step per mini-batch, starting from the
parameters all tasks share; the driver then averages the tasks' parameters and
moments, weighted by their rows.  Where a task gets many blocks at once it deals
their rows to lanes of LANE_ROWS rows, which step side by side in stacked matrices
and are averaged as the tasks are: the same mini-batches and passes, as with more
and smaller partitions.  A task holds one batch of blocks, the driver one
parameter vector per partition.  The result depends only on the seed and on the
rows of each partition in their order, so train on a materialised table.

Scoring: ``Network.forward`` is a projection over literal weights; it needs no
model object on the executors and runs on a stream.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile import defaults as D
from turnstile.functions.expressions import name_lookup

BLOCK_ROWS = 8_192
# Rows of a lane at least; fewer than two lanes go block by block.
LANE_ROWS = 8_192
# Adam, with its usual constants.
RATE, DECAY, DECAY_SQUARES, TINY = 0.005, 0.9, 0.999, 1e-8
# Inputs of a unit up to which its sum is written out.
UNROLLED = 256
BLOCK_SCHEMA = "x binary, label binary"
STEP_SCHEMA = "part int, n bigint, steps bigint, state binary"


@dataclass
class Network:
    """Weights (inputs x units) and biases of each layer; hidden units are
    ``relu`` or ``sigmoid``, the last layer is a softmax over the classes."""
    weights: list[np.ndarray]
    biases: list[np.ndarray]
    activation: str = "relu"

    @property
    def layers(self) -> list[int]:
        return [len(self.weights[0]), *[len(b) for b in self.biases]]

    @staticmethod
    def from_spark_ml(model) -> Network:
        """The network of a fitted MultilayerPerceptronClassifier: per layer the
        weights column by column, then the biases."""
        sizes, flat = model.getLayers(), np.asarray(model.weights)
        weights, biases, at = [], [], 0
        for n, m in zip(sizes, sizes[1:]):
            # Its matrices are units x inputs, stored by input.
            weights.append(flat[at:at + n * m].reshape(n, m))
            biases.append(flat[at + n * m:at + n * m + m])
            at += n * m + m
        return Network(weights, biases, "sigmoid")

    def forward(self, inputs: Column) -> tuple[list, list[Column]]:
        """(steps, class probabilities): ``steps`` are (name, column) pairs to add
        one after the other, each an array of one layer's units."""
        steps, x = [], inputs
        for k, (w, b) in enumerate(zip(self.weights, self.biases)):
            sums = [_dot(x, w[:, j], b[j]) for j in range(len(b))]
            if k + 1 < len(self.weights):
                sums = [F.greatest(s, F.lit(0.0)) if self.activation == "relu"
                        else F.lit(1.0) / (F.lit(1.0) + F.exp(-s)) for s in sums]
            steps.append((f"_layer_{k}", F.array(*sums)))
            x = F.col(f"_layer_{k}")
        top = F.array_max(x)
        parts = [F.exp(x[j] - top) for j in range(len(self.biases[-1]))]
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        return steps, [p / total for p in parts]

    def score(self, df: DataFrame, features: Column, output: str = "probability") -> DataFrame:
        """``df`` with the array of class probabilities of ``features``, an array
        of doubles."""
        steps, classes = self.forward(F.col("_inputs"))
        out = df.withColumn("_inputs", features)
        for name, column in steps:
            out = out.withColumn(name, column)
        return out.withColumn(output, F.array(*classes)).drop("_inputs", *[n for n, _ in steps])

    def transform(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        """``df`` with ``probability`` (an array) and ``prediction``, as a fitted
        classifier adds them."""
        kind = df.schema[features_col].dataType.typeName()
        column = F.col(features_col) if kind == "array" else vector_to_array(features_col)
        scored = self.score(df, column)
        return scored.withColumn("prediction", (F.array_position(
            "probability", F.array_max("probability")) - 1).cast("double"))


def _dot(x: Column, weights: np.ndarray, bias: float) -> Column:
    """Products added in the order of the inputs, then the bias.  Few inputs are
    written out, which compiles; many are an array."""
    if len(weights) > UNROLLED:
        values = F.array(*[F.lit(w) for w in weights.tolist()])
        return F.aggregate(F.zip_with(x, values, lambda a, b: a * b), F.lit(0.0),
                           lambda total, v: total + v) + F.lit(float(bias))
    total = x[0] * F.lit(float(weights[0]))
    for i, w in enumerate(weights[1:].tolist(), 1):
        total = total + x[i] * F.lit(w)
    return total + F.lit(float(bias))


def probabilities(net: Network, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(inputs of every layer, class probabilities) of some rows."""
    held = [x]
    for k, (w, b) in enumerate(zip(net.weights, net.biases)):
        x = x @ w + b
        if k + 1 < len(net.weights):
            x = np.maximum(x, 0.0) if net.activation == "relu" else 1.0 / (1.0 + np.exp(-x))
            held.append(x)
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return held, x / x.sum(axis=1, keepdims=True)


def gradient(net: Network, x: np.ndarray, label: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean cross entropy of some rows, and its derivative by the parameters."""
    held, p = probabilities(net, x)
    loss = -float(np.log(np.maximum(p[np.arange(len(x)), label], 1e-300)).mean())
    delta = (p - np.eye(p.shape[1])[label]) / len(x)
    parts: list[np.ndarray] = []
    for k in range(len(net.weights) - 1, -1, -1):
        parts = [(held[k].T @ delta).ravel(), delta.sum(axis=0), *parts]
        if k:
            slope = (held[k] > 0) if net.activation == "relu" else held[k] * (1.0 - held[k])
            delta = (delta @ net.weights[k].T) * slope
    return loss, np.concatenate(parts)


def _relu_gradient(net: Network, out: Network, n: int) -> Callable[[np.ndarray, np.ndarray], None]:
    """``gradient`` of mini-batches of ``n`` rows, for ReLU: called with the rows and
    their classes as rows of the unit matrix, it puts the derivative into ``out``.
    The same operations in the same order, in buffers that are made once: of
    matrices this small, the time goes into calls and allocations."""
    units = net.layers[1:]
    held, deltas = [np.empty((n, m)) for m in units], [np.empty((n, m)) for m in units]
    slopes, column, count = [np.empty((n, m), bool) for m in units], np.empty((n, 1)), np.array(float(n))
    zero, turned = np.zeros(()), [w.T for w in net.weights]
    p, last = held[-1], len(units) - 1

    def run(x: np.ndarray, wanted: np.ndarray) -> None:
        below = x
        for k in range(last + 1):
            np.dot(below, net.weights[k], held[k])
            np.add(held[k], net.biases[k], held[k])
            if k < last:
                np.maximum(held[k], zero, held[k])
            below = held[k]
        np.maximum.reduce(p, 1, None, column, True)
        np.subtract(p, column, p)
        np.exp(p, p)
        np.add.reduce(p, 1, None, column, True)
        np.divide(p, column, p)
        np.subtract(p, wanted, deltas[last])
        np.divide(deltas[last], count, deltas[last])
        for k in range(last, -1, -1):
            np.dot((held[k - 1] if k else x).T, deltas[k], out.weights[k])
            np.add.reduce(deltas[k], 0, None, out.biases[k])
            if k:
                np.dot(deltas[k], turned[k], deltas[k - 1])
                np.greater(held[k - 1], zero, slopes[k - 1])
                np.multiply(deltas[k - 1], slopes[k - 1], deltas[k - 1])

    return run


def flat(net: Network) -> np.ndarray:
    return np.concatenate([p.ravel() for pair in zip(net.weights, net.biases) for p in pair])


def from_flat(values: np.ndarray, layers: Sequence[int], activation: str = "relu") -> Network:
    return _views(values.copy(), layers, activation)


def _views(values: np.ndarray, layers: Sequence[int], activation: str = "relu") -> Network:
    """The network whose weights and biases are parts of ``values`` itself."""
    weights, biases, at = [], [], 0
    for n, m in zip(layers, layers[1:]):
        weights.append(values[at:at + n * m].reshape(n, m))
        biases.append(values[at + n * m:at + n * m + m])
        at += n * m + m
    return Network(weights, biases, activation)


def start(layers: Sequence[int], seed: int) -> Network:
    """Weights of variance 2 / inputs, biases a little above zero, so that units
    start alive."""
    rnd = np.random.default_rng(seed)
    return Network([rnd.normal(0.0, np.sqrt(2.0 / n), (n, m)) for n, m in zip(layers, layers[1:])],
                   [np.full(m, 0.01) for m in layers[1:]])


def _adam(state: np.ndarray, steps: int, x: np.ndarray, label: np.ndarray, layers: Sequence[int],
          batch: int, order: np.random.Generator) -> int:
    """Mini-batch steps over the rows of a block, in a random order; ``state``
    (parameters, mean, mean square) is changed in place."""
    n = len(state) // 3
    theta, moments = state[:n], state[n:]
    mean, square = moments[:n], moments[n:]
    new, a, b, change = np.empty(2 * n), np.empty(n), np.empty(n), np.empty(2 * n)
    g, squares = new[:n], new[n:]
    rates = np.repeat([1 - DECAY, 1 - DECAY_SQUARES], n)
    net, out = _views(theta, layers), _views(g, layers)
    rows = order.permutation(len(x))
    x, wanted = x[rows], np.eye(layers[-1])[label[rows]]
    whole = _relu_gradient(net, out, batch)
    for at in range(0, len(rows), batch):
        some = x[at:at + batch]
        derive = whole if len(some) == batch else _relu_gradient(net, out, len(some))
        derive(some, wanted[at:at + batch])
        steps += 1
        np.multiply(g, g, squares)
        # moments += rates * (new - moments)
        np.subtract(new, moments, change)
        np.multiply(change, rates, change)
        np.add(moments, change, moments)
        # theta -= RATE * (mean / ...) / (sqrt(square / ...) + TINY)
        np.divide(mean, 1 - DECAY ** steps, a)
        np.multiply(a, RATE, a)
        np.divide(square, 1 - DECAY_SQUARES ** steps, b)
        np.sqrt(b, b)
        np.add(b, TINY, b)
        np.divide(a, b, a)
        np.subtract(theta, a, theta)
    return steps


def _lane_gradients(theta: np.ndarray, g: np.ndarray, layers: Sequence[int], n: int
                    ) -> Callable[[np.ndarray, np.ndarray], None]:
    """As ``_relu_gradient``, for networks whose parameters are the rows of ``theta``:
    called with ``n`` rows and their classes for each of them, it puts the
    derivatives into the rows of ``g``."""
    lanes, units, last = len(theta), layers[1:], len(layers) - 2
    weights, biases = _lane_views(theta, layers)
    out_weights, out_biases = _lane_views(g, layers)
    held, deltas = [np.empty((lanes, n, m)) for m in units], [np.empty((lanes, n, m)) for m in units]
    slopes = [np.empty((lanes, n, m), bool) for m in units]
    ones, p = np.ones((lanes, 1, n)), held[-1]

    def run(x: np.ndarray, wanted: np.ndarray) -> None:
        below = x
        for k in range(last + 1):
            np.matmul(below, weights[k], held[k])
            np.add(held[k], biases[k], held[k])
            if k < last:
                np.maximum(held[k], 0.0, held[k])
            below = held[k]
        # Class by class: of few classes, a reduction costs more than its sums.
        top, total = p[..., 0].copy(), np.zeros((lanes, n))
        for c in range(1, units[-1]):
            np.maximum(top, p[..., c], top)
        np.subtract(p, top[..., None], p)
        np.exp(p, p)
        for c in range(units[-1]):
            np.add(total, p[..., c], total)
        np.divide(p, total[..., None], p)
        np.subtract(p, wanted, deltas[last])
        np.divide(deltas[last], float(n), deltas[last])
        for k in range(last, -1, -1):
            np.matmul((held[k - 1] if k else x).swapaxes(1, 2), deltas[k], out_weights[k])
            np.matmul(ones, deltas[k], out_biases[k])
            if k:
                np.matmul(deltas[k], weights[k].swapaxes(1, 2), deltas[k - 1])
                np.greater(held[k - 1], 0.0, slopes[k - 1])
                np.multiply(deltas[k - 1], slopes[k - 1], deltas[k - 1])

    return run


def _lane_views(values: np.ndarray, layers: Sequence[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """As ``_views``, of a network per row: weights (row, inputs, units), biases
    (row, 1, units)."""
    weights, biases, at = [], [], 0
    for n, m in zip(layers, layers[1:]):
        weights.append(values[:, at:at + n * m].reshape(-1, n, m, copy=False))
        biases.append(values[:, None, at + n * m:at + n * m + m])
        at += n * m + m
    return weights, biases


def _adam_lanes(state: np.ndarray, steps: int, x: np.ndarray, label: np.ndarray, layers: Sequence[int],
                batch: int, order: np.random.Generator) -> int:
    """As ``_adam``, with the rows dealt at random to lanes that all start from
    ``state`` and whose average it becomes; fewer rows than lanes are left over, and
    take their steps after that."""
    n, lanes = len(state) // 3, len(x) // LANE_ROWS
    size = len(x) // lanes
    rows = order.permutation(len(x))
    dealt, classes = rows[:lanes * size].reshape(lanes, size), np.eye(layers[-1])
    theta, moments = np.tile(state[:n], (lanes, 1)), np.tile(state[n:], (lanes, 1))
    mean, square = moments[:, :n], moments[:, n:]
    new, change = np.empty((lanes, 2 * n)), np.empty((lanes, 2 * n))
    a, b = np.empty((lanes, n)), np.empty((lanes, n))
    g, squares = new[:, :n], new[:, n:]
    rates = np.repeat([1 - DECAY, 1 - DECAY_SQUARES], n)
    whole = _lane_gradients(theta, g, layers, min(batch, size))
    for at in range(0, size, batch):
        some = dealt[:, at:at + batch]
        derive = whole if some.shape[1] == min(batch, size) else _lane_gradients(theta, g, layers, some.shape[1])
        derive(x[some], classes[label[some]])
        steps += 1
        np.multiply(g, g, squares)
        np.subtract(new, moments, change)
        np.multiply(change, rates, change)
        np.add(moments, change, moments)
        np.multiply(mean, RATE / (1 - DECAY ** steps), a)
        np.multiply(square, 1 / (1 - DECAY_SQUARES ** steps), b)
        np.sqrt(b, b)
        np.add(b, TINY, b)
        np.divide(a, b, a)
        np.subtract(theta, a, theta)
    state[:n], state[n:] = theta.mean(axis=0), moments.mean(axis=0)
    left = rows[lanes * size:]
    return _adam(state, steps, x[left], label[left], layers, batch, order) if len(left) else steps


def fit_relu(df: DataFrame, features_col: str, label: str, n_inputs: int,
             hidden: Sequence[int] = D.MLP_HIDDEN, n_outputs: int = 2, passes: int = D.MLP_MAX_ITER,
             batch: int = D.MLP_BLOCK_SIZE, seed: int = 0) -> Network:
    """A ReLU network with a softmax of ``n_outputs`` classes 0, 1, ..., trained for
    ``passes`` over ``df`` in mini-batches of ``batch`` rows.  Rows with a null
    label or a label that is no class raise; an empty table gives the start."""
    (lab,) = name_lookup(df, [label])
    layers = [n_inputs, *hidden, n_outputs]
    kind = df.schema[features_col].dataType.typeName()
    x = F.col(features_col) if kind == "array" else vector_to_array(features_col)
    ok = F.col(lab).isin(*range(n_outputs))
    number = F.when(ok, F.col(lab)).otherwise(F.raise_error(F.lit(f"label {lab} holds a value that is no class")))
    rows = df.select(x.cast("array<double>").alias("x"), number.cast("int").alias("label"))
    theta = flat(start(layers, seed))
    state, steps = np.concatenate([theta, np.zeros(2 * len(theta))]), 0
    blocks = _blocks(rows, n_inputs).persist()
    try:
        for k in range(passes):
            done = _pass(blocks, state, steps, layers, batch, seed, k)
            total = sum(n for _, n, _, _ in done)
            if not total:
                break
            # In the order of the partitions, so that sums are added alike.
            state = sum(n / total * np.frombuffer(s) for _, n, _, s in sorted(done))
            steps = max(s for _, _, s, _ in done)
    finally:
        blocks.unpersist()
    return from_flat(state[:len(theta)], layers)


def _packed(x: np.ndarray) -> bytes:
    """Rows as bytes.  Columns of whole numbers up to 255, as indicators are, take a
    byte a value; which they are comes last."""
    with np.errstate(invalid="ignore"):
        narrow = (x == x.astype(np.uint8)).all(axis=0)
    return x[:, ~narrow].tobytes() + x[:, narrow].astype(np.uint8).tobytes() + narrow.tobytes()


def _unpack(data: pa.Buffer, into: np.ndarray) -> None:
    """The rows of ``_packed``."""
    n, p = into.shape
    narrow = np.frombuffer(data, bool, p, data.size - p)
    k = int(narrow.sum())
    into[:, ~narrow] = np.frombuffer(data, float, n * (p - k)).reshape(n, p - k)
    into[:, narrow] = np.frombuffer(data, np.uint8, n * k, 8 * n * (p - k)).reshape(n, k)


def _blocks(rows: DataFrame, n_inputs: int) -> DataFrame:
    """``rows`` (x, label) as blocks of BLOCK_ROWS rows at most, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                block = b.slice(at, BLOCK_ROWS)
                x = block.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_inputs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_packed(x)], pa.binary()),
                     pa.array([block.column(1).to_numpy().tobytes()], pa.binary())], names=["x", "label"])

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def _pass(blocks: DataFrame, state: np.ndarray, steps: int, layers: Sequence[int], batch: int,
          seed: int, number: int) -> list[tuple[int, int, int, bytes]]:
    """(partition, rows, steps, state) of every partition after one pass."""
    sent = base64.b64encode(state.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, part = np.frombuffer(base64.b64decode(sent)).copy(), TaskContext.get().partitionId()
        now, n = steps, 0
        for b in batches:
            labels = [np.frombuffer(v.as_buffer(), np.int32) for v in b.column(1)]
            ends = np.cumsum([0, *map(len, labels)])
            x = np.empty((ends[-1], layers[0]))
            for k, values in enumerate(b.column(0)):
                _unpack(values.as_buffer(), x[ends[k]:ends[k + 1]])
            label, step = np.concatenate([np.empty(0, np.int32), *labels]), _adam
            if len(x) >= 2 * LANE_ROWS:
                step, ends = _adam_lanes, [0, len(x)]
            for at, end in zip(ends, ends[1:]):
                order = np.random.default_rng([seed, number, part, n])
                now = step(mine, now, x[at:end], label[at:end], layers, batch, order)
                n += int(end - at)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([n]), pa.array([now]), pa.array([mine.tobytes()], pa.binary())],
                names=["part", "n", "steps", "state"])

    got = blocks.mapInArrow(run, STEP_SCHEMA).toArrow()
    return list(zip(*(got.column(c).to_pylist() for c in ("part", "n", "steps", "state")))) if got.num_rows else []
