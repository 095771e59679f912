"""Networks of dense layers: true back-propagation, in whole passes or mini-batches.

Rows are kept as one array of features and one of labels.  In a task a batch of rows is a
matrix X; a layer is ``act(A @ W.T + b)``, and the chain rule runs back through the same
products.

Whole passes: every task adds up the gradients of its rows and yields one row of sums; the
driver holds the parameters and the optimiser's state and makes one step an epoch.

Mini-batches: rows are dealt to ``lanes`` by a hash of seed and key, and inside a lane to
``batches`` by a hash of seed, epoch and key.  A task goes through a lane's rows in order of
batch and key and makes a step after each batch, so one pass feeds many steps; after the
epoch the lanes' parameters and states are averaged (parallel stochastic descent).  Lanes
and batches depend on keys alone, and so does the result, whatever the partitions.

A network of one unit is a linear model (squared loss), a logistic one (cross entropy and
sigmoid) or a support vector machine (hinge loss).  L2 adds ``l2 * w`` to the gradient of a
weight; L1 moves weights towards zero by ``rate * l1`` after the step and stops there
(soft threshold), so that weights become exactly zero.  Biases are not regularised.

Results by case: nulls in features, labels or key raise, or their rows are left out with
``handle_invalid="skip"``; scoring a null feature gives null; NaN and infinity propagate as in
any arithmetic; a table without rows raises; a batch without rows makes no step; rows that
repeat a key share lane and batch, where their order is that of their values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.functions.activations import IDENTITY, SIGMOID, SOFTMAX, Activation, LeakyReLU, ReLU
from colfit.functions.numeric import any_null, array_sum, bind, double, double_array, ln
from colfit.functions.uniform import uniform_column, uniform_value
from colfit.operators.stats import added_up, check_counts, check_invalid, require_columns
from colfit.session import persisted, ship_package

SQUARED = "squared"
CROSS_ENTROPY = "cross_entropy"
HINGE = "hinge"

#: Rows of a mini-batch that are multiplied at once.
ROWS_AT_ONCE = 10_000


@dataclass(frozen=True)
class DenseLayer:
    """``weights[i][j]`` is what output i takes of input j."""

    weights: tuple[tuple[float, ...], ...]
    biases: tuple[float, ...]
    activation: Activation = IDENTITY

    def __post_init__(self):
        if not self.biases or len(self.weights) != len(self.biases) or len({len(row) for row in self.weights}) != 1:
            raise ValueError("need one row of weights, all of one length, and one bias for each output")

    @property
    def inputs(self) -> int:
        return len(self.weights[0])


def random_layer(inputs: int, outputs: int, activation: Activation, seed: int, layer: int = 0) -> DenseLayer:
    """Weights uniform within the root of 6 over inputs plus outputs, by a hash; no biases."""
    limit = (6 / (inputs + outputs)) ** 0.5
    weights = [[uniform_value(-limit, limit, seed, "weight", layer, i, j) for j in range(inputs)] for i in range(outputs)]
    return DenseLayer(tuple(map(tuple, weights)), (0.0,) * outputs, activation)


def zero_layer(inputs: int, outputs: int = 1, activation: Activation = IDENTITY) -> DenseLayer:
    return DenseLayer(((0.0,) * inputs,) * outputs, (0.0,) * outputs, activation)


@dataclass(frozen=True)
class Descent:
    """Steps of ``rate`` times the gradient."""

    rate: float
    l1: float = 0.0
    l2: float = 0.0
    moments = 0

    def step(self, values: np.ndarray, gradient: np.ndarray, moments: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        return values - self.rate * gradient, moments


@dataclass(frozen=True)
class Adam:
    """Steps scaled by running means of the gradient and its square, corrected for their start."""

    rate: float = 0.001
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-8
    l1: float = 0.0
    l2: float = 0.0
    moments = 2

    def step(self, values: np.ndarray, gradient: np.ndarray, moments: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        first = self.beta1 * moments[0] + (1 - self.beta1) * gradient
        second = self.beta2 * moments[1] + (1 - self.beta2) * gradient * gradient
        corrected = second / (1 - self.beta2**steps)
        change = self.rate * (first / (1 - self.beta1**steps)) / (np.sqrt(corrected) + self.epsilon)
        return values - change, np.stack((first, second))


Optimiser = Descent | Adam


@dataclass(frozen=True)
class OptimiserState:
    """Steps and epochs done and, for each parameter, the optimiser's moments."""

    steps: int = 0
    epochs: int = 0
    moments: tuple[tuple[float, ...], ...] = ()


@dataclass(frozen=True)
class DenseNetwork:
    """Layers between named features and one label column for each output."""

    features: tuple[str, ...]
    labels: tuple[str, ...]
    layers: tuple[DenseLayer, ...]
    loss_function: str = SQUARED
    state: OptimiserState = field(default=OptimiserState(), compare=False)

    def __post_init__(self):
        if not self.layers:
            raise ValueError("need at least one layer")
        widths = [len(self.features), *(len(layer.biases) for layer in self.layers)]
        if [layer.inputs for layer in self.layers] != widths[:-1] or widths[-1] != len(self.labels):
            raise ValueError("every layer takes what the one before gives, the last gives one value a label")
        last = self.layers[-1].activation
        if any(layer.activation == SOFTMAX for layer in self.layers[:-1]):
            raise ValueError("softmax is for the last layer")
        fits = {SQUARED: last != SOFTMAX, CROSS_ENTROPY: last in (SIGMOID, SOFTMAX), HINGE: last == IDENTITY}
        if not fits.get(self.loss_function):
            raise ValueError(f"loss {self.loss_function!r} does not go with this last activation")

    # ---- scoring ----------------------------------------------------------

    @property
    def output(self) -> Column:
        """The array of outputs; null where a feature is null."""
        values = F.array(*[double(f) for f in self.features])
        for layer in self.layers:
            values = _applied(values, layer)
        return F.when(~any_null(self.features), values)

    def predict(self, df: DataFrame, column: str = "output") -> DataFrame:
        """``df`` with the array of outputs, a projection."""
        require_columns(df, self.features)
        return df.withColumn(column, self.output)

    def loss(self, df: DataFrame) -> DataFrame:
        """Mean loss as a one-row DataFrame with column ``loss``, without regularisation."""
        require_columns(df, [*self.features, *self.labels])
        y = F.array(*[double(c) for c in self.labels])
        pairs = df.select(F.arrays_zip(self.output.alias("p"), y.alias("y")).alias("pairs"))
        one = F.lit(1.0)
        of_pair = {
            SQUARED: lambda z: (z.p - z.y) * (z.p - z.y),
            HINGE: lambda z: F.greatest(one - (z.y * 2 - one) * z.p, F.lit(0.0)),
            CROSS_ENTROPY: lambda z: -_weighted_ln(z.y, z.p) - _weighted_ln(one - z.y, one - z.p),
        }[self.loss_function]
        share = float(len(self.labels))
        if self.layers[-1].activation == SOFTMAX:
            of_pair, share = (lambda z: -_weighted_ln(z.y, z.p)), 1.0
        each = array_sum(F.transform("pairs", of_pair)) / F.lit(share)
        return pairs.agg(F.avg(each).alias("loss"))

    def accuracy(self, df: DataFrame) -> DataFrame:
        """Share of rows whose class is right: the first largest output, or one output above a half (0 for hinge)."""
        require_columns(df, [*self.features, *self.labels])
        if len(self.labels) == 1:
            level = 0.0 if self.loss_function == HINGE else 0.5
            found = (F.element_at(self.output, 1) > F.lit(level)).cast("double")
            right = found == double(self.labels[0])
        else:
            y = F.array(*[double(c) for c in self.labels])
            right = bind(self.output, lambda p: F.array_position(p, F.array_max(p))) == F.array_position(y, F.array_max(y))
        return df.agg(F.avg(right.cast("double")).alias("accuracy"))

    # ---- parameters -------------------------------------------------------

    def flat(self) -> np.ndarray:
        """All parameters, layer by layer, weights before biases."""
        return np.concatenate([np.append(np.ravel(layer.weights), layer.biases) for layer in self.layers])

    def with_flat(self, values: np.ndarray, state: OptimiserState = OptimiserState()) -> DenseNetwork:
        layers = []
        for (w, b), layer in zip(_matrices(values, _shapes(self)), self.layers, strict=True):
            layers.append(DenseLayer(tuple(map(tuple, w.tolist())), tuple(b.tolist()), layer.activation))
        return replace(self, layers=tuple(layers), state=state)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """``layer, output, input, value``; a bias has no input."""
        rows = []
        for k, layer in enumerate(self.layers):
            for i, (weights, bias) in enumerate(zip(layer.weights, layer.biases, strict=True)):
                rows += [(k, i, j, w) for j, w in enumerate(weights)] + [(k, i, None, bias)]
        return spark.createDataFrame(rows, "layer int, output int, input int, value double")

    # ---- training ---------------------------------------------------------

    def gradients(self, df: DataFrame, handle_invalid: str = "error") -> DenseNetwork:
        """The mean gradient of the loss, as a network of gradients."""
        rows = self._rows(df, None, handle_invalid)
        with persisted(rows):
            self._check(rows)
            return self.with_flat(self._gradient(rows))

    def fit(
        self,
        df: DataFrame,
        num_epochs: int,
        optimiser: Optimiser,
        *,
        batches: int | None = None,
        lanes: int = 1,
        key: str | None = None,
        seed: int = 0,
        handle_invalid: str = "error",
    ) -> DenseNetwork:
        """The network after so many epochs; continues with the state that it has.

        Without ``batches`` an epoch is one step; with them, that many steps in each lane,
        and ``key`` names the column that deals out rows.  A lane is what one task works on,
        so a cluster wants at least as many as it has cores.
        """
        if batches is not None and (batches < 1 or lanes < 1 or key is None):
            raise ValueError("mini-batches need a key, at least one batch and one lane")
        rows = self._rows(df, key if batches else None, handle_invalid)
        if batches:
            lane = F.floor(uniform_column(0, lanes, seed, "lane", F.col("key"))).cast("int")
            rows = rows.withColumn("lane", lane).repartition(lanes, "lane")
        network = self
        with persisted(rows):
            self._check(rows)
            for _ in range(num_epochs):
                if batches:
                    network = network._after_lanes(rows, batches, seed, optimiser)
                else:
                    values, moments = network._stepper(optimiser)(
                        network.flat(), network._gradient(rows), network._moments(optimiser), network.state.steps + 1
                    )
                    network = network._moved(values, moments, network.state.steps + 1)
        return network

    def _rows(self, df: DataFrame, key: str | None, handle_invalid: str) -> DataFrame:
        check_invalid(handle_invalid)
        names = [*self.features, *self.labels]
        require_columns(df, [*names, *([key] if key else [])])
        missing = any_null(list(dict.fromkeys(names)))
        if key:
            missing = missing | F.col(f"`{key}`").isNull()
        rows = df.where(~missing) if handle_invalid == "skip" else df
        return rows.select(
            F.array(*[double(f) for f in self.features]).alias("x"),
            F.array(*[double(c) for c in self.labels]).alias("y"),
            missing.alias("missing"),
            *([F.col(f"`{key}`").alias("key")] if key else []),
        )

    def _check(self, rows: DataFrame) -> None:
        check_counts(*rows.agg(F.count("*"), F.count_if("missing")).first())

    def _gradient(self, rows: DataFrame) -> np.ndarray:
        shapes, loss = _shapes(self), self.loss_function
        values, kinds = self.flat(), [layer.activation for layer in self.layers]

        def total(batch: pa.RecordBatch) -> np.ndarray:
            x, y = (_matrix(batch, c) for c in ("x", "y"))
            return np.append(back_propagated(_matrices(values, shapes), kinds, loss, x, y), len(x))

        sums = added_up(rows.select("x", "y"), total)
        return sums[:-1] / sums[-1]

    def _moments(self, optimiser: Optimiser) -> np.ndarray:
        if not self.state.steps:
            return np.zeros((optimiser.moments, len(self.flat())))
        if len(self.state.moments) != optimiser.moments:
            raise ValueError("the network's state is that of another optimiser")
        return np.array(self.state.moments).reshape(optimiser.moments, len(self.flat()))

    def _moved(self, values: np.ndarray, moments: np.ndarray, steps: int) -> DenseNetwork:
        packed = tuple(map(tuple, moments.tolist()))
        return self.with_flat(values, OptimiserState(steps, self.state.epochs + 1, packed))

    def _stepper(self, optimiser: Optimiser):
        """``(values, gradient, moments, steps) -> (values, moments)``, regularised."""
        weights = np.concatenate([np.repeat([True, False], [n * m, n]) for n, m in _shapes(self)])

        def step(values, gradient, moments, steps):
            if optimiser.l2:
                gradient = gradient + np.where(weights, optimiser.l2 * values, 0.0)
            values, moments = optimiser.step(values, gradient, moments, steps)
            if optimiser.l1:
                nearer = np.sign(values) * np.maximum(np.abs(values) - optimiser.rate * optimiser.l1, 0.0)
                values = np.where(weights, nearer, values)
            return values, moments

        return step

    def _after_lanes(self, rows: DataFrame, batches: int, seed: int, optimiser: Optimiser) -> DenseNetwork:
        """The network after one epoch of mini-batches: the average of the lanes."""
        shapes, loss, kinds = _shapes(self), self.loss_function, [layer.activation for layer in self.layers]
        first, first_moments, first_steps = self.flat(), self._moments(optimiser), self.state.steps
        step = self._stepper(optimiser)
        batch_of = F.floor(uniform_column(0, batches, seed, "batch", self.state.epochs, F.col("key"))).cast("int")

        def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def finished() -> pa.RecordBatch:
                flat = np.concatenate(([steps], values, moments.ravel()))
                return pa.RecordBatch.from_arrays([pa.array([lane], pa.int32()), pa.array([flat], pa.list_(pa.float64()))], ["lane", "found"])

            lane = None
            gradient, n = np.zeros_like(first), 0
            for own, x, y, last in _blocks(incoming):
                if own != lane:
                    if lane is not None:
                        yield finished()
                    lane, values, moments, steps = own, first, first_moments, first_steps
                gradient, n = gradient + back_propagated(_matrices(values, shapes), kinds, loss, x, y), n + len(x)
                if last:
                    steps += 1
                    values, moments = step(values, gradient / n, moments, steps)
                    gradient, n = np.zeros_like(first), 0
            if lane is not None:
                yield finished()

        ship_package(rows.sparkSession)
        ordered = rows.select("lane", batch_of.alias("batch"), "key", "x", "y").sortWithinPartitions("lane", "batch", "key", "x", "y")
        ended = ordered.select("lane", "batch", "x", "y").mapInArrow(run, "lane int, found array<double>")
        of_lanes = F.array_sort(F.collect_list(F.struct("lane", "value")))  # added up in one order
        found = (
            ended.select("lane", F.posexplode("found").alias("pos", "value"))
            .groupBy("pos")
            .agg((array_sum(F.transform(of_lanes, lambda v: v.value)) / F.count("*")).alias("mean"), F.max("value").alias("most"))
            .collect()  # a row per number that a lane ends with
        )
        found.sort(key=lambda r: r["pos"])
        means = np.array([r["mean"] for r in found[1:]])
        moments = means[len(first) :].reshape(optimiser.moments, len(first))
        return self._moved(means[: len(first)], moments, int(found[0]["most"]))


def _weighted_ln(weight: Column, x: Column) -> Column:
    """``weight * ln(x)``, nothing for no weight."""
    return F.when(weight == 0, F.lit(0.0)).otherwise(weight * ln(x))


def _applied(values: Column, layer: DenseLayer) -> Column:
    """A layer on an array, evaluated once."""
    rows = F.array(*[double_array(row) for row in layer.weights])

    def spread(inputs: Column) -> Column:
        sums = F.zip_with(
            rows, double_array(layer.biases), lambda row, b: array_sum(F.zip_with(row, inputs, lambda w, x: w * x)) + b
        )
        if layer.activation != SOFTMAX:
            return layer.activation.activate_array(sums)
        shifted = bind(sums, lambda z: F.transform(z, lambda v: F.exp(v - F.array_max(z))))
        return bind(shifted, lambda e: F.transform(e, lambda v: v / array_sum(e)))

    return bind(values, spread)


def _shapes(network: DenseNetwork) -> list[tuple[int, int]]:
    return [(len(layer.biases), layer.inputs) for layer in network.layers]


def _matrices(values: np.ndarray, shapes: Sequence[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for n, m in shapes:
        out.append((values[at : at + n * m].reshape(n, m), values[at + n * m : at + n * m + n]))
        at += n * m + n
    return out


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(incoming: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """``lane, x, y`` of rows sorted by lane and batch, and whether the batch ends with them.

    A batch is cut where its own rows are counted, not where those that come are.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows, last = 0, None
    for incoming_batch in incoming:
        lane, number = incoming_batch.column("lane").to_numpy(), incoming_batch.column("batch").to_numpy()
        x, y = _matrix(incoming_batch, "x"), _matrix(incoming_batch, "y")
        changes = np.flatnonzero((lane[1:] != lane[:-1]) | (number[1:] != number[:-1])) + 1
        edges = [0, *changes.tolist(), len(lane)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            own = int(lane[a]), int(number[a])
            if held and own != last:
                yield last[0], *_joined(held), True
                held, rows = [], 0
            last = own
            while rows + b - a > ROWS_AT_ONCE:
                cut = a + ROWS_AT_ONCE - rows
                yield last[0], *_joined([*held, (x[a:cut], y[a:cut])]), False
                held, rows, a = [], 0, cut
            held.append((x[a:b], y[a:b]))
            rows += b - a
    if held:
        yield last[0], *_joined(held), True


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    x, y = zip(*parts, strict=True)
    return np.concatenate(x), np.concatenate(y)


def activated(kind: Activation, z: np.ndarray) -> np.ndarray:
    """An activation of every number, softmax of every row."""
    if kind == IDENTITY:
        return z
    if kind == SIGMOID:
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-z))
    if isinstance(kind, ReLU):
        return np.where(z > 0, z, 0.0)
    if isinstance(kind, LeakyReLU):
        return np.where(z > 0, z, kind.alpha * z)
    shifted = np.exp(z - z.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def _slope(kind: Activation, z: np.ndarray, a: np.ndarray) -> np.ndarray:
    if kind == IDENTITY:
        return np.ones_like(z)
    if kind == SIGMOID:
        return a * (1 - a)
    return np.where(z > 0, 1.0, kind.alpha if isinstance(kind, LeakyReLU) else 0.0)


def back_propagated(
    parameters: Sequence[tuple[np.ndarray, np.ndarray]], kinds: Sequence[Activation], loss: str, x: np.ndarray, y: np.ndarray
) -> np.ndarray:
    """Gradients of all parameters added up over the rows of ``x`` and ``y``."""
    inputs, sums = [x], []
    for (w, b), kind in zip(parameters, kinds, strict=True):
        sums.append(inputs[-1] @ w.T + b)
        inputs.append(activated(kind, sums[-1]))
    p, share = inputs[-1], y.shape[1]
    if loss == HINGE:
        sign = 2 * y - 1
        error = np.where(sign * p < 1, -sign, 0.0) / share
    elif loss == SQUARED:
        error = 2 * (p - y) / share * _slope(kinds[-1], sums[-1], p)
    elif kinds[-1] == SOFTMAX:
        error = p * y.sum(axis=1, keepdims=True) - y
    else:  # the sigmoid's slope cancels
        error = (p - y) / share
    out = []
    for k in range(len(parameters) - 1, -1, -1):
        out.append(np.append((error.T @ inputs[k]).ravel(), error.sum(axis=0)))
        if k:
            error = (error @ parameters[k][0]) * _slope(kinds[k - 1], sums[k - 1], inputs[k])
    return np.concatenate(out[::-1])
