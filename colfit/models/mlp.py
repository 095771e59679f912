"""Multilayer perceptron, in two forms with the same arithmetic.

``ColumnNetwork``: one sample, whose vector is a whole column of a table; a
layer is a table as long as that column.

``Network``: one sample per row in an ``array<double>``; layers are as wide as
the array.  Training averages the updates of all samples.

The backward pass follows one recursion: the output gradient is the loss's
intercept gradient, a single number; a layer's input is the layer below applied
to the raw inputs; the gradient handed down is the layer's new weights.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.functions.activations import Activation
from colfit.functions.losses import MSE, Hinge, Loss
from colfit.functions.numeric import array_sum, bind, double_array
from colfit.models.layers import activated, aligned, dots, stepped
from colfit.operators.stats import array_means, require_columns
from colfit.session import persisted, shared_folder


#: Epochs whose parameters are kept before they are written to the checkpoint folder.
EPOCHS_BETWEEN_WRITES = 5


@dataclass(frozen=True)
class ColumnNetwork:
    """Layers are DataFrames ``(pos, weight, bias)``, one activation each.

    Inputs are DataFrames ``(pos, value)``, with ``label`` for training.
    """

    layers: tuple[DataFrame, ...] = ()
    activations: tuple[Activation, ...] = ()
    loss_function: Loss = MSE

    def __post_init__(self):
        if len(self.layers) != len(self.activations):
            raise ValueError(
                f"{len(self.layers)} layers but {len(self.activations)} activations"
            )

    def add_layer(self, layer: DataFrame, activation: Activation) -> ColumnNetwork:
        return replace(
            self, layers=(*self.layers, layer), activations=(*self.activations, activation)
        )

    def set_layer(self, i: int, layer: DataFrame, activation: Activation) -> ColumnNetwork:
        return replace(
            self,
            layers=_replaced(self.layers, i, layer),
            activations=_replaced(self.activations, i, activation),
        )

    def forward(self, inputs: DataFrame) -> DataFrame:
        """Outputs ``(pos, value)``: a projection of the last layer's biases."""
        if not self.layers:
            return inputs.select("pos", "value")
        with self._joined(inputs, ["value"]) as joined:
            (first,) = dots(joined, [F.col("value") * F.col("weight0")])
            last = self._chain(joined, first)
        return activated(self.layers[-1], last, self.activations[-1])

    predict = forward

    def backward(
        self, inputs: DataFrame, learning_rate: float, output: str | None = None
    ) -> ColumnNetwork:
        """The network after one update from ``(pos, value, label)``.

        ``output`` names a column of ``inputs`` holding outputs computed before;
        without it they are computed here.
        """
        extra = [output] if output else []
        with self._joined(inputs, ["value", "label", *extra]) as state:
            return self._from_state(self._updated(state, learning_rate, output).checkpoint())

    def fit(self, inputs: DataFrame, num_epochs: int, learning_rate: float) -> ColumnNetwork:
        """Inputs and layers are joined once; an epoch is one aggregate for each
        layer and one for the gradients over the kept parameters.  Every few epochs
        they are written to the shared checkpoint folder, which keeps the plan from
        growing.
        """
        if num_epochs <= 0 or not self.layers:
            return self
        kept: list[DataFrame] = []
        with self._joined(inputs, ["value", "label"]) as state:
            try:
                for epoch in range(1, num_epochs + 1):
                    state = self._updated(state, learning_rate, None)
                    if epoch % EPOCHS_BETWEEN_WRITES == 0 or epoch == num_epochs:
                        state = state.checkpoint()
                        while kept:
                            kept.pop().unpersist()
                    else:
                        kept.append(state.persist(StorageLevel.MEMORY_AND_DISK))
            finally:
                for table in kept:
                    table.unpersist()
        return self._from_state(state)

    def loss(self, inputs: DataFrame) -> DataFrame:
        """The loss as a one-row DataFrame; prediction and label change places."""
        return self._scored(inputs).agg(
            self.loss_function.loss(F.col("output"), F.col("label")).alias("loss")
        )

    def accuracy(self, inputs: DataFrame) -> DataFrame:
        """Share of outputs exactly equal to the label."""
        hit = (F.col("output") == F.col("label")).cast("double")
        return self._scored(inputs).agg(F.avg(hit).alias("accuracy"))

    def _scored(self, inputs: DataFrame) -> DataFrame:
        require_columns(inputs, ["pos", "value", "label"])
        outputs = self.forward(inputs).withColumnRenamed("value", "output")
        labels = inputs.select("pos", F.col("label").cast("double").alias("label"))
        return labels.join(outputs, "pos")

    def _joined(
        self, inputs: DataFrame, columns: Sequence[str]
    ) -> AbstractContextManager[DataFrame]:
        require_columns(inputs, ["pos", *columns])
        shared_folder(inputs.sparkSession)
        rows = inputs.select(
            "pos", *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]
        )
        return aligned(rows, self.layers)

    def _output(self, state: DataFrame, i: int, dot: float) -> Column:
        return self.activations[i].over_column(state, F.lit(dot) + F.col(f"bias{i}"))

    def _chain(self, state: DataFrame, dot: float) -> float:
        """The last layer's dot product, from the first one's."""
        for i in range(len(self.layers) - 1):
            (dot,) = dots(state, [self._output(state, i, dot) * F.col(f"weight{i + 1}")])
        return dot

    def _updated(
        self, state: DataFrame, learning_rate: float, output: str | None
    ) -> DataFrame:
        last = len(self.layers) - 1
        x, rate = F.col("value"), F.lit(float(learning_rate))
        raw = dots(state, [x * F.col(f"weight{i}") for i in range(max(last, 1))])
        below = [
            x if i == 0 else self._output(state, i - 1, raw[i - 1]) for i in range(last + 1)
        ]
        out = F.col(output) if output else self._output(state, last, self._chain(state, raw[0]))

        # Each layer's new weights are a + b*g in the output gradient g, so their
        # sums, the bias shifts of the layers below, come from the pass that finds g.
        a, b, sums = F.lit(0.0), F.lit(1.0), []
        for i in range(last, 0, -1):
            a = stepped(F.col(f"weight{i}"), below[i], a, learning_rate)
            b = -(below[i] * b) * rate
            sums += [F.sum(a), F.sum(b)]
        gradient = self.loss_function.intercept_gradient(F.col("label"), out)
        g, *sums = state.agg(gradient.alias("g"), *sums).first()
        shifts = [a + b * g for a, b in zip(sums[::2], sums[1::2], strict=True)][::-1] + [g]

        weights: dict[int, Column] = {}
        down = F.lit(g)
        for i in range(last, -1, -1):
            weights[i] = down = stepped(F.col(f"weight{i}"), below[i], down, learning_rate)
        updated = {f"weight{i}": w for i, w in weights.items()}
        for i, shift in enumerate(shifts):
            updated[f"bias{i}"] = F.col(f"bias{i}") - F.lit(shift) * rate
        return state.withColumns(updated)

    def _from_state(self, state: DataFrame) -> ColumnNetwork:
        tables = tuple(
            state.select(
                "pos", F.col(f"weight{i}").alias("weight"), F.col(f"bias{i}").alias("bias")
            )
            for i in range(len(self.layers))
        )
        return replace(self, layers=tables)

    def parameters(self) -> DataFrame:
        """All layers as one table ``(layer, pos, weight, bias)``."""
        tables = [
            t.select(F.lit(i).alias("layer"), "pos", "weight", "bias")
            for i, t in enumerate(self.layers)
        ]
        result = tables[0]
        for table in tables[1:]:
            result = result.unionByName(table)
        return result


@dataclass(frozen=True)
class Layer:
    """A layer for array inputs: as many weights and biases as array elements."""

    weights: tuple[float, ...]
    biases: tuple[float, ...]
    activation: Activation

    def __post_init__(self):
        if len(self.weights) != len(self.biases):
            raise ValueError(f"{len(self.weights)} weights but {len(self.biases)} biases")


@dataclass(frozen=True)
class Network:
    """Layers of equal width; samples are rows with an array of that width."""

    layers: tuple[Layer, ...] = ()
    loss_function: Loss = MSE

    def __post_init__(self):
        if len({len(layer.weights) for layer in self.layers}) > 1:
            raise ValueError("layers must have equal width")

    def add_layer(self, layer: Layer) -> Network:
        return replace(self, layers=(*self.layers, layer))

    def set_layer(self, i: int, layer: Layer) -> Network:
        return replace(self, layers=_replaced(self.layers, i, layer))

    def forward(self, df: DataFrame, vector: str, column: str = "output") -> DataFrame:
        """``df`` with the output array; rows are scored independently, no shuffle."""
        require_columns(df, [vector])
        return df.withColumn(column, self.output(F.col(f"`{vector}`")))

    def output(self, vector: Column) -> Column:
        """The output array of an input array.

        Each layer is one number until the last one spreads it over the neurons.
        Every step uses the one before it once, so the expression stays as long
        as the network is deep.
        """
        vector = vector.cast("array<double>")
        if not self.layers:
            return vector
        first, *rest = self.layers
        outputs = _outputs(_dot(self._checked(vector), first.weights), first)
        for layer in rest:
            outputs = _outputs(_dot(outputs, layer.weights), layer)
        return outputs

    predict = forward

    def loss(self, df: DataFrame, vector: str, label: str) -> DataFrame:
        """Mean over samples of the sample's loss; prediction and label change places."""
        p, y = F.col("pair.output"), F.col("pair.label")
        value = self.loss_function.loss(p, y)
        if isinstance(self.loss_function, Hinge):
            # A sum over positions: divide by the number of samples.
            value = value / (F.count("*") / F.lit(float(self._width())))
        return self._pairs(df, vector, label).agg(value.alias("loss"))

    def accuracy(self, df: DataFrame, vector: str, label: str) -> DataFrame:
        """Share of outputs exactly equal to the label."""
        hit = (F.col("pair.output") == F.col("pair.label")).cast("double")
        return self._pairs(df, vector, label).agg(F.avg(hit).alias("accuracy"))

    def fit(
        self, df: DataFrame, vector: str, label: str, num_epochs: int, learning_rate: float
    ) -> Network:
        """One aggregate per epoch; the parameters pass through the driver."""
        require_columns(df, [vector, label])
        network = self
        with persisted(df.select(*dict.fromkeys([vector, label]))) as rows:
            for _ in range(num_epochs):
                network = network.backward(rows, vector, label, learning_rate)
        return network

    def backward(
        self, df: DataFrame, vector: str, label: str, learning_rate: float
    ) -> Network:
        """The network after one update, averaged over the samples of ``df``.

        A sample's new weights and bias shifts are computed within its row; each
        task adds them up and yields one row.
        """
        if not self.layers:
            return self
        require_columns(df, [vector, label])
        last = len(self.layers) - 1
        x = self._checked(F.col(f"`{vector}`").cast("array<double>"))
        rows = df.select(
            x.alias("x"), F.col(f"`{label}`").cast("array<double>").alias("y")
        ).select(
            "x",
            self._output_gradient(F.col("y"), self.output(F.col("x"))).alias("g"),
            *[_dot(F.col("x"), self.layers[i].weights).alias(f"dot{i}") for i in range(last)],
        )
        rate = F.lit(float(learning_rate))
        for i in range(last, -1, -1):
            below = F.col("x") if i == 0 else _outputs(F.col(f"dot{i - 1}"), self.layers[i - 1])
            if i == last:
                step = F.transform(below, lambda x: x * F.col("g"))
            else:
                step = F.zip_with(below, F.col(f"w{i + 1}"), lambda x, g: x * g)
            old = double_array(self.layers[i].weights)
            rows = rows.withColumn(f"w{i}", F.zip_with(old, step, lambda w, s: w - s * rate))
        shifts = [*[array_sum(F.col(f"w{i + 1}")) for i in range(last)], F.col("g")]
        values = F.concat(*[F.col(f"w{i}") for i in range(last + 1)], F.array(*shifts))
        found = array_means(rows, values)
        if found is None:
            raise ValueError("no samples to learn from")
        means = found.tolist()
        d = self._width()
        return replace(
            self,
            layers=tuple(
                Layer(
                    tuple(means[i * d + j] for j in range(d)),
                    tuple(b - means[(last + 1) * d + i] * learning_rate for b in layer.biases),
                    layer.activation,
                )
                for i, layer in enumerate(self.layers)
            ),
        )

    def _width(self) -> int:
        return len(self.layers[0].weights)

    def _checked(self, vector: Column) -> Column:
        width = self._width()
        wrong = F.raise_error(F.lit(f"expected an array of {width} values"))
        return F.when(
            vector.isNotNull(),
            F.when(F.size(vector) == width, vector).otherwise(wrong.cast("array<double>")),
        )

    def _output_gradient(self, y: Column, output: Column) -> Column:
        loss = self.loss_function
        terms = F.zip_with(y, output, lambda a, p: loss.intercept_term(a, p))
        return array_sum(terms) / F.size(terms) * F.lit(loss.intercept_scale)

    def _pairs(self, df: DataFrame, vector: str, label: str) -> DataFrame:
        """One row for each sample and position."""
        require_columns(df, [vector, label])
        pairs = F.arrays_zip(
            self.output(F.col(f"`{vector}`")).alias("output"),
            F.col(f"`{label}`").cast("array<double>").alias("label"),
        )
        return df.select(F.explode_outer(pairs).alias("pair"))


def _dot(vector: Column, weights: Sequence[float]) -> Column:
    return array_sum(F.zip_with(vector, double_array(weights), lambda x, w: x * w))


def _outputs(dot: Column, layer: Layer) -> Column:
    """The layer's output array from its dot product, which is evaluated once."""

    def spread(d: Column) -> Column:
        sums = F.transform(double_array(layer.biases), lambda b: d + b)
        return F.when(d.isNotNull(), layer.activation.activate_array(sums))

    return bind(dot, spread)


def _replaced(items: tuple, i: int, item) -> tuple:
    if not 0 <= i < len(items):
        raise IndexError(f"layer {i} out of range for {len(items)} layers")
    return (*items[:i], item, *items[i + 1 :])
