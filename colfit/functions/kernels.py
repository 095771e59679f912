"""Elementwise kernels of two columns (not a Gram matrix)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kernel:
    def apply(self, x: Column, y: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Identity(Kernel):
    """``x``; the second column is ignored."""

    def apply(self, x, y):
        return x


@dataclass(frozen=True)
class Linear(Kernel):
    def apply(self, x, y):
        return x * y


@dataclass(frozen=True)
class Polynomial(Kernel):
    """``(x*y + a) ** b``"""

    a: float
    b: float

    def apply(self, x, y):
        return F.pow(x * y + F.lit(float(self.a)), F.lit(float(self.b)))


@dataclass(frozen=True)
class RadialBasis(Kernel):
    """``exp(-gamma * (x - y)**2)``"""

    gamma: float

    def apply(self, x, y):
        return F.exp(F.lit(-float(self.gamma)) * ((x - y) * (x - y)))


IDENTITY = Identity()
LINEAR = Linear()
