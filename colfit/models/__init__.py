from colfit.models.dense import Adam, DenseLayer, DenseNetwork, Descent, random_layer, zero_layer
from colfit.models.kmeans import EQUIDISTANT, RANDOM, KMeans, KMeansModel, MaxIter, Tol
from colfit.models.layers import layer_random, layer_zeroes, positions
from colfit.models.linear import LinearModel, fit_linear
from colfit.models.linkage import Linkage, fit_single_linkage
from colfit.models.logistic import LogisticModel, classify, fit_logistic
from colfit.models.mlp import ColumnNetwork, Layer, Network
from colfit.models.svm import SVMModel, fit_svm
from colfit.models.tree import CLASSIFICATION, REGRESSION, TreeModel, fit_forest, fit_tree

__all__ = [
    "CLASSIFICATION",
    "EQUIDISTANT",
    "RANDOM",
    "REGRESSION",
    "Adam",
    "ColumnNetwork",
    "DenseLayer",
    "DenseNetwork",
    "Descent",
    "KMeans",
    "KMeansModel",
    "Layer",
    "Linkage",
    "LinearModel",
    "LogisticModel",
    "MaxIter",
    "Network",
    "SVMModel",
    "Tol",
    "TreeModel",
    "classify",
    "fit_forest",
    "fit_linear",
    "fit_logistic",
    "fit_single_linkage",
    "fit_svm",
    "fit_tree",
    "layer_random",
    "layer_zeroes",
    "positions",
    "random_layer",
    "zero_layer",
]
