"""Defaults of a study, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    test_fraction: float = 0.2
    seed: int = 42
    folds: int = 5
    variance_kept: float = 0.95
    top_correlations: int = 30
    smote_neighbours: int = 5
    cluster_smote_neighbours: int = 2
    cluster_smote_clusters: int = 8
    # minority share a cluster needs; None takes the balance-derived default
    cluster_smote_threshold: float | None = 0.01
    # False keeps every label-derived column in the model inputs
    leak_guard: bool = True
    # passes that a linear fit may take; reaching them is reported
    linear_iterations: int = 1_000
    # random cosine features that stand for the RBF kernel
    fourier_size: int = 256
