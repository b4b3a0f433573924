"""Search spaces of the ten models as data, and their translation to Spark parameters."""

from __future__ import annotations

import numpy as np

# The published search ranges. ("uniform", start, width) covers start..start+width,
# ("log", low, high) is log-uniform, ("int", low, high) excludes high, ("choice", ...) lists.
SPACES: dict[str, dict[str, tuple]] = {
    "Logistic Regression": {
        "C": ("log", 1e-4, 1e4),
        "penalty": ("choice", "l1", "l2", "elasticnet"),
        "solver": ("choice", "saga"),
        "l1_ratio": ("uniform", 0, 1),
        "class_weight": ("choice", "balanced", None),
        "max_iter": ("choice", 1000),
    },
    "SGD Classifier": {
        "loss": ("choice", "log_loss", "modified_huber", "perceptron"),
        "penalty": ("choice", "l1", "l2", "elasticnet"),
        "alpha": ("log", 1e-6, 1e-2),
        "l1_ratio": ("uniform", 0, 1),
        "learning_rate": ("choice", "optimal", "adaptive"),
        "class_weight": ("choice", "balanced", None),
        "epsilon": ("uniform", 0.01, 0.1),
        "max_iter": ("choice", 1000),
        "eta0": ("uniform", 0.01, 1.0),
        "power_t": ("uniform", 0.1, 0.9),
    },
    "Random Forest": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int_or_none", 5, 50, 10),
        "min_samples_split": ("int", 2, 20),
        "min_samples_leaf": ("int", 1, 10),
        "max_features": ("choice", "sqrt", "log2", None),
        "bootstrap": ("choice", True, False),
        "class_weight": ("choice", "balanced", "balanced_subsample", None),
        "criterion": ("choice", "gini", "entropy"),
        "max_samples": ("uniform", 0.5, 0.5),
    },
    "K-Nearest Neighbors": {
        "n_neighbors": ("int", 3, 20),
        "weights": ("choice", "uniform", "distance"),
        "algorithm": ("choice", "auto", "ball_tree", "kd_tree", "brute"),
        "leaf_size": ("int", 20, 100),
        "p": ("choice", 1, 2),
        "metric": ("choice", "minkowski", "euclidean", "manhattan", "chebyshev"),
    },
    "XGBoost": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 1e-3, 1e-1),
        "subsample": ("uniform", 0.6, 0.4),
        "colsample_bytree": ("uniform", 0.6, 0.4),
        "min_child_weight": ("int", 1, 7),
        "gamma": ("uniform", 0, 5),
        "reg_alpha": ("log", 1e-5, 1),
        "reg_lambda": ("log", 1e-5, 1),
        "scale_pos_weight": ("choice", 1, 5, 10),
        "max_delta_step": ("int", 0, 10),
    },
    "LightGBM": {
        "n_estimators": ("int", 100, 500),
        "learning_rate": ("log", 1e-3, 1e-1),
        "num_leaves": ("int", 20, 100),
        "max_depth": ("int", 3, 10),
        "min_child_samples": ("int", 10, 50),
        "subsample": ("uniform", 0.6, 0.4),
        "colsample_bytree": ("uniform", 0.6, 0.4),
        "reg_alpha": ("log", 1e-5, 1),
        "reg_lambda": ("log", 1e-5, 1),
        "min_split_gain": ("uniform", 0, 1),
        "class_weight": ("choice", "balanced", None),
        "boosting_type": ("choice", "gbdt", "dart"),
    },
    "Gradient Boosting": {
        "n_estimators": ("int", 100, 500),
        "learning_rate": ("log", 1e-3, 1e-1),
        "max_depth": ("int", 3, 10),
        "min_samples_split": ("int", 2, 20),
        "min_samples_leaf": ("int", 1, 10),
        "subsample": ("uniform", 0.6, 0.4),
        "max_features": ("choice", "sqrt", "log2", None),
        "criterion": ("choice", "friedman_mse", "squared_error"),
        "validation_fraction": ("uniform", 0.1, 0.2),
        "n_iter_no_change": ("int", 5, 20),
        "tol": ("log", 1e-5, 1e-3),
    },
    "AdaBoost": {
        "n_estimators": ("int", 50, 300),
        "learning_rate": ("uniform", 0.01, 1.99),
        "algorithm": ("choice", "SAMME", "SAMME.R"),
        "base_depth": ("choice", 1, 2, 3),
    },
    "Linear SVC": {
        "C": ("log", 1e-4, 1e4),
        "loss": ("choice", "hinge", "squared_hinge"),
        "penalty": ("choice", "l1", "l2"),
        "dual": ("choice", False),
        "tol": ("log", 1e-5, 1e-3),
        "class_weight": ("choice", "balanced", None),
        "intercept_scaling": ("uniform", 0.1, 10),
        "max_iter": ("choice", 2000),
    },
    "Decision Tree": {
        "max_depth": ("int_or_none", 5, 50, 10),
        "min_samples_split": ("int", 2, 20),
        "min_samples_leaf": ("int", 1, 10),
        "max_features": ("choice", "sqrt", "log2", None),
        "class_weight": ("choice", "balanced", None),
        "criterion": ("choice", "gini", "entropy"),
    },
}

# Spark trees cannot be deeper; "no limit" is read as this depth.
DEEPEST = 30


def _draw(rng: np.random.Generator, rule: tuple):
    kind, *args = rule
    if kind == "uniform":
        return float(args[0] + rng.random() * args[1])
    if kind == "log":
        return float(np.exp(rng.uniform(np.log(args[0]), np.log(args[1]))))
    if kind == "int":
        return int(rng.integers(args[0], args[1]))
    if kind == "int_or_none":
        return None if rng.integers(args[2] + 1) == 0 else int(rng.integers(args[0], args[1]))
    return args[int(rng.integers(len(args)))]


def sample_space(name: str, count: int, seed: int = 42, space: dict[str, tuple] | None = None) -> list[dict]:
    """``count`` seeded draws from a model's space."""
    rng = np.random.default_rng(seed)
    rules = space or SPACES[name]
    return [{p: _draw(rng, rule) for p, rule in rules.items()} for _ in range(count)]
