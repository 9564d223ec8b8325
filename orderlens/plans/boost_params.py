"""Settings of the classifiers (M1, M4)."""

from __future__ import annotations

from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class BoostParams:
    """Boosting settings (M1/M4).  Reference values: 3000 rounds, rate 0.05,
    depth 6, min child weight 3, row sample 0.8, column sample 0.8, seed 42,
    early stop after 50 rounds without gain.  ``min_instances_per_node`` counts
    rows, not Hessian weight.  ``max_bins`` is a least value: it follows the
    largest number of levels of a categorical feature."""

    max_iter: int = 3000
    step_size: float = 0.05
    max_depth: int = 6
    min_instances_per_node: int = 3
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    seed: int = 42
    patience: int = 50
    max_bins: int = 32
    classifier: str = "gbt"  # or "rf"
    num_trees: int = 100  # random forest only

    def record(self) -> dict:
        """Hyper-parameter record (M4)."""
        return asdict(self)
