"""Hyper-parameters of the recurrent model and its training jobs."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class RnnConfig:
    """Model and training settings.

    Defaults follow the full-batch program of the original project: one layer,
    25 hidden units, windows of 25 predicted characters, AdaGrad with
    learning rate 0.1 and element-wise gradient clipping at 5.
    """

    num_layers: int = 1
    hidden: int = 25
    seq_len: int = 25
    learn_rate: float = 0.1
    clip: float = 5.0
    # local passes over each paragraph in parameter averaging
    iters: int = 1
    epochs: int = 1
    seed: int = 7
    # "gaussian" (N(0,1)*0.01, seeded), "zero" or "sine" (closed form, SQL-checkable)
    init: str = "gaussian"
    # use the recurrent gradient exactly as the original program did (Wh, not Wh^T)
    compat_untransposed: bool = False
    # memory one task may use for the model, its gradient and accumulators (bytes)
    model_bytes: int = 1 << 30

    def with_(self, **kw) -> "RnnConfig":
        return replace(self, **kw)
