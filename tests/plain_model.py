"""The model as one plain function of a flat parameter vector, for tests.

The loss takes a batch of complex vectors, so its gradient comes from complex
steps (the imaginary part of the loss at ``theta + i h e_k``), without any
back-propagation.  Local training is a fold over chunk bounds given in closed form.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np

H_STEP = 1e-30


class Size(NamedTuple):
    layers: int
    hidden: int
    vocab: int


def blocks(theta: np.ndarray, size: Size) -> list[tuple]:
    """(Win, Wh, Wout, bh, bout) of every layer, each with the batch axis first."""
    h, v = size.hidden, size.vocab
    shapes = [(h, v), (h, h), (v, h), (h,), (v,)] * size.layers
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    parts = [p.reshape(len(theta), *s) for p, s in zip(np.split(theta, ends[:-1], axis=1), shapes)]
    return [tuple(parts[5 * i:5 * i + 5]) for i in range(size.layers)]


def loss(theta: np.ndarray, size: Size, ids, start=None):
    """Summed -ln p of ``ids[1:]`` and the final states, for every vector of the batch."""
    model = blocks(np.atleast_2d(theta), size)
    states = [np.zeros((1, size.hidden)) if start is None else start[i][None] for i in range(size.layers)]
    total = 0
    for x, y in zip(ids, ids[1:]):
        signal = None
        for i, (w_in, w_rec, w_out, b_rec, b_out) in enumerate(model):
            drive = w_in[:, :, x] if signal is None else (w_in @ signal[:, :, None])[:, :, 0]
            states[i] = np.tanh(drive + (w_rec @ states[i][:, :, None])[:, :, 0] + b_rec)
            signal = (w_out @ states[i][:, :, None])[:, :, 0] + b_out
        top = signal.real.max(axis=1, keepdims=True)
        total = total + np.log(np.exp(signal - top).sum(axis=1)) + top[:, 0] - signal[:, y]
    return total, np.stack([np.broadcast_to(s, (len(model[0][0]), size.hidden)) for s in states])


def clipped_gradient(theta: np.ndarray, size: Size, ids, start=None, limit: float = np.inf):
    """Loss, clipped gradient and final states of one window."""
    stepped = theta[None] + 1j * H_STEP * np.eye(len(theta))
    slope = loss(stepped, size, ids, start)[0].imag / H_STEP
    value, states = loss(theta, size, ids, start)
    return float(np.real(value)[0]), np.clip(slope, -limit, limit), states[:, 0]


def chunk_bounds(n: int, length: int, mode: str) -> list[tuple[int, int]]:
    count = (n - 1) // length if mode == "tumbling" else -(-(n - 1) // length) - 1
    return [(k * length, (k + 1) * length + 1) for k in range(max(0, count))]


def adagrad(theta, acc, slope, rate):
    acc = acc + slope ** 2
    return theta - rate * slope / np.sqrt(acc + 1e-8), acc


def train_locally(theta, acc, size: Size, ids, length, rate, limit, passes=1, mode="paragraph"):
    """Loss of the first pass, weights and accumulators after all passes."""
    def follow(state, bounds):
        first, theta, acc, states = state
        value, slope, states = clipped_gradient(theta, size, ids[slice(*bounds)], states, limit)
        return (first + value, *adagrad(theta, acc, slope, rate), states)

    losses = []
    for _ in range(passes):
        value, theta, acc, _ = reduce(follow, chunk_bounds(len(ids), length, mode), (0.0, theta, acc, None))
        losses.append(value)
    return losses[0], theta, acc
