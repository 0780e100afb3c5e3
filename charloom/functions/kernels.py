"""NumPy kernels of the stacked recurrent model, run inside Spark tasks.

These functions see Arrow batches turned into arrays.

Model (per layer l; ``x`` is the one-hot input for layer 0 and the previous
layer's raw logits above it):

    h_t = tanh(Win x_t + Wh h_{t-1} + bh)        y_t = Wout h_t + bout

Only the top layer's logits go through softmax; the loss of a window is the
summed negative log-likelihood of its targets (natural log).

Parameter arrays carry a leading layer axis: Win (NL,H,V), Wh (NL,H,H),
Wout (NL,V,H), bh (NL,H), bout (NL,V).  The flat layout (used for the
``model``/``grads`` tables) is layer-major, then block in ``BLOCKS`` order, then
row-major inside the block.
"""

from __future__ import annotations

import numpy as np

from charloom.functions.exprs import HASH_BITS, HASH_MULTIPLIERS, HASH_SHIFTS, HASH_STARTS, WORD

BLOCKS = ("Win", "Wh", "Wout", "bh", "bout")
EPS = 1e-8
_BLAS_PINNED = False


def single_thread_blas() -> None:
    """Spark already runs one Python worker per core; a multi-threaded BLAS in
    each of them oversubscribes the machine.  Pin the loaded OpenBLAS to one
    thread, once per process (no-op when it cannot be found)."""
    global _BLAS_PINNED
    if _BLAS_PINNED:
        return
    _BLAS_PINNED = True
    try:
        import ctypes
        with open("/proc/self/maps") as maps:
            libs = {line.split()[-1] for line in maps if "openblas" in line.lower() and ".so" in line}
        for path in libs:
            lib = ctypes.CDLL(path)
            for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads",
                         "openblas_set_num_threads64_", "openblas_set_num_threads"):
                if hasattr(lib, name):
                    getattr(lib, name)(1)
                    break
    except OSError:
        pass


# ---------------------------------------------------------------- layout
def block_shapes(hidden: int, vocab: int) -> dict:
    return {"Win": (hidden, vocab), "Wh": (hidden, hidden), "Wout": (vocab, hidden),
            "bh": (hidden,), "bout": (vocab,)}


def n_params(layers: int, hidden: int, vocab: int) -> int:
    return layers * sum(int(np.prod(s)) for s in block_shapes(hidden, vocab).values())


def zeros(layers: int, hidden: int, vocab: int) -> dict:
    return {b: np.zeros((layers,) + s) for b, s in block_shapes(hidden, vocab).items()}


def dims(params: dict) -> tuple:
    layers, hidden, vocab = params["Win"].shape
    return layers, hidden, vocab


def flatten(params: dict) -> np.ndarray:
    layers = dims(params)[0]
    return np.concatenate([params[b][l].ravel() for l in range(layers) for b in BLOCKS])


def unflatten(vec: np.ndarray, layers: int, hidden: int, vocab: int) -> dict:
    out = zeros(layers, hidden, vocab)
    pos = 0
    for l in range(layers):
        for b in BLOCKS:
            size = out[b][l].size
            out[b][l] = vec[pos:pos + size].reshape(out[b][l].shape)
            pos += size
    return out


def index_table(layers: int, hidden: int, vocab: int) -> np.ndarray:
    """Rows (k, layer, block_no, i, j) for every flat parameter index k."""
    rows, k = [], 0
    for l in range(layers):
        for bno, b in enumerate(BLOCKS):
            shape = block_shapes(hidden, vocab)[b]
            ii, jj = (np.indices(shape).reshape(len(shape), -1) if len(shape) == 2
                      else (np.arange(shape[0]), np.zeros(shape[0], dtype=int)))
            size = len(ii)
            rows.append(np.stack([np.arange(k, k + size), np.full(size, l), np.full(size, bno), ii, jj], 1))
            k += size
    return np.concatenate(rows).astype(np.int64)


def init_params(layers: int, hidden: int, vocab: int, kind: str = "gaussian", seed: int = 7) -> dict:
    """gaussian: N(0,1)*0.01 weights and zero biases (seeded);  zero: all zeros;
    sine: 0.1*sin(5*layer + block_no + 0.7*i + 1.3*j) for every entry (closed
    form that SQL can rebuild); sine_static: sine with the recurrent block Wh
    zeroed, so each step depends only on its own input character."""
    p = zeros(layers, hidden, vocab)
    if kind == "zero":
        return p
    if kind == "gaussian":
        rng = np.random.default_rng(seed)
        for b in ("Win", "Wh", "Wout"):
            p[b] = rng.standard_normal(p[b].shape) * 0.01
        return p
    if kind in ("sine", "sine_static"):
        for l in range(layers):
            for bno, b in enumerate(BLOCKS):
                shape = p[b][l].shape
                if len(shape) == 2:
                    i, j = np.indices(shape)
                else:
                    i, j = np.arange(shape[0]), np.zeros(shape[0])
                p[b][l] = 0.1 * np.sin(5 * l + bno + 0.7 * i + 1.3 * j)
        if kind == "sine_static":
            p["Wh"][:] = 0.0
        return p
    raise ValueError(f"unknown init {kind!r}")


# ---------------------------------------------------------------- small maths
def log_softmax(y: np.ndarray) -> np.ndarray:
    """Max-shifted, so logits beyond exp's range (y > 709) stay finite."""
    z = y - y.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def softmax(y: np.ndarray) -> np.ndarray:
    z = np.exp(y - y.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def clip(g, lim: float):
    """Element-wise clip to [-lim, lim]; NaN passes through unchanged."""
    return np.clip(g, -lim, lim)


def adagrad(params: dict, accs: dict, grads: dict, lr: float) -> None:
    """In place: acc += g^2 first, then w -= lr * g / sqrt(acc + 1e-8)."""
    for b in BLOCKS:
        accs[b] += grads[b] * grads[b]
        params[b] -= lr * grads[b] / np.sqrt(accs[b] + EPS)


# ---------------------------------------------------------------- shared-weight batches
def _mm(a: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(n,T,K) @ (K,M) as one 2-D product (a 3-D @ would loop over n)."""
    return (a.reshape(-1, a.shape[-1]) @ w).reshape(a.shape[:-1] + (w.shape[-1],))


def forward(params: dict, x: np.ndarray, h0: np.ndarray | None = None):
    """Teacher-forced forward pass of n windows of T inputs (ids ``x`` (n,T)).

    Returns hidden states (NL,n,T,H) and raw logits (NL,n,T,V) of every layer.
    The input products are done for all steps at once; only the recurrence
    loops over time.
    """
    layers, hidden, vocab = dims(params)
    n, steps = x.shape
    hs = np.empty((layers, n, steps, hidden))
    ys = np.empty((layers, n, steps, vocab))
    for l in range(layers):
        pre = params["Win"][0].T[x] if l == 0 else _mm(ys[l - 1], params["Win"][l].T)
        pre += params["bh"][l]
        h = np.zeros((n, hidden)) if h0 is None else h0[l]
        wht = params["Wh"][l].T
        for t in range(steps):
            h = np.tanh(pre[:, t] + h @ wht)
            hs[l, :, t] = h
        np.matmul(hs[l].reshape(-1, hidden), params["Wout"][l].T, out=ys[l].reshape(-1, vocab))
        ys[l] += params["bout"][l]
    return hs, ys


def probs_and_losses(ys_top: np.ndarray, targets: np.ndarray, overwrite: bool = False):
    """Softmax probabilities (n,T,V) and summed cross-entropy per window (n,)
    from one exponential pass over max-shifted logits.  With ``overwrite`` the
    logits array is reused for the probabilities."""
    z = np.subtract(ys_top, ys_top.max(axis=-1, keepdims=True), out=ys_top if overwrite else None)
    n, steps = targets.shape
    zt = z[np.arange(n)[:, None], np.arange(steps)[None, :], targets]
    e = np.exp(z, out=z)
    s = e.sum(axis=-1, keepdims=True)
    losses = (np.log(s[..., 0]) - zt).sum(axis=1)
    e /= s
    return e, losses


def window_losses(ys_top: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Summed cross-entropy of each window (n,) from top-layer logits (n,T,V)."""
    lp = log_softmax(ys_top)
    n, steps = targets.shape
    return -lp[np.arange(n)[:, None], np.arange(steps)[None, :], targets].sum(axis=1)


#: logits up to this size need no shift by their maximum before they are exponentiated
PLAIN_LOGITS = 500.0
#: rows whose logits are held at once, so that they stay in the processor's cache
LOGIT_ROWS = 128
#: the same for gradients, which need the windows of whole rows
TOP_ROWS = 750


def top_states(params: dict, x: np.ndarray, h0: np.ndarray | None = None, states: list | None = None) -> np.ndarray:
    """Hidden states (T,n,H) of the top layer over inputs ``x`` (T,n).  A layer's logits
    go into the next layer's inputs only, so the two products are one matrix of H x H.
    ``states`` takes every layer's (T,n,H)."""
    layers, hidden, _ = dims(params)
    steps, n = x.shape
    hs = None
    for l in range(layers):
        if l == 0:
            pre = np.take(np.ascontiguousarray(params["Win"][0].T), x, axis=0)
        else:
            through = params["Win"][l] @ params["Wout"][l - 1]
            pre = _mm(hs, through.T)
            pre += params["Win"][l] @ params["bout"][l - 1]
        pre += params["bh"][l]
        hs = np.empty((steps, n, hidden))
        h = np.zeros((n, hidden)) if h0 is None else h0[l]
        wht = params["Wh"][l].T
        for t in range(steps):
            np.matmul(h, wht, out=hs[t])
            hs[t] += pre[t]
            h = np.tanh(hs[t], out=hs[t])
        if states is not None:
            states.append(hs)
    return hs


def step_losses(params: dict, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Cross-entropy (N,) of targets (N,) after top-layer states (N,H): logits are
    made for a few rows at a time, and shifted by their maximum where they may be large."""
    wout, bout = params["Wout"][-1], params["bout"][-1]
    wt = np.ascontiguousarray(wout.T)
    with np.errstate(over="ignore", invalid="ignore"):
        plain = np.abs(wout).sum(axis=1).max() < PLAIN_LOGITS and np.ptp(bout) < PLAIN_LOGITS
    out = np.empty(len(h))
    if plain:
        top = bout.max()
        scale = np.exp(bout - top)
    size = max(1, min(LOGIT_ROWS, 800_000 // len(bout)))
    z = np.empty((size, len(bout)))
    for r in range(0, len(h), size):
        k = min(size, len(h) - r)
        y, t = z[:k], targets[r:r + k]
        np.matmul(h[r:r + k], wt, out=y)
        if plain:
            own = y[np.arange(k), t] + bout[t] - top
            out[r:r + k] = np.log(np.exp(y, out=y) @ scale) - own
        else:
            y += bout
            out[r:r + k] = -log_softmax(y)[np.arange(k), t]
    return out


def window_nll(params: dict, x: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Summed cross-entropy (n,) of n windows (n,T), each from a zero state."""
    h = top_states(params, np.ascontiguousarray(x.T))
    return step_losses(params, h.reshape(-1, h.shape[-1]), targets.T.ravel()).reshape(h.shape[:2]).sum(axis=0)


def clipped_outer_sum(a: np.ndarray, b: np.ndarray, lim: float) -> np.ndarray:
    """sum_w clip(sum_t a[w,t,:] outer b[w,t,:]), without per-window matrices where
    these are larger than the windows' steps.

    |sum_t a_i b_j| <= (sum_t |a_i|) * max|b|: rows (w,i) under ``lim`` by that
    bound are never clipped, so one big product covers all windows; the few rows
    over the bound are left out of it, computed exactly per window and added
    clipped.
    """
    n, steps, na = a.shape
    nb = b.shape[2]
    with np.errstate(invalid="ignore", over="ignore"):
        if na * nb <= steps * (na + nb):
            own = np.matmul(np.swapaxes(a, 1, 2), b)
            return np.clip(own, -lim, lim, out=own).sum(axis=0)
        bmax = np.abs(b).max(axis=(1, 2)) if b.size else np.zeros(n)
        bound = np.abs(a).sum(axis=1) * bmax[:, None]
        over = ~(bound <= lim)  # and where the bound is not a number
        w, i = np.nonzero(over)
        if not len(w):
            return a.reshape(-1, na).T @ b.reshape(-1, nb)
        finite = np.isfinite(bmax)
        if finite.all() and np.isfinite(bound).all():
            # all rows at once, and what clipping takes from the few that it meets
            out = a.reshape(-1, na).T @ b.reshape(-1, nb)
            rows = np.einsum("mt,mtb->mb", a[w, :, i], b[w])
            met = np.abs(rows).max(axis=1) > lim
            np.add.at(out, i[met], clip(rows[met], lim) - rows[met])
            return out
        # rows over the bound take no part in the product; a window that holds no finite number would spoil it
        kept = np.where(over[:, None, :], 0.0, a)[finite]
        out = kept.reshape(-1, na).T @ b[finite].reshape(-1, nb)
        rows = np.einsum("mt,mtb->mb", a[w, :, i], b[w])
        np.add.at(out, i, clip(rows, lim))
        rest = ~over & ~finite[:, None]  # rows of zeros beside infinite numbers
        for v, j in zip(*np.nonzero(rest)):
            out[j] += clip(a[v, :, j] @ b[v], lim)
    return out


#: a window's sums are made for all characters where these are no more times its steps
DENSE_SUMS = 32


def _grouped_onehot_sum(a: np.ndarray, x: np.ndarray, vocab: int, lim: float) -> np.ndarray:
    """sum over windows of clipped per-(window, char) sums, as (A, V)."""
    n, steps, na = a.shape
    out = np.zeros((na, vocab))
    if vocab <= DENSE_SUMS * steps:
        size = max(1, 65_536 // vocab)
        for c in range(0, n, size):
            part = np.ascontiguousarray(a[c:c + size].reshape(-1, na).T)
            m = part.shape[1] // steps
            keys = (np.arange(m)[:, None] * vocab + x[c:c + m]).ravel()
            for j in range(na):
                sums = np.bincount(keys, weights=part[j], minlength=m * vocab).reshape(m, vocab)
                out[j] += np.clip(sums, -lim, lim, out=sums).sum(axis=0)
        return out
    keys = (np.arange(n)[:, None] * vocab + x).ravel()
    uniq, inv = np.unique(keys, return_inverse=True)
    cols, a2 = uniq % vocab, a.reshape(-1, na)
    for j in range(na):
        sums = np.bincount(inv, weights=a2[:, j], minlength=len(uniq))
        out[j] = np.bincount(cols, weights=clip(sums, lim), minlength=vocab)
    return out


def clipped_onehot_sum(a: np.ndarray, x: np.ndarray, vocab: int, lim: float) -> np.ndarray:
    """sum_w clip(sum_t a[w,t,:] outer onehot(x[w,t])) as an (A, V) matrix.

    Over a large vocabulary, a window whose sum_t |a| stays under ``lim`` in every row
    cannot clip, so such windows are added with one bincount per row; the others by
    their exact per-(window, char) clipped sums.
    """
    n, steps, na = a.shape
    if vocab <= DENSE_SUMS * steps:
        return _grouped_onehot_sum(a, x, vocab, lim)
    flag = np.abs(a).sum(axis=1).max(axis=1) > lim
    plain = ~flag
    if flag.all():
        return _grouped_onehot_sum(a, x, vocab, lim)
    a2, xs = (a, x) if not flag.any() else (a[plain], x[plain])
    a2 = a2.reshape(-1, na)
    xs = xs.ravel()
    out = np.empty((na, vocab))
    for j in range(na):
        out[j] = np.bincount(xs, weights=a2[:, j], minlength=vocab)
    if flag.any():
        out += _grouped_onehot_sum(a[flag], x[flag], vocab, lim)
    return out


def _top_layer_gradient(params: dict, hs: np.ndarray, targets: np.ndarray, lim: float):
    """Losses (n,), the top layer's clipped ``Wout`` and ``bout`` sums and what flows back
    into its states (n,T,H), with the logits of a few windows at a time.  Logits are
    exponentiated and not divided: the few numbers that a row gives are.  The bias is
    the weight of a state that is always one."""
    n, steps, hidden = hs.shape
    wout, bout = params["Wout"][-1], params["bout"][-1]
    vocab = len(bout)
    with np.errstate(over="ignore", invalid="ignore"):
        plain = np.abs(wout).sum(axis=1).max() + np.abs(bout).max() < PLAIN_LOGITS
    into = np.concatenate([wout.T, bout[None]])
    out_of = np.concatenate([wout, np.ones((vocab, 1))], axis=1)
    losses, back = np.empty(n), np.empty(hs.shape)
    g = np.zeros(into.shape)
    size = max(1, min(n, TOP_ROWS // steps, 800_000 // (vocab * max(steps, hidden + 1))))
    one, kept, sums = np.ones((size * steps, hidden + 1)), np.empty((size * steps, vocab)), np.empty((size, hidden + 1, vocab))
    for c in range(0, n, size):
        y = targets[c:c + size].ravel()
        m, at = len(y) // steps, np.arange(0, len(y) * vocab, vocab) + y
        h, e, own = one[:len(y)], kept[:len(y)], sums[:m]
        flat = e.reshape(-1)
        h[:, :hidden], h[:, hidden] = hs[c:c + m].reshape(-1, hidden), 1.0
        np.matmul(h, into, out=e)
        if not plain:
            e -= e.max(axis=-1, keepdims=True)
        logit = flat[at]
        np.exp(e, out=e)
        through = e @ out_of
        s = through[:, -1:]
        losses[c:c + m] = (np.log(s[:, 0]) - logit).reshape(m, steps).sum(axis=1)
        np.subtract(through[:, :-1] / s, np.take(wout, y, axis=0), out=back[c:c + m].reshape(-1, hidden))
        # every window's gradient: probabilities less one for the target, times the states
        flat[at] -= s[:, 0]
        h /= s
        np.matmul(h.reshape(m, steps, -1).transpose(0, 2, 1), e.reshape(m, steps, vocab), out=own)
        g += np.clip(own, -lim, lim, out=own).sum(axis=0)
    return losses, g[:-1].T, g[-1], back


def grad_sum(params: dict, x: np.ndarray, targets: np.ndarray, lim: float,
             h0: np.ndarray | None = None, compat_untransposed: bool = False):
    """Loss and back-propagation through time for n windows sharing one model.

    Each window's gradient is clipped element-wise before windows are summed
    (the per-window clip of the original full-batch step).  Returns
    (per-window losses (n,), summed clipped gradients as a params dict).
    """
    layers, hidden, vocab = dims(params)
    n, steps = x.shape
    if layers == 1:
        h = top_states(params, np.ascontiguousarray(x.T), h0)
        hs, ys = np.ascontiguousarray(h.transpose(1, 0, 2))[None], None
    else:
        hs, ys = forward(params, x, h0)
    g = zeros(layers, hidden, vocab)
    losses, g["Wout"][-1], g["bout"][-1], back = _top_layer_gradient(params, hs[-1], targets, lim)
    delta = None
    for l in range(layers - 1, -1, -1):
        if l < layers - 1:
            g["Wout"][l] = clipped_outer_sum(delta, hs[l], lim)
            g["bout"][l] = clip(delta.sum(axis=1), lim).sum(axis=0)
            back = _mm(delta, params["Wout"][l])
        rec = params["Wh"][l].T if compat_untransposed else params["Wh"][l]
        draw = _back_through_time(hs[l], back, rec)
        _state_gradients(params, g, l, draw, hs, ys, x, h0, lim)
        if l:
            delta = _mm(draw, params["Win"][l])
    return losses, g


def _back_through_time(hs: np.ndarray, back: np.ndarray, rec: np.ndarray) -> np.ndarray:
    n, steps, hidden = hs.shape
    slope = 1.0 - hs ** 2
    draw = np.empty((n, steps, hidden))
    nxt = np.zeros((n, hidden))
    for t in range(steps - 1, -1, -1):
        d = slope[:, t] * (back[:, t] + nxt)
        draw[:, t] = d
        nxt = d @ rec
    return draw


def _state_gradients(params, g, l, draw, hs, ys, x, h0, lim) -> None:
    """Clipped sums of the blocks before a layer's states, from the gradient ``draw`` (n,T,H) there."""
    n, steps, hidden = draw.shape
    prev = np.empty((n, steps, hidden + 1))  # and a state that is always one, whose weight is the bias
    prev[:, 0, :hidden] = 0.0 if h0 is None else h0[l]
    prev[:, 1:, :hidden], prev[:, :, hidden] = hs[l][:, :-1], 1.0
    own = clipped_outer_sum(draw, prev, lim)
    g["Wh"][l], g["bh"][l] = own[:, :-1], own[:, -1]
    g["Win"][l] = clipped_onehot_sum(draw, x, dims(params)[2], lim) if l == 0 else clipped_outer_sum(draw, ys[l - 1], lim)


#: windows whose states of all steps are held at once
STATE_WINDOWS = 512


def group_rows(vocab: int) -> int:
    """Windows for one call of :func:`grad_sums`: their counts of every character stay small."""
    return max(16, min(8192, 4_000_000 // max(1, vocab)))


def grad_sums(params: dict, x: np.ndarray, targets: np.ndarray, lim: float, compat_untransposed: bool = False):
    """:func:`grad_sum` over about :func:`group_rows` windows from zero states.  Where the
    windows go through few distinct states, what follows from a state (logits,
    probabilities, losses) is made once for each; else it is made for every
    window, a slice at a time."""
    layers, hidden, vocab = dims(params)
    losses, g = np.zeros(len(x)), zeros(layers, hidden, vocab)
    rest = np.arange(len(x))
    found = distinct_states(params, x) if layers == 1 else None
    if found is not None:
        rest = _shared_grad_sum(params, x, targets, lim, compat_untransposed, *found, losses, g)
    size = min(STATE_WINDOWS, batch_rows(1, hidden, x.shape[1])) if layers == 1 else batch_rows(vocab, hidden, x.shape[1])
    for c in range(0, len(rest), size):
        at = rest[c:c + size]
        losses[at], part = grad_sum(params, x[at], targets[at], lim, compat_untransposed=compat_untransposed)
        for b in BLOCKS:
            g[b] += part[b]
    return losses, g


def distinct_states(params: dict, x: np.ndarray):
    """The distinct states of a one-layer model that n windows (n,T) go through from a
    zero state: ``(number (n,T) of each window's state, states (M,H), first number of each
    step (T+1,))``; None where they are not few.  A state follows from the one before it
    and the input, and states that are equal to the last bit are one."""
    n, steps = x.shape
    _, hidden, vocab = dims(params)
    win, wht, bias = np.ascontiguousarray(params["Win"][0].T), params["Wh"][0].T, params["bh"][0]
    numbers = np.empty((n, steps), dtype=np.int64)
    own, h = np.zeros(n, dtype=np.int64), np.zeros((1, hidden))
    states, first = [], [0]
    for t in range(steps):
        key = own * vocab + x[:, t]
        seen = np.zeros(len(h) * vocab, dtype=bool)
        seen[key] = True
        keys = np.flatnonzero(seen)
        if len(keys) > n // 4:
            return None
        new = np.tanh(h[keys // vocab] @ wht + win[keys % vocab] + bias)
        if not np.isfinite(new).all():
            return None
        _, kept, same = np.unique(new.view(np.dtype((np.void, new.itemsize * hidden))).ravel(), return_index=True, return_inverse=True)
        place = np.zeros(len(seen), dtype=np.int64)
        place[keys] = same
        own, h = place[key], np.ascontiguousarray(new[kept])
        numbers[:, t] = own + first[-1]
        if len(h) > n // 8:
            return None
        states.append(h)
        first.append(first[-1] + len(h))
    return numbers, np.concatenate(states), np.array(first)


def _shared_grad_sum(params, x, targets, lim, compat_untransposed, numbers, states, first, losses, g) -> np.ndarray:
    """Puts the losses and adds the gradient sums of the windows whose ``Wout`` gradient
    certainly meets no clipping; returns the others."""
    n, steps = x.shape
    _, hidden, vocab = dims(params)
    logits = states @ params["Wout"][0].T + params["bout"][0]
    nll = -log_softmax(logits)
    p = np.exp(-nll)
    if not np.isfinite(nll).all():
        return np.arange(n)
    spans = list(zip(first[:-1], first[1:]))
    most = np.sum([p[a:b].max(axis=0) for a, b in spans], axis=0)   # no window's sum of probabilities is above,
    least = np.sum([p[a:b].min(axis=0) for a, b in spans], axis=0)  # or below
    flat = np.arange(n)[:, None] * vocab + targets
    counts = np.bincount(flat.ravel(), minlength=n * vocab).reshape(n, vocab)
    # |sum_t delta h| <= (sum of probabilities + count) * largest |h|
    sure = ((counts + most) * np.abs(states).max() <= lim).all(axis=1)
    mine = np.flatnonzero(sure)
    if not len(mine):
        return np.arange(n)
    k, y = (numbers, targets) if len(mine) == n else (numbers[mine], targets[mine])
    if len(mine) < n:
        counts = counts[mine]
    key = k * vocab + y
    losses[mine] = nll.ravel()[key].sum(axis=1)
    pairs = np.bincount(key.ravel(), minlength=p.size).reshape(p.shape)
    delta = pairs.sum(axis=1, keepdims=True) * p - pairs
    g["Wout"][0] += delta.T @ states
    g["bout"][0] += delta.sum(axis=0)
    # entries of bout that clipping may meet, window by window
    w, v = np.nonzero((counts > lim + least) | (most > lim))
    own = p[k[w], v[:, None]].sum(axis=1) - counts[w, v]
    np.add.at(g["bout"][0], v, clip(own, lim) - own)
    if not params["Wout"][0].any():
        return np.flatnonzero(~sure)  # nothing flows back
    xs = x[mine]
    back = (p @ params["Wout"][0])[k] - params["Wout"][0][y]
    hs = states[k]
    rec = params["Wh"][0].T if compat_untransposed else params["Wh"][0]
    part = zeros(1, hidden, vocab)
    _state_gradients(params, part, 0, _back_through_time(hs, back, rec), hs[None], None, xs, None, lim)
    for b in ("Win", "Wh", "bh"):
        g[b] += part[b]
    return np.flatnonzero(~sure)


def bias_only(params: dict) -> bool:
    """Whether every state is zero and nothing flows back from the logits: these are the
    last output bias at every step, and only that has a gradient."""
    return all(np.isfinite(params[b]).all() for b in BLOCKS) and not any(params[b].any() for b in ("Win", "bh", "Wout"))


#: characters whose windows are counted at once
COUNT_CHARS = 1 << 17


def bias_grad_sum(params: dict, ids: np.ndarray, lens: np.ndarray, n_own: np.ndarray, seq_len: int, lim: float):
    """:func:`grad_sum` of a model that is :func:`bias_only`, over every window that starts
    among the first ``n_own`` ids of each row (see :func:`window_starts`): (loss, sum (V,)
    of the clipped ``bout`` gradients, number of windows).

    A window's gradient for a character is its expected less its found number of times
    among the targets.  Windows that start side by side share all targets but two, so
    none is built: the sums follow from how many windows each target is in, and what
    clipping takes from how many windows hold a character k times or more."""
    nll = -log_softmax(params["bout"][-1])
    expected = seq_len * np.exp(-nll)
    lens = np.asarray(lens, dtype=np.int64)
    windows = np.clip(np.minimum(np.asarray(n_own, dtype=np.int64), lens - seq_len), 0, None)
    # clipping meets numbers from `least` on; where it also meets low ones, all count
    frequent = np.flatnonzero(expected > lim)
    least = int(min(seq_len, np.floor(expected.min() + lim))) + 1
    found, often = np.zeros(len(nll)), np.zeros((seq_len + 2, len(nll)))
    ends = np.cumsum(lens)
    cuts = [0, *(np.flatnonzero(np.diff(ends // COUNT_CHARS)) + 1).tolist(), len(lens)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            _count_targets(ids[ends[a] - lens[a]:ends[b - 1]], lens[a:b], windows[a:b], seq_len, least, frequent, found, often)
    n = int(windows.sum())
    grad = n * expected - found
    times = expected - np.arange(1, seq_len + 1)[:, None]
    grad += ((often[1:-1] - often[2:]) * (clip(times, lim) - times)).sum(axis=0)
    grad += (n - often[1]) * (clip(expected, lim) - expected)
    return float(found @ nll), grad, n


def _count_targets(ids, lens, windows, seq_len, least, frequent, found, often) -> None:
    """Adds to ``found`` (V,) how many windows of the rows each target is in, and to
    ``often[k]`` how many hold a character k times or more among their targets, for k
    from ``least`` on, or from 1 for the characters ``frequent``.

    Such a window counts at its first target of the kind, place ``p``: it starts before
    ``p``, not before the last place of the kind ahead of it, and reaches the k-th."""
    vocab, rows = len(found), np.arange(len(lens))
    begin = np.cumsum(lens) - lens + rows * seq_len  # rows are apart, so no window's reach spans two
    row = np.repeat(rows, lens)
    place = np.arange(len(ids)) + row * seq_len
    start, stop = begin[row], (begin + windows)[row]
    starts = np.minimum(stop, place) - np.maximum(start, place - seq_len)
    found += np.bincount(ids, weights=np.maximum(starts, 0), minlength=vocab)
    small = np.uint8 if vocab <= 1 << 8 else np.uint16 if vocab <= 1 << 16 else np.int32  # small numbers sort by radix
    order = np.argsort(ids.astype(small), kind="stable")
    at, ch = place[order], ids[order]
    first = np.searchsorted(ch, np.arange(vocab + 1))
    for k in range(1 if len(frequent) else least, seq_len + 1):
        if k == least:
            j = np.flatnonzero(at[k - 1:] - at[:max(0, len(at) - k + 1)] < seq_len)
        elif k == 1:
            j = np.concatenate([np.arange(first[v], first[v + 1]) for v in frequent])
        else:
            j = j[j + k - 1 < len(at)]
            j = j[at[j + k - 1] - at[j] < seq_len]
        j = j[ch[j + k - 1] == ch[j]]
        before = np.where(j > first[ch[j]], at[j - 1], -1)
        p = order[j]
        starts = np.minimum(stop[p], at[j]) - np.maximum(np.maximum(start[p], at[j + k - 1] - seq_len), before)
        often[k] += np.bincount(ch[j], weights=np.maximum(starts, 0), minlength=vocab)


def batch_rows(vocab: int, hidden: int, steps: int, budget: int = 800_000) -> int:
    """Windows per kernel call so the (n,T,max(V,H)) arrays stay near ``budget`` doubles."""
    return max(16, budget // max(1, steps * max(vocab, hidden)))


def window_starts(lens: np.ndarray, n_own: np.ndarray, seq_len: int, stride: int = 1,
                  origin: np.ndarray | None = None):
    """All whole windows of ``seq_len + 1`` ids that start among the first
    ``n_own`` ids of each row (row texts hold their own ids and a halo), with
    ``(origin + start) % stride == 0``.  Returns (row index, start in row)."""
    lens = np.asarray(lens, dtype=np.int64)
    m = np.clip(np.minimum(np.asarray(n_own, dtype=np.int64), lens - seq_len), 0, None)
    first = np.zeros_like(m) if origin is None or stride == 1 else (-np.asarray(origin, dtype=np.int64)) % stride
    counts = np.where(m > first, (m - first + stride - 1) // stride, 0)
    rows = np.repeat(np.arange(len(m)), counts)
    k = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return rows, first[rows] + k * stride


def gather_windows(ids: np.ndarray, lens: np.ndarray, rows: np.ndarray, starts: np.ndarray,
                   seq_len: int) -> np.ndarray:
    """(n, seq_len + 1) windows cut from the concatenated row ids."""
    base = np.cumsum(lens) - lens
    return ids[(base[rows] + starts)[:, None] + np.arange(seq_len + 1)]


# ---------------------------------------------------------------- per-sequence weights
def _bmm_t(a, w):
    """Batched a (n,T,K) times w^T where w is (n,M,K) -> (n,T,M)."""
    return np.matmul(a, np.swapaxes(w, 1, 2))


def sequence_step(params: dict, x: np.ndarray, targets: np.ndarray, h0: np.ndarray, lim: float,
                  compat_untransposed: bool = False):
    """One window per sequence, each sequence with its own weights.

    ``params`` arrays carry a leading sequence axis: Win (n,NL,H,V), ...;
    ``h0`` is (n,NL,H).  Returns (losses (n,), clipped gradients with the same
    leading axis, last hidden states (n,NL,H)).
    """
    n, layers, hidden, vocab = params["Win"].shape
    steps = x.shape[1]
    hs = np.empty((layers, n, steps, hidden))
    ys = np.empty((layers, n, steps, vocab))
    ar = np.arange(n)
    for l in range(layers):
        win = params["Win"][:, l]
        if l == 0:
            pre = np.take_along_axis(win, x[:, None, :], axis=2).transpose(0, 2, 1).copy()
        else:
            pre = _bmm_t(ys[l - 1], win)
        pre += params["bh"][:, l][:, None, :]
        h = h0[:, l]
        wh = params["Wh"][:, l]
        for t in range(steps):
            h = np.tanh(pre[:, t] + np.einsum("nij,nj->ni", wh, h))
            hs[l, :, t] = h
        ys[l] = _bmm_t(hs[l], params["Wout"][:, l]) + params["bout"][:, l][:, None, :]
    losses = window_losses(ys[-1], targets)
    delta = softmax(ys[-1])
    delta[ar[:, None], np.arange(steps)[None, :], targets] -= 1.0
    g = {b: np.zeros_like(params[b]) for b in BLOCKS}
    for l in range(layers - 1, -1, -1):
        g["Wout"][:, l] = np.matmul(np.swapaxes(delta, 1, 2), hs[l])
        g["bout"][:, l] = delta.sum(axis=1)
        dh_out = np.matmul(delta, params["Wout"][:, l])
        wh = params["Wh"][:, l]
        draw = np.empty((n, steps, hidden))
        nxt = np.zeros((n, hidden))
        for t in range(steps - 1, -1, -1):
            d = (1.0 - hs[l, :, t] ** 2) * (dh_out[:, t] + nxt)
            draw[:, t] = d
            nxt = np.einsum("nij,ni->nj", wh, d) if not compat_untransposed else np.einsum("nij,nj->ni", wh, d)
        g["bh"][:, l] = draw.sum(axis=1)
        prev = np.concatenate([h0[:, l][:, None], hs[l][:, :-1]], axis=1)
        g["Wh"][:, l] = np.matmul(np.swapaxes(draw, 1, 2), prev)
        if l == 0:
            columns = np.zeros((n, vocab, hidden))  # a step's gradient goes to its input's column
            np.add.at(columns, (ar[:, None], x), draw)
            g["Win"][:, 0] = np.swapaxes(columns, 1, 2)
        else:
            g["Win"][:, l] = np.matmul(np.swapaxes(draw, 1, 2), ys[l - 1])
            delta = np.matmul(draw, params["Win"][:, l])
    for b in BLOCKS:
        g[b] = clip(g[b], lim)
    return losses, g, np.stack([hs[l][:, -1] for l in range(layers)], axis=1)


def chunk_count(n: np.ndarray, seq_len: int, mode: str) -> np.ndarray:
    """Windows a sequential pass takes over a sequence of n ids.

    paragraph: the per-paragraph loop (stride seq_len, strict end test, so
    max(0, ceil((n-1)/L) - 1)); tumbling: every whole window, floor((n-1)/L).
    """
    n = np.asarray(n, dtype=np.int64)
    if mode == "paragraph":
        return np.maximum(0, -(-(n - 1) // seq_len) - 1)
    if mode == "tumbling":
        return np.maximum(0, (n - 1) // seq_len)
    raise ValueError(mode)


def _apply(w: np.ndarray, a: np.ndarray, g: np.ndarray, cfg) -> None:
    """Clipped AdaGrad in place; ``g`` is used up."""
    np.clip(g, -cfg.clip, cfg.clip, out=g)
    t = g * g
    a += t
    np.add(a, EPS, out=t)
    np.sqrt(t, out=t)
    g *= cfg.learn_rate
    g /= t
    w -= g


def _bias_step(w: dict, a: dict, targets: np.ndarray, cfg) -> np.ndarray:
    """A step whose states and output weights are all zero: every logit is its bias, made
    once for a window, and the other blocks' gradients are zero, which leaves them as they are."""
    n, steps = targets.shape
    vocab = w["bout"].shape[1]
    lp = log_softmax(w["bout"])
    flat = np.arange(n)[:, None] * vocab + targets
    losses = -lp.ravel()[flat].sum(axis=1)
    counts = np.bincount(flat.ravel(), minlength=n * vocab).reshape(n, vocab)
    _apply(w["bout"], a["bout"], steps * np.exp(lp) - counts, cfg)
    return losses


def _one_layer_step(w: dict, a: dict, x: np.ndarray, targets: np.ndarray, h0: np.ndarray, cfg):
    """:func:`sequence_step` and its AdaGrad update for one-layer models, in place.  ``Win`` is
    held as (n,V,H), so an input's weights are one row: only rows that a window reads have a
    gradient there and are updated."""
    n, steps = x.shape
    vocab, hidden = w["Wout"].shape[1:]
    seq, step = np.arange(n)[:, None], np.arange(steps)[None, :]
    win, acc_in = w["Win"].reshape(-1, hidden), a["Win"].reshape(-1, hidden)
    rows = x + seq * vocab
    pre = win[rows]
    pre += w["bh"][:, None, :]
    if not (pre.any() or h0.any() or w["Wout"].any()) and np.isfinite(w["Wh"]).all():
        return _bias_step(w, a, targets, cfg), h0
    hs = np.empty((n, steps + 1, hidden))
    hs[:, 0] = h0
    for t in range(steps):
        np.tanh(pre[:, t] + np.matmul(w["Wh"], hs[:, t, :, None])[:, :, 0], out=hs[:, t + 1])
    own = hs[:, 1:]
    delta = np.matmul(own, np.swapaxes(w["Wout"], 1, 2))
    delta += w["bout"][:, None, :]
    delta -= delta.max(axis=-1, keepdims=True)
    losses = -delta[seq, step, targets].sum(axis=1)
    np.exp(delta, out=delta)
    s = delta.sum(axis=-1)
    losses += np.log(s).sum(axis=1)
    delta /= s[:, :, None]
    delta[seq, step, targets] -= 1.0
    back = np.matmul(delta, w["Wout"])
    _apply(w["Wout"], a["Wout"], np.matmul(np.swapaxes(delta, 1, 2), own), cfg)
    _apply(w["bout"], a["bout"], delta.sum(axis=1), cfg)
    rec = w["Wh"] if cfg.compat_untransposed else np.swapaxes(w["Wh"], 1, 2)
    slope = 1.0 - own ** 2
    draw = np.empty((n, steps, hidden))
    nxt = np.zeros((n, hidden))
    for t in range(steps - 1, -1, -1):
        d = slope[:, t] * (back[:, t] + nxt)
        draw[:, t] = d
        nxt = np.matmul(rec, d[:, :, None])[:, :, 0]
    g_rec = np.matmul(np.swapaxes(draw, 1, 2), hs[:, :-1])
    order = np.argsort(rows, axis=None, kind="stable")  # a step's gradient goes to its input's row
    flat = rows.ravel()[order]
    begin = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    g_in, read = np.add.reduceat(draw.reshape(-1, hidden)[order], begin, axis=0), flat[begin]
    w_read, a_read = win[read], acc_in[read]
    _apply(w_read, a_read, g_in, cfg)
    win[read], acc_in[read] = w_read, a_read
    _apply(w["Wh"], a["Wh"], g_rec, cfg)
    _apply(w["bh"], a["bh"], draw.sum(axis=1), cfg)
    return losses, own[:, -1]


def _train_batch(params: dict, accs: dict, seqs: list, counts: np.ndarray, cfg):
    """Sequences (longest first) in lock-step from the same weights: loss of the first
    pass, weights and accumulators with a leading sequence axis, last states (n,NL,H)."""
    layers, hidden, _ = dims(params)
    L, m, total = cfg.seq_len, len(seqs), 0.0
    plain = layers == 1

    def copies(blocks):
        if not plain:
            return {b: np.repeat(blocks[b][None], m, axis=0) for b in BLOCKS}
        one = {b: blocks[b][0].T if b == "Win" else blocks[b][0] for b in BLOCKS}
        return {b: np.repeat(one[b][None], m, axis=0) for b in BLOCKS}

    w, a = copies(params), copies(accs)
    for it in range(cfg.iters):
        h = np.zeros((m, layers, hidden))
        for k in range(int(counts[0])):
            act = int((counts > k).sum())  # sorted by count: active ones are a prefix
            win = np.stack([s[k * L: k * L + L + 1] for s in seqs[:act]])
            sub, acc = {b: w[b][:act] for b in BLOCKS}, {b: a[b][:act] for b in BLOCKS}
            if plain:
                losses, h[:act, 0] = _one_layer_step(sub, acc, win[:, :-1], win[:, 1:], h[:act, 0], cfg)
            else:
                losses, g, h[:act] = sequence_step(sub, win[:, :-1], win[:, 1:], h[:act], cfg.clip, cfg.compat_untransposed)
                for b in BLOCKS:
                    acc[b] += g[b] * g[b]
                    sub[b] -= cfg.learn_rate * g[b] / np.sqrt(acc[b] + EPS)
            if it == 0:
                total += float(losses.sum())
    if plain:
        w, a = ({b: (np.swapaxes(x[b], 1, 2) if b == "Win" else x[b])[:, None] for b in BLOCKS} for x in (w, a))
    return total, w, a, h


def train_sequences(params: dict, accs: dict, seqs: list, cfg, mode: str = "paragraph",
                    budget: int = 4_000_000, states: np.ndarray | None = None):
    """Local training of every sequence from the same starting weights and
    AdaGrad accumulators: ``cfg.iters`` passes of sequential windows, hidden state
    carried from window to window and reset at each pass, AdaGrad after every
    window.  Sequences advance in lock-step batches, each with its own copy of the
    weights; a batch holds about ``budget`` doubles.

    Returns (loss of the first pass, sum of final weights, sum of final
    accumulators, total ids, number of sequences).  ``states`` (n,NL,H), where
    given, takes the hidden states after each sequence's last window.
    """
    layers, hidden, vocab = dims(params)
    L = cfg.seq_len
    batch = max(1, min(64, budget // (4 * n_params(layers, hidden, vocab) + 2 * layers * L * (vocab + hidden))))
    counts = chunk_count([len(s) for s in seqs], L, mode)
    w_sum = {b: np.zeros_like(params[b]) for b in BLOCKS}
    a_sum = {b: np.zeros_like(params[b]) for b in BLOCKS}
    total_loss = 0.0
    idle = counts == 0
    for b in BLOCKS:  # sequences without a window keep the starting weights
        w_sum[b] += params[b] * idle.sum()
        a_sum[b] += accs[b] * idle.sum()
    busy = [i for i in np.argsort(-counts, kind="stable") if counts[i] > 0]
    for s0 in range(0, len(busy), batch):
        idx = busy[s0:s0 + batch]
        loss, w, a, h = _train_batch(params, accs, [seqs[i] for i in idx], counts[idx], cfg)
        total_loss += loss
        if states is not None:
            states[idx] = h
        for b in BLOCKS:
            w_sum[b] += w[b].sum(axis=0)
            a_sum[b] += a[b].sum(axis=0)
    return total_loss, w_sum, a_sum, int(sum(len(s) for s in seqs)), len(seqs)


# ---------------------------------------------------------------- scoring and generation
def sequence_losses(params: dict, seqs: list, max_batch: int = 1024, chunk: int = 128, h0: np.ndarray | None = None):
    """Teacher-forced loss of each whole sequence from a zero state: every id
    after the first is predicted.  Up to ``max_batch`` length-sorted sequences
    advance together; time is processed ``chunk`` steps at a time through every
    layer (hidden states carried), so memory is O(batch * chunk * H) whatever
    the sequence length.  Returns (summed nats (n,), predictions (n,)); with start
    states ``h0`` (NL,n,H) also the states after each sequence's last input."""
    layers, hidden, vocab = dims(params)
    n = len(seqs)
    lens = np.array([len(s) for s in seqs], dtype=np.int64)
    out = np.zeros(n)
    final = np.zeros((layers, n, hidden)) if h0 is None else h0.copy()
    order = np.argsort(lens, kind="stable")
    for b0 in range(0, n, max_batch):
        idx = order[b0:b0 + max_batch]
        width = int(lens[idx].max())
        if width < 2:
            continue
        m = len(idx)
        npred = lens[idx] - 1
        h = final[:, idx]
        tot = np.zeros(m)
        for c0 in range(0, width - 1, chunk):
            c1 = min(width - 1, c0 + chunk)
            live = npred > c0                      # sorted ascending: a suffix of the batch
            s0 = int(np.argmax(live))
            x = np.zeros((m - s0, c1 + 1 - c0), dtype=np.int64)  # this chunk's ids only
            for r, k in enumerate(idx[s0:]):
                own = seqs[k][c0:c1 + 1]
                x[r, :len(own)] = own
            ending = np.flatnonzero((npred[s0:] > c0) & (npred[s0:] <= c1))
            x, layer = np.ascontiguousarray(x.T), []
            hs = top_states(params, x[:-1], h[:, s0:], layer)
            for l in range(layers):
                h[l, s0:] = layer[l][-1]
                final[l, idx[s0:][ending]] = layer[l][npred[s0:][ending] - 1 - c0, ending]
            own = np.arange(c0, c1)[:, None] < npred[s0:]
            nll = np.zeros(own.shape)
            nll[own] = step_losses(params, hs[own], x[1:][own])
            tot[s0:] += nll.sum(axis=0)
        out[idx] = tot
    n_pred = np.maximum(lens - 1, 0)
    return (out, n_pred) if h0 is None else (out, n_pred, final)


def inverse_cdf(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Rows of probabilities p (n,V), uniforms u (n,): the smallest k with
    u < cdf[k]; u <= cdf[0] gives 0 and u >= cdf[V-1] gives V-1."""
    cdf = np.cumsum(p, axis=1)
    k = (cdf <= u[:, None]).sum(axis=1)
    k = np.where(u <= cdf[:, 0], 0, k)
    return np.minimum(k, p.shape[1] - 1)


def unit_hash(seed: int, epoch, *keys) -> np.ndarray:
    """NumPy twin of ``exprs.unit_hash``, broadcast over its arguments."""
    keys = np.broadcast_arrays(*(np.asarray(k, dtype=np.int64) for k in (seed, epoch, *keys)))
    word = np.uint64(WORD)
    out = []
    for start in HASH_STARTS:
        h = np.full(keys[0].shape, start, np.uint64)
        for k in keys:
            k = k.astype(np.uint64)
            for part in (k & word, k >> np.uint64(32)):
                h ^= part
                for shift, factor in zip(HASH_SHIFTS, (*HASH_MULTIPLIERS, None)):
                    h ^= h >> np.uint64(shift)
                    if factor:
                        h = (h * np.uint64(factor)) & word
        out.append(h)
    return ((out[0] << np.uint64(HASH_BITS - 32)) + (out[1] >> np.uint64(64 - HASH_BITS))).astype(np.int64)


def unit_uniform(seed: int, epoch, *keys) -> np.ndarray:
    """NumPy twin of ``exprs.unit_uniform``."""
    return (unit_hash(seed, epoch, *keys) >> 7) / float(1 << 53)


#: positions that one stream of gaps samples
GAP_BLOCK = 4096


def gap_positions(rate: float, seed: int, epoch: int, blocks: np.ndarray, *keys: np.ndarray):
    """A Bernoulli sample of the positions of each block (``blocks`` numbers them,
    ``GAP_BLOCK`` positions each): geometric gaps from the block's own stream of
    uniforms, so the work is a draw for each sampled position and one more for
    each block.  Returns (which block, position), in order within a block."""
    at = np.arange(len(blocks))
    pos = blocks.astype(np.int64) * GAP_BLOCK - 1
    end = pos + 1 + GAP_BLOCK
    found, step = [], 0
    while len(at):
        u = unit_uniform(seed, epoch, *(k[at] for k in keys), blocks[at], step)
        # beyond the block in any case; a gap need not fit an integer
        gap = np.minimum(np.floor(np.log(1.0 - u) / np.log(1.0 - rate)), GAP_BLOCK + 1).astype(np.int64)
        pos[at] += 1 + gap
        at = at[pos[at] < end[at]]
        found.append((at, pos[at]))
        step += 1
    which = np.concatenate([a for a, _ in found]) if found else at
    place = np.concatenate([p for _, p in found]) if found else at
    order = np.lexsort((place, which))
    return which[order], place[order]


def sampled_places(rate: float, seed: int, epoch: int, origin: np.ndarray, n: np.ndarray, *keys: np.ndarray):
    """Rows that hold the positions ``origin`` to ``origin + n`` (of the sequence that
    ``keys`` name): (row, place in the row) of every sampled position."""
    first, last = origin // GAP_BLOCK, (origin + np.maximum(n, 1) - 1) // GAP_BLOCK
    each = (last - first + 1) * (n > 0)
    row = np.repeat(np.arange(len(origin)), each)
    block = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    streams, which = np.unique(np.stack([*(k[row] for k in keys), block]), axis=1, return_inverse=True)
    of, place = gap_positions(rate, seed, epoch, streams[-1], *streams[:-1])
    counts = np.bincount(of, minlength=streams.shape[1])
    starts = np.cumsum(counts) - counts
    k = counts[which]
    at = np.repeat(starts[which], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    rows = np.repeat(row, k)
    inside = place[at] - origin[rows]
    kept = (inside >= 0) & (inside < n[rows])
    return rows[kept], inside[kept]


def generate(params: dict, seeds: np.ndarray, steps: int, uniforms=None, h0=None) -> np.ndarray:
    """Advance every prompt together: feed the seed id, then each produced id.

    ``uniforms`` (n, steps) selects inverse-CDF sampling; None means greedy
    (argmax, ties to the lowest id).  The seed itself is not emitted.  ``h0``
    (NL,n,H) are the states to start from.
    """
    layers, hidden, vocab = dims(params)
    n = len(seeds)
    h = np.zeros((layers, n, hidden)) if h0 is None else h0.copy()
    cur = np.asarray(seeds, dtype=np.int64)
    out = np.empty((n, steps), dtype=np.int64)
    for t in range(steps):
        inp = None
        for l in range(layers):
            pre = params["Win"][0].T[cur] if l == 0 else inp @ params["Win"][l].T
            h[l] = np.tanh(pre + h[l] @ params["Wh"][l].T + params["bh"][l])
            inp = h[l] @ params["Wout"][l].T + params["bout"][l]
        if uniforms is None:
            cur = np.argmax(inp, axis=1)
        else:
            cur = inverse_cdf(softmax(inp), uniforms[:, t])
        out[:, t] = cur
    return out
