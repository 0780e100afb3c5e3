import numpy as np
import pytest

from charloom.config import RnnConfig
from charloom.functions import kernels as K
from tests.plain_model import Size, clipped_gradient, loss, train_locally


def rand_params(NL, H, V, seed=0, scale=0.5):
    rng = np.random.default_rng(seed)
    p = K.zeros(NL, H, V)
    for b in K.BLOCKS:
        p[b] = rng.standard_normal(p[b].shape) * scale
    return p


@pytest.mark.parametrize("NL", [1, 2])
@pytest.mark.parametrize("compat", [False, True])
def test_grad_sum_matches_complex_steps(NL, compat):
    H, V, T, n, lim = 5, 7, 6, 9, 0.8
    p = rand_params(NL, H, V, seed=NL)
    if compat:  # with symmetric recurrent weights the untransposed product is the gradient too
        p["Wh"] = (p["Wh"] + p["Wh"].transpose(0, 2, 1)) / 2
    ids = np.random.default_rng(3).integers(0, V, size=(n, T + 1))
    losses, g = K.grad_sum(p, ids[:, :-1], ids[:, 1:], lim, compat_untransposed=compat)
    exp = [clipped_gradient(K.flatten(p), Size(NL, H, V), w, limit=lim) for w in ids]
    np.testing.assert_allclose(losses, [e[0] for e in exp], rtol=1e-10)
    np.testing.assert_allclose(K.flatten(g), sum(e[1] for e in exp), rtol=1e-9, atol=1e-12)


def test_untransposed_recurrence_differs():
    p = rand_params(1, 5, 7)
    ids = np.random.default_rng(3).integers(0, 7, size=(4, 6))
    a, b = (K.grad_sum(p, ids[:, :-1], ids[:, 1:], 9.0, compat_untransposed=c)[1]["Wh"] for c in (False, True))
    assert not np.allclose(a, b)


def test_clipping_is_exact_beside_huge_and_infinite_rows():
    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((6, 4, 3)), rng.standard_normal((6, 4, 5))
    a[1, 2, 0], a[3, 1, 1] = 1e15, np.inf
    exp = sum(np.clip(a[w].T @ b[w], -0.9, 0.9) for w in range(6))
    got = K.clipped_outer_sum(a, b, 0.9)
    np.testing.assert_allclose(got, exp, rtol=1e-12, atol=1e-12)
    b[4, 0, 0], a[4] = np.inf, 0.0
    with np.errstate(invalid="ignore"):
        exp = sum(np.clip(a[w].T @ b[w], -0.9, 0.9) for w in range(6))
    np.testing.assert_allclose(K.clipped_outer_sum(a, b, 0.9), exp, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("NL", [1, 2])
def test_gradient_matches_finite_differences(NL):
    """Unclipped gradient of one window vs central differences, every block."""
    H, V, T = 4, 5, 5
    p = rand_params(NL, H, V, seed=11, scale=0.4)
    ids = np.array([[0, 3, 1, 4, 2, 2]])
    _, g = K.grad_sum(p, ids[:, :-1], ids[:, 1:], lim=1e9)

    def loss(q):
        return K.window_losses(K.forward(q, ids[:, :-1])[1][-1], ids[:, 1:])[0]

    eps = 1e-6
    for b in K.BLOCKS:
        num = np.zeros_like(p[b])
        it = np.nditer(p[b], flags=["multi_index"])
        for _ in it:
            q = {k: v.copy() for k, v in p.items()}
            q[b][it.multi_index] += eps
            up = loss(q)
            q[b][it.multi_index] -= 2 * eps
            num[it.multi_index] = (up - loss(q)) / (2 * eps)
        np.testing.assert_allclose(g[b], num, atol=1e-7, err_msg=b)


def test_untransposed_recurrent_gradient_is_wrong():
    H, V, T = 4, 5, 6
    p = rand_params(1, H, V, seed=5, scale=0.6)
    ids = np.array([[0, 3, 1, 4, 2, 2, 1]])
    _, g_ok = K.grad_sum(p, ids[:, :-1], ids[:, 1:], lim=1e9)
    _, g_compat = K.grad_sum(p, ids[:, :-1], ids[:, 1:], lim=1e9, compat_untransposed=True)
    assert not np.allclose(g_ok["Wh"], g_compat["Wh"])


def test_clip_sum_exact_with_heavy_clipping():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((13, 7, 4)) * 3
    b = rng.standard_normal((13, 7, 3))
    exp = sum(np.clip(a[w].T @ b[w], -1.0, 1.0) for w in range(13))
    np.testing.assert_allclose(K.clipped_outer_sum(a, b, 1.0), exp, rtol=1e-12)
    x = rng.integers(0, 5, size=(13, 7))
    oh = np.eye(5)[x]
    exp = sum(np.clip(a[w].T @ oh[w], -1.0, 1.0) for w in range(13))
    np.testing.assert_allclose(K.clipped_onehot_sum(a, x, 5, 1.0), exp, rtol=1e-12)


def test_clip_passes_nan():
    g = np.array([np.nan, 7.0, -7.0, 5.0, -5.0, 1.0])
    out = K.clip(g, 5.0)
    assert np.isnan(out[0]) and list(out[1:]) == [5.0, -5.0, 5.0, -5.0, 1.0]


def test_softmax_handles_large_logits():
    y = np.array([[800.0, 799.0, 0.0]])
    p = K.softmax(y)
    assert np.isfinite(p).all() and abs(p.sum() - 1) < 1e-12
    assert np.isfinite(K.log_softmax(y)).all()


@pytest.mark.parametrize("mode", ["paragraph", "tumbling"])
@pytest.mark.parametrize("NL", [1, 2])
def test_train_sequences_matches_fold(mode, NL):
    cfg = RnnConfig(num_layers=NL, hidden=4, seq_len=3, learn_rate=0.1, clip=0.5, iters=2)
    V = 6
    p = rand_params(NL, 4, V, seed=2, scale=0.3)
    accs = {b: np.abs(rand_params(NL, 4, V, seed=9)[b]) for b in K.BLOCKS}
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, V, size=n) for n in (1, 2, 3, 4, 5, 7, 10, 13)]
    exp = [train_locally(K.flatten(p), K.flatten(accs), Size(NL, 4, V), s, 3, 0.1, 0.5, 2, mode) for s in seqs]
    for budget in (1, 4_000_000):  # one sequence at a time, and all in lock-step
        loss, w_sum, a_sum, total, cnt = K.train_sequences(p, accs, seqs, cfg, mode=mode, budget=budget)
        assert cnt == len(seqs) and total == sum(len(s) for s in seqs)
        np.testing.assert_allclose(loss, sum(e[0] for e in exp), rtol=1e-10)
        np.testing.assert_allclose(K.flatten(w_sum), sum(e[1] for e in exp), rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(K.flatten(a_sum), sum(e[2] for e in exp), rtol=1e-9, atol=1e-12)


def test_chunk_counts_by_enumeration():
    L = 4
    for n in range(0, 60):
        # paragraph chunks end before the line's last character, tumbling ones at it at the latest
        assert K.chunk_count([n], L, "paragraph")[0] == len([k for k in range(n) if (k + 1) * L < n - 1])
        assert K.chunk_count([n], L, "tumbling")[0] == len([k for k in range(n) if (k + 1) * L <= n - 1])


def test_sequence_losses_equal_plain_loss():
    p = rand_params(2, 4, 6, seed=4, scale=0.4)
    size, theta = Size(2, 4, 6), K.flatten(p)
    seqs = [np.array([1, 2, 3, 4, 5, 0, 1]), np.array([2]), np.array([3, 3]), np.array([], dtype=int)]
    tot, npred = K.sequence_losses(p, seqs, max_batch=2, chunk=3)
    h0 = np.random.default_rng(0).standard_normal((2, 4, 4))
    from_h0, _, final = K.sequence_losses(p, seqs, max_batch=2, chunk=3, h0=h0)
    for i, s in enumerate(seqs):
        assert npred[i] == max(len(s) - 1, 0)
        if len(s) > 1:
            assert abs(tot[i] - loss(theta, size, s)[0][0]) < 1e-9
            exp, states = loss(theta, size, s, h0[:, i])
            assert abs(from_h0[i] - exp[0]) < 1e-9
            np.testing.assert_allclose(final[:, i], states[:, 0], rtol=1e-12)
        else:
            assert tot[i] == 0
            np.testing.assert_array_equal(final[:, i], h0[:, i])


def test_long_line_scores_in_bounded_memory():
    import tracemalloc
    p = rand_params(1, 25, 100, seed=1, scale=0.1)
    tracemalloc.start()
    K.sequence_losses(p, [np.zeros(300_000, np.int32), *[np.zeros(5, np.int32)] * 255])
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_inverse_cdf_rules():
    p = np.array([[0.2, 0.3, 0.5]] * 6)
    u = np.array([0.0, 0.2, 0.2000001, 0.5, 0.99, 1.0])
    assert K.inverse_cdf(p, u).tolist() == [0, 0, 1, 2, 2, 2]


def test_hash_is_wide():
    h = K.unit_hash(7, 3, np.array([0, 1, 10**12]))
    assert h.dtype == np.int64 and (h >= 0).all() and (h < 1 << 60).all()
    assert K.unit_hash(7, 3, 5) != K.unit_hash(7, 3, 5 + (1 << 31) - 1)
    assert ((u := K.unit_uniform(7, 3, np.arange(1000))) < 1).all() and 0.45 < u.mean() < 0.55


def test_onehot_clip_sum_mixed_windows():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((20, 6, 3)) * 0.1
    a[::3] *= 40  # some windows exceed the bound, most do not
    x = rng.integers(0, 7, size=(20, 6))
    oh = np.eye(7)[x]
    exp = sum(np.clip(a[w].T @ oh[w], -1.0, 1.0) for w in range(20))
    np.testing.assert_allclose(K.clipped_onehot_sum(a, x, 7, 1.0), exp, rtol=1e-12, atol=1e-14)


def test_window_starts_match_enumeration():
    rng = np.random.default_rng(8)
    lens = rng.integers(0, 30, size=40)
    own = np.minimum(lens, rng.integers(0, 30, size=40))
    origin = rng.integers(0, 1000, size=40)
    for stride in (1, 4):
        rows, starts = K.window_starts(lens, own, 5, stride, origin)
        exp = [(r, s) for r in range(40) for s in range(max(0, min(own[r], lens[r] - 5)))
               if (origin[r] + s) % stride == 0]
        assert list(zip(rows.tolist(), starts.tolist())) == exp
    ids = np.arange(lens.sum())
    rows, starts = K.window_starts(lens, own, 5)
    w = K.gather_windows(ids, lens, rows, starts, 5)
    base = np.cumsum(lens) - lens
    assert all((w[i] == base[r] + s + np.arange(6)).all() for i, (r, s) in enumerate(zip(rows, starts)))
