"""DuckDB SQL that trains the recurrent model from non-zero weights (oracles).

One layer of a few hidden units.  Two forms:

* windows that share one model (gradient sums, T1, T2): relations with a row per
  window and step; the forward state and the backward state run along the steps
  by recursion, the softmax and the output gradients are aggregates over
  (window, character);
* sequences with a model each (T3, T4): a fold over a sequence's windows whose
  state is one list -- weights, accumulators, hidden state, loss -- and whose step
  runs forward and backward through the window by inner folds.

A model is a relation ``m(block, i, j, w, a)``.
"""

from __future__ import annotations

from charloom.functions.sql import clip_sql


def sine(block_no: int, i: str, j: str) -> str:
    return f"0.1 * sin({block_no} + 0.7 * ({i}) + 1.3 * ({j}))"


def sine_model(hidden: int) -> list:
    """``voc(v)`` from ``vocab`` and the closed-form start model ``m0``."""
    n = f"range({hidden})"
    parts = [f"SELECT 'Win' AS block, a.range AS i, b.v AS j, {sine(0, 'a.range', 'b.v')} AS w, CAST(0.0 AS DOUBLE) AS a FROM {n} a, voc b",
             f"SELECT 'Wh', a.range, b.range, {sine(1, 'a.range', 'b.range')}, 0.0 FROM {n} a, {n} b",
             f"SELECT 'Wout', a.v, b.range, {sine(2, 'a.v', 'b.range')}, 0.0 FROM voc a, {n} b",
             f"SELECT 'bh', a.range, 0, {sine(3, 'a.range', '0')}, 0.0 FROM {n} a",
             f"SELECT 'bout', a.v, 0, {sine(4, 'a.v', '0')}, 0.0 FROM voc a"]
    return ["voc AS (SELECT id AS v FROM vocab)", "m0 AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")"]


def _sum(terms) -> str:
    return " + ".join(terms)


def window_gradients(e: int, hidden: int, steps: int, clip: float) -> list:
    """CTEs from ``ws(e, w, t, x, y)`` (epoch, window, step 1.., input, target) and
    the model ``m{e}``: ``loss{e}(loss, n)`` and ``g{e}(block, i, j, g)``, the sums
    of every window's clipped gradients."""
    h, n = range(1, hidden + 1), hidden

    def both(a: str, b: str) -> str:
        return ", ".join(f"{a.format(k=k)} AS {b.format(k=k)}" for k in h)

    def clipped(x: str) -> str:
        return clip_sql(x, clip)

    # the backward step: through the tanh, then to the step before by the columns of Wh
    back = "[" + ", ".join(f"(1 - h{i} * h{i}) * (d{i} + s[{i}])" for i in h) + "]"
    onward = "[" + ", ".join(_sum(f"p.wh[{(i - 1) * n + k}] * r[{i}]" for i in h) for k in h) + "]"
    zeros = "[" + ", ".join(["CAST(0.0 AS DOUBLE)"] * n) + "]"
    nxt = "[" + ", ".join(f"tanh(i.w[{i}] + p.bh[{i}] + " + _sum(f"p.wh[{(i - 1) * n + k}] * f.s[{k}]" for k in h) + ")" for i in h) + "]"
    logit = "o.b + " + _sum(f"o.o{k} * f.h{k}" for k in h)
    return [
        f"ws{e} AS MATERIALIZED (SELECT w, t, x, y FROM ws WHERE e = {e})",
        f"par{e} AS MATERIALIZED (SELECT list(w ORDER BY i, j) FILTER (block = 'Wh') AS wh, list(w ORDER BY i) FILTER (block = 'bh') AS bh FROM m{e})",
        f"win{e} AS MATERIALIZED (SELECT j AS v, list(w ORDER BY i) AS w FROM m{e} WHERE block = 'Win' GROUP BY j)",
        f"wo{e} AS MATERIALIZED (SELECT i AS v, max(w) FILTER (block = 'bout') AS b, "
        + ", ".join(f"max(w) FILTER (block = 'Wout' AND j = {k - 1}) AS o{k}" for k in h)
        + f" FROM m{e} WHERE block IN ('Wout', 'bout') GROUP BY i)",
        f"f{e} AS (SELECT DISTINCT w, 0 AS t, {zeros} AS s FROM ws{e} UNION ALL SELECT f.w, f.t + 1, {nxt} FROM f{e} f "
        f"JOIN ws{e} q ON q.w = f.w AND q.t = f.t + 1 JOIN win{e} i ON i.v = q.x, par{e} p)",
        f"fw{e} AS MATERIALIZED (SELECT q.w, q.t, q.x, q.y, {both('a.s[{k}]', 'h{k}')}, {both('b.s[{k}]', 'p{k}')} FROM ws{e} q "
        f"JOIN f{e} a ON a.w = q.w AND a.t = q.t JOIN f{e} b ON b.w = q.w AND b.t = q.t - 1)",
        f"z{e} AS MATERIALIZED (SELECT w, t, sum(z) AS z, {both('sum(z * o{k})', 'd{k}')} FROM "
        f"(SELECT f.w, f.t, exp({logit}) AS z, {both('o.o{k}', 'o{k}')} FROM fw{e} f, wo{e} o) GROUP BY w, t)",
        f"d{e} AS MATERIALIZED (SELECT f.w, f.t, f.x, {both('f.h{k}', 'h{k}')}, {both('f.p{k}', 'p{k}')}, "
        f"{both('z.d{k} / z.z - o.o{k}', 'd{k}')}, ln(z.z) - ({logit}) AS loss FROM fw{e} f JOIN z{e} z ON z.w = f.w AND z.t = f.t "
        f"JOIN wo{e} o ON o.v = f.y)",
        f"loss{e} AS MATERIALIZED (SELECT coalesce(sum(loss), 0.0) AS loss, count(DISTINCT w) AS n FROM d{e})",
        f"b{e} AS (SELECT DISTINCT w, {steps + 1} AS t, {zeros} AS s, {zeros} AS r FROM ws{e} UNION ALL "
        f"SELECT w, t, {onward} AS s, r FROM (SELECT b.w, b.t - 1 AS t, {back} AS r FROM b{e} b "
        f"JOIN d{e} d ON d.w = b.w AND d.t = b.t - 1) x, par{e} p)",
        f"r{e} AS MATERIALIZED (SELECT d.w, d.x, {both('b.r[{k}]', 'r{k}')}, {both('d.p{k}', 'p{k}')} FROM b{e} b "
        f"JOIN d{e} d ON d.w = b.w AND d.t = b.t)",
        f"top{e} AS (SELECT v, {both('sum(' + clipped('g{k}') + ')', 'g{k}')}, sum({clipped('g0')}) AS g0 FROM ("
        f"SELECT w, v, {both('sum(q * h{k})', 'g{k}')}, sum(q) AS g0 FROM ("
        f"SELECT f.w, o.v, exp({logit}) / z.z AS q, {both('f.h{k}', 'h{k}')} FROM fw{e} f JOIN z{e} z ON z.w = f.w AND z.t = f.t, wo{e} o "
        f"UNION ALL SELECT w, y, -1.0, {both('h{k}', 'h{k}')} FROM fw{e}) GROUP BY w, v) GROUP BY v)",
        f"rec{e} AS (SELECT " + ", ".join(f"sum({clipped(f'c{i}{k}')}) AS c{i}{k}" for i in h for k in h) + ", "
        + ", ".join(f"sum({clipped(f'c{i}')}) AS c{i}" for i in h) + " FROM (SELECT w, "
        + ", ".join(f"sum(r{i} * p{k}) AS c{i}{k}" for i in h for k in h) + ", " + ", ".join(f"sum(r{i}) AS c{i}" for i in h)
        + f" FROM r{e} GROUP BY w))",
        f"inp{e} AS (SELECT x, {both('sum(' + clipped('g{k}') + ')', 'g{k}')} FROM (SELECT w, x, {both('sum(r{k})', 'g{k}')} FROM r{e} "
        "GROUP BY w, x) GROUP BY x)",
        f"g{e} AS MATERIALIZED (" + " UNION ALL ".join(
            [f"SELECT 'Win' AS block, {k - 1} AS i, x AS j, g{k} AS g FROM inp{e}" for k in h]
            + [f"SELECT 'Wout', v, {k - 1}, g{k} FROM top{e}" for k in h] + [f"SELECT 'bout', v, 0, g0 FROM top{e}"]
            + [f"SELECT 'Wh', {i - 1}, {k - 1}, c{i}{k} FROM rec{e}" for i in h for k in h]
            + [f"SELECT 'bh', {i - 1}, 0, c{i} FROM rec{e}" for i in h]) + ")"]


def adagrad(e: int, rate: float) -> str:
    """The model ``m{e + 1}`` after a step with the mean of ``g{e}``."""
    return (f"m{e + 1} AS MATERIALIZED (SELECT block, i, j, w - {rate} * g / sqrt(a + g * g + 1e-8) AS w, a + g * g AS a FROM ("
            f"SELECT m.*, CASE WHEN (SELECT n FROM loss{e}) > 0 THEN coalesce(g.g, 0.0) / (SELECT n FROM loss{e}) ELSE 0.0 END AS g "
            f"FROM m{e} m LEFT JOIN g{e} g USING (block, i, j)))")


def window_training(epochs: int, hidden: int, steps: int, clip: float, rate: float, smooth) -> tuple:
    """CTEs and one select per epoch (metrics) of T1 or T2 over ``ws``.  ``smooth``
    gives the epoch's smoothed loss from the value before it and the epoch."""
    ctes, selects, before = [], [], f"{steps} * ln((SELECT count(*) FROM vocab))"
    for e in range(epochs):
        ctes += window_gradients(e, hidden, steps, clip) + [adagrad(e, rate), f"sm{e} AS MATERIALIZED (SELECT {smooth(before, e)} AS v)"]
        before = f"(SELECT v FROM sm{e})"
        selects.append(
            f"SELECT CAST({e} AS BIGINT) AS epoch, CAST(n AS BIGINT) AS n, round(loss / (n * {steps}), 6) AS loss_per_char, "
            f"round({before}, 6) AS smooth_loss, round((SELECT sum(w) FROM m{e + 1}), 6) AS w_sum, "
            f"round((SELECT sum(w * w) FROM m{e + 1}), 6) AS w_sq, round((SELECT sum(a) FROM m{e + 1}), 6) AS acc_sum FROM loss{e}")
    return ctes, selects


# ---------------------------------------------------------------- sequences with a model each
def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound once to ``value``."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def chunk_step(hidden: int, steps: int, clip: float, rate: float) -> str:
    """One window of a sequence: ``s`` is the state -- the model's ``k`` weights (the
    flat order of the blocks), their accumulators, the hidden state, the loss --
    and ``c`` the window's characters.  Columns: ``v`` (characters), ``k``."""
    n, h = hidden, range(1, hidden + 1)
    win, wh, wo = "0", f"{n} * v", f"{n} * v + {n * n}"
    bh, bo = f"2 * {n} * v + {n * n}", f"2 * {n} * v + {n * n + n}"

    def state(at: str, k) -> str:  # hidden states stand one after the other, the start first
        return f"hs[{n} * ({at}) + {k}]"
    nxt = ", ".join(f"tanh(s[{win} + {i - 1} * v + x + 1] + s[{bh} + {i}] + "
                    + _sum(f"s[{wh} + {(i - 1) * n + k}] * g[len(g) - {n - k}]" for k in h) + ")" for i in h)
    forward = f"list_reduce(c[1:{steps}], lambda g, x: list_concat(g, [{nxt}]), s[2 * k + 1:2 * k + {n}])"
    # the softmax of every step, then less one at the target
    logit = f"s[{bo} + u + 1] + " + _sum(f"s[{wo} + {n} * u + {k}] * {state('t', k)}" for k in h)
    exps = f"list_transform(range(1, {steps + 1}), lambda t: list_transform(range(v), lambda u: exp({logit})))"
    sums = "list_transform(ex, lambda q: list_sum(q))"
    loss = f"list_sum(list_transform(range(1, {steps + 1}), lambda t: ln(zs[t]) - ln(ex[t][c[t + 1] + 1])))"
    delta = (f"list_transform(range(1, {steps + 1}), lambda t: list_transform(range(1, v + 1), lambda u: "
             f"ex[t][u] / zs[t] - CASE WHEN u = c[t + 1] + 1 THEN 1.0 ELSE 0.0 END))")
    out = f"list_transform(de, lambda q: [" + ", ".join(
        f"list_sum(list_transform(range(v), lambda u: q[u + 1] * s[{wo} + {n} * u + {k}]))" for k in h) + "])"
    # backward: the newest step's gradient in front
    through = ", ".join(
        f"(1 - {state('t', i)} * {state('t', i)}) * (dh[t][{i}] + CASE WHEN len(b) = 0 THEN 0.0 ELSE "
        + _sum(f"s[{wh} + {(j - 1) * n + i}] * b[{j}]" for j in h) + " END)" for i in h)
    none = "CAST([] AS DOUBLE[])"
    back = f"list_reduce(range({steps}, 0, -1), lambda b, t: list_concat([{through}], b), {none})"

    def draw(t: str, i: str) -> str:
        return f"bk[{n} * ({t} - 1) + {i}]"

    def over(body: str) -> str:
        return f"list_sum(list_transform(range(1, {steps + 1}), lambda t: {body}))"
    grads = "list_concat(list_concat(list_concat(list_concat(" + ", ".join([
        f"list_transform(range({n} * v), lambda z: {over('CASE WHEN c[t] = z % v THEN ' + draw('t', '(z // v + 1)') + ' ELSE 0.0 END')})",
        f"list_transform(range({n * n}), lambda z: {over(draw('t', f'(z // {n} + 1)') + ' * ' + state('t - 1', f'(z % {n} + 1)'))}))",
        f"list_transform(range({n} * v), lambda z: {over(f'de[t][z // {n} + 1] * ' + state('t', f'(z % {n} + 1)'))}))",
        f"list_transform(range(1, {n + 1}), lambda z: {over(draw('t', 'z'))}))",
        f"list_transform(range(1, v + 1), lambda z: {over('de[t][z]')}))"])
    clipped = f"list_transform({grads}, lambda q: {clip_sql('q', clip)})"
    update = (f"list_concat(list_concat(list_transform(range(1, k + 1), lambda q: s[q] - {rate} * gr[q] / sqrt(s[k + q] + gr[q] * gr[q] + 1e-8)), "
              f"list_transform(range(1, k + 1), lambda q: s[k + q] + gr[q] * gr[q])), "
              f"list_concat(hs[len(hs) - {n - 1}:len(hs)], [s[2 * k + {n + 1}] + {loss}]))")
    return let("hs", forward, let("ex", exps, let("zs", sums, let("de", delta, let("dh", out, let("bk", back, let("gr", clipped, update)))))))


def sequence_training(chunks: str, epochs: int, hidden: int, steps: int, clip: float, rate: float, smooth) -> tuple:
    """CTEs and selects of T3 or T4.  ``chunks`` names a relation (e, q, n, ids, cs):
    per epoch and sequence its characters' number, its characters and the list of
    its windows (each a list of characters)."""
    order = "CASE block WHEN 'Win' THEN 0 WHEN 'Wh' THEN 1 WHEN 'Wout' THEN 2 WHEN 'bh' THEN 3 ELSE 4 END, i, j"
    zeros = "[" + ", ".join(["CAST(0.0 AS DOUBLE)"] * (hidden + 1)) + "]"
    step = chunk_step(hidden, steps, clip, rate)
    ctes = [f"l0 AS MATERIALIZED (SELECT list(w ORDER BY {order}) AS w, list(a ORDER BY {order}) AS a FROM m0)"]
    selects, before = [], f"{steps} * ln((SELECT count(*) FROM vocab))"
    for e in range(epochs):
        ctes += [
            f"q{e} AS MATERIALIZED (SELECT d.q, d.ids, n, len(cs) AS ch, CASE WHEN len(cs) = 0 THEN list_concat(list_concat(l.w, l.a), {zeros}) ELSE "
            f"list_reduce(cs, lambda s, c: {step}, list_concat(list_concat(l.w, l.a), {zeros})) END AS s, k "
            f"FROM {chunks} d, l{e} l, (SELECT count(*) AS v FROM vocab), (SELECT count(*) AS k FROM m0) WHERE d.e = {e})",
            f"tot{e} AS MATERIALIZED (SELECT count(*) AS n, coalesce(sum(n), 0) AS len, coalesce(sum(ch), 0) AS chunks, "
            f"coalesce(sum(s[2 * k + {hidden + 1}]), 0.0) AS loss FROM q{e})",
            f"u{e} AS MATERIALIZED (SELECT z, avg(x) AS x FROM (SELECT unnest(s[1:2 * k]) AS x, generate_subscripts(s[1:2 * k], 1) AS z FROM q{e}) "
            "GROUP BY z)",
            f"l{e + 1} AS MATERIALIZED (SELECT CASE WHEN (SELECT n FROM tot{e}) > 0 THEN (SELECT list(x ORDER BY z) FROM u{e} "
            f"WHERE z <= (SELECT count(*) FROM m0)) ELSE l.w END AS w, CASE WHEN (SELECT n FROM tot{e}) > 0 THEN "
            f"(SELECT list(x ORDER BY z) FROM u{e} WHERE z > (SELECT count(*) FROM m0)) ELSE l.a END AS a FROM l{e} l)",
            f"sm{e} AS MATERIALIZED (SELECT {smooth(before, e)} AS v)"]
        before = f"(SELECT v FROM sm{e})"
        selects.append(
            f"SELECT CAST({e} AS BIGINT) AS epoch, CAST(n AS BIGINT) AS n, round(loss / len, 6) AS loss_per_char, round({before}, 6) AS smooth_loss, "
            f"round(list_sum((SELECT w FROM l{e + 1})), 6) AS w_sum, "
            f"round(list_sum(list_transform((SELECT w FROM l{e + 1}), lambda x: x * x)), 6) AS w_sq, "
            f"round(list_sum((SELECT a FROM l{e + 1})), 6) AS acc_sum FROM tot{e}")
    return ctes, selects
