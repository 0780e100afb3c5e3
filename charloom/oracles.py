"""DuckDB oracle SQL, one statement per registered query (same column names)."""

from __future__ import annotations

from charloom.functions.sql import (CHARS_CTE, GCHARS_CTE, gap_sample_ctes, LINES_CTE, NONEMPTY_CTE, VOCAB_CTE,
                                    keep_sql, md5_int_sql, with_ctes)
from charloom.queries import (CFG, PARAGRAPH_SAMPLE_RATE, SAMPLE_EPOCHS, WINDOW_SAMPLE_RATE, L)

BASE = with_ctes(LINES_CTE, NONEMPTY_CTE, CHARS_CTE, VOCAB_CTE, GCHARS_CTE)


def _base(*extra: str) -> str:
    return with_ctes(LINES_CTE, NONEMPTY_CTE, CHARS_CTE, VOCAB_CTE, GCHARS_CTE, *extra)


CHUNKS_SQL = f"greatest(0, CAST(ceil((length(line) - 1) / {float(L)}) AS BIGINT) - 1)"
EPOCHS_SQL = "(VALUES " + ", ".join(f"({e})" for e in SAMPLE_EPOCHS) + ") AS e(epoch)"

LINE_WINDOWS_CTE = (
    "lwin AS (SELECT doc_id, line_no, pos, "
    f"string_agg(ch, '') OVER (PARTITION BY doc_id, line_no ORDER BY pos ROWS BETWEEN CURRENT ROW AND {L} FOLLOWING) AS win "
    "FROM chars)")
CORPUS_WINDOWS_CTE = (
    "gwin AS (SELECT doc_id, gpos, "
    f"string_agg(ch, '') OVER (ORDER BY gpos ROWS BETWEEN CURRENT ROW AND {L} FOLLOWING) AS win FROM gchars)")


def _summary(src: str, where: str = "TRUE") -> str:
    return (f"SELECT doc_id, CAST(count(*) AS BIGINT) AS n_windows, "
            f"CAST(sum({md5_int_sql('win')}) AS BIGINT) AS checksum "
            f"FROM {src} WHERE length(win) = {L + 1} AND {where} GROUP BY doc_id")


ORACLES = {
    "corpus_lines": _base() + (
        f"SELECT doc_id, line_no, CAST(length(line) AS BIGINT) AS n, {md5_int_sql('line')} AS checksum FROM lines"),
    "nonempty_lines": _base() + "SELECT doc_id, line_no, CAST(length(line) AS BIGINT) AS n FROM nonempty",
    "char_tokens": _base() + (
        "SELECT doc_id, CAST(count(*) AS BIGINT) AS n_chars, CAST(count(DISTINCT ch) AS BIGINT) AS n_distinct, "
        "CAST(sum((pos + 1) * unicode(ch)) AS BIGINT) AS checksum FROM chars GROUP BY doc_id"),
    "word_tokens": _base(
        "words AS (SELECT unnest(CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::VARCHAR[] "
        "ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM lines)") + (
        "SELECT word, CAST(count(*) AS BIGINT) AS n FROM words GROUP BY word"),
    "vocab": _base() + "SELECT ch, CAST(id AS BIGINT) AS id, CAST(n AS BIGINT) AS n FROM vocab",
    "corpus_summary": _base() + (
        "SELECT (SELECT CAST(count(*) AS BIGINT) FROM vocab) AS vocab_size, "
        "CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs, CAST(count(*) AS BIGINT) AS n_lines, "
        "CAST(sum(CASE WHEN line <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n_nonempty, "
        "CAST(sum(length(line)) AS BIGINT) AS n_chars, "
        f"CAST({CFG.num_layers} AS BIGINT) AS num_layers, CAST({CFG.hidden} AS BIGINT) AS hidden, "
        f"CAST({CFG.seq_len} AS BIGINT) AS seq_len FROM lines"),
    "encoded_lines": _base() + (
        "SELECT doc_id, line_no, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids "
        "FROM gchars GROUP BY doc_id, line_no"),
    "decoded_lines": _base() + (
        f"SELECT doc_id, line_no, CAST(length(line) AS BIGINT) AS n, {md5_int_sql('line')} AS checksum FROM nonempty"),
    "one_hot": _base(
        "per AS (SELECT doc_id, id, count(*) AS cnt FROM gchars GROUP BY doc_id, id)",
        "grid AS (SELECT d.doc_id, v.id FROM (SELECT DISTINCT doc_id FROM per) d CROSS JOIN vocab v)") + (
        "SELECT g.doc_id, string_agg(CAST(coalesce(p.cnt, 0) AS VARCHAR), ',' ORDER BY g.id) AS hist "
        "FROM grid g LEFT JOIN per p USING (doc_id, id) GROUP BY g.doc_id"),
    "shifted_pairs": _base(
        "nxt AS (SELECT id AS x, lead(id) OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS y FROM gchars)") + (
        "SELECT CAST(x AS BIGINT) AS input_id, CAST(y AS BIGINT) AS target_id, CAST(count(*) AS BIGINT) AS n "
        "FROM nxt WHERE y IS NOT NULL GROUP BY x, y"),
    "text_round_trip": _base() + (
        f"SELECT CAST(length(line) AS BIGINT) AS n, {md5_int_sql('line')} AS checksum, CAST(count(*) AS BIGINT) AS copies "
        "FROM lines GROUP BY ALL"),
    "text_order": _base() + (
        "SELECT CAST(coalesce(sum(length(line)) OVER (ORDER BY doc_id, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
        f"AS BIGINT) AS goff, CAST(length(line) AS BIGINT) AS n, {md5_int_sql('line')} AS checksum FROM nonempty"),
    "line_offsets": _base() + (
        "SELECT doc_id, line_no, "
        "CAST(coalesce(sum(length(line)) OVER (ORDER BY doc_id, line_no ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS BIGINT) AS goff, "
        "CAST(coalesce(sum(length(line)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED "
        "PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS doff, "
        "CAST(length(line) AS BIGINT) AS n FROM nonempty"),
    "eval_prefix": _base() + (
        "SELECT CAST(gpos AS BIGINT) AS gpos, ch, CAST(id AS BIGINT) AS id FROM gchars WHERE gpos < 51"),
    "corpus_sliding": _base(CORPUS_WINDOWS_CTE) + _summary("gwin"),
    "corpus_tumbling": _base(CORPUS_WINDOWS_CTE) + _summary("gwin", f"gpos % {L} = 0"),
    "line_sliding": _base(LINE_WINDOWS_CTE) + _summary("lwin"),
    "paragraph_chunks": _base(
        LINE_WINDOWS_CTE,
        f"chunked AS (SELECT w.doc_id, w.win FROM lwin w JOIN nonempty n USING (doc_id, line_no) "
        f"WHERE w.pos % {L} = 0 AND w.pos < {CHUNKS_SQL} * {L})",
        f"ws AS ({_summary('chunked')})",
        f"pd AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_paragraphs, "
        f"CAST(sum(CASE WHEN {CHUNKS_SQL} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_idle, "
        f"CAST(sum({CHUNKS_SQL}) AS BIGINT) AS n_chunks FROM nonempty GROUP BY doc_id)") + (
        "SELECT pd.doc_id, n_paragraphs, n_idle, n_chunks, CAST(coalesce(n_windows, 0) AS BIGINT) AS n_windows, "
        "CAST(coalesce(checksum, 0) AS BIGINT) AS checksum FROM pd LEFT JOIN ws USING (doc_id)"),
    "sampled_windows": _base(CORPUS_WINDOWS_CTE, *gap_sample_ctes("picked", WINDOW_SAMPLE_RATE, CFG.seed, len(SAMPLE_EPOCHS),
                                                                 f"SELECT greatest(0, count(*) - {L}) FROM gchars")).replace(
        "WITH ", "WITH RECURSIVE ", 1) + (
        "SELECT CAST(e AS BIGINT) AS epoch, CAST(gpos AS BIGINT) AS start, win FROM gwin JOIN picked ON pos = gpos"),
    "sampled_paragraphs": _base() + (
        f"SELECT CAST(epoch AS BIGINT) AS epoch, doc_id, line_no, CAST(length(line) AS BIGINT) AS n "
        f"FROM nonempty CROSS JOIN {EPOCHS_SQL} WHERE "
        f"{keep_sql(PARAGRAPH_SAMPLE_RATE, CFG.seed, 'epoch', 'doc_id', 'line_no')}"),
}


# ---------------------------------------------------------------- model oracles
from charloom.functions.sql import clip_sql, uniform_sql  # noqa: E402
from charloom.queries import EVAL_OFFSET, GEN_STEPS, SQL_HIDDEN, STACKED, T1_EPOCHS, T2_EPOCHS, T2_RATE  # noqa: E402

H = CFG.hidden
V_SQL = "(SELECT count(*) FROM vocab)"


def _sine(layer: int, bno: int, i: str, j: str) -> str:
    return f"0.1 * sin({5 * layer + bno} + 0.7 * ({i}) + 1.3 * ({j}))"


def static_ctes(layers: int) -> list:
    """Per-character logits of the sine_static model (Wh = 0): each step depends
    only on its input character, so a V x V table holds every forward pass."""
    ctes = ["voc AS (SELECT id AS v FROM vocab)", f"hid AS (SELECT range AS i FROM range({H}))",
            f"h0 AS (SELECT voc.v, hid.i, tanh({_sine(0, 0, 'hid.i', 'voc.v')} + {_sine(0, 3, 'hid.i', '0')}) AS h "
            "FROM voc, hid)",
            f"y0 AS (SELECT h.v, u.v AS u, sum({_sine(0, 2, 'u.v', 'h.i')} * h.h) + {_sine(0, 4, 'u.v', '0')} AS y "
            "FROM h0 h, voc u GROUP BY h.v, u.v)"]
    for l in range(1, layers):
        ctes.append(f"h{l} AS (SELECT y.v, hid.i, tanh(sum({_sine(l, 0, 'hid.i', 'y.u')} * y.y) + "
                    f"{_sine(l, 3, 'hid.i', '0')}) AS h FROM y{l - 1} y, hid GROUP BY y.v, hid.i)")
        ctes.append(f"y{l} AS (SELECT h.v, u.v AS u, sum({_sine(l, 2, 'u.v', 'h.i')} * h.h) + "
                    f"{_sine(l, 4, 'u.v', '0')} AS y FROM h{l} h, voc u GROUP BY h.v, u.v)")
    top = f"y{layers - 1}"
    ctes.append(f"lse AS (SELECT v, ln(sum(exp(y))) AS lse FROM {top} GROUP BY v)")
    ctes.append(f"lp AS (SELECT y.v, y.u, y.y, y.y - lse.lse AS lp FROM {top} y JOIN lse USING (v))")
    return ctes


def recurrent_ctes(layers: int) -> list:
    """Tables of the sine model with ``SQL_HIDDEN`` units: ``win`` (a character's
    input to layer 0, bias added), ``wout`` (rows of the top layer's output
    weights, the bias last) and, for two layers, ``mid`` (what layer 0's state adds
    to layer 1's input through layer 0's outputs, the constant last)."""
    n = range(SQL_HIDDEN)
    ctes = ["voc AS (SELECT id AS v FROM vocab)",
            "win AS (SELECT v, [" + ", ".join(f"{_sine(0, 0, i, 'v')} + {_sine(0, 3, i, '0')}" for i in n) + "] AS w FROM voc)"]
    top = layers - 1
    ctes.append("wout AS (SELECT list([" + ", ".join(_sine(top, 2, "v", i) for i in n) + f", {_sine(top, 4, 'v', '0')}] ORDER BY v) AS o FROM voc)")
    if layers == 2:
        rows = ["[" + ", ".join(f"sum({_sine(1, 0, i, 'v')} * {_sine(0, 2, 'v', k)})" for k in n)
                + f", sum({_sine(1, 0, i, 'v')} * {_sine(0, 4, 'v', '0')}) + {_sine(1, 3, i, '0')}]" for i in n]
        ctes.append("mid AS (SELECT [" + ", ".join(rows) + "] AS m FROM voc)")
    return ctes


def _next_state(layer: int, source: str, state: str) -> str:
    """tanh(source + Wh state), unit by unit."""
    return "[" + ", ".join(
        f"tanh({source}[{i + 1}] + " + " + ".join(f"{_sine(layer, 1, i, k)} * {state}[{k + 1}]" for k in range(SQL_HIDDEN)) + ")"
        for i in range(SQL_HIDDEN)) + "]"


def _affine(rows: str, state: str) -> str:
    """Rows of weights (constant last) times a state."""
    return (f"list_transform({rows}, lambda r: " + " + ".join(f"r[{k + 1}] * {state}[{k + 1}]" for k in range(SQL_HIDDEN))
            + f" + r[{SQL_HIDDEN + 1}])")


ZERO_STATE = "[" + ", ".join(["CAST(0.0 AS DOUBLE)"] * SQL_HIDDEN) + "]"
LSE = "ln(list_sum(list_transform(y, lambda z: exp(z))))"
# inverse of the cumulative distribution: the first id if u is within its share, else those whose cumulated share is at most u
DRAWN = ("CASE WHEN u <= c[1] THEN 0 ELSE least(len(c) - 1, len(list_filter(c, lambda z: z <= u))) END")
CUMULATED = "list_transform(range(1, len(p) + 1), lambda k: list_sum(p[1:k]))"


def _rbase(*extra: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([LINES_CTE, NONEMPTY_CTE, CHARS_CTE, VOCAB_CTE, GCHARS_CTE, *extra]) + "\n"


def _model_rows(layers: int, value_sql, acc_sql="0.0") -> str:
    """All parameter rows (layer, block, i, j) of a model with H hidden units;
    value_sql(layer, bno, i, j) gives w."""
    parts = []
    for l in range(layers):
        specs = [(0, "Win", f"range({H})", "voc"), (1, "Wh", f"range({H})", f"range({H})"),
                 (2, "Wout", "voc", f"range({H})"), (3, "bh", f"range({H})", None), (4, "bout", "voc", None)]
        for bno, name, isrc, jsrc in specs:
            iexpr = "a.v" if isrc == "voc" else "a.range"
            if jsrc is None:
                jexpr, src = "0", f"{isrc} a"
            else:
                jexpr = "b.v" if jsrc == "voc" else "b.range"
                src = f"{isrc} a, {jsrc} b"
            parts.append(f"SELECT CAST({l} AS BIGINT) AS layer, '{name}' AS block, CAST({iexpr} AS BIGINT) AS i, "
                         f"CAST({jexpr} AS BIGINT) AS j, {value_sql(l, bno, iexpr, jexpr)} AS w, {acc_sql} AS acc "
                         f"FROM {src}")
    return " UNION ALL ".join(parts)


BASE_G = f"CAST({L} AS DOUBLE) / {V_SQL}"
LIM = CFG.clip
LR = CFG.learn_rate

TUMBLING_CTES = [
    CORPUS_WINDOWS_CTE,
    f"tw AS (SELECT gpos AS start, win FROM gwin WHERE gpos % {L} = 0 AND length(win) = {L + 1})",
    "nw AS (SELECT count(*) AS nw FROM tw)",
    f"tcnt AS (SELECT start, ch, count(*) AS cnt FROM (SELECT start, unnest(string_split(substr(win, 2, {L}), '')) "
    "AS ch FROM tw) GROUP BY start, ch)",
    f"pres AS (SELECT v.id, sum({clip_sql(BASE_G + ' - cnt', LIM)}) AS g_present, count(*) AS n_present "
    "FROM tcnt JOIN vocab v USING (ch) GROUP BY v.id)",
    f"bgrad AS (SELECT v.id AS i, (SELECT nw FROM nw) AS n_windows, coalesce(g_present, 0) + "
    f"((SELECT nw FROM nw) - coalesce(n_present, 0)) * {clip_sql(BASE_G, LIM)} AS g_sum "
    "FROM vocab v LEFT JOIN pres ON pres.id = v.id)",
]

ORACLES["model_init"] = _rbase("voc AS (SELECT id AS v FROM vocab)") + (
    "SELECT layer, block, i, j, round(w, 6) AS w, round(acc, 6) AS acc FROM ("
    + _model_rows(STACKED, lambda l, b, i, j: _sine(l, b, i, j)) + ")")

ORACLES["softmax_xent"] = _rbase(*static_ctes(STACKED),
    "nxt AS (SELECT id AS x, lead(id) OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS y FROM gchars)",
    "pairs AS (SELECT x, y, count(*) AS n FROM nxt WHERE y IS NOT NULL GROUP BY x, y)") + (
    "SELECT CAST(pairs.x AS BIGINT) AS input_id, CAST(pairs.y AS BIGINT) AS target_id, CAST(pairs.n AS BIGINT) AS n, "
    "round(exp(lp.lp), 6) AS p, round(-lp.lp, 6) AS xent FROM pairs JOIN lp ON lp.v = pairs.x AND lp.u = pairs.y")

ORACLES["clipped_grads"] = _rbase(*TUMBLING_CTES) + (
    "SELECT CAST(i AS BIGINT) AS i, CAST(n_windows AS BIGINT) AS n_windows, round(g_sum, 6) AS g_sum, "
    "round(g_sum / n_windows, 6) AS g_mean FROM bgrad")

ORACLES["window_grads"] = _rbase("voc AS (SELECT id AS v FROM vocab)", *TUMBLING_CTES) + (
    "SELECT m.layer, m.block, m.i, m.j, CAST((SELECT nw FROM nw) AS BIGINT) AS n_windows, "
    "round(coalesce(b.g_sum, 0.0), 6) AS g_sum, round(coalesce(b.g_sum, 0.0) / (SELECT nw FROM nw), 6) AS g_mean "
    "FROM (" + _model_rows(1, lambda l, b, i, j: "0.0") + ") m "
    "LEFT JOIN bgrad b ON m.block = 'bout' AND b.i = m.i")

ORACLES["adagrad_step"] = _rbase("voc AS (SELECT id AS v FROM vocab)", *TUMBLING_CTES) + (
    "SELECT layer, block, i, j, round(w - " + str(LR) + " * g / sqrt(acc + g * g + 1e-8), 6) AS w, "
    "round(acc + g * g, 6) AS acc FROM (SELECT m.*, CASE WHEN m.block = 'bout' THEN b.g_sum / b.n_windows "
    "ELSE 0.0 END AS g FROM (" + _model_rows(1, lambda l, b, i, j: _sine(l, b, i, j)) + ") m "
    "LEFT JOIN bgrad b ON b.i = m.i)")

ORACLES["window_loss"] = _rbase(*recurrent_ctes(STACKED),
    f"wx AS (SELECT gpos // {L} AS w, gpos % {L} AS t, id FROM gchars UNION ALL "
    f"SELECT gpos // {L} - 1, {L}, id FROM gchars WHERE gpos > 0 AND gpos % {L} = 0)",
    f"nwin AS (SELECT (count(*) - 1) // {L} AS n FROM gchars)",
    "st AS (SELECT w, 0 AS t, " + f"{ZERO_STATE} AS a, {ZERO_STATE} AS b, CAST(0.0 AS DOUBLE) AS loss "
    "FROM wx WHERE t = 0 AND w < (SELECT n FROM nwin) UNION ALL "
    f"SELECT w, t + 1, a, b, loss + {LSE} - y[target + 1] FROM ("
    f"SELECT w, t, a, b, loss, target, {_affine('(SELECT o FROM wout)', 'b')} AS y FROM ("
    f"SELECT w, t, a, {_next_state(1, 's', 'b')} AS b, loss, target FROM ("
    f"SELECT w, t, a, b, loss, target, {_affine('(SELECT m FROM mid)', 'a')} AS s FROM ("
    f"SELECT st.w, st.t, {_next_state(0, 'win.w', 'st.a')} AS a, st.b, st.loss, nx.id AS target FROM st "
    "JOIN wx ON wx.w = st.w AND wx.t = st.t JOIN win ON win.v = wx.id JOIN wx nx ON nx.w = st.w AND nx.t = st.t + 1 "
    f"WHERE st.t < {L}))))),"
    f"sd AS (SELECT w, loss FROM st WHERE t = {L})") + (
    "SELECT g.doc_id, CAST(count(*) AS BIGINT) AS n_windows, round(avg(sd.loss), 6) AS mean_loss "
    f"FROM sd JOIN gchars g ON g.gpos = sd.w * {L} GROUP BY g.doc_id")

def _line_scores() -> str:
    """Every line's characters folded through the two-layer model; the state of the
    fold is both layers' hidden units and the loss in one list."""
    n = SQL_HIDDEN
    first, second, last = f"s[1:{n}]", f"s[{n + 1}:{2 * n}]", f"s[{2 * n + 1}]"
    step = (
        f"list_transform([{_next_state(0, 'w[CAST(p[1] AS BIGINT) + 1]', first)}], lambda h: "
        f"list_transform([{_affine('m', 'h')}], lambda d: list_transform([{_next_state(1, 'd', second)}], lambda k: "
        f"list_transform([{_affine('o', 'k')}], lambda y: list_concat(list_concat(h, k), "
        f"[{last} + {LSE} - y[CAST(p[2] AS BIGINT) + 1]]))[1])[1])[1])[1]")
    return _rbase(*recurrent_ctes(STACKED),
        "lb AS (SELECT doc_id, line_no, pos, id AS x, lead(id) OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS y FROM gchars)",
        "ls AS (SELECT doc_id, line_no, list([CAST(x AS DOUBLE), CAST(y AS DOUBLE)] ORDER BY pos) AS ps FROM lb "
        "WHERE y IS NOT NULL GROUP BY doc_id, line_no)",
        "mdl AS (SELECT (SELECT list(w ORDER BY v) FROM win) AS w, (SELECT m FROM mid) AS m, (SELECT o FROM wout) AS o)",
        f"sc AS (SELECT doc_id, len(ps) AS n, list_reduce(ps, lambda s, p: {step}, "
        f"list_concat(list_concat({ZERO_STATE}, {ZERO_STATE}), [CAST(0.0 AS DOUBLE)])) AS s FROM ls, mdl)") + (
        "SELECT d.doc_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_pred, "
        f"round(sum(s[{2 * n + 1}]) / sum(n), 6) AS mean_loss, round(exp(sum(s[{2 * n + 1}]) / sum(n)), 6) AS perplexity, "
        "CAST(0 AS BIGINT) AS n_unknown FROM (SELECT DISTINCT doc_id FROM lines) d LEFT JOIN sc USING (doc_id) GROUP BY d.doc_id")


ORACLES["doc_scores"] = _line_scores()


def _zero_bias_training(hist_cte: str, n_cte: str, epochs: int, extra=()) -> str:
    """Unrolled epochs of full-batch / mini-batch training from the zero model.

    With every weight zero the hidden state stays zero, only the output bias b
    learns, and window w's gradient for char c is L*softmax(b)_c - count_w(c).
    ``hist_cte`` defines hist(epoch, c, k, m): m windows in that epoch whose
    targets hold char c exactly k >= 1 times; ``n_cte`` defines nwin(epoch, nw).
    """
    ctes = [*extra, hist_cte, n_cte,
            "s0 AS (SELECT id AS c, 0.0 AS b, 0.0 AS a FROM vocab)"]
    sels = []
    smooth_prev = f"{L} * ln({V_SQL})"
    for e in range(epochs):
        ctes += [
            f"z{e} AS (SELECT ln(sum(exp(b))) AS lse FROM s{e})",
            f"p{e} AS (SELECT c, b, a, exp(b - (SELECT lse FROM z{e})) AS p FROM s{e})",
            f"h{e} AS (SELECT c, k, m FROM hist WHERE epoch = {e})",
            f"n{e} AS (SELECT coalesce(max(nw), 0) AS nw FROM nwin WHERE epoch = {e})",
            f"g{e} AS (SELECT p.c, p.b, p.a, coalesce(sum(h.m * {clip_sql(str(L) + ' * p.p - h.k', LIM)}), 0.0) + "
            f"((SELECT nw FROM n{e}) - coalesce(sum(h.m), 0)) * {clip_sql(str(L) + ' * p.p', LIM)} AS gs, "
            f"coalesce(sum(h.m * h.k), 0) AS tc FROM p{e} p LEFT JOIN h{e} h ON h.c = p.c GROUP BY p.c, p.b, p.a, p.p)",
            f"l{e} AS (SELECT sum(tc * ((SELECT lse FROM z{e}) - b)) AS loss FROM g{e})",
            f"s{e + 1} AS (SELECT c, CASE WHEN n > 0 THEN b - {LR} * gm / sqrt(a + gm * gm + 1e-8) ELSE b END AS b, "
            f"CASE WHEN n > 0 THEN a + gm * gm ELSE a END AS a FROM (SELECT c, b, a, (SELECT nw FROM n{e}) AS n, "
            f"CASE WHEN (SELECT nw FROM n{e}) > 0 THEN gs / (SELECT nw FROM n{e}) ELSE 0.0 END AS gm FROM g{e}))",
            f"sm{e} AS (SELECT CASE WHEN (SELECT nw FROM n{e}) > 0 THEN 0.999 * ({smooth_prev}) + 0.001 * "
            f"(SELECT loss FROM l{e}) / (SELECT nw FROM n{e}) ELSE ({smooth_prev}) END AS v)",
        ]
        smooth_prev = f"(SELECT v FROM sm{e})"
        sels.append(
            f"SELECT CAST({e} AS BIGINT) AS epoch, CAST((SELECT nw FROM n{e}) AS BIGINT) AS n, "
            f"round((SELECT loss FROM l{e}) / ((SELECT nw FROM n{e}) * {L}), 6) AS loss_per_char, "
            f"round((SELECT v FROM sm{e}), 6) AS smooth_loss, round((SELECT sum(b) FROM s{e + 1}), 6) AS w_sum, "
            f"round((SELECT sum(b * b) FROM s{e + 1}), 6) AS w_sq, round((SELECT sum(a) FROM s{e + 1}), 6) AS acc_sum")
    return _rbase(*ctes) + " UNION ALL ".join(sels)


# every corpus window: sweep over target positions; window s holds target q iff q-L <= s <= q-1
T1_HIST = (
    f"hist AS (SELECT e.epoch, c, k, sum(len) AS m FROM range({T1_EPOCHS}) e(epoch), ("
    f"SELECT c, k, least(coalesce(s_next, nwall), nwall) - least(s, nwall) AS len FROM ("
    f"SELECT c, s, sum(d) OVER (PARTITION BY c ORDER BY s) AS k, lead(s) OVER (PARTITION BY c ORDER BY s) AS s_next, "
    f"(SELECT count(*) - {L} FROM gchars) AS nwall FROM ("
    f"SELECT c, s, sum(d) AS d FROM (SELECT id AS c, greatest(0, gpos - {L}) AS s, 1 AS d FROM gchars WHERE gpos >= 1 "
    "UNION ALL SELECT id AS c, gpos AS s, -1 AS d FROM gchars WHERE gpos >= 1) GROUP BY c, s))) "
    "WHERE k > 0 AND len > 0 GROUP BY e.epoch, c, k)")
T1_N = f"nwin AS (SELECT e.epoch, count(*) - {L} AS nw FROM gchars, range({T1_EPOCHS}) e(epoch) GROUP BY e.epoch)"

ORACLES["train_full_batch"] = _zero_bias_training(T1_HIST, T1_N, T1_EPOCHS)

T2_PICKED = gap_sample_ctes("picked", T2_RATE, CFG.seed, T2_EPOCHS, f"SELECT greatest(0, count(*) - {L}) FROM gchars")
T2_SAMPLED = "sw AS (SELECT e AS epoch, gpos AS start, win FROM gwin JOIN picked ON pos = gpos)"
T2_HIST = (
    f"hist AS (SELECT epoch, c, k, count(*) AS m FROM (SELECT epoch, start, v.id AS c, count(*) AS k FROM ("
    f"SELECT epoch, start, unnest(string_split(substr(win, 2, {L}), '')) AS ch FROM sw) t JOIN vocab v USING (ch) "
    "GROUP BY epoch, start, v.id) GROUP BY epoch, c, k)")
T2_N = "nwin AS (SELECT epoch, count(*) AS nw FROM sw GROUP BY epoch)"

ORACLES["train_mini_batch"] = _zero_bias_training(T2_HIST, T2_N, T2_EPOCHS, (CORPUS_WINDOWS_CTE, *T2_PICKED, T2_SAMPLED))

ORACLES["inverse_cdf_sample"] = _rbase(
    f"cdf AS (SELECT id, CAST(sum(n) OVER (ORDER BY id ROWS UNBOUNDED PRECEDING) AS DOUBLE) / "
    "CAST((SELECT sum(n) FROM vocab) AS DOUBLE) AS c FROM vocab)",
    f"d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, {uniform_sql(CFG.seed, 0, 'doc_id')} AS u FROM documents)",
    f"pick AS (SELECT d.doc_id, CASE WHEN d.u <= (SELECT c FROM cdf WHERE id = 0) THEN 0 ELSE "
    f"least({V_SQL} - 1, (SELECT count(*) FROM cdf WHERE cdf.c <= d.u)) END AS id FROM d)") + (
    "SELECT pick.doc_id, CAST(pick.id AS BIGINT) AS id, v.ch FROM pick JOIN vocab v ON v.id = pick.id")

BREAK = "'\\r\\n|\\r|\\n', '', 'g'"
PROMPTS_CTE = (f"pr0 AS (SELECT CAST(item_id AS BIGINT) AS prompt_id, regexp_replace(text, {BREAK}) AS t FROM benchmark),\n"
               "p0 AS (SELECT prompt_id, v.id AS seed_id FROM pr0 LEFT JOIN vocab v ON v.ch = substr(t, 1, 1) AND length(t) > 0)")
# inverse-CDF intervals of the next-character distribution after each char (disjoint):
# k=0: u <= c0; k=1: c0 < u < c1; 2<=k<V-1: c(k-1) <= u < ck; k=V-1: u beyond c(V-2)
INTERVALS_CTES = [
    "pr AS (SELECT v, u, exp(y) / sum(exp(y)) OVER (PARTITION BY v) AS p FROM y0)",
    "cd AS (SELECT v, u, sum(p) OVER (PARTITION BY v ORDER BY u ROWS UNBOUNDED PRECEDING) AS c FROM pr)",
    "iv AS (SELECT v, u AS k, lag(c) OVER (PARTITION BY v ORDER BY u) AS lo, c AS hi FROM cd)",
]


def _interval_match(u: str) -> str:
    top = f"({V_SQL} - 1)"
    return (f"((iv.k = 0 AND {u} <= iv.hi) OR (iv.k = 1 AND iv.k < {top} AND {u} > iv.lo AND {u} < iv.hi) OR "
            f"(iv.k >= 2 AND iv.k < {top} AND {u} >= iv.lo AND {u} < iv.hi) OR "
            f"(iv.k = {top} AND iv.k >= 1 AND ((iv.k = 1 AND {u} > iv.lo) OR (iv.k > 1 AND {u} >= iv.lo))))")


def _generated(pick: str) -> str:
    """Every prompt's state carried along; ``pick`` chooses the next id from ``y`` (and ``u``)."""
    return _rbase(*recurrent_ctes(1), PROMPTS_CTE,
        f"gen AS (SELECT prompt_id, seed_id, 0 AS t, seed_id AS cur, {ZERO_STATE} AS h, '' AS text FROM p0 "
        "WHERE seed_id IS NOT NULL UNION ALL "
        "SELECT prompt_id, seed_id, t + 1, k, h, text || voc2.ch FROM ("
        f"SELECT *, {pick} AS k FROM (SELECT *, {CUMULATED} AS c, {uniform_sql(CFG.seed, 'prompt_id', 't')} AS u FROM ("
        f"SELECT *, list_transform(y, lambda z: exp(z) / tot) AS p FROM ("
        "SELECT *, list_sum(list_transform(y, lambda z: exp(z))) AS tot FROM ("
        f"SELECT *, {_affine('(SELECT o FROM wout)', 'h')} AS y FROM ("
        f"SELECT g.prompt_id, g.seed_id, g.t, g.text, {_next_state(0, 'win.w', 'g.h')} AS h FROM gen g "
        f"JOIN win ON win.v = g.cur WHERE g.t < {GEN_STEPS})))))) JOIN vocab voc2 ON voc2.id = k)") + (
        "SELECT p0.prompt_id, CAST(p0.seed_id AS BIGINT) AS seed_id, gen.text FROM p0 "
        f"LEFT JOIN gen ON gen.prompt_id = p0.prompt_id AND gen.t = {GEN_STEPS}")


ORACLES["generate_greedy"] = _generated("list_position(y, list_max(y)) - 1")
ORACLES["generate_sampled"] = _generated(DRAWN)

ORACLES["free_running_loss"] = _rbase(*recurrent_ctes(1),
    f"items AS (SELECT CAST(item_id AS BIGINT) AS prompt_id, regexp_replace(coalesce(text, ''), {BREAK}) AS t FROM benchmark)",
    "ic AS (SELECT i.prompt_id, u.ord, v.id FROM items i, unnest(string_split(i.t, '')) WITH ORDINALITY AS u(ch, ord) "
    "LEFT JOIN vocab v ON v.ch = u.ch WHERE i.t <> '')",
    "known AS (SELECT prompt_id, id, row_number() OVER (PARTITION BY prompt_id ORDER BY ord) - 1 AS t FROM ic WHERE id IS NOT NULL)",
    "size AS (SELECT i.prompt_id, count(ic.id) AS n, count(ic.ord) - count(ic.id) AS unknown FROM items i "
    "LEFT JOIN ic USING (prompt_id) GROUP BY i.prompt_id)",
    f"run AS (SELECT prompt_id, t, id AS cur, {ZERO_STATE} AS h, CAST(0.0 AS DOUBLE) AS loss FROM known WHERE t = 0 UNION ALL "
    f"SELECT prompt_id, t + 1, {DRAWN}, h, loss + CASE WHEN t >= {EVAL_OFFSET} THEN ln(tot) - y[target + 1] ELSE 0.0 END FROM ("
    f"SELECT *, {CUMULATED} AS c, {uniform_sql(CFG.seed, 'prompt_id', 't')} AS u FROM ("
    "SELECT *, list_transform(y, lambda z: exp(z) / tot) AS p FROM ("
    "SELECT *, list_sum(list_transform(y, lambda z: exp(z))) AS tot FROM ("
    f"SELECT *, {_affine('(SELECT o FROM wout)', 'h')} AS y FROM ("
    f"SELECT r.prompt_id, r.t, r.loss, k.id AS target, {_next_state(0, 'win.w', 'r.h')} AS h FROM run r "
    "JOIN known k ON k.prompt_id = r.prompt_id AND k.t = r.t + 1 JOIN win ON win.v = r.cur))))))") + (
    f"SELECT s.prompt_id, CAST(greatest(0, s.n - 1 - {EVAL_OFFSET}) AS BIGINT) AS n_scored, "
    "CAST(s.unknown AS BIGINT) AS n_unknown, round(coalesce(r.loss, 0.0), 6) AS loss "
    "FROM size s LEFT JOIN run r ON r.prompt_id = s.prompt_id AND r.t = s.n - 1")


def _zero_sequence_training(unit: str, rate: float, epochs: int, parts: bool = False):
    """Unrolled epochs of local training + averaging from the zero model.

    Each sampled sequence starts from the global output bias b and accumulator
    a (lists of V doubles) and steps through its chunks with AdaGrad: chunk
    gradient clip(L*softmax(b) - counts); a recursive CTE per epoch carries
    (b, a, loss) from chunk to chunk.  Sequences without a chunk keep (b, a).
    """
    if unit == "paragraph":
        seqs = "seqs AS (SELECT doc_id, line_no, CAST(length(line) AS BIGINT) AS n FROM nonempty)"
        chunks = f"greatest(0, CAST(ceil((n - 1) / {float(L)}) AS BIGINT) - 1)"
        sc = "sc AS (SELECT doc_id, line_no, pos AS q, id FROM gchars)"
        keys = ("s.doc_id", "s.line_no")
    else:
        seqs = "seqs AS (SELECT doc_id, CAST(-1 AS BIGINT) AS line_no, count(*) AS n FROM gchars GROUP BY doc_id)"
        chunks = f"(n - 1) // {L}"
        sc = ("sc AS (SELECT doc_id, CAST(-1 AS BIGINT) AS line_no, "
              "row_number() OVER (PARTITION BY doc_id ORDER BY line_no, pos) - 1 AS q, id FROM gchars)")
        keys = ("s.doc_id",)
    keep = keep_sql(rate, CFG.seed, "e.epoch", *keys) if rate < 1.0 else "TRUE"
    clip_z = clip_sql(f"{L} * exp(z[1] - r.lse) - z[2]", LIM)
    ctes = [seqs, sc,
            f"samp AS (SELECT e.epoch, s.doc_id, s.line_no, s.n, {chunks} AS ch FROM seqs s, range({epochs}) e(epoch) "
            f"WHERE {keep})",
            "need AS (SELECT DISTINCT doc_id, line_no, ch FROM samp WHERE ch > 0)",
            f"tk AS (SELECT sc.doc_id, sc.line_no, (sc.q - 1) // {L} AS k, sc.id, count(*) AS cnt FROM sc "
            f"JOIN need USING (doc_id, line_no) WHERE sc.q >= 1 AND (sc.q - 1) // {L} < need.ch "
            "GROUP BY sc.doc_id, sc.line_no, (sc.q - 1) // 25, sc.id)".replace("// 25", f"// {L}"),
            "ks AS (SELECT doc_id, line_no, unnest(range(ch)) AS k FROM need)",
            "cl AS (SELECT ks.doc_id, ks.line_no, ks.k, list(CAST(coalesce(tk.cnt, 0) AS DOUBLE) ORDER BY v.id) AS cnt "
            "FROM ks CROSS JOIN vocab v LEFT JOIN tk ON tk.doc_id = ks.doc_id AND tk.line_no = ks.line_no "
            "AND tk.k = ks.k AND tk.id = v.id GROUP BY ks.doc_id, ks.line_no, ks.k)",
            "st0 AS (SELECT list(CAST(0.0 AS DOUBLE) ORDER BY id) AS b, list(CAST(0.0 AS DOUBLE) ORDER BY id) AS a "
            "FROM vocab)"]
    sels = []
    smooth_prev = f"{L} * ln({V_SQL})"
    for e in range(epochs):
        ctes += [
            f"r{e} AS (SELECT s.doc_id, s.line_no, s.ch, 0 AS k, g.b, g.a, CAST(0.0 AS DOUBLE) AS loss "
            f"FROM samp s, st{e} g WHERE s.epoch = {e} AND s.ch > 0 UNION ALL "
            "SELECT doc_id, line_no, ch, k + 1, "
            f"list_transform(list_zip(b, gg, a2), lambda z: z[1] - {LR} * z[2] / sqrt(z[3] + 1e-8)), a2, loss + dl "
            "FROM (SELECT *, list_transform(list_zip(a, gg), lambda z: z[1] + z[2] * z[2]) AS a2 FROM ("
            f"SELECT r.doc_id, r.line_no, r.ch, r.k, r.b, r.a, r.loss, "
            f"list_transform(list_zip(r.b, cl.cnt), lambda z: {clip_z}) AS gg, "
            f"{L} * r.lse - list_sum(list_transform(list_zip(cl.cnt, r.b), lambda z: z[1] * z[2])) AS dl "
            f"FROM (SELECT *, ln(list_sum(list_transform(b, lambda x: exp(x)))) AS lse FROM r{e} WHERE k < ch) r "
            "JOIN cl ON cl.doc_id = r.doc_id AND cl.line_no = r.line_no AND cl.k = r.k)))",
            f"fin{e} AS (SELECT * FROM r{e} WHERE k = ch)",
            f"cnt{e} AS (SELECT count(*) AS n, coalesce(sum(n), 0) AS len, coalesce(sum(ch), 0) AS chunks, coalesce(sum(CASE WHEN ch = 0 THEN 1 ELSE 0 END), 0) "
            f"AS idle FROM samp WHERE epoch = {e})",
            f"el{e} AS (SELECT i, sum(bv) AS bs, sum(av) AS acs FROM (SELECT unnest(b) AS bv, unnest(a) AS av, "
            f"generate_subscripts(b, 1) AS i FROM fin{e} UNION ALL SELECT unnest(b) * (SELECT idle FROM cnt{e}), "
            f"unnest(a) * (SELECT idle FROM cnt{e}), generate_subscripts(b, 1) FROM st{e}) GROUP BY i)",
            f"st{e + 1} AS (SELECT CASE WHEN (SELECT n FROM cnt{e}) > 0 THEN (SELECT list(bs / (SELECT n FROM cnt{e}) "
            f"ORDER BY i) FROM el{e}) ELSE (SELECT b FROM st{e}) END AS b, CASE WHEN (SELECT n FROM cnt{e}) > 0 THEN "
            f"(SELECT list(acs / (SELECT n FROM cnt{e}) ORDER BY i) FROM el{e}) ELSE (SELECT a FROM st{e}) END AS a)",
            f"ls{e} AS (SELECT coalesce(sum(loss), 0.0) AS loss FROM fin{e})",
            f"sm{e} AS (SELECT CASE WHEN (SELECT chunks FROM cnt{e}) > 0 THEN 0.999 * ({smooth_prev}) + 0.001 * "
            f"(SELECT loss FROM ls{e}) / (SELECT chunks FROM cnt{e}) ELSE ({smooth_prev}) END AS v)",
        ]
        smooth_prev = f"(SELECT v FROM sm{e})"
        sels.append(
            f"SELECT CAST({e} AS BIGINT) AS epoch, CAST((SELECT n FROM cnt{e}) AS BIGINT) AS n, "
            f"round((SELECT loss FROM ls{e}) / (SELECT len FROM cnt{e}), 6) AS loss_per_char, "
            f"round((SELECT v FROM sm{e}), 6) AS smooth_loss, round(list_sum((SELECT b FROM st{e + 1})), 6) AS w_sum, "
            f"round(list_sum(list_transform((SELECT b FROM st{e + 1}), lambda x: x * x)), 6) AS w_sq, "
            f"round(list_sum((SELECT a FROM st{e + 1})), 6) AS acc_sum")
    if parts:
        return ctes, sels
    return _rbase(*ctes) + " UNION ALL ".join(sels)


from charloom.queries import T3_EPOCHS, T3_RATE  # noqa: E402

ORACLES["train_param_avg"] = _zero_sequence_training("paragraph", T3_RATE, T3_EPOCHS)


def _zero_document_training(epochs: int) -> str:
    """The same training over whole documents: a document's chunks are one list of
    count vectors, folded from the global bias and accumulator; the state of the
    fold is the bias, the accumulator and the loss in one list."""
    b, a, last = "s[1:len(x)]", "s[len(x) + 1:2 * len(x)]", "s[2 * len(x) + 1]"
    step = (
        f"list_transform([ln(list_sum(list_transform({b}, lambda q: exp(q))))], lambda lse: "
        f"list_transform([list_transform(list_zip({b}, x), lambda z: {clip_sql(f'({L} * exp(z[1] - lse) - z[2])', LIM)})], lambda g: "
        f"list_concat(list_concat("
        f"list_transform(list_zip({b}, g, {a}), lambda z: z[1] - {LR} * z[2] / sqrt(z[3] + z[2] * z[2] + 1e-8)), "
        f"list_transform(list_zip(g, {a}), lambda z: z[2] + z[1] * z[1])), "
        f"[{last} + {L} * lse - list_sum(list_transform(list_zip(x, {b}), lambda z: z[1] * z[2]))]))[1])[1]")
    ctes = [
        "sc AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, pos) - 1 AS q, id FROM gchars)",
        f"size AS (SELECT doc_id, count(*) AS n, (count(*) - 1) // {L} AS ch FROM sc GROUP BY doc_id)",
        f"tk AS (SELECT doc_id, (q - 1) // {L} AS k, sc.id, count(*) AS cnt FROM sc JOIN size USING (doc_id) "
        f"WHERE q >= 1 AND (q - 1) // {L} < ch GROUP BY ALL)",
        "ks AS (SELECT doc_id, unnest(range(ch)) AS k FROM size WHERE ch > 0)",
        "cl AS (SELECT ks.doc_id, ks.k, list(CAST(coalesce(tk.cnt, 0) AS DOUBLE) ORDER BY v.id) AS x FROM ks CROSS JOIN vocab v "
        "LEFT JOIN tk ON tk.doc_id = ks.doc_id AND tk.k = ks.k AND tk.id = v.id GROUP BY ks.doc_id, ks.k)",
        "dl AS (SELECT doc_id, list(x ORDER BY k) AS xs FROM cl GROUP BY doc_id)",
        "tot AS (SELECT count(*) AS n, sum(n) AS len, sum(ch) AS chunks, sum(CASE WHEN ch = 0 THEN 1 ELSE 0 END) AS idle FROM size)",
        "s0 AS (SELECT list(CAST(0.0 AS DOUBLE) ORDER BY id) AS b, list(CAST(0.0 AS DOUBLE) ORDER BY id) AS a FROM vocab)"]
    sels, smooth = [], f"{L} * ln({V_SQL})"
    for e in range(epochs):
        ctes += [
            f"f{e} AS MATERIALIZED (SELECT list_reduce(d.xs, lambda s, x: {step}, "
            f"list_concat(list_concat(g.b, g.a), [CAST(0.0 AS DOUBLE)])) AS s FROM dl d, s{e} g)",
            f"u{e} AS (SELECT i, sum(v) AS v FROM (SELECT unnest(s) AS v, generate_subscripts(s, 1) AS i FROM f{e} UNION ALL "
            f"SELECT unnest(list_concat(b, a)) * (SELECT idle FROM tot), generate_subscripts(list_concat(b, a), 1) FROM s{e}) GROUP BY i)",
            f"s{e + 1} AS (SELECT list(v / (SELECT n FROM tot) ORDER BY i) FILTER (i <= {V_SQL}) AS b, "
            f"list(v / (SELECT n FROM tot) ORDER BY i) FILTER (i > {V_SQL} AND i <= 2 * {V_SQL}) AS a FROM u{e})",
            f"l{e} AS (SELECT v AS loss FROM u{e} WHERE i = 2 * {V_SQL} + 1)",
            f"m{e} AS (SELECT 0.999 * ({smooth}) + 0.001 * (SELECT loss FROM l{e}) / (SELECT chunks FROM tot) AS v)"]
        smooth = f"(SELECT v FROM m{e})"
        sels.append(
            f"SELECT CAST({e} AS BIGINT) AS epoch, CAST((SELECT n FROM tot) AS BIGINT) AS n, "
            f"round((SELECT loss FROM l{e}) / (SELECT len FROM tot), 6) AS loss_per_char, round({smooth}, 6) AS smooth_loss, "
            f"round(list_sum(b), 6) AS w_sum, round(list_sum(list_transform(b, lambda z: z * z)), 6) AS w_sq, "
            f"round(list_sum(a), 6) AS acc_sum FROM s{e + 1}")
    return _rbase(*ctes) + " UNION ALL ".join(sels)


from charloom.queries import T4_EPOCHS  # noqa: E402

ORACLES["train_per_document"] = _zero_document_training(T4_EPOCHS)


# conversations: turns in order, line breaks dropped, one sequence per conversation
CONV_CTES = [
    "turns AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, "
    "regexp_replace(text, '\\r\\n|\\r|\\n', '', 'g') AS t FROM conversations)",
    "cchars AS (SELECT conv_id, turn, u.ord AS pos, u.ch FROM turns, "
    "unnest(string_split(t, '')) WITH ORDINALITY AS u(ch, ord) WHERE t <> '')",
    "vocab AS (SELECT ch, CAST(row_number() OVER (ORDER BY ch) - 1 AS INTEGER) AS id FROM "
    "(SELECT DISTINCT ch FROM cchars))",
]
ORACLES["carried_state_loss"] = "WITH RECURSIVE " + ",\n".join(CONV_CTES + recurrent_ctes(1) + [
    "seq AS (SELECT c.conv_id, v.id, row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn, c.pos) - 1 AS k "
    "FROM cchars c JOIN vocab v USING (ch))",
    "size AS (SELECT t.conv_id, count(s.id) AS n FROM (SELECT DISTINCT conv_id FROM turns) t LEFT JOIN seq s USING (conv_id) GROUP BY 1)",
    f"run AS (SELECT conv_id, k, id AS cur, {ZERO_STATE} AS h, CAST(0.0 AS DOUBLE) AS loss FROM seq WHERE k = 0 UNION ALL "
    f"SELECT conv_id, k + 1, target, h, loss + {LSE} - y[target + 1] FROM ("
    f"SELECT *, {_affine('(SELECT o FROM wout)', 'h')} AS y FROM ("
    f"SELECT r.conv_id, r.k, r.loss, s.id AS target, {_next_state(0, 'win.w', 'r.h')} AS h FROM run r "
    "JOIN seq s ON s.conv_id = r.conv_id AND s.k = r.k + 1 JOIN win ON win.v = r.cur)))",
]) + (" SELECT s.conv_id, CAST(greatest(0, s.n - 1) AS BIGINT) AS n_pred, CAST(0 AS BIGINT) AS n_unknown, "
      "round(CASE WHEN s.n > 1 THEN r.loss / (s.n - 1) END, 6) AS mean_loss "
      "FROM size s LEFT JOIN run r ON r.conv_id = s.conv_id AND r.k = s.n - 1")


def _samples_after_epochs() -> str:
    """G6 with the zero model: after epoch e only the output bias b_e is
    non-zero, so every step samples from softmax(b_e) whatever the input."""
    from charloom.queries import SAMPLE_LEN
    ctes, _ = _zero_sequence_training("paragraph", T3_RATE, T3_EPOCHS, parts=True)
    ctes = list(ctes) + [PROMPTS_CTE]
    sels = []
    for e in range(T3_EPOCHS):
        ctes += [
            f"dist{e} AS (SELECT i - 1 AS k, exp(bv) / sum(exp(bv)) OVER () AS p FROM "
            f"(SELECT unnest(b) AS bv, generate_subscripts(b, 1) AS i FROM st{e + 1}))",
            f"iv{e} AS (SELECT k, lag(c) OVER (ORDER BY k) AS lo, c AS hi FROM "
            f"(SELECT k, sum(p) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS c FROM dist{e}))",
            f"draw{e} AS (SELECT p0.prompt_id, t.t, {uniform_sql(CFG.seed, 'p0.prompt_id', 't.t')} AS u "
            f"FROM p0, range({SAMPLE_LEN}) t(t) WHERE p0.seed_id IS NOT NULL)",
        ]
        sels.append(
            f"SELECT CAST({e} AS BIGINT) AS epoch, d.prompt_id, string_agg(v.ch, '' ORDER BY d.t) AS text "
            f"FROM draw{e} d JOIN iv{e} iv ON {_interval_match('d.u')} JOIN vocab v ON v.id = iv.k "
            "GROUP BY d.prompt_id")
    return _rbase(*ctes) + " UNION ALL ".join(sels)


ORACLES["training_samples"] = _samples_after_epochs()


# ---------------------------------------------------------------- training from non-zero weights
from charloom.functions import sql_rnn as R  # noqa: E402
from charloom.queries import SINE, SINE_RATE, SINE_SEQUENCE_RATE  # noqa: E402

# the item texts in place of the documents
ITEMS_CTE = "documents AS (SELECT item_id AS doc_id, text FROM benchmark)"
SINE_CTES = R.sine_model(SINE.hidden)
SHAPE = (SINE.hidden, L, SINE.clip)


def _steps(starts: str) -> str:
    """``ws(e, w, t, x, y)`` from the windows ``(e, w)`` that start at character ``w``."""
    return (f"ws AS (SELECT s.e, s.w, r.range + 1 AS t, g.id AS x, n.id AS y FROM ({starts}) s CROSS JOIN range({L}) r "
            "JOIN gchars g ON g.gpos = s.w + r.range JOIN gchars n ON n.gpos = s.w + r.range + 1)")


def _per_window(before: str, e: int) -> str:
    return (f"CASE WHEN (SELECT n FROM loss{e}) > 0 THEN 0.999 * ({before}) + 0.001 * (SELECT loss / n FROM loss{e}) ELSE {before} END")


def _per_chunk(before: str, e: int) -> str:
    return (f"CASE WHEN (SELECT chunks FROM tot{e}) > 0 THEN 0.999 * ({before}) + 0.001 * (SELECT loss / chunks FROM tot{e}) ELSE {before} END")


ORACLES["window_grads_sine"] = _rbase(
    *SINE_CTES, _steps(f"SELECT 0 AS e, gpos AS w FROM gchars WHERE gpos % {L} = 0 AND gpos + {L} < (SELECT count(*) FROM gchars)"),
    *R.window_gradients(0, *SHAPE)) + (
    "SELECT block, m.i::BIGINT AS i, m.j::BIGINT AS j, (SELECT n FROM loss0) AS n_windows, round(coalesce(g, 0.0), 3) AS g_sum, "
    "round(coalesce(g, 0.0) / (SELECT n FROM loss0), 8) AS g_mean FROM m0 m LEFT JOIN g0 USING (block, i, j)")


def _window_training_sine(ctes: list, starts: str, picked=()) -> str:
    more, selects = R.window_training(SINE.epochs, *SHAPE, SINE.learn_rate, _per_window)
    base = _rbase(*SINE_CTES, *picked, _steps(starts), *more)
    return base.replace("WITH RECURSIVE ", "WITH RECURSIVE " + "".join(c + ",\n" for c in ctes), 1) + " UNION ALL ".join(selects)


ORACLES["train_full_batch_sine"] = _window_training_sine([ITEMS_CTE], (
    f"SELECT r.range AS e, gpos AS w FROM gchars, range({SINE.epochs}) r WHERE gpos + {L} < (SELECT count(*) FROM gchars)"))
ORACLES["train_mini_batch_sine"] = _window_training_sine(
    [], "SELECT e, pos AS w FROM picked",
    gap_sample_ctes("picked", SINE_RATE, SINE.seed, SINE.epochs, f"SELECT greatest(0, count(*) - {L}) FROM gchars"))


def _sequences(unit: str) -> list:
    """``chunks(e, q, n, cs)`` of the item texts: paragraphs or whole texts."""
    by = "doc_id, line_no" if unit == "paragraph" else "doc_id"
    count = f"greatest(0, CAST(ceil((n - 1) / {float(L)}) AS BIGINT) - 1)" if unit == "paragraph" else f"(n - 1) // {L}"
    kept = keep_sql(SINE_SEQUENCE_RATE, SINE.seed, "r.range", "doc_id", "line_no") if unit == "paragraph" else "TRUE"
    return [f"seqs AS (SELECT {by}, count(*) AS n, list(id ORDER BY gpos) AS ids FROM gchars GROUP BY {by})",
            f"chunks AS MATERIALIZED (SELECT r.range AS e, doc_id AS q, n, ids, list_transform(range({count}), "
            f"lambda z: ids[{L} * z + 1:{L} * z + {L + 1}]) AS cs FROM seqs, range({SINE.epochs}) r WHERE {kept})"]


def _sequence_training_sine(unit: str) -> str:
    more, selects = R.sequence_training("chunks", SINE.epochs, *SHAPE, SINE.learn_rate, _per_chunk)
    base = _rbase(*SINE_CTES, *_sequences(unit), *more)
    return base.replace("WITH RECURSIVE ", f"WITH RECURSIVE {ITEMS_CTE},\n", 1) + " UNION ALL ".join(selects)


ORACLES["train_param_avg_sine"] = _sequence_training_sine("paragraph")
ORACLES["train_per_document_sine"] = _sequence_training_sine("document")
ORACLES["train_resumed_sine"] = ORACLES["train_param_avg_sine"]


def _state_samples_sine() -> str:
    n, more = SINE.hidden, R.sequence_training("chunks", SINE.epochs, *SHAPE, SINE.learn_rate, _per_chunk)[0]
    ctes, selects = [*SINE_CTES, *_sequences("document"), *more], []
    size = f"(2 * {n} * v + {n * n + n} + v)"
    for e in range(SINE.epochs):
        state = ", ".join(f"tanh(w[{i} * v + cur + 1] + w[2 * {n} * v + {n * n + i + 1}] + "
                          + " + ".join(f"w[{n} * v + {n * i + k + 1}] * h[{k + 1}]" for k in range(n)) + ")" for i in range(n))
        logits = (f"list_transform(range(v), lambda z: w[2 * {n} * v + {n * n + n} + z + 1] + "
                  + " + ".join(f"w[{n} * v + {n * n} + {n} * z + {k + 1}] * h[{k + 1}]" for k in range(n)) + ")")
        ctes.append(
            f"gen{e} AS (SELECT q AS prompt_id, 0 AS t, ids[{L} * ch + 1] AS cur, s[2 * {size} + 1:2 * {size} + {n}] AS h, '' AS text, v "
            f"FROM q{e}, (SELECT count(*) AS v FROM vocab) UNION ALL SELECT prompt_id, t + 1, k, h, text || vocab.ch, v FROM ("
            f"SELECT *, {DRAWN} AS k FROM (SELECT *, {CUMULATED} AS c, {uniform_sql(CFG.seed, 'prompt_id', 't')} AS u FROM ("
            "SELECT *, list_transform(y, lambda z: exp(z) / tot) AS p FROM (SELECT *, list_sum(list_transform(y, lambda z: exp(z))) AS tot FROM ("
            f"SELECT *, {logits} AS y FROM (SELECT prompt_id, t, text, v, w, [{state}] AS h FROM gen{e}, l{e + 1} "
            f"WHERE t < {GEN_STEPS})))))) x JOIN vocab ON vocab.id = x.k)")
        selects.append(f"SELECT CAST({e} AS BIGINT) AS epoch, prompt_id, text FROM gen{e} WHERE t = {GEN_STEPS}")
    return _rbase(*ctes).replace("WITH RECURSIVE ", f"WITH RECURSIVE {ITEMS_CTE},\n", 1) + " UNION ALL ".join(selects)


ORACLES["state_samples_sine"] = _state_samples_sine()

# the closed form of the running average over the windows of window_loss
ORACLES["smoothed_loss"] = ORACLES["window_loss"].rsplit("SELECT g.doc_id", 1)[0] + (
    "SELECT doc_id, count(*) AS n_steps, round(arg_max(smooth, w), 6) AS smooth_loss FROM (SELECT g.doc_id, w, pow(0.999, w + 1) * "
    f"({L} * ln({V_SQL}) + sum(0.001 * loss / pow(0.999, w + 1)) OVER (ORDER BY w)) AS smooth FROM sd JOIN gchars g ON g.gpos = sd.w * {L}) "
    "GROUP BY doc_id")
