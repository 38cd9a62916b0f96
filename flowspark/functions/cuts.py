"""Where a flow ends, for one bounded run of packets of one connection.

Only the active timeout depends on where the previous flow started, so a run of packets is
described as a function from "state of the open flow on entry" to "state on exit". Such
functions compose, which lets the blocks of a very large connection be worked on in parallel.

State of an open flow: its first packet (number, time, direction) and the FINs it has seen
(0, 1, or 2 = closed). The choice between entry states is a step function of the flow's start
time, stored as ascending thresholds and one more outcome than there are thresholds.
"""

from __future__ import annotations

import numpy as np

CLOSED = 2
NEVER = np.iinfo(np.int64).max


def first_above(ts: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each i the first j > i with ts[j] > limit[i], else len(ts)."""
    n = len(ts)
    if n < 2 or (ts[1:] >= ts[:-1]).all():
        return np.maximum(np.searchsorted(ts, limit, side="right"), np.arange(1, n + 1))
    # Out-of-order times: skip power-of-two stretches whose maximum stays within the limit.
    maxima = [ts]
    while 2 << (len(maxima) - 1) <= n:
        last, half = maxima[-1], 1 << (len(maxima) - 1)
        maxima.append(np.maximum(last[:-half], last[half:]))
    pos = np.arange(1, n + 1)
    for level in range(len(maxima) - 1, -1, -1):
        fits = pos + (1 << level) <= n
        top = maxima[level][np.where(fits, pos, 0)]
        pos = np.where(fits & (top <= limit), pos + (1 << level), pos)
    return pos


def next_starts(ts, fin, hard, active_us) -> np.ndarray:
    """For a flow starting at i, the position of the flow after it (len(ts) when not in this run)."""
    n = len(ts)
    at = np.arange(n)
    fins = np.flatnonzero(fin)
    second = np.searchsorted(fins, at, side="left") + 1
    after_fin = np.append(fins + 1, [n, n])[np.minimum(second, len(fins))]
    edges = np.append(np.flatnonzero(hard), n)
    nxt = np.minimum(after_fin, edges[np.searchsorted(edges[:-1], at, side="right")])
    if active_us is not None:
        nxt = np.minimum(nxt, first_above(ts, ts + active_us))
    return nxt


def walk(nxt: np.ndarray, first: int) -> np.ndarray:
    """Positions of all flow starts when a flow starts at `first`."""
    n, at, starts = len(nxt), first, []
    while at < n:
        starts.append(at)
        at = int(nxt[at])
    return np.array(starts, dtype=np.int64)


def late_starts(ts, fin, hard, active_us) -> np.ndarray:
    """Positions of flow starts that only the active timeout explains."""
    given = next_starts(ts, fin, hard, None)
    starts = walk(np.minimum(given, first_above(ts, ts + active_us)), 0)
    return starts[1:][starts[1:] < given[starts[:-1]]]


def first_cut(ts, fin, hard, active_us, start_ts: int, fins_seen: int) -> int:
    """Position of the first packet that does not belong to the flow open on entry."""
    n = len(ts)
    if fins_seen >= CLOSED or hard[0]:
        return 0
    fins, edges = np.flatnonzero(fin), np.flatnonzero(hard)
    need = 1 - fins_seen
    cut = min(fins[need] + 1 if len(fins) > need else n, edges[0] if len(edges) else n)
    if active_us is not None:
        late = np.flatnonzero(ts > start_ts + active_us)
        cut = min(cut, late[0] if len(late) else n)
    return int(cut)


def _squeeze(thr, *outs):
    """Drop thresholds whose two sides have the same outcome."""
    if len(thr) == 0:
        return (thr, *outs)
    differs = np.zeros(len(thr), dtype=bool)
    for o in outs:
        differs |= o[1:] != o[:-1]
    keep = np.append(differs, True)
    return (thr[differs], *(np.append(o[:-1][differs], o[-1]) for o in outs)) if not keep.all() else (thr, *outs)


def run_table(pkt, ts, direction, fin, hard, active_us, max_before: int, min_before: int = -NEVER - 1) -> dict:
    """The run as a function of the entry state: {fins seen: (thresholds, pkt, ts, dir, fins, flows)}.

    `flows` counts the flows started in the run; 0 means the entry flow is still open. max_before and min_before bound
    the times of all packets before the run: no entry flow started outside them.
    """
    n = len(ts)
    nxt = next_starts(ts, fin, hard, active_us)
    jump = np.where(nxt < n, nxt, np.arange(n))
    flows = (nxt < n).astype(np.int64)
    while True:  # pointer doubling: last flow start reached from each position
        further = jump[jump]
        if (further == jump).all():
            break
        flows = flows + flows[jump]
        jump = further
    fins_from = np.append(np.cumsum(fin[::-1])[::-1], 0)
    total_fins = int(fins_from[0])

    def outcome(positions):
        last = jump[positions]
        return (pkt[last], ts[last], direction[last].astype(np.int64),
                np.minimum(fins_from[last], CLOSED).astype(np.int64), flows[positions] + 1)

    table = {CLOSED: (np.array([], dtype=np.int64), *outcome(np.array([0])))}
    for seen in (0, 1):
        stop = first_cut(ts, fin, hard, None, 0, seen)
        if active_us is None or stop == 0:
            thr, at = np.array([], dtype=np.int64), np.array([], dtype=np.int64)
        else:
            top = np.maximum.accumulate(ts[:stop])
            at = np.flatnonzero(np.append(True, top[1:] > top[:-1]))
            thr = top[at] - active_us
            thr, at = (x[np.searchsorted(thr, min_before, side="right"):] for x in (thr, at))
        known = np.searchsorted(thr, max_before, side="right")
        if known < len(thr):  # no entry flow started that late
            thr, outs = thr[:known], outcome(at[:known + 1])
        elif stop < n:
            outs = outcome(np.append(at, stop))
        else:
            outs = tuple(
                np.append(o, v) for o, v in zip(outcome(at), (-1, 0, 0, min(seen + total_fins, CLOSED), 0))
            )
        table[seen] = _squeeze(thr, *outs)
    return table


def apply_table(table: dict, state: tuple) -> tuple:
    """Exit state (pkt, ts, dir, fins, flows so far) for one entry state of the same form."""
    pkt, ts, direction, fins, flows = state
    thr, *outs = table[min(fins, CLOSED)]
    i = int(np.searchsorted(thr, ts, side="right"))
    o_pkt, o_ts, o_dir, o_fins, o_flows = (int(o[i]) for o in outs)
    if o_flows == 0:
        return pkt, ts, direction, o_fins, flows
    return o_pkt, o_ts, o_dir, o_fins, flows + o_flows


def chain(first: dict, second: dict, max_before: int) -> dict:
    """The function that applies `first` and then `second`."""
    joined = {}
    for seen, (thr, *outs) in first.items():
        parts = [np.array(o, dtype=np.int64) for o in outs]
        pkt, ts, direction, fins, flows = parts
        res = [p.copy() for p in parts]
        for state in (0, 1, CLOSED):
            s_thr, *s_outs = second[state]
            pick = (fins == state) & (flows > 0)
            if not pick.any():
                continue
            i = np.searchsorted(s_thr, ts[pick], side="right")
            n_pkt, n_ts, n_dir, n_fins, n_flows = (o[i] for o in s_outs)
            moved = n_flows > 0
            for r, old, new in zip(res[:3], (pkt, ts, direction), (n_pkt, n_ts, n_dir)):
                r[pick] = np.where(moved, new, old[pick])
            res[3][pick] = n_fins
            res[4][pick] = flows[pick] + n_flows
        if flows[-1] == 0:  # the entry flow may outlive the first run: split that step further
            low = thr[-1] if len(thr) else np.iinfo(np.int64).min
            s_thr, *s_outs = second[int(fins[-1])]
            later = (s_thr > low) & (s_thr <= max_before)
            base = int(np.searchsorted(s_thr, low, side="right"))
            stop = base + int(later.sum())
            thr = np.append(thr, s_thr[later])
            res = [np.append(r[:-1], o[base:stop + 1]) for r, o in zip(res, s_outs)]
        joined[seen] = _squeeze(thr, *res)
    return joined
