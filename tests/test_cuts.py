import numpy as np
import pytest

from flowspark.functions import cuts


def brute(ts, fin, hard, active):
    """Flow starts when a flow starts at 0."""
    starts, start, fins, closed = [], None, 0, True
    for i in range(len(ts)):
        if closed or hard[i] or (active is not None and ts[i] - start > active):
            starts.append(i)
            start, fins, closed = ts[i], 0, False
        fins += int(fin[i])
        closed = fins >= 2
    return starts


def trace(rng, n, ordered):
    ts = np.cumsum(rng.integers(0, 40, n))
    if not ordered:
        ts = ts + rng.integers(-60, 60, n)
    return ts.astype(np.int64), rng.random(n) < 0.1, rng.random(n) < 0.03


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("active", [None, 30, 200])
def test_starts_match_packet_by_packet(ordered, active):
    rng = np.random.default_rng(1)
    for _ in range(150):
        ts, fin, hard = trace(rng, int(rng.integers(1, 80)), ordered)
        got = cuts.walk(cuts.next_starts(ts, fin, hard, active), 0)
        assert got.tolist() == brute(ts, fin, hard, active)


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("active", [None, 30, 200])
@pytest.mark.parametrize("bounded", [True, False])
def test_chained_blocks_match_packet_by_packet(ordered, active, bounded):
    rng = np.random.default_rng(2)
    for _ in range(120):
        n = int(rng.integers(2, 90))
        ts, fin, hard = trace(rng, n, ordered)
        hard[0] = True
        want = brute(ts, fin, hard, active)
        pkt, d = np.arange(n) * 10, rng.integers(0, 2, n)
        edges = [0, *sorted(set(rng.integers(1, n, int(rng.integers(1, 8))).tolist())), n]
        tables, before = [], []
        for a, b in zip(edges, edges[1:]):
            most = int(ts[:a].max()) if a and bounded else (np.iinfo(np.int64).max if a else np.iinfo(np.int64).min)
            before.append(most)
            tables.append(cuts.run_table(pkt[a:b], ts[a:b], d[a:b], fin[a:b], hard[a:b], active, most))
        # Entry states one block after the other.
        state, seen = (-1, 0, 0, cuts.CLOSED, 0), []
        for (a, b), t in zip(zip(edges, edges[1:]), tables):
            first = cuts.first_cut(ts[a:b], fin[a:b], hard[a:b], active, state[1], state[3])
            seen += (cuts.walk(cuts.next_starts(ts[a:b], fin[a:b], hard[a:b], active), first) + a).tolist()
            state = cuts.apply_table(t, state)
        assert seen == want
        assert (state[0], state[1], state[2], state[4]) == (pkt[want[-1]], ts[want[-1]], d[want[-1]], len(want))
        # The same from neighbouring blocks joined into one function, for any entry state.
        for i in range(1, len(tables) - 1):
            joined = tables[i]
            for t in tables[i + 1:]:
                joined = cuts.chain(joined, t, before[i])
            for s_ts in (*ts[:edges[i]][-3:], int(ts[:edges[i]].max())):
                for fins in (0, 1, 2):
                    entry = one = (7, int(s_ts), 1, fins, 5)
                    for t in tables[i:]:
                        one = cuts.apply_table(t, one)
                    assert cuts.apply_table(joined, entry) == one
