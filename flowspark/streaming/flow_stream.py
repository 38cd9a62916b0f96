"""Flows from a packet stream.

Per connection the state is the open flow's running totals, never its packets: counts, sums, exact
sums of squares, extremes, last times and the open burst, from which all 65 features follow. A flow
is emitted when a packet ends it (RST, second FIN), when a later packet falls beyond a timeout, or
when the watermark passes the timeout; with its flow a connection's state ends, so what is kept is
bounded by the connections open at a time. Flows are therefore not numbered here: `numbered` does so
at rest. Packets behind the watermark are dropped by the engine; packets of one micro-batch are taken
in order of their number, so they meet in one task: bound a batch by `max_files` (or the source's own
rate limit).

Bursts go by time, whatever the order in which packets come: a flow keeps its bursts as intervals,
which a late packet may extend or join, and folds those that the watermark has passed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowspark.functions import cuts
from flowspark.operators import features
from flowspark.operators.flows import ACK, FIN, KEY, KEY_DDL, PSH, RST, SYN, UDP, URG, FlowConfig, with_key
from flowspark.session import scratch_path

_TOTALS = ["fwd_pkts", "bwd_pkts", "fwd_bytes", "bwd_bytes"]
#: Series a flow keeps the moments of: number, sum, sum of squares (whole, as text), least, greatest.
_SERIES = ["fwd_len", "bwd_len", "len", "iat", "fwd_iat", "bwd_iat", "active", "idle"]
_COUNTS = ["fwd_psh", "fin_cnt", "syn_cnt", "psh_cnt", "ack_cnt", "urg_cnt", "fwd_header", "bwd_header", "act_data_fwd"]
#: What has no value before its first packet: -1.
_FIRSTS = ["init_win_fwd", "init_win_bwd", "min_seg_fwd", "last_fwd", "last_bwd"]
_SQUARES = [f"{x}_sq" for x in _SERIES]
_MOMENTS = [f"{x}_{m}" for x in _SERIES for m in ("n", "sum", "lo", "hi")]
_OPEN = ["flow_start", "start_dir", "first_us", "last_us", "fins", *_TOTALS, *_COUNTS, *_FIRSTS, *_MOMENTS]
#: Sums of squares are whole numbers of any size, as text; so are the bursts not yet folded, as `from to from to ...`.
_TEXTS = [*_SQUARES, "bursts"]
_STATE = ["prev_ts", "prev_flags", "is_open", "timer", *_OPEN, *_TEXTS]
_STATE_DDL = ", ".join(f"{c} {'string' if c in _TEXTS else 'bigint'}" for c in _STATE)
_FRESH = dict.fromkeys([*_TOTALS, *_COUNTS, *_MOMENTS], 0) | dict.fromkeys(_FIRSTS, -1) | dict.fromkeys(_SQUARES, "0") | {"bursts": ""}
_STATS = [f"{x}_{m}" for x in _SERIES[:6] for m in ("max", "min", "mean", "std")] + [
    "len_var", "fwd_iat_total", "bwd_iat_total", *[f"{x}_{m}" for x in ("active", "idle") for m in ("mean", "std", "max", "min")],
    *_COUNTS, "init_win_fwd", "init_win_bwd", "min_seg_fwd"]
FLOW_DDL = (f"{KEY_DDL}, flow_start bigint, first_us bigint, last_us bigint, "
            "fwd_pkts bigint, bwd_pkts bigint, fwd_bytes bigint, bwd_bytes bigint, end_reason string, start_dir bigint")
_STATS_DDL = ", ".join(f"{c} double" for c in _STATS)
_COLUMNS = [*KEY, "flow_start", "first_us", "last_us", *_TOTALS, "end_reason", "start_dir"]


def _squares(values: np.ndarray) -> int:
    """Sum of squares as a whole number of any size."""
    most = max(abs(int(values.max())), abs(int(values.min())))
    if most * most * len(values) < 1 << 63:
        return int(np.dot(values, values))
    if most < 1 << 40 and len(values) < 1 << 20:
        high, low = values >> 20, values & 0xFFFFF
        return (int(np.dot(high, high)) << 40) + (int(np.dot(high, low)) << 21) + int(np.dot(low, low))
    return sum(v * v for v in values.tolist())


def _add(s: dict, series: str, values: np.ndarray) -> None:
    """Take values into the moments of a series."""
    if not len(values):
        return
    low, high = int(values.min()), int(values.max())
    if s[f"{series}_n"]:
        low, high = min(low, s[f"{series}_lo"]), max(high, s[f"{series}_hi"])
    s.update({
        f"{series}_n": s[f"{series}_n"] + len(values), f"{series}_sum": s[f"{series}_sum"] + int(values.sum()), f"{series}_lo": low,
        f"{series}_hi": high, f"{series}_sq": str(int(s[f"{series}_sq"]) + _squares(values)),
    })


def _moments(s: dict, series: str, none: float | None) -> dict[str, float | None]:
    n, total = s[f"{series}_n"], s[f"{series}_sum"]
    if not n:
        return dict.fromkeys((f"{series}_max", f"{series}_min", f"{series}_mean", f"{series}_std"), none)
    spread = (n * int(s[f"{series}_sq"]) - total * total) / (n * n)
    return {f"{series}_max": float(s[f"{series}_hi"]), f"{series}_min": float(s[f"{series}_lo"]), f"{series}_mean": total / n,
            f"{series}_std": spread ** 0.5}


def _take(s: dict, known: bool, ts, forward, size, header, flags, win, burst_us: int) -> None:
    """Take a run of packets of one flow into its state; known: the flow has packets before them."""
    _add(s, "iat", np.diff(ts, prepend=s["last_us"]) if known else np.diff(ts))
    _add(s, "len", size)
    for name, mine in (("fwd", forward), ("bwd", ~forward)):
        if not mine.any():
            continue
        _add(s, f"{name}_len", size[mine])
        own = ts[mine]
        _add(s, f"{name}_iat", np.diff(own, prepend=s[f"last_{name}"]) if s[f"last_{name}"] >= 0 else np.diff(own))
        if s[f"last_{name}"] < 0:
            s[f"init_win_{name}"] = int(win[mine][0])
        s[f"last_{name}"] = int(own[-1])
        s[f"{name}_header"] += int(header[mine].sum())
    if forward.any():
        low = int(header[forward].min())
        s["min_seg_fwd"] = low if s["min_seg_fwd"] < 0 else min(low, s["min_seg_fwd"])
        s["act_data_fwd"] += int((size[forward] > 0).sum())
        s["fwd_psh"] += int((flags[forward] & PSH > 0).sum())
    for name, bit in (("fin_cnt", FIN), ("syn_cnt", SYN), ("psh_cnt", PSH), ("ack_cnt", ACK), ("urg_cnt", URG)):
        s[name] += int((flags & bit > 0).sum())
    own = np.sort(ts)
    pauses = np.flatnonzero(np.diff(own) > burst_us)
    new = np.stack([own[np.append(0, pauses + 1)], own[np.append(pauses, len(own) - 1)]], 1)
    s["bursts"] = _joined(np.concatenate([_bursts(s), new]), burst_us)


def _bursts(s: dict) -> np.ndarray:
    """Bursts not yet folded, rows (from, to) in order."""
    return np.array(s["bursts"].split(), np.int64).reshape(-1, 2)


def _joined(bursts: np.ndarray, burst_us: int) -> str:
    """Bursts with those joined that no pause keeps apart. Times within a burst do not matter: its ends decide what joins it."""
    bursts = bursts[np.argsort(bursts[:, 0], kind="stable")]
    reach = np.maximum.accumulate(bursts[:, 1])
    head = np.append(True, bursts[1:, 0] - reach[:-1] > burst_us)
    tail = np.append(head[1:], True)
    return " ".join(map(str, np.stack([bursts[head, 0], reach[tail]], 1).ravel().tolist()))


def _fold_bursts(s: dict, until: int | None) -> None:
    """Take bursts into the active and idle times whose next burst began before `until` (all if None): no packet can come between."""
    bursts = _bursts(s)
    n = len(bursts) if until is None else int(np.searchsorted(bursts[1:, 0], until, "left"))
    if not n:
        return
    lengths = bursts[:n, 1] - bursts[:n, 0]
    _add(s, "active", lengths[lengths > 0])
    _add(s, "idle", bursts[1:n + 1, 0] - bursts[:len(bursts[1:n + 1]), 1])
    s["bursts"] = " ".join(map(str, bursts[n:].ravel().tolist()))


def _run_squares(values: np.ndarray, starts: np.ndarray) -> list[int]:
    """Sums of squares of consecutive runs as whole numbers of any size."""
    most = max(abs(int(values.max())), abs(int(values.min())))
    if most * most * len(values) < 1 << 63:
        return np.add.reduceat(values * values, starts).tolist()
    if most < 1 << 40 and len(values) < 1 << 20:
        high, low = values >> 20, values & 0xFFFFF
        parts = [np.add.reduceat(v, starts).tolist() for v in (high * high, high * low, low * low)]
        return [(a << 40) + (b << 21) + c for a, b, c in zip(*parts)]
    wide = values.astype(object)
    return np.add.reduceat(wide * wide, starts).tolist()


def _run_moments(series: str, values: np.ndarray, run: np.ndarray, runs: int, none: float) -> dict[str, np.ndarray]:
    """As `_moments`, for `runs` runs at once; `run` is the number of each value's run, ascending."""
    out = {m: np.full(runs, none) for m in ("max", "min", "mean", "std")}
    if len(values):
        count = np.bincount(run, minlength=runs)
        have = np.flatnonzero(count)
        starts = (np.cumsum(count) - count)[have]
        n, total = count[have].tolist(), np.add.reduceat(values, starts).tolist()
        out["max"][have], out["min"][have] = np.maximum.reduceat(values, starts), np.minimum.reduceat(values, starts)
        out["mean"][have] = [t / k for t, k in zip(total, n)]
        out["std"][have] = [((k * q - t * t) / (k * k)) ** 0.5 for k, q, t in zip(n, _run_squares(values, starts), total)]
    return {f"{series}_{m}": v for m, v in out.items()}


def _whole_flows(run, ts, forward, size, header, flags, win, burst_us: int) -> dict[str, np.ndarray]:
    """What `_take` and `_close` give, for whole flows at once; `run` is the number of each packet's flow, ascending."""
    runs = int(run[-1]) + 1
    same = run[1:] == run[:-1]
    own = np.lexsort((ts, run))
    t, gap = ts[own], np.diff(ts[own])
    pause = same & (gap > burst_us)
    head = np.append(True, ~same | pause)
    length = t[np.append(head[1:], True)] - t[head]
    out = _run_moments("len", size, run, runs, 0.0) | _run_moments("iat", np.diff(ts)[same], run[1:][same], runs, 0.0)
    out |= _run_moments("active", length[length > 0], run[head][length > 0], runs, np.nan)
    out |= _run_moments("idle", gap[pause], run[1:][pause], runs, np.nan)
    for name, mine in (("fwd", forward), ("bwd", ~forward)):
        r = run[mine]
        near = r[1:] == r[:-1]
        gaps, at = np.diff(ts[mine])[near], r[1:][near]
        out |= _run_moments(f"{name}_len", size[mine], r, runs, 0.0) | _run_moments(f"{name}_iat", gaps, at, runs, 0.0)
        wins, headers, total = np.full(runs, -1.0), np.zeros(runs, np.int64), np.zeros(runs, np.int64)
        if len(r):
            opens = np.flatnonzero(np.append(True, ~near))
            wins[r[opens]], headers[r[opens]] = win[mine][opens], np.add.reduceat(header[mine], opens)
        if len(at):
            edge = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            total[at[edge]] = np.add.reduceat(gaps, edge)
        out |= {f"init_win_{name}": wins, f"{name}_header": headers.astype(float), f"{name}_iat_total": total.astype(float)}
    counts = [forward & (flags & PSH > 0), *[flags & bit > 0 for bit in (FIN, SYN, PSH, ACK, URG)], forward & (size > 0)]
    names = ["fwd_psh", "fin_cnt", "syn_cnt", "psh_cnt", "ack_cnt", "urg_cnt", "act_data_fwd"]
    out |= {name: np.bincount(run[c], minlength=runs).astype(float) for name, c in zip(names, counts)}
    # A flow begins with a packet of its own direction, so each has a least header.
    least = np.minimum.reduceat(np.where(forward, header, cuts.NEVER), np.flatnonzero(np.append(True, ~same)))
    return out | {"len_var": np.array([v ** 2 for v in out["len_std"].tolist()]), "min_seg_fwd": np.where(least >= 0, least, 20).astype(float)}


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FlowProcessor(StatefulProcessor):
    def __init__(self, cfg: FlowConfig, stats: bool):
        self.cfg, self.stats = cfg, stats
        self.columns = [*_COLUMNS, *(_STATS if stats else [])]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("flow", _STATE_DDL)

    def _idle(self, key) -> int:
        limit = self.cfg.udp_us if int(key[KEY.index("protocol")]) == UDP else self.cfg.idle_us
        return cuts.NEVER if limit is None else limit

    def _emit(self, key, flows: list[dict]) -> Iterator[pd.DataFrame]:
        if flows:
            rows = pd.DataFrame(flows).assign(**dict(zip(KEY, key)))
            yield rows[self.columns]

    def _timer(self, key, s: dict) -> None:
        due = 0
        if s["is_open"]:
            due = s["last_us"] + min(self._idle(key), 10**17)
            if self.cfg.active_us is not None:
                due = min(due, s["first_us"] + self.cfg.active_us)
            due = due // 1000 + 1
        if due != s["timer"]:
            if s["timer"]:
                self.handle.deleteTimer(s["timer"])
            if due:
                self.handle.registerTimer(due)
            s["timer"] = due

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        cols = [np.concatenate([f[c].to_numpy() for f in frames])
                for c in ("pkt_no", "ts_us", "flags", "dir", "payload_len", "header_len", "win")]
        order = np.argsort(cols[0], kind="stable")
        pkt, ts, flags, d, size, header, win = (c[order] for c in cols)
        s = dict(zip(_STATE, self.state.get())) if self.state.exists() else dict.fromkeys(_STATE, 0) | _FRESH
        known = bool(s["is_open"])
        gaps = np.diff(ts, prepend=s["prev_ts"] if known else ts[0])
        hard = gaps > self._idle(key)
        if self.cfg.use_rst:
            hard |= (np.append(s["prev_flags"], flags[:-1]) & RST) > 0
        fin = ((flags & FIN) > 0) & self.cfg.use_fin
        first = cuts.first_cut(ts, fin, hard, self.cfg.active_us, s["first_us"], s["fins"]) if s["is_open"] else 0
        starts = cuts.walk(cuts.next_starts(ts, fin, hard, self.cfg.active_us), first)
        # Runs of packets of one flow each; the first may continue the open flow.
        begins = starts if first == 0 else np.append(0, starts)
        ends = np.append(begins[1:], len(ts))
        start_dir = d[begins].copy()
        if first > 0:
            start_dir[0] = s["start_dir"]
        forward = d == np.repeat(start_dir, ends - begins)
        size, header, win = (v.astype(np.int64) for v in (size, header, win))
        sums = [np.add.reduceat(v.astype(np.int64), begins)
                for v in (forward, ~forward, np.where(forward, size, 0), np.where(forward, 0, size), fin)]
        rst = ((flags[ends - 1] & RST) > 0) & self.cfg.use_rst
        # Flows that begin and end among these packets never become state: all of them are taken at once.
        whole = rst | (sums[4] >= cuts.CLOSED)
        whole[:-1] = True
        whole[0] &= first == 0
        done = []
        if s["is_open"] and first == 0:
            done.append(self._close(s, "timeout"))
        for i in np.flatnonzero(~whole).tolist():  # the flow open before, the one open after
            low, high = begins[i], ends[i]
            if i > 0 or first == 0:
                s.update(is_open=1, flow_start=int(pkt[low]), start_dir=int(d[low]), first_us=int(ts[low]), fins=0, **_FRESH)
            run = slice(low, high)
            if self.stats:
                _take(s, i == 0 and first > 0, ts[run], forward[run], size[run], header[run], flags[run], win[run], self.cfg.burst_us)
            for name, total in zip([*_TOTALS, "fins"], sums):
                s[name] += int(total[i])
            s["last_us"] = int(ts[high - 1])
            if rst[i]:
                done.append(self._close(s, "rst"))
            elif s["fins"] >= cuts.CLOSED:
                done.append(self._close(s, "fin"))
            elif high < len(ts):
                done.append(self._close(s, "timeout"))
        s.update(prev_ts=int(ts[-1]), prev_flags=int(flags[-1]))
        self._timer(key, s)
        if s["is_open"]:
            _fold_bursts(s, timerValues.getCurrentWatermarkInMs() * 1000)
            self.state.update(tuple(s[c] if c in _TEXTS else int(s[c]) for c in _STATE))
        else:
            self.state.clear()  # nothing of a flow that has ended bears on the next
        yield from self._emit(key, done)
        if whole.any():
            low, high = begins[whole], ends[whole]
            reason = np.where(rst[whole], "rst", np.where(sums[4][whole] >= cuts.CLOSED, "fin", "timeout")).astype(object)
            out = {"flow_start": pkt[low], "first_us": ts[low], "last_us": ts[high - 1], "start_dir": d[low], "end_reason": reason,
                   **{name: total[whole] for name, total in zip(_TOTALS, sums)}}
            if self.stats:
                mine, run = np.repeat(whole, ends - begins), np.repeat(np.arange(len(low)), high - low)
                out |= _whole_flows(run, *(v[mine] for v in (ts, forward, size, header, flags, win)), self.cfg.burst_us)
            keys = {name: np.full(len(low), value, object) for name, value in zip(KEY, key)}
            yield pd.DataFrame({c: keys[c] if c in keys else out[c] for c in self.columns}, copy=False)

    def _close(self, s: dict, reason: str) -> dict:
        s["is_open"] = 0
        out = {"end_reason": reason, **{c: s[c] for c in ("flow_start", "first_us", "last_us", "start_dir", *_TOTALS)}}
        if not self.stats:
            return out
        _fold_bursts(s, None)
        for series in _SERIES:
            out |= _moments(s, series, None if series in ("active", "idle") else 0.0)
        out |= {c: float(s[c]) for c in (*_COUNTS, "init_win_fwd", "init_win_bwd")}
        return out | {"len_var": out["len_std"] ** 2, "fwd_iat_total": float(s["fwd_iat_sum"]), "bwd_iat_total": float(s["bwd_iat_sum"]),
                      "min_seg_fwd": float(s["min_seg_fwd"]) if s["min_seg_fwd"] >= 0 else 20.0}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = dict(zip(_STATE, self.state.get()))
        if s["is_open"]:
            self.state.clear()
            yield from self._emit(key, [self._close(s, "timeout")])

    def close(self) -> None:
        pass


def event_time(packets: DataFrame, delay: str) -> DataFrame:
    return packets.withColumn("event_time", F.timestamp_micros("ts_us")).withWatermark("event_time", delay)


def stream_flows(packets: DataFrame, cfg: FlowConfig = FlowConfig(), delay: str = "0 seconds", stats: bool = False) -> DataFrame:
    """Flow rows from a streaming packet table; `delay` is how late a packet may be; stats: with what the features need."""
    packets.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    # The key projection keeps event_time, on which the timers run.
    timed = event_time(packets, delay)
    keyed = with_key(timed, extra=["event_time"])
    return keyed.groupBy(*KEY).transformWithStateInPandas(
        FlowProcessor(cfg, stats), f"{FLOW_DDL}, {_STATS_DDL}" if stats else FLOW_DDL, "append", "EventTime")


def stream_features(packets: DataFrame, cfg: FlowConfig = FlowConfig(), delay: str = "0 seconds") -> DataFrame:
    """Metadata and the 65 features of each flow as it ends, as `features.flow_features` gives them at rest."""
    flows = stream_flows(packets, cfg, delay, stats=True).withColumn("flow_seq", F.lit(None).cast("bigint"))
    flows = flows.withColumn("dur", F.greatest(F.lit(0), F.col("last_us") - F.col("first_us")).cast("double"))
    return features.canonical(features.derive(flows)).drop("flow_seq")


def numbered(flows: DataFrame) -> DataFrame:
    """Flows at rest with flow_seq, their number within the connection: from stream_flows or stream_features."""
    if set(KEY) <= set(flows.columns):
        ends = [F.col(c) for c in KEY]
    else:
        a, b = (F.struct(F.col(f"{side}_IP").alias("ip"), F.col(f"{side}_Port").alias("port")) for side in ("Source", "Destination"))
        ends = [F.col("capture_id"), F.least(a, b), F.greatest(a, b), F.col("Protocol")]
    return flows.withColumn("flow_seq", F.row_number().over(Window.partitionBy(*ends).orderBy("flow_start")).cast("bigint") - 1)


def stream_sessions(packets: DataFrame, cfg: FlowConfig = FlowConfig(), delay: str = "0 seconds") -> DataFrame:
    """Idle-only sessions of each connection with the built-in session window."""
    keyed = with_key(event_time(packets, delay), extra=["event_time"])
    gap = F.when(F.col("protocol") == UDP, f"{cfg.udp_us} microseconds").otherwise(f"{cfg.idle_us} microseconds")
    return keyed.groupBy(*KEY, F.session_window("event_time", gap)).agg(
        F.count(F.lit(1)).alias("packets"), F.sum(F.col("payload_len").cast("bigint")).alias("bytes"),
        F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"),
    ).drop("session_window")


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything available and read what it wrote."""
    spark = stream.sparkSession
    out, log = scratch_path(spark, name), scratch_path(spark, f"{name}-log")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).outputMode(
        "append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def open_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A folder of packet files as a stream, at most max_files of them in one micro-batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)
