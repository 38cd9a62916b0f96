"""Packets to bidirectional flows.

A packet opens a new flow of its connection when the gap to the previous packet exceeds the idle
timeout, when the flow has lasted longer than the active timeout, or when the previous packet
ended the flow (RST, or the second FIN).

Connections of ordinary size run on window functions. Only stretches that outlast the active
timeout need a fold, since that rule depends on where the flow began. Connections of more than
`heavy_packets` packets are cut into blocks of consecutive packet numbers; each block is reduced to a step function from
the state before it to the state after it (functions/cuts.py), and once the state before each block is known the blocks
are marked in parallel. Where a connection's functions have few steps in all, one row of at most `table_steps` steps runs
through them; where they have many (very many packets within one active timeout, again and again), the steps are rows that
are composed by range joins (flow_steps.py). No row holds more than a block or `table_steps` steps.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions import cuts
from flowspark.operators import flow_steps
from flowspark.session import materialize

KEY = ["capture_id", "lo_ip", "lo_port", "hi_ip", "hi_port", "protocol"]
KEY_DDL = "capture_id string, lo_ip string, lo_port int, hi_ip string, hi_port int, protocol int"
BODY = ["pkt_no", "ts_us", "dir", "payload_len", "header_len", "flags", "win"]

FIN, SYN, RST, PSH, ACK, URG = 1, 2, 4, 8, 16, 32
TCP, UDP = 6, 17


@dataclass(frozen=True)
class FlowConfig:
    """Timeouts in microseconds; None switches a rule off."""

    idle_us: int | None = 120_000_000
    udp_us: int | None = 120_000_000
    active_us: int | None = 1_800_000_000
    burst_us: int = 1_000_000
    use_rst: bool = True
    use_fin: bool = True
    heavy_packets: int = 1 << 20
    block_packets: int = 8192
    fan_in: int = 4
    table_steps: int = 16_384

    def only(self, **rules) -> FlowConfig:
        """Same timeouts with just the named rules on."""
        off = dict(idle_us=None, udp_us=None, active_us=None, use_rst=False, use_fin=False)
        return replace(self, **{**off, **rules})


def keep_transport(packets: DataFrame) -> DataFrame:
    return packets.where(F.col("protocol").isin(TCP, UDP))


def payload_length(frame_len: Column, ip_header: Column, transport_header: Column) -> Column:
    return F.greatest(F.lit(0), frame_len - ip_header - transport_header)


def header_lengths(headers: DataFrame, payload_basis: str = "frame") -> DataFrame:
    """Header and payload lengths from header fields.

    In: ip_version, ihl, protocol, data_offset, frame_len, ip_len. `payload_basis` 'frame' counts
    from the whole frame, link layer included; 'ip' from the IP length.
    """
    ip_header = F.when(F.col("ip_version") == 4, F.col("ihl") * 4).otherwise(F.lit(40))
    offset = F.when(F.col("data_offset") > 0, F.col("data_offset") * 4).otherwise(F.lit(20))
    transport = F.when(F.col("protocol") == UDP, F.lit(8)).otherwise(offset)
    total = F.col("frame_len" if payload_basis == "frame" else "ip_len")
    return headers.withColumns({
        "ip_header_len": ip_header,
        "header_len": transport,
        "payload_len": payload_length(total, ip_header, transport),
    })


def decode_flags(packets: DataFrame) -> DataFrame:
    bits = {"fin": FIN, "syn": SYN, "rst": RST, "psh": PSH, "ack": ACK, "urg": URG}
    return packets.withColumns(
        {name: (F.col("flags").bitwiseAND(bit) > 0).cast("int") for name, bit in bits.items()}
    )


def with_key(packets: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Both directions of a connection under one key; `dir` 0 is from the low to the high endpoint."""
    src_low = (F.col("src_ip") < F.col("dst_ip")) | (
        (F.col("src_ip") == F.col("dst_ip")) & (F.col("src_port") <= F.col("dst_port"))
    )
    return packets.select(
        "capture_id",
        F.when(src_low, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("lo_ip"),
        F.when(src_low, F.col("src_port")).otherwise(F.col("dst_port")).alias("lo_port"),
        F.when(src_low, F.col("dst_ip")).otherwise(F.col("src_ip")).alias("hi_ip"),
        F.when(src_low, F.col("dst_port")).otherwise(F.col("src_port")).alias("hi_port"),
        "protocol", "pkt_no", "ts_us",
        F.when(src_low, F.lit(0)).otherwise(F.lit(1)).alias("dir"),
        *[F.col(c).cast("int").alias(c) for c in ("payload_len", "header_len", "flags", "win")],
        *extra,
    )


def conversation_rollup(packets: DataFrame) -> DataFrame:
    return with_key(packets).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("packets"),
        F.sum(F.col("payload_len").cast("bigint")).alias("bytes"),
        F.min("ts_us").alias("first_us"),
        F.max("ts_us").alias("last_us"),
    )


def _gap_limit(cfg: FlowConfig) -> Column:
    never = F.lit(cuts.NEVER)
    idle = never if cfg.idle_us is None else F.lit(cfg.idle_us).cast("bigint")
    udp = never if cfg.udp_us is None else F.lit(cfg.udp_us).cast("bigint")
    return F.when(F.col("protocol") == UDP, udp).otherwise(idle)


def _bit(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(bit) > 0


def _order(by: list[str]):
    """Packets in order; a told cut stands before its packet. Frames: before the row, up to the row."""
    w = Window.partitionBy(*by).orderBy("pkt_no", F.desc("is_cut"))
    return (w, w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0))


def _carried(value: Column, carry: str | None) -> Column:
    return value if carry is None else F.coalesce(value, F.col(carry))


def _boundaries(rows: DataFrame, cfg: FlowConfig, by: list[str], carry: bool = False) -> DataFrame:
    """Boundaries that hold whatever the state: first packet, idle gap, packet after RST, known cut.

    `rows` may hold rows with only a key, a packet number and `is_cut` 1, which say that the packet
    of that number opens a flow. With `carry`, rows bring what came before their block.
    """
    w, before, _ = _order(by)
    df = rows.withColumns({
        "prev_ts": _carried(F.last("ts_us", ignorenulls=True).over(before), "c_prev_ts" if carry else None),
        "prev_flags": _carried(F.last("flags", ignorenulls=True).over(before), "c_prev_flags" if carry else None),
        "told": F.lag("is_cut", 1, 0).over(w) == 1,
    })
    hard = F.col("prev_ts").isNull() | (F.col("ts_us") - F.col("prev_ts") > _gap_limit(cfg)) | F.col("told")
    if cfg.use_rst:
        hard = hard | _bit(F.col("prev_flags"), RST)
    return df.withColumn("hard", (F.col("is_cut") == 0) & hard)


def _mark(rows: DataFrame, cfg: FlowConfig, by: list[str] = KEY, carry: bool = False) -> DataFrame:
    """Flow marks by window functions in one sort order; within boundaries every second FIN closes a flow."""
    _, before, upto = _order(by)
    df = _boundaries(rows, cfg, by, carry)
    cut = F.col("hard")
    if cfg.use_fin:
        fins = F.coalesce(F.sum(F.when(_bit(F.col("flags"), FIN), 1).otherwise(0)).over(before), F.lit(0))
        df = df.withColumn("fins", fins)
        # The count only grows, so its largest value at a boundary is that of the latest boundary.
        at_boundary = F.max(F.when(F.col("hard"), F.col("fins"))).over(upto)
        base = F.coalesce(at_boundary, -F.col("c_fins")) if carry else at_boundary
        df = df.withColumn("since", F.col("fins") - base)
        cut = cut | (_bit(F.col("prev_flags"), FIN) & (F.col("since") % 2 == 0))
    df = df.withColumn("cut", (F.col("is_cut") == 0) & cut)
    started = F.sum(F.col("cut").cast("bigint")).over(upto)
    df = df.withColumns({
        "flow_start": _carried(F.max(F.when(F.col("cut"), F.col("pkt_no"))).over(upto), "c_pkt" if carry else None),
        "start_dir": _carried(
            F.last(F.when(F.col("cut"), F.col("dir")), ignorenulls=True).over(upto), "c_dir" if carry else None).cast("int"),
        "flow_seq": (started + F.col("c_flows") if carry else started) - 1,
        **{f"p{d}_{c}": _carried(F.last(F.when(F.col("dir") == d, F.col(c)), ignorenulls=True).over(before),
                                 f"c_last{d}_{c}" if carry else None)
           for d in (0, 1) for c in ("pkt_no", "ts_us")},
    })
    same_pkt = F.when(F.col("dir") == 0, F.col("p0_pkt_no")).otherwise(F.col("p1_pkt_no"))
    same_ts = F.when(F.col("dir") == 0, F.col("p0_ts_us")).otherwise(F.col("p1_ts_us"))
    return df.where("is_cut = 0").select(
        *KEY, *BODY, "flow_start", "start_dir",
        F.when(~F.col("cut"), F.col("ts_us") - F.col("prev_ts")).alias("gap_us"),
        F.when(same_pkt >= F.col("flow_start"), F.col("ts_us") - same_ts).alias("dir_gap_us"), "flow_seq",
    )


def _late_starts(active_us: int):
    def late(pkt: pd.Series, ts: pd.Series, fin: pd.Series) -> pd.Series:
        sizes = pkt.map(len).to_numpy()
        edges = np.cumsum(sizes) - sizes
        p, t, f = (np.concatenate(c.to_list()) for c in (pkt, ts, fin))
        opens = np.zeros(len(t), dtype=bool)
        opens[edges] = True
        at = cuts.late_starts(t, f > 0, opens, active_us)
        return pd.Series(np.split(p[at], np.searchsorted(at, edges[1:])))

    return F.pandas_udf(late, "array<bigint>")


def active_cuts(keyed: DataFrame, cfg: FlowConfig) -> DataFrame:
    """(key, pkt_no) of packets that open a flow because of the active timeout.

    This rule depends on where the flow began, so stretches between boundaries that outlast the
    timeout, and only they, are folded: one array row each, many rows to an array operation. The
    rest of the packets never leave the JVM.
    """
    thin = keyed.select(*KEY, "pkt_no", "ts_us", "flags", F.lit(0).alias("is_cut"))
    seg = F.max(F.when(F.col("hard"), F.col("pkt_no"))).over(_order(KEY)[2])
    stretches = _boundaries(thin, cfg, KEY).withColumn("seg", seg)
    whole = Window.partitionBy(*KEY, "seg")
    long = stretches.withColumn("span", F.max("ts_us").over(whole) - F.min("ts_us").over(whole)).where(
        F.col("span") > cfg.active_us)
    fin = _bit(F.col("flags"), FIN).cast("int") if cfg.use_fin else F.lit(0)
    rows = F.array_sort(F.collect_list(F.struct("pkt_no", "ts_us", fin.alias("fin"))))
    lists = long.groupBy(*KEY, "seg").agg(rows.alias("rows"))
    starts = _late_starts(cfg.active_us)(F.col("rows.pkt_no"), F.col("rows.ts_us"), F.col("rows.fin"))
    return lists.select(*KEY, F.explode(starts).alias("pkt_no"))


def _ordinary(keyed: DataFrame, cfg: FlowConfig) -> DataFrame:
    """Marked packets of connections of at most `heavy_packets` packets."""
    rows = keyed.withColumn("is_cut", F.lit(0))
    if cfg.active_us is not None:
        told = active_cuts(keyed, cfg).withColumn("is_cut", F.lit(1))
        rows = rows.unionByName(told, allowMissingColumns=True)
    return _mark(rows, cfg)


# ---- connections too large for one task -------------------------------------------------------

_BLOCK = [*KEY, "blk"]
_STEPS = "array<array<bigint>>"  # a block's tables, see functions/cuts.py
_UNOPENED = (-1, 0, 0, cuts.CLOSED, 0)


def _pack(table: dict) -> list[np.ndarray]:
    return [a.astype(np.int64) for s in (0, 1, 2) for a in table[s]]


def _unpack(steps) -> dict:
    arrays = [np.asarray(a, dtype=np.int64) for a in steps]
    return {s: tuple(arrays[6 * s:6 * s + 6]) for s in (0, 1, 2)}


def _block_rows(hot: DataFrame) -> DataFrame:
    """One row per connection and block: its packets, reduced to what ends a flow, and its tail."""
    packets = F.array_sort(F.collect_list(F.struct("pkt_no", "ts_us", "dir", "flags")))
    last_of = [F.max(F.when(F.col("dir") == d, F.struct("pkt_no", "ts_us"))).alias(f"last{d}") for d in (0, 1)]
    return hot.groupBy(*_BLOCK).agg(
        packets.alias("rows"), F.max_by(F.struct("ts_us", "flags"), "pkt_no").alias("tail"), F.max("ts_us").alias("max_ts"),
        F.min("ts_us").alias("min_ts"),
        *last_of,
    )


def _block_carry(blocks: DataFrame) -> DataFrame:
    """What the packets before each block left behind."""
    w = Window.partitionBy(*KEY).orderBy("blk")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    last = {d: F.last(f"last{d}", ignorenulls=True).over(before) for d in (0, 1)}
    return blocks.select(
        *_BLOCK, F.lag("tail.ts_us").over(w).alias("c_prev_ts"), F.lag("tail.flags").over(w).alias("c_prev_flags"),
        F.max("max_ts").over(before).alias("max_before"), F.min("min_ts").over(before).alias("min_before"),
        *[last[d][c].alias(f"c_last{d}_{c}") for d in (0, 1) for c in ("pkt_no", "ts_us")],
    )


def _run(ts, flags, carry, cfg: FlowConfig):
    """Times, FINs and hard boundaries of a block; carry: has a predecessor, its time and flags, idle limit."""
    known, prev_ts, prev_flags, limit = (int(c) for c in carry[:4])
    gaps = np.diff(ts, prepend=prev_ts if known else ts[0])
    hard = gaps > limit
    if cfg.use_rst:
        hard |= (np.append(prev_flags, flags[:-1]) & RST) > 0
    hard[0] |= not known
    return ts, ((flags & FIN) > 0) & cfg.use_fin, hard


def _carry_array(cfg: FlowConfig) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.array(
        F.col("c_prev_ts").isNotNull().cast("bigint"), F.coalesce("c_prev_ts", zero),
        F.coalesce(F.col("c_prev_flags").cast("bigint"), zero), _gap_limit(cfg).cast("bigint"),
        F.coalesce("max_before", F.lit(np.iinfo(np.int64).min)), F.coalesce("min_before", F.lit(np.iinfo(np.int64).min)),
    )


def _tables(cfg: FlowConfig):
    def reduce_blocks(pkt: pd.Series, ts: pd.Series, d: pd.Series, flags: pd.Series, carry: pd.Series) -> pd.Series:
        out = []
        for p, t, x, f, c in zip(pkt, ts, d, flags, carry):
            t, fin, hard = _run(t, f, c, cfg)
            out.append(_pack(cuts.run_table(p, t, x, fin, hard, cfg.active_us, int(c[4]), int(c[5]))))
        return pd.Series(out)

    return F.pandas_udf(reduce_blocks, _STEPS)


def _late_in_block(cfg: FlowConfig):
    def late(pkt: pd.Series, ts: pd.Series, flags: pd.Series, carry: pd.Series, state: pd.Series) -> pd.Series:
        out = []
        for p, t, f, c, s in zip(pkt, ts, flags, carry, state):
            t, fin, hard = _run(t, f, c, cfg)
            first = cuts.first_cut(t, fin, hard, cfg.active_us, int(s[1]), int(s[3]))
            given = cuts.first_cut(t, fin, hard, None, int(s[1]), int(s[3]))
            inner = cuts.late_starts(t[first:], fin[first:], hard[first:], cfg.active_us) + first if first < len(t) else []
            out.append(p[np.append([first] if first < given else [], inner).astype(np.int64)])
        return pd.Series(out)

    return F.pandas_udf(late, "array<bigint>")


def _entered(steps: pd.Series, state: pd.Series) -> pd.Series:
    """Entry state of each run in turn, starting from the state before the first."""
    out = []
    for group, first in zip(steps, state):
        at, states = tuple(int(v) for v in first), []
        for s in group:
            states.append(np.array(at, dtype=np.int64))
            at = cuts.apply_table(_unpack(s), at)
        out.append(states)
    return pd.Series(out)


def _entry(runs: DataFrame, cfg: FlowConfig) -> DataFrame:
    """State before each block: by one row of each connection with few steps, by rows of steps for the others."""
    steps = sum(F.size(F.col("steps")[6 * seen]) for seen in (0, 1)) + 3
    sizes = runs.groupBy(*KEY).agg(F.sum(steps).alias("n"))
    many = materialize(sizes.where(F.col("n") > cfg.table_steps).select(*KEY), "many_steps")
    some = not many.isEmpty()
    few = runs.join(many, KEY, "left_anti") if some else runs
    in_order = few.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("blk", "steps"))).alias("runs"))
    unopened = F.array(*[F.lit(v).cast("bigint") for v in _UNOPENED])
    states = F.pandas_udf(_entered, _STEPS)(F.col("runs.steps"), unopened)
    entry = in_order.select(*KEY, F.inline(F.arrays_zip(F.col("runs.blk").alias("blk"), states.alias("state"))))
    if not some:
        return entry
    rows = materialize(flow_steps.rows_of(runs.join(many, KEY, "left_semi"), KEY), "step_rows")
    rest = flow_steps.entry_states(rows, KEY, _UNOPENED, cfg.fan_in)
    return entry.unionByName(rest.select(*_BLOCK, F.array(*flow_steps.STATE).alias("state")))


def _oversized(keyed: DataFrame, cfg: FlowConfig) -> DataFrame:
    """Marked packets of connections of any size, block by block."""
    hot = keyed.withColumn("blk", F.expr(f"pkt_no div {cfg.block_packets}"))
    blocks = materialize(_block_rows(hot), "blocks")
    carry = materialize(_block_carry(blocks.drop("rows")), "carry")
    known = blocks.select(*_BLOCK, "rows").join(carry, _BLOCK).withColumn("carry", _carry_array(cfg))
    r = [F.col(f"rows.{c}") for c in ("pkt_no", "ts_us", "dir", "flags")]
    runs = materialize(known.select(
        *_BLOCK, F.col("carry")[4].alias("max_before"), _tables(cfg)(*r, F.col("carry")).alias("steps")), "runs")
    entry = materialize(_entry(runs, cfg), "entry")
    found = _late_in_block(cfg)(r[0], r[1], r[3], F.col("carry"), F.col("state"))
    late = materialize(known.join(entry, _BLOCK).select(
        *_BLOCK, F.explode(found).alias("pkt_no"), F.lit(1).alias("is_cut")), "late")
    before = carry.join(entry, _BLOCK).select(
        *carry.columns, *[F.col("state")[i].alias(f"c_{n}") for i, n in enumerate(("pkt", "ts", "dir", "fins", "flows"))])
    # A flow that ended just before the block has nothing to go on with.
    before = before.withColumn("c_prev_ts", F.when(F.col("c_fins") < cuts.CLOSED, F.col("c_prev_ts")))
    rows = hot.withColumn("is_cut", F.lit(0)).unionByName(late, allowMissingColumns=True)
    return _mark(rows.join(before, _BLOCK), cfg, _BLOCK, carry=True)


@dataclass(frozen=True)
class MarkedPackets:
    """Packets with their flow, by size of their connection."""

    ordinary: DataFrame
    oversized: DataFrame | None


def mark_flows(packets: DataFrame, cfg: FlowConfig = FlowConfig()) -> MarkedPackets:
    keyed = with_key(packets)
    heavy = materialize(
        keyed.groupBy(*KEY).count().where(F.col("count") > cfg.heavy_packets).select(*KEY), "heavy"
    )
    if heavy.isEmpty():
        return MarkedPackets(_ordinary(keyed, cfg), None)
    # Read five times from here on: written, they are decoded and keyed once, and the joins compare columns, not what makes them.
    keyed = materialize(keyed, "keyed")
    return MarkedPackets(
        _ordinary(keyed.join(heavy, KEY, "left_anti"), cfg), _oversized(keyed.join(heavy, KEY, "left_semi"), cfg)
    )


def assign_flows(packets: DataFrame, cfg: FlowConfig = FlowConfig()) -> DataFrame:
    """Packets with key, `flow_start` (number of the flow's first packet), `flow_seq`, `is_fwd`,
    `gap_us` (to the previous packet of the flow) and `dir_gap_us` (same direction)."""
    marked = mark_flows(packets, cfg)
    out = marked.ordinary if marked.oversized is None else marked.ordinary.unionByName(marked.oversized)
    return out.withColumn("is_fwd", F.col("dir") == F.col("start_dir"))
