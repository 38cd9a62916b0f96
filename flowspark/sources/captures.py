"""Packet captures (pcap and pcapng) to a packet table.

Two passes, both distributed. The first walks record headers, many tasks to a file: a task starts at
any offset and takes the first place from which a chain of headers agrees for a record. Such a guess
counts once the walk of the stretch before ends exactly there; where it does not, the stretch is
walked again from that end. The second pass decodes stretches of `split_packets` records. Files are
read in pieces of `piece` bytes, one request each; within a piece headers are walked in memory and
the fields of all its packets are gathered at once.

Captures that cannot be read (empty, foreign, not to be opened) or end in the middle of a record are
a side output with offset and reason; what comes before a cut is decoded.
"""

from __future__ import annotations

import hashlib
import json
import re
import socket
import struct
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowspark.operators import labels
from flowspark.operators.flows import TCP, UDP, FlowConfig
from flowspark.session import materialize
from flowspark.sources.tables import new_captures

PACKET_DDL = (
    "capture_id string, path string, pkt_no bigint, ts_us bigint, src_ip string, dst_ip string, src_port int, dst_port int, "
    "protocol int, payload_len int, header_len int, flags int, win int"
)
_INDEX_DDL = (
    "path string, k int, size bigint, begin bigint, end bigint, n bigint, marks array<struct<offset:bigint,local:bigint,effects:string>>, "
    "effects string, bad_at bigint, reason string"
)

# File magics and block types of the two public capture formats.
_PCAP = {b"\xd4\xc3\xb2\xa1": ("<", 1), b"\xa1\xb2\xc3\xd4": (">", 1), b"\x4d\x3c\xb2\xa1": ("<", 1000), b"\xa1\xb2\x3c\x4d": (">", 1000)}
_SECTION, _INTERFACE, _SIMPLE, _ENHANCED = 0x0A0D0D0A, 1, 3, 6
# Link types and the length of their header.
_ETHERNET, _RAW, _LINUX_SLL, _LOOPBACK = 1, (12, 101), 113, 0


#: What a ledger knows a finished capture by; config is a hash of all that its flows depend on.
LEDGER_KEY = ["path", "config"]
#: Bytes of a file that one task of the first pass walks.
INDEX_BYTES = 256 << 20
#: Headers that must agree for a guessed record, and the longest record believed in a guess.
_CHAIN, _LONGEST = 12, 1 << 22
#: Bytes fetched at a time from a capture; on object storage this is one request.
PIECE = 16 << 20
#: Most tasks asked for in one pass.
_MOST_TASKS = 20_000


def _open(path: str):
    system, local = fs.FileSystem.from_uri(path)
    return system.open_input_file(local)


class _Pieces:
    """A file read in pieces; at most one is held."""

    def __init__(self, f, size: int):
        self.f, self.size, self.base, self.data = f, size, 0, b""

    def holds(self, at: int, n: int) -> bool:
        return self.base <= at and at + n <= self.base + len(self.data)

    def fetch(self, at: int, n: int) -> bool:
        self.f.seek(at)
        self.base, self.data = at, self.f.read(max(n, self.size))
        return len(self.data) >= n


def _start(pieces: _Pieces) -> dict:
    """Format, byte order, link types and clocks (units per second) as far as the file's first bytes tell."""
    pieces.fetch(0, 24)
    head = pieces.data[:24]
    if head[:4] in _PCAP:
        order, per_us = _PCAP[head[:4]]
        link = struct.unpack(order + "I", head[20:24])[0] & 0x0FFFFFFF
        return {"kind": "pcap", "order": order, "links": [link], "clocks": [per_us * 1_000_000], "offset": 24}
    if head[:4] == b"\x0a\x0d\x0d\x0a":
        return {"kind": "pcapng", "order": "<" if head[8:12] == b"\x4d\x3c\x2b\x1a" else ">", "links": [], "clocks": [], "offset": 0}
    raise ValueError("not a capture file")


def _clock(order: str, options: bytes) -> int:
    """Time units per second of a pcapng interface."""
    at = 0
    while at + 4 <= len(options):
        code, size = struct.unpack(order + "HH", options[at:at + 4])
        if code == 9 and size:
            v = options[at + 4]
            return 2 ** (v & 0x7F) if v & 0x80 else 10 ** v
        if code == 0:
            break
        at += 4 + (size + 3) // 4 * 4
    return 1_000_000


def _walk(pieces: _Pieces, state: dict, stop: int | None) -> Iterator[tuple[bytes, np.ndarray]]:
    """Runs of records from state['offset'], one per fetched piece: its bytes and rows of (offset in the file, time in
    microseconds, link type, first byte in the piece, captured bytes). Interfaces met on the way are noted in state."""
    at, rows = state["offset"], []

    def run():
        out = pieces.data, np.array(rows, np.int64).reshape(-1, 5)
        rows.clear()
        return out

    pcap, head = state["kind"] == "pcap", 16 if state["kind"] == "pcap" else 12
    while stop is None or at < stop:
        if not pieces.holds(at, head):
            if rows:
                yield run()
            if not pieces.fetch(at, head):
                return
        i, order = at - pieces.base, state["order"]
        if pcap:
            sec, frac, size, _ = struct.unpack_from(order + "IIII", pieces.data, i)
            whole = 16 + size
        else:
            if pieces.data[i:i + 4] == b"\x0a\x0d\x0d\x0a":
                if rows:
                    yield run()  # before the state changes: a run's records all go by the state as it stands
                order = state["order"] = "<" if pieces.data[i + 8:i + 12] == b"\x4d\x3c\x2b\x1a" else ">"
                state["links"], state["clocks"] = [], []
            kind, whole = struct.unpack_from(order + "II", pieces.data, i)
            if whole < 12:
                break
        if not pieces.holds(at, whole):
            if rows:
                yield run()
            if not pieces.fetch(at, whole):
                return
            i = 0
        if pcap:
            rows.append((at, sec * 1_000_000 + frac * 1_000_000 // state["clocks"][0], state["links"][0], i + 16, size))
        elif kind == _INTERFACE:
            if rows:
                yield run()
            state["links"].append(struct.unpack_from(order + "H", pieces.data, i + 8)[0])
            state["clocks"].append(_clock(order, pieces.data[i + 16:i + whole - 4]))
        elif kind == _ENHANCED:
            iface, high, low, kept, _ = struct.unpack_from(order + "IIIII", pieces.data, i + 8)
            known = iface < len(state["links"])  # packets of an interface that no block describes have no link type
            rows.append((at, ((high << 32) | low) * 1_000_000 // (state["clocks"][iface] if known else 1_000_000),
                         state["links"][iface] if known else -1, i + 28, min(kept, max(0, whole - 32))))
        elif kind == _SIMPLE:
            size = min(struct.unpack_from(order + "I", pieces.data, i + 8)[0], whole - 16)
            rows.append((at, 0, state["links"][0] if state["links"] else _ETHERNET, i + 12, size))
        at += whole
    if rows:
        yield run()


def _head(f, size: int) -> dict:
    """Format of a file by its first bytes; ValueError if it is no capture."""
    if size < 24:
        raise ValueError("empty or shorter than a file header")
    return _start(_Pieces(f, 24))


def _number(order: str, data: bytes) -> np.ndarray:
    """The 32-bit number at every place of data."""
    d = np.frombuffer(data, np.uint8).astype(np.int64)
    if len(d) < 4:
        return np.empty(0, np.int64)
    parts = d[:-3], d[1:-2], d[2:-1], d[3:]
    return sum(p << (8 * i) for i, p in enumerate(parts if order == "<" else parts[::-1]))


def _record(pieces: _Pieces, head: dict, order: str, at: int, size: int) -> int | None:
    """Length of the record or block at a place if its header makes sense, else None."""
    need = 16 if head["kind"] == "pcap" else 12
    if at + need > size or not (pieces.holds(at, need) or pieces.fetch(at, need)):
        return None
    i = at - pieces.base
    if head["kind"] == "pcap":
        _, frac, kept, whole = struct.unpack_from(order + "IIII", pieces.data, i)
        fits = frac < head["clocks"][0] and 0 < kept <= _LONGEST and kept <= whole
        return 16 + kept if fits else None
    kind, whole = struct.unpack_from(order + "II", pieces.data, i)
    if whole % 4 or not 12 <= whole <= _LONGEST or at + whole > size:
        return None
    if not (pieces.holds(at, whole) or pieces.fetch(at, whole)):
        return None
    i = at - pieces.base
    return whole if struct.unpack_from(order + "I", pieces.data, i + whole - 4)[0] == whole else None


def _agrees(pieces: _Pieces, head: dict, order: str, at: int, size: int) -> bool:
    """Whether a chain of headers from a place makes sense, or reaches the file's end."""
    for met in range(_CHAIN):
        if at >= size:
            return met > 0 and at == size
        n = _record(pieces, head, order, at, size)
        if n is None:
            return False
        at += n
    return True


def _found(f, head: dict, low: int, high: int, size: int) -> int | None:
    """First place in [low, high) where a record seems to begin."""
    look, chain = 1 << 16, _Pieces(f, 1 << 16)
    for base in range(low, high, look):
        f.seek(base)
        data = f.read(min(look + 16, size - base))
        guesses = []
        for order in [head["order"]] if head["kind"] == "pcap" else ["<", ">"]:
            number = _number(order, data)
            if head["kind"] == "pcap":
                if len(number) <= 12:
                    continue
                frac, kept, whole = number[4:-8], number[8:-4], number[12:]
                fits = (frac < head["clocks"][0]) & (kept > 0) & (kept <= _LONGEST) & (kept <= whole)
            else:
                whole = number[4:]
                fits = (whole % 4 == 0) & (whole >= 12) & (whole <= _LONGEST)
            guesses += [(base + i, order) for i in np.flatnonzero(fits[:look]).tolist()]
        for at, order in sorted(guesses):
            if at < high and _agrees(chain, head, order, at, size):
                return at
    return None


def _order_at(pieces: _Pieces, head: dict, at: int, size: int) -> str:
    """Byte order of the pcapng block at a place: the one in which its two lengths agree."""
    return next((order for order in "<>" if _record(pieces, head, order, at, size)), head["order"])


def index_stretch(f, size: int, low: int, high: int, start: int | None, split_packets: int, piece: int) -> dict:
    """Records of a file that begin in [low, high): where the first does, where the first one after them does, their number,
    every split_packets-th of them, and what sections and interfaces say on the way. start: a known beginning, else a guess."""
    head = _head(f, size)
    pieces = _Pieces(f, min(piece, max(high - low, 24) + 64))
    out = {"begin": -1, "end": -1, "n": 0, "marks": [], "effects": None, "bad_at": None, "reason": None}
    effects, at, order = [], start, head["order"]
    if low == 0:
        at = head["offset"]
        if head["kind"] == "pcap":
            effects = [{"links": head["links"], "clocks": head["clocks"]}]
    elif at is None:
        at = _found(f, head, low, high, size)
    if at is None or (low and at >= high):
        return out
    out["begin"] = at
    pcap = head["kind"] == "pcap"
    if not pcap and low:
        order = _order_at(pieces, head, at, size)
    told = json.dumps(effects)
    while at < high:
        need = 16 if pcap else 12
        if at + need > size:
            break
        if not pieces.holds(at, need):
            pieces.fetch(at, need)
        i = at - pieces.base
        if pcap:
            whole, counts = 16 + struct.unpack_from(order + "I", pieces.data, i + 8)[0], True
        else:
            if pieces.data[i:i + 4] == b"\x0a\x0d\x0d\x0a":
                order = "<" if pieces.data[i + 8:i + 12] == b"\x4d\x3c\x2b\x1a" else ">"
            kind, whole = struct.unpack_from(order + "II", pieces.data, i)
            counts = kind in (_ENHANCED, _SIMPLE)
        if whole < need or at + whole > size:
            break
        if not counts:
            if kind in (_SECTION, _INTERFACE):
                if not pieces.holds(at, whole):
                    pieces.fetch(at, whole)
                    i = 0
                if kind == _SECTION:
                    effects = [{"order": order, "links": [], "clocks": []}]
                else:
                    link = struct.unpack_from(order + "H", pieces.data, i + 8)[0]
                    effects.append({"link": link, "clock": _clock(order, pieces.data[i + 16:i + whole - 4])})
                told = json.dumps(effects)
        else:
            if out["n"] % split_packets == 0:
                out["marks"].append({"offset": at, "local": out["n"], "effects": told})
            out["n"] += 1
        at += whole
    out["end"], out["effects"] = at, told if effects else None
    if at < high and at < size:  # nothing behind a record that is cut or makes no sense can be relied on
        out |= {"end": size, "bad_at": at, "reason": "cut in the middle of a record"}
    return out


def _index(split_packets: int, piece: int, index_bytes: int):
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                low = r.k * index_bytes
                start = None if pd.isna(r.start) else int(r.start)
                row = {"path": r.path, "k": r.k, "size": r.size}
                none = {"begin": -1, "end": -1, "n": 0, "marks": [], "effects": None, "bad_at": None, "reason": None}
                try:
                    with _open(r.path) as f:
                        row |= index_stretch(f, r.size, low, min(r.size, low + index_bytes), start, split_packets, piece)
                except (ValueError, OSError) as e:
                    row |= none | ({"bad_at": low, "reason": str(e)} if r.k == 0 else {})
                yield pd.DataFrame([row]).astype({"bad_at": "Int64"})

    return index


def _sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sizes = []
        for path in pdf["path"]:
            try:
                with _open(path) as f:
                    sizes.append(f.size())
            except OSError:
                sizes.append(0)  # the first pass meets the error again and says so
        yield pd.DataFrame({"path": pdf["path"], "size": sizes})


def _tasks(n: int) -> int:
    # A row of a few bytes stands for a whole file or stretch: the number of tasks has to be said, or they are merged.
    return max(1, min(n, _MOST_TASKS))


def _indexed(found: DataFrame, split_packets: int, piece: int, index_bytes: int) -> DataFrame:
    """Written index rows of all stretches, each verified from the file's start on."""
    run = _index(split_packets, piece, index_bytes)
    files = found.select("path").distinct()
    sizes = files.repartition(_tasks(files.count())).mapInPandas(_sizes, "path string, size bigint")
    last = F.greatest(F.ceil(F.col("size") / index_bytes) - 1, F.lit(0)).cast("int")
    stretches = materialize(sizes.select("path", "size", F.explode(F.sequence(F.lit(0), last)).alias("k")), "stretches")
    asked = stretches.withColumn("start", F.lit(None).cast("bigint"))
    rows = materialize(asked.repartition(_tasks(asked.count())).mapInPandas(run, _INDEX_DDL), "index")
    before = Window.partitionBy("path").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        # Where the records before end is where those of a stretch begin, or they leave none to it.
        end = F.last(F.when(F.col("begin") >= 0, F.col("end")), ignorenulls=True).over(before)
        expected = F.when(F.col("end_before") < F.least("size", (F.col("k") + 1) * F.lit(index_bytes)), F.col("end_before")).otherwise(-1)
        chained = rows.withColumn("end_before", end).where("k > 0 AND end_before IS NOT NULL").withColumn("start", expected)
        wrong = materialize(chained.where("start <> begin").select("path", "size", "k", "start"), "unverified")
        n = wrong.count()
        if not n:
            return rows
        # A start of -1 lies before the stretch: nothing begins there, and the walk gives an empty row.
        empty = wrong.where("start = -1").select("path", "k", "size", *[F.lit(-1).cast("bigint").alias(c) for c in ("begin", "end")], F.lit(0).cast("bigint").alias("n"))
        again = wrong.where("start >= 0").repartition(_tasks(n)).mapInPandas(run, _INDEX_DDL)
        rows = materialize(rows.join(wrong.select("path", "k"), ["path", "k"], "left_anti").unionByName(again)
                           .unionByName(empty, allowMissingColumns=True), "index")


def _splits(index: DataFrame) -> DataFrame:
    """Stretches to decode: path, what holds at their start, offset, stop and number of the first record."""
    w = Window.partitionBy("path").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    known = index.select("path", "marks", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"), F.collect_list("effects").over(w).alias("before"))
    marks = known.select("path", "base", "before", F.explode("marks").alias("m"))
    last = F.lead("m.offset").over(Window.partitionBy("path").orderBy("m.offset"))
    return marks.select("path", F.array_append("before", F.col("m.effects")).alias("effects"), F.col("m.offset").alias("offset"),
                        F.coalesce(last, F.lit(np.iinfo(np.int64).max)).alias("stop"), (F.col("base") + F.col("m.local")).alias("first_pkt"))


def _state_at(f, effects: list[str], offset: int) -> dict:
    """What _walk has to know at an offset: the file's format, with what sections and interfaces before it said."""
    state = _start(_Pieces(f, 24)) | {"offset": offset}
    for e in (e for told in effects for e in json.loads(told)):
        if "links" in e:
            state |= {k: list(v) if isinstance(v, list) else v for k, v in e.items()}
        else:
            state["links"].append(e["link"])
            state["clocks"].append(e["clock"])
    return state


class _Fields:
    """Bytes of many packets in one piece: the same place of every packet at once; places outside a packet give 0."""

    def __init__(self, data: bytes, first: np.ndarray, size: np.ndarray):
        self.data, self.first, self.size = np.frombuffer(data, np.uint8), first, size

    def byte(self, at: np.ndarray | int) -> np.ndarray:
        at = np.broadcast_to(at, self.first.shape)
        inside = (at >= 0) & (at < self.size)
        return np.where(inside, self.data[np.where(inside, self.first + at, 0)], 0).astype(np.int64)

    def short(self, at: np.ndarray | int) -> np.ndarray:
        return (self.byte(at) << 8) | self.byte(at + 1)

    def texts(self, at: np.ndarray, n: int, family: int, some: np.ndarray) -> np.ndarray:
        """Addresses of n bytes of some packets as text; each different one is written once."""
        raw = self.data[(self.first + at)[some][:, None] + np.arange(n)]
        names, back = np.unique(np.ascontiguousarray(raw).view(f"V{n}").ravel(), return_inverse=True)
        return np.array([socket.inet_ntop(family, x.tobytes().ljust(n, b"\0")) for x in names], object)[back]


_IP_KINDS = (0x0800, 0x86DD)


def _network(p: _Fields, link: np.ndarray) -> np.ndarray:
    """Where each packet's IP header starts, or -1."""
    at, kind = np.full(len(link), 14), p.short(12)
    while (tagged := np.isin(kind, (0x8100, 0x88A8)) & (at < p.size)).any():
        kind = np.where(tagged, p.short(at + 2), kind)
        at = at + 4 * tagged
    ethernet = np.where(np.isin(kind, _IP_KINDS), at, -1)
    cooked = np.where(np.isin(p.short(14), _IP_KINDS), 16, -1)
    return np.select([link == _ETHERNET, np.isin(link, _RAW), link == _LINUX_SLL, link == _LOOPBACK], [ethernet, 0, cooked, 4], -1)


def _packets(data: bytes, run: np.ndarray, basis: str) -> tuple[np.ndarray, dict]:
    """Which records are TCP or UDP packets, and their columns from src_ip on."""
    p = _Fields(data, run[:, 3], run[:, 4])
    at = _network(p, run[:, 2])
    fits = (at >= 0) & (p.size >= at + 20)
    version = p.byte(at) >> 4
    v4, v6 = fits & (version == 4), fits & (version == 6) & (p.size >= at + 40)
    v4 &= (p.short(at + 6) & 0x1FFF) == 0
    ip_len = np.where(v4, (p.byte(at) & 0xF) * 4, 40)
    total = np.where(v4, p.short(at + 2), 40 + p.short(at + 4))
    proto, t = np.where(v4, p.byte(at + 9), p.byte(at + 6)), at + ip_len
    while (more := v6 & np.isin(proto, (0, 43, 60)) & (p.size >= t + 8)).any():  # extension headers before the transport
        proto, t = np.where(more, p.byte(t), proto), np.where(more, t + 8 + p.byte(t + 1) * 8, t)
    tcp, udp = (v4 | v6) & (proto == TCP) & (p.size >= t + 16), (v4 | v6) & (proto == UDP) & (p.size >= t + 8)
    keep = np.flatnonzero(tcp | udp)
    offset = (p.byte(t + 12) >> 4) * 4
    header = np.where(udp, 8, np.where(offset == 0, 20, offset))
    length = p.size if basis == "frame" else total
    src, dst = np.empty(len(run), object), np.empty(len(run), object)
    for some, n, family, a, b in ((v4, 4, socket.AF_INET, 12, 16), (v6, 16, socket.AF_INET6, 8, 24)):
        some = some & (tcp | udp)
        if some.any():
            src[some], dst[some] = p.texts(at + a, n, family, some), p.texts(at + b, n, family, some)
    columns = {
        "src_ip": src, "dst_ip": dst, "src_port": p.short(t), "dst_port": p.short(t + 2), "protocol": proto,
        "payload_len": np.maximum(0, length - ip_len - header), "header_len": header,
        "flags": np.where(tcp, p.byte(t + 13) & 0x3F, 0), "win": np.where(tcp, p.short(t + 14), -1),
    }
    return keep, {name: values[keep] for name, values in columns.items()}


def _decode(basis: str, max_packets: int | None, piece: int):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for split in pdf.itertuples():
                name, n = split.path.rsplit("/", 1)[-1], split.first_pkt
                with _open(split.path) as f:
                    for data, run in _walk(_Pieces(f, piece), _state_at(f, list(split.effects), split.offset), split.stop):
                        if max_packets is not None:
                            run = run[:max(0, max_packets - n)]
                        if not len(run):
                            break
                        keep, columns = _packets(data, run, basis)
                        yield pd.DataFrame({"capture_id": name, "path": split.path, "pkt_no": n + keep, "ts_us": run[keep, 1], **columns})
                        n += len(run)

    return decode


def find_captures(spark: SparkSession, path: str) -> DataFrame:
    """Paths and sizes of all captures below a folder, empty ones too; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pcap*").load(path)
    # A scan gives no rows for empty files, so they come from its listing, which the driver holds anyway.
    listed = spark.createDataFrame([(re.sub("^file:/+", "file:/", unquote(p)),) for p in files.inputFiles()], "path string")
    found = files.select("path", "length")
    empty = listed.join(found, "path", "left_anti").withColumn("length", F.lit(0).cast("bigint"))
    return found.unionByName(empty).where(F.col("path").rlike(r"\.(pcap|pcapng)$"))


@dataclass(frozen=True)
class Captures:
    """Packets of the captures that can be read, and (path, bad_at, reason) of what cannot."""

    packets: DataFrame
    bad: DataFrame


def read_captures(spark: SparkSession, path: str | DataFrame, max_packets: int | None = None, payload_basis: str = "frame",
                  split_packets: int = 1 << 18, piece: int = PIECE, index_bytes: int = INDEX_BYTES) -> Captures:
    """TCP and UDP packets of captures; pkt_no counts every record of a file, `max_packets` caps it."""
    found = path if isinstance(path, DataFrame) else find_captures(spark, path)
    index = _indexed(found, split_packets, piece, index_bytes)
    splits = materialize(_splits(index), "splits")
    if max_packets is not None:
        splits = splits.where(F.col("first_pkt") < max_packets)
    packets = splits.repartition(_tasks(splits.count())).mapInPandas(_decode(payload_basis, max_packets, piece), PACKET_DDL)
    return Captures(packets, index.where("reason IS NOT NULL").select("path", "bad_at", "reason"))


def decode_captures(spark: SparkSession, path: str | DataFrame, max_packets: int | None = None, payload_basis: str = "frame",
                    split_packets: int = 1 << 18, piece: int = PIECE) -> DataFrame:
    """The packets of read_captures."""
    return read_captures(spark, path, max_packets, payload_basis, split_packets, piece).packets


def config_key(cfg: FlowConfig, max_packets: int | None = None, payload_basis: str = "frame") -> str:
    """Hash of everything that the flows of a capture depend on; how the work is cut up does not count."""
    rules = {k: v for k, v in asdict(cfg).items() if k not in ("heavy_packets", "block_packets", "fan_in", "table_steps")}
    return hashlib.sha256(json.dumps([rules, max_packets, payload_basis], sort_keys=True).encode()).hexdigest()


def labeled_captures(spark: SparkSession, path: str, config: str, exclude: list[str] = ()) -> DataFrame:
    """Captures below a folder with their labels and the hash of what is to be extracted."""
    found = labels.path_labels(find_captures(spark, path)).withColumn("config", F.lit(config))
    return found.where(~F.col("specific_family").isin(list(exclude))) if exclude else found


def load_captures(spark: SparkSession, path: str, done: DataFrame | None = None, exclude: list[str] = (),
                  max_packets: int | None = None, idle_us: int | None = None, active_us: int | None = None,
                  cfg: FlowConfig | None = None, payload_basis: str = "frame") -> tuple[DataFrame, DataFrame]:
    """Labeled captures not yet done with these parameters, and their packets; timeouts may come as cfg."""
    cfg = FlowConfig(idle_us=idle_us, active_us=active_us) if cfg is None else cfg
    found = labeled_captures(spark, path, config_key(cfg, max_packets, payload_basis), exclude)
    if done is not None:
        found = new_captures(found, done, LEDGER_KEY)
    return found, decode_captures(spark, found, max_packets, payload_basis)


def record_captures(found: DataFrame, path: str) -> None:
    """Append captures whose flows are written to a ledger, to be given as `done` next time."""
    found.select(*LEDGER_KEY).write.mode("append").parquet(path)
