import socket
import struct

import pytest

from flowspark.sources import captures


def ip4(proto, body, src="10.0.0.1", dst="10.0.0.2", options=b""):
    head = struct.pack(">BBHHHBBH4s4s", 0x40 | (5 + len(options) // 4), 0, 20 + len(options) + len(body), 0, 0, 64, proto, 0,
                       socket.inet_aton(src), socket.inet_aton(dst))
    return head + options + body


def tcp(flags, payload=b"", sport=1000, dport=80, offset=5):
    return struct.pack(">HHIIBBHHH", sport, dport, 0, 0, offset << 4, flags, 4096, 0, 0) + b"\0" * (offset * 4 - 20) + payload


def udp(payload, sport=53, dport=5353):
    return struct.pack(">HHHH", sport, dport, 8 + len(payload), 0) + payload


ETH = b"\0" * 12 + b"\x08\x00"
FRAMES = [
    ETH + ip4(6, tcp(2, b"abc")),
    b"\0" * 12 + b"\x08\x06" + b"\0" * 28,                                  # not IP: counted, not kept
    ETH + ip4(17, udp(b"12345")),
    b"\0" * 12 + b"\x81\x00\0\x05\x08\x00" + ip4(6, tcp(0x11, b"", offset=8), options=b"\0" * 4),
    b"\0" * 12 + b"\x86\xdd" + struct.pack(">IHBB16s16s", 6 << 28, 24, 6, 9, b"\0" * 15 + b"\1", b"\0" * 15 + b"\2") + tcp(4, b"wxyz"),
]
WANT = [  # number, source, ports, protocol, payload (link layer counted), header, flags, window
    (0, "10.0.0.1", 1000, 80, 6, 3 + 14, 20, 2, 4096), (2, "10.0.0.1", 53, 5353, 17, 5 + 14, 8, 0, -1),
    (3, "10.0.0.1", 1000, 80, 6, 18, 32, 0x11, 4096), (4, "::1", 1000, 80, 6, 4 + 14, 20, 4, 4096),
]


def pcap():
    out = struct.pack("<IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    for i, f in enumerate(FRAMES):
        out += struct.pack("<IIII", 100 + i, 250_000, len(f), len(f)) + f
    return out


def block(kind, body):
    body += b"\0" * (-len(body) % 4)
    return struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)


def pcapng():
    out = block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1))
    out += block(1, struct.pack("<HHI", 1, 0, 0) + struct.pack("<HHB3x", 9, 1, 9) + struct.pack("<HH", 0, 0))
    for i, f in enumerate(FRAMES):
        t = (100 + i) * 10**9 + 250_000_000
        out += block(6, struct.pack("<IIIII", 0, t >> 32, t & 0xFFFFFFFF, len(f), len(f)) + f)
    return out


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("caps")
    for rel, data in {"Malware/Zeus/one.pcap": pcap(), "Benign/Gmail.pcapng": pcapng(), "Benign/notes.txt": b"x"}.items():
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        (root / rel).write_bytes(data)
    return str(root)


@pytest.mark.parametrize("split", [1, 2, 1000])
def test_both_formats_decode_alike(spark, folder, split):
    rows = captures.decode_captures(spark, folder, split_packets=split).orderBy("capture_id", "pkt_no").collect()
    for name in ("one.pcap", "Gmail.pcapng"):
        mine = [r for r in rows if r.capture_id == name]
        assert [(r.pkt_no, r.src_ip, r.src_port, r.dst_port, r.protocol, r.payload_len, r.header_len, r.flags, r.win) for r in mine] == WANT
        assert [r.ts_us for r in mine] == [(100 + n) * 1_000_000 + 250_000 for n in (0, 2, 3, 4)]


def test_cap_counts_every_frame(spark, folder):
    rows = captures.decode_captures(spark, folder, max_packets=3).collect()
    assert sorted((r.capture_id, r.pkt_no) for r in rows) == [("Gmail.pcapng", 0), ("Gmail.pcapng", 2), ("one.pcap", 0), ("one.pcap", 2)]


def test_payload_from_ip_length(spark, folder):
    rows = captures.decode_captures(spark, folder, payload_basis="ip").where("capture_id = 'one.pcap'").orderBy("pkt_no").collect()
    assert [r.payload_len for r in rows] == [3, 5, 0, 4]


def test_only_new_captures_are_read(spark, folder):
    found, packets = captures.load_captures(spark, folder)
    assert {(r.capture_id, r.binary_label, r.specific_family) for r in found.collect()} == {
        ("one.pcap", "MALICIOUS", "Zeus"), ("Gmail.pcapng", "BENIGN", "Gmail")}
    left, more = captures.load_captures(spark, folder, done=found.where("binary_label = 'BENIGN'"))
    assert [r.capture_id for r in left.collect()] == ["one.pcap"] and more.select("capture_id").distinct().count() == 1
    assert captures.load_captures(spark, folder, done=found, max_packets=5)[0].count() == 2
    assert captures.load_captures(spark, folder, exclude=["Zeus"])[0].count() == 1


def test_changed_timeouts_are_extracted_again(spark, folder, tmp_path):
    found, _ = captures.load_captures(spark, folder, idle_us=5, active_us=7)
    captures.record_captures(found, str(tmp_path / "ledger"))
    done = spark.read.parquet(str(tmp_path / "ledger"))
    assert captures.load_captures(spark, folder, done=done, idle_us=5, active_us=7)[0].count() == 0
    assert captures.load_captures(spark, folder, done=done, idle_us=5, active_us=8)[0].count() == 2


@pytest.mark.parametrize("piece", [24, 100, 1 << 20])
def test_pieces_of_any_size_decode_alike(spark, folder, piece):
    rows = captures.decode_captures(spark, folder, split_packets=2, piece=piece).orderBy("capture_id", "pkt_no").collect()
    for name in ("one.pcap", "Gmail.pcapng"):
        mine = [r for r in rows if r.capture_id == name]
        assert [(r.pkt_no, r.src_ip, r.src_port, r.dst_port, r.protocol, r.payload_len, r.header_len, r.flags, r.win) for r in mine] == WANT


def test_reads_are_bounded_by_bytes(tmp_path):
    class Counted:
        def __init__(self, data):
            self.data, self.at, self.reads = data, 0, 0

        def seek(self, at):
            self.at = at

        def read(self, n):
            self.reads += 1
            self.at += n
            return self.data[self.at - n:self.at]

    data = pcap() + b"".join(struct.pack("<IIII", 1, 2, 60, 60) + b"\0" * 60 for _ in range(10_000))
    f = Counted(data)
    pieces = captures._Pieces(f, 100_000)
    state = captures._start(pieces)
    assert sum(len(run) for _, run in captures._walk(pieces, state, None)) == 10_000 + len(FRAMES)
    assert f.reads <= 3 + 2 * len(data) / 100_000


def test_nanoseconds_are_cut_exactly(spark, tmp_path):
    t = 1_700_000_000_123_456_999
    data = block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1))
    data += block(1, struct.pack("<HHI", 1, 0, 0) + struct.pack("<HHB3x", 9, 1, 9) + struct.pack("<HH", 0, 0))
    data += block(6, struct.pack("<IIIII", 0, t >> 32, t & 0xFFFFFFFF, len(FRAMES[0]), len(FRAMES[0])) + FRAMES[0])
    (tmp_path / "n.pcapng").write_bytes(data)
    assert [r.ts_us for r in captures.decode_captures(spark, str(tmp_path)).collect()] == [1_700_000_000_123_456]


def test_many_files_are_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    for i in range(40):
        (tmp_path / f"c{i}.pcap").write_bytes(pcap())
    packets = captures.decode_captures(spark, str(tmp_path), split_packets=2)
    tasks = packets.select(F.spark_partition_id().alias("p")).distinct().count()
    assert packets.count() == 40 * len(WANT) and tasks > 10


def stretches(data, size):
    """Offsets of all records, from stretches of `size` bytes that are verified one after the other; and the repairs."""
    import io

    f, rows, repairs, end = io.BytesIO(data), [], 0, 0
    for low in range(0, len(data), size):
        high = min(len(data), low + size)
        row = captures.index_stretch(f, len(data), low, high, None, 1, 1 << 20)
        want = -1 if end >= high else end
        if low and row["begin"] != want:
            repairs += 1
            row = captures.index_stretch(f, len(data), low, high, end, 1, 1 << 20)
        assert low == 0 or row["begin"] == want
        end = row["end"] if row["begin"] >= 0 else end
        rows.append(row)
    return [m["offset"] for r in rows for m in r["marks"]], repairs


@pytest.mark.parametrize("made", [pcap, pcapng])
def test_stretches_cut_at_every_offset_hold_the_same_records(made):
    data = made()
    whole = stretches(data, len(data))[0]
    assert len(whole) == len(FRAMES)
    for size in range(1, len(data)):
        assert stretches(data, size)[0] == whole


def test_guessed_records_are_mostly_right():
    import random

    rng = random.Random(5)
    data = struct.pack("<IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    for i in range(3000):
        n = rng.randrange(60, 1500)
        data += struct.pack("<IIII", 1_500_000_000 + i, rng.randrange(10**6), n, n) + rng.randbytes(n)
    offsets, repairs = stretches(data, 7001)
    assert len(offsets) == 3000 and repairs <= 3


@pytest.mark.parametrize("size", [40, 64, 101])
def test_one_file_is_indexed_by_many_tasks(spark, folder, size, monkeypatch):
    seen = []
    keep = captures.materialize

    def watched(df, name):
        seen.append((name, keep(df, name)))
        return seen[-1][1]

    monkeypatch.setattr(captures, "materialize", watched)
    got = captures.read_captures(spark, folder, split_packets=2, index_bytes=size)
    rows = got.packets.orderBy("capture_id", "pkt_no").collect()
    for name in ("one.pcap", "Gmail.pcapng"):
        mine = [r for r in rows if r.capture_id == name]
        assert [(r.pkt_no, r.src_ip, r.src_port, r.dst_port, r.protocol, r.payload_len, r.header_len, r.flags, r.win) for r in mine] == WANT
        assert [r.ts_us for r in mine] == [(100 + n) * 1_000_000 + 250_000 for n in (0, 2, 3, 4)]
    assert got.bad.count() == 0
    index = dict(seen)["index"]
    assert index.groupBy("path").count().agg({"count": "min"}).first()[0] > 1


def test_later_sections_and_interfaces_count_in_later_stretches(spark, tmp_path):
    """A second section in the other byte order, with an interface of another clock, met many stretches before its packets."""
    def big(kind, body):
        body += b"\0" * (-len(body) % 4)
        return struct.pack(">II", kind, len(body) + 12) + body + struct.pack(">I", len(body) + 12)

    data = pcapng() + big(0x0A0D0D0A, struct.pack(">IHHq", 0x1A2B3C4D, 1, 0, -1))
    data += big(1, struct.pack(">HHI", 1, 0, 0) + struct.pack(">HHB3x", 9, 1, 3) + struct.pack(">HH", 0, 0))
    for i in range(20):
        data += big(6, struct.pack(">IIIII", 0, 0, 5000 + i, len(FRAMES[0]), len(FRAMES[0])) + FRAMES[0])
    data += big(6, struct.pack(">IIIII", 7, 0, 1, len(FRAMES[0]), len(FRAMES[0])) + FRAMES[0])  # an interface nobody described
    (tmp_path / "two.pcapng").write_bytes(data)
    got = captures.read_captures(spark, str(tmp_path), split_packets=3, index_bytes=90)
    rows = got.packets.orderBy("pkt_no").collect()
    assert [r.pkt_no for r in rows] == [0, 2, 3, 4, *range(5, 25)]
    assert [r.ts_us for r in rows[4:]] == [(5000 + i) * 1000 for i in range(20)]


def test_bad_captures_are_set_aside(spark, folder, tmp_path):
    import shutil

    root = tmp_path / "mixed"
    shutil.copytree(folder, root)
    whole = pcap()
    (root / "Benign" / "empty.pcap").write_bytes(b"")
    (root / "Benign" / "foreign.pcap").write_bytes(b"PK\x03\x04" + b"x" * 500)
    (root / "Benign" / "short.pcap").write_bytes(whole[:10])
    (root / "Benign" / "cut.pcap").write_bytes(whole[:-10])
    (root / "Benign" / "header.pcap").write_bytes(whole[:24])
    (root / "Benign" / "ng.pcapng").write_bytes(pcapng()[:-7])
    for size in (captures.INDEX_BYTES, 60):
        got = captures.read_captures(spark, str(root), index_bytes=size)
        bad = {r.path.rsplit("/", 1)[-1]: (r.bad_at, r.reason) for r in got.bad.collect()}
        assert {k: v[0] for k, v in bad.items()} == {
            "empty.pcap": 0, "foreign.pcap": 0, "short.pcap": 0, "cut.pcap": len(whole) - 16 - len(FRAMES[4]),
            "ng.pcapng": len(pcapng()) - len(block(6, b"\0" * 20 + FRAMES[4]))}
        counts = {r.capture_id: r["count"] for r in got.packets.groupBy("capture_id").count().collect()}
        assert counts == {"one.pcap": 4, "Gmail.pcapng": 4, "cut.pcap": 3, "ng.pcapng": 3}
