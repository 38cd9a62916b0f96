import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from flowspark.session import get_session  # noqa: E402

PACKET_DDL = ("capture_id string, pkt_no bigint, ts_us bigint, src_ip string, dst_ip string, src_port int, dst_port int, "
              "protocol int, payload_len int, header_len int, flags int, win int")


@pytest.fixture(scope="session")
def spark():
    return get_session(
        "tests", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                    "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})


@pytest.fixture(scope="session")
def make_packets(spark):
    """Packets of one or more connections from (seconds, from_a, flags, further fields) tuples."""

    def make(*rows, protocol=6, capture="c"):
        out = []
        for i, (sec, from_a, flags, *more) in enumerate(rows):
            extra = more[0] if more else {}
            a, b = ("10.0.0.1", 1000), ("10.0.0.2", 80)
            src, dst = (a, b) if from_a else (b, a)
            out.append((capture, extra.get("no", i), round(sec * 1_000_000), src[0], dst[0], src[1], dst[1], protocol,
                        extra.get("len", 10), extra.get("hdr", 20), flags, extra.get("win", 100)))
        return spark.createDataFrame(out, PACKET_DDL)

    return make
