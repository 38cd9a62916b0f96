"""Network-shaped views of the given tables, written once for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.functions.schema import FEATURES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

_MESSY = [
    name if i % 4 == 0 else name.lower() if i % 4 == 1 else f" {name} " if i % 4 == 2 else name.lower().replace(" ", "_")
    for i, name in enumerate(FEATURES)
]
HEADER_NAMES = _MESSY + [
    " Dst Port", "TotLen Fwd Pkts", "FWD PSH Flags ", "Label", "Mystery_Col", "Source_IP", "RST Flag Cnt", "Protocol",
    "Fwd Header Length.1", "pkt_len_mean", "Flow Byts/s", "Destination_Port", "Filename", "Flow_ID", "Timestamp",
]

_PACKETS = """
SELECT concat('cap', cast(user_id % 4 AS string)) AS capture_id, event_id AS pkt_no, {US} AS ts_us,
 CASE WHEN k % 3 = 0 THEN sip ELSE cip END AS src_ip, CASE WHEN k % 3 = 0 THEN cip ELSE sip END AS dst_ip,
 CASE WHEN k % 3 = 0 THEN sport ELSE cport END AS src_port, CASE WHEN k % 3 = 0 THEN cport ELSE sport END AS dst_port,
 proto AS protocol,
 CASE WHEN k % 4 = 0 THEN 0 ELSE cast(floor(value * 10) AS int) END AS payload_len,
 CASE WHEN proto = 17 THEN 8 ELSE 20 + 4 * (k % 3) END AS header_len,
 CASE WHEN proto = 17 THEN 0 ELSE
   (CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) + (CASE WHEN event_type = 'view' THEN 2 ELSE 0 END)
 + (CASE WHEN event_type = 'error' AND k % 5 = 0 THEN 4 ELSE 0 END)
 + (CASE WHEN event_type = 'purchase' THEN 8 ELSE 0 END)
 + (CASE WHEN event_type = 'click' OR k % 2 = 0 THEN 16 ELSE 0 END) + (CASE WHEN k % 50 = 0 THEN 32 ELSE 0 END) END
   AS flags,
 CASE WHEN proto = 17 THEN -1 ELSE 1024 + 37 * k END AS win
FROM (SELECT e.*, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k,
        concat('10.0.', cast(user_id {IDIV} 250 AS string), '.', cast(user_id % 250 + 1 AS string)) AS cip,
        concat('192.168.1.', cast(user_id % 7 + 1 AS string)) AS sip,
        cast(40000 + user_id AS int) AS cport,
        CASE user_id % 4 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 53 ELSE 22 END AS sport,
        CASE WHEN user_id % 5 = 0 THEN 17 ELSE 6 END AS proto FROM events e) x
"""

_FRAMES = """
SELECT concat('cap', cast(l_suppkey % 4 AS string)) AS capture_id, l_orderkey AS order_no, l_linenumber AS line_no,
 CASE WHEN l_partkey % 5 = 0 THEN 6 ELSE 4 END AS ip_version, 5 + l_linenumber % 3 AS ihl,
 CASE cast(l_partkey % 9 AS int) WHEN 0 THEN 1 WHEN 1 THEN 17 WHEN 2 THEN 17 ELSE 6 END AS protocol,
 CASE WHEN l_partkey % 11 = 0 THEN 0 ELSE 5 + cast(l_suppkey % 6 AS int) END AS data_offset,
 cast(floor(l_quantity * 20) AS int) AS frame_len, cast(floor(l_quantity * 20) AS int) - 14 AS ip_len,
 cast(l_orderkey % 64 AS int) AS flags
FROM lineitem
"""

_RAW_FLOWS = """
SELECT cast(l_suppkey AS string) AS {Q}Dst Port{Q},
 CASE WHEN l_linenumber = 7 THEN 'inf' WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'NaN'
      ELSE cast(cast(floor(l_quantity * 1000) AS bigint) AS string) END AS {Q}flow_duration{Q},
 cast(l_partkey AS string) AS {Q}TotLen Fwd Pkts{Q},
 CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN 'n/a'
      ELSE cast(cast(floor(l_extendedprice) AS bigint) AS string) END AS {Q}Flow Byts/s{Q},
 cast(l_linenumber AS string) AS {Q}FWD PSH Flags {Q}, '0' AS {Q}Fwd Header Length.1{Q},
 cast(l_linenumber + 1 AS string) AS {Q}Flow Duration {Q}, l_returnflag AS {Q}Label{Q}
FROM lineitem
"""

_RAW_LABELS = """
SELECT o_orderkey AS row_id, CASE o_orderkey % 16 WHEN 0 THEN ' BENIGN ' WHEN 1 THEN 'DDoS' WHEN 2 THEN 'PortScan'
 WHEN 3 THEN 'DoS Hulk' WHEN 4 THEN 'DoS GoldenEye' WHEN 5 THEN 'DoS slowloris' WHEN 6 THEN 'DoS Slowhttptest'
 WHEN 7 THEN 'Heartbleed' WHEN 8 THEN 'FTP-Patator' WHEN 9 THEN 'SSH-Patator' WHEN 10 THEN 'Bot'
 WHEN 11 THEN 'Web Attack – XSS' WHEN 12 THEN 'Web Attack – Brute Force' WHEN 13 THEN 'Infiltration'
 WHEN 14 THEN 'benign' ELSE 'Weird Thing' END AS raw_label FROM orders
"""

_SCORED = """
SELECT o_orderkey AS row_id, o_orderpriority AS dataset, concat('cap', cast(o_custkey % 12 AS string)) AS capture_id,
 concat('F', cast(o_custkey % 10 AS string)) AS specific_family,
 CASE o_orderkey % 5 WHEN 0 THEN 'DoS' WHEN 1 THEN 'DDoS' WHEN 2 THEN 'PortScan' WHEN 3 THEN 'Botnet' ELSE 'Malware' END
   AS category,
 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y_true,
 round(((o_orderkey * 7919) % 10007) / cast(10007 AS double) * cast(0.7 AS double)
   + CASE WHEN o_orderstatus = 'F' THEN cast(0.3 AS double) ELSE cast(0 AS double) END, 4) AS prob
FROM orders
"""

_CAPTURE_PATHS = """
SELECT s_suppkey AS file_id, concat('/data/', CASE WHEN s_suppkey % 2 = 0 THEN 'Malware' ELSE 'Benign' END, '/',
 CASE WHEN s_suppkey % 3 = 0 THEN concat('Fam', cast(s_nationkey AS string), '/') ELSE '' END,
 'name', cast(s_suppkey AS string),
 CASE WHEN s_suppkey % 7 = 0 THEN '.txt' WHEN s_suppkey % 5 = 0 THEN '.pcapng' ELSE '.pcap' END) AS path
FROM supplier
"""

_DOH_ROWS = """
SELECT p_partkey AS row_id, p_size * cast(0.25 AS double) AS Duration, p_retailprice AS PacketLengthMean,
 p_retailprice * cast(2 AS double) AS PacketLengthVariance, cast(p_size AS double) AS PacketLengthStandardDeviation,
 cast(p_size * 10 AS double) AS FlowBytesSent, cast(p_size * 20 AS double) AS FlowBytesReceived,
 cast(p_size AS double) / 4 AS FlowSentRate,
 CASE p_partkey % 3 WHEN 0 THEN 'NonDoH' WHEN 1 THEN 'Malicious' ELSE 'Benign' END AS Label FROM part
"""

# One file of 2 to 100 columns per part; spellings rotate through HEADER_NAMES.
_HEADERS = """
SELECT dataset, ordinal, {ARR}[cast((p_partkey + ordinal) % %(n)d AS int) {OFF}] AS name
FROM (SELECT p_partkey, concat('file', cast(p_partkey AS string)) AS dataset, {EXPLODE} AS ordinal FROM part) f
""".replace("%(n)d", str(len(HEADER_NAMES)))

_VECTORS = """
SELECT vec_id AS row_id, embedding, label AS family, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y_true FROM embeddings
"""

VIEWS = {
    "packets": _PACKETS, "frames": _FRAMES, "raw_flows": _RAW_FLOWS, "raw_labels": _RAW_LABELS, "scored": _SCORED,
    "capture_paths": _CAPTURE_PATHS, "doh_rows": _DOH_ROWS, "headers": _HEADERS, "feature_vectors": _VECTORS,
}


def _names(open_: str, close: str) -> str:
    return open_ + ", ".join("'" + n + "'" for n in HEADER_NAMES) + close


def _fill(text: str, spark: bool) -> str:
    parts = {
        "{US}": "unix_micros(cast(ts AS timestamp))" if spark else "epoch_us(ts)",
        "{IDIV}": "div" if spark else "//",
        "{Q}": "`" if spark else '"',
        "{ARR}": _names("array(", ")") if spark else _names("[", "]"),
        "{OFF}": "" if spark else "+ 1",
        "{EXPLODE}": "explode(sequence(0, p_size * 2 - 1))" if spark else "unnest(range(0, p_size * 2))",
    }
    for key, value in parts.items():
        text = text.replace(key, value)
    return text.strip()


def duck(*names: str) -> str:
    """`WITH` prefix naming the views for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({_fill(VIEWS[n], spark=False)})" for n in names) + "\n"


def duck_body(name: str) -> str:
    return _fill(VIEWS[name], spark=False)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Views of many rows for each row of their table: how many. A small file of such a table is one task's input.
_ROWS_OF_ONE = {"headers": "p_size * 2"}
TASK_ROWS = 1 << 18


def _spread(rows: DataFrame, each: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows dealt over as many tasks as what they become needs, about `task_rows` a task."""
    total = rows.agg(F.sum(F.expr(each).cast("bigint"))).first()[0] or 0
    return rows.repartition(max(total, 0) // task_rows + 1)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _fill(VIEWS[name], spark=True)
    source = next(t for t in TABLES if f"FROM {t}" in text)
    rows = table(spark, sf_dir, source)
    if name in _ROWS_OF_ONE:
        rows = _spread(rows, _ROWS_OF_ONE[name])
    return spark.sql(text.replace(f"FROM {source}", "FROM {src}"), src=rows)
