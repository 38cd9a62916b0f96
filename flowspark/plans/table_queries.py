"""Sources and sinks, schema checks, cleaning and labels (inventory sections A, B and C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowspark.functions import schema as sc
from flowspark.operators import labels, metrics, sampling
from flowspark.operators import normalize as nz
from flowspark.plans.registry import query, rounded, values
from flowspark.plans.views import duck, view
from flowspark.session import scratch_path
from flowspark.sources import tables

_RAW_NORMAL = """SELECT "Dst Port" AS "Destination Port", "flow_duration" AS "Flow Duration",
 "TotLen Fwd Pkts" AS "Total Length of Fwd Packets", "Flow Byts/s" AS "Flow Bytes/s", "FWD PSH Flags " AS "Fwd PSH Flags",
 "Fwd Header Length.1", "Label" FROM raw_flows"""
_RAW_FEATURES = ["Destination Port", "Flow Duration", "Total Length of Fwd Packets", "Flow Bytes/s", "Fwd PSH Flags"]

# ---- sources and sinks -------------------------------------------------------------------------


@query("scan_csv_flows", duck("raw_flows") + _RAW_NORMAL)
def scan_csv_flows(spark, sf):
    raw, path = view(spark, sf, "raw_flows"), scratch_path(spark, "csv")
    tables.write_csv(raw, path)
    return nz.normalize(tables.scan_csv(spark, path, columns=raw.columns))


@query("scan_dir_capture_id", duck("raw_labels") + """SELECT concat('part', cast(row_id % 8 AS VARCHAR)) AS capture_id,
 cast(row_id AS VARCHAR) AS row_id, trim(raw_label) AS label FROM raw_labels""")
def scan_dir_capture_id(spark, sf):
    path = scratch_path(spark, "captures")
    rows = view(spark, sf, "raw_labels").withColumn("capture", F.concat(F.lit("part"), F.col("row_id") % 8))
    tables.write_csv(rows, path, "capture")
    found = tables.scan_dir(spark, path, "*.csv", tables.folder_value("capture"))
    return found.select("capture_id", "row_id", F.trim("raw_label").alias("label"))


@query("scan_csv_mixed_headers", duck("raw_flows") + """SELECT "Dst Port" AS "Destination Port", "flow_duration" AS "Flow Duration",
 CASE WHEN "Label" <> 'N' THEN "Flow Byts/s" END AS "Flow Bytes/s", CASE WHEN "Label" = 'N' THEN "FWD PSH Flags " END AS "Fwd PSH Flags",
 "Label" FROM raw_flows""")
def scan_csv_mixed_headers(spark, sf):
    """Two layouts in one folder: columns in another order, one missing, one more."""
    raw, path = view(spark, sf, "raw_flows"), scratch_path(spark, "csv")
    raw = raw.select("Dst Port", "flow_duration", "Flow Byts/s", "FWD PSH Flags ", "Label")
    tables.write_csv(raw.where("Label <> 'N'").drop("FWD PSH Flags "), f"{path}/a")
    tables.write_csv(raw.where("Label = 'N'").select("Label", "FWD PSH Flags ", "flow_duration", "Dst Port"), f"{path}/b")
    frames = [nz.normalize(f.drop("capture_id")) for f in tables.scan_by_header(spark, path)]
    return sampling.combine(frames).select("Destination Port", "Flow Duration", "Flow Bytes/s", "Fwd PSH Flags", "Label")


@query("scan_parquet_projection", "SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem WHERE l_quantity > 40")
def scan_parquet_projection(spark, sf):
    return tables.scan_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_suppkey", "l_quantity"], "l_quantity > 40")


@query("capture_path_labels", duck("capture_paths") + """SELECT file_id, capture_id, original_label,
 CASE WHEN malware THEN 'MALICIOUS' ELSE 'BENIGN' END AS binary_label, CASE WHEN malware THEN 'Malware' ELSE 'Benign' END AS attack_category,
 CASE WHEN malware THEN 'Malware' ELSE 'Benign' END AS attack_family, original_label AS specific_family
FROM (SELECT file_id, split_part(path, '/', -1) AS capture_id, split_part(path, '/', 3) = 'Malware' AS malware,
  CASE WHEN len(string_split(path, '/')) > 4 THEN split_part(path, '/', 4) ELSE split_part(split_part(path, '/', -1), '.', 1) END
   AS original_label FROM capture_paths WHERE path LIKE '%.pcap' OR path LIKE '%.pcapng')""")
def capture_path_labels(spark, sf):
    return labels.path_labels(view(spark, sf, "capture_paths")).drop("path")


@query("scan_json_profiles", duck("raw_flows") + _RAW_NORMAL)
def scan_json_profiles(spark, sf):
    profiles, path = nz.normalize(view(spark, sf, "raw_flows")), scratch_path(spark, "json")
    tables.write_json(profiles, path)
    return tables.scan_profiles(spark, path, profiles.columns)


@query("sink_parquet_roundtrip", duck("scored") + "SELECT * FROM scored")
def sink_parquet_roundtrip(spark, sf):
    scored, path = view(spark, sf, "scored"), scratch_path(spark, "parquet")
    tables.write_parquet(scored, path, "dataset")
    return spark.read.schema(scored.schema).parquet(path)


@query("sink_csv_roundtrip", duck("scored") + "SELECT row_id, dataset, capture_id, category, y_true, prob FROM scored")
def sink_csv_roundtrip(spark, sf):
    scored = view(spark, sf, "scored").select("row_id", "dataset", "capture_id", "category", "y_true", "prob")
    path = scratch_path(spark, "csv")
    tables.write_csv(scored, path)
    back = tables.scan_csv(spark, path, columns=scored.columns)
    return back.select(*[F.col(c).try_cast(t).alias(c) for c, t in scored.dtypes])


@query("metrics_to_json", duck("scored") + """SELECT dataset, concat('{"dataset":"', dataset, '","tp":', tp, ',"fp":', fp, ',"fn":', fn,
 ',"tn":', tn, '}') AS json FROM (SELECT dataset, count(*) FILTER (y_true = 1 AND prob >= 0.5) AS tp,
 count(*) FILTER (y_true = 0 AND prob >= 0.5) AS fp, count(*) FILTER (y_true = 1 AND prob < 0.5) AS fn,
 count(*) FILTER (y_true = 0 AND prob < 0.5) AS tn FROM scored GROUP BY dataset)""")
def metrics_to_json(spark, sf):
    flagged = view(spark, sf, "scored").withColumn("pred", (F.col("prob") >= 0.5).cast("int"))
    return tables.as_json(metrics.confusion(flagged, "y_true", "pred", ["dataset"]), ["dataset"])


@query("incremental_new_captures", duck("capture_paths") + """SELECT path, cast(NULL AS INT) AS max_packets FROM capture_paths
 WHERE file_id % 4 <> 0""")
def incremental_new_captures(spark, sf):
    # A quarter was extracted in full before, a further third only under a cap, which does not count.
    found = view(spark, sf, "capture_paths").select("file_id", "path", F.lit(0).alias("cap"))
    done = found.where("file_id % 4 = 0").unionByName(found.where("file_id % 3 = 1").withColumn("cap", F.lit(25000)))
    return tables.new_captures(found, done, ["path", "cap"]).select("path", F.lit(None).cast("int").alias("max_packets"))


# ---- schema ------------------------------------------------------------------------------------

_ALIAS_CTE = values(sorted(sc.ALIASES.items()), "aliases", "alias, canonical")
_FEATURE_CTE = values([(f,) for f in sc.FEATURES], "features", "canonical")
_FORBIDDEN_CTE = values([(f,) for f in sc.FORBIDDEN], "forbidden", "canonical")
_CANON = duck("headers").rstrip() + f""", {_ALIAS_CTE}, {_FEATURE_CTE}, {_FORBIDDEN_CTE}, canon AS (
 SELECT dataset, ordinal, name, coalesce(a.canonical, b.canonical, trim(name)) AS canonical FROM headers
 LEFT JOIN aliases a ON lower(trim(name)) = a.alias LEFT JOIN aliases b ON replace(lower(trim(name)), '_', ' ') = b.alias),
names AS (SELECT DISTINCT dataset, canonical FROM canon) """


@query("alias_normalized_select", duck("raw_flows") + _RAW_NORMAL)
def alias_normalized_select(spark, sf):
    return nz.normalize(view(spark, sf, "raw_flows"))


@query("alias_rename_report", _CANON + "SELECT dataset, ordinal, name, canonical FROM canon WHERE name <> canonical")
def alias_rename_report(spark, sf):
    return nz.rename_report(view(spark, sf, "headers"))


@query("alias_dedupe_first", _CANON + """SELECT dataset, canonical, ordinal, name FROM (SELECT *, row_number() OVER
 (PARTITION BY dataset, canonical ORDER BY ordinal) AS rn FROM canon) WHERE rn = 1""")
def alias_dedupe_first(spark, sf):
    return nz.first_of_duplicates(view(spark, sf, "headers"))


@query("schema_present", _CANON + "SELECT * FROM names SEMI JOIN features USING (canonical)")
def schema_present(spark, sf):
    return nz.schema_present(view(spark, sf, "headers"))


@query("schema_missing", _CANON + """SELECT d.dataset, f.canonical FROM (SELECT DISTINCT dataset FROM names) d, features f
 EXCEPT SELECT dataset, canonical FROM names""")
def schema_missing(spark, sf):
    return nz.schema_missing(view(spark, sf, "headers"))


@query("schema_extra", _CANON + "SELECT * FROM names ANTI JOIN features USING (canonical)")
def schema_extra(spark, sf):
    return nz.schema_extra(view(spark, sf, "headers"))


@query("schema_forbidden", _CANON + "SELECT * FROM names SEMI JOIN forbidden USING (canonical)")
def schema_forbidden(spark, sf):
    return nz.schema_forbidden(view(spark, sf, "headers"))


@query("schema_compat_verdict", _CANON + """SELECT dataset, present, extra, forbidden, 65 - present AS missing, present = 65 AS strict_ok,
 65 - present < 32.5 AS lenient_ok FROM (SELECT dataset, count(*) FILTER (canonical IN (SELECT canonical FROM features)) AS present,
 count(*) FILTER (canonical NOT IN (SELECT canonical FROM features)) AS extra,
 count(*) FILTER (canonical IN (SELECT canonical FROM forbidden)) AS forbidden FROM names GROUP BY dataset)""")
def schema_compat_verdict(spark, sf):
    return nz.schema_verdict(view(spark, sf, "headers"))


# ---- cleaning ----------------------------------------------------------------------------------

_NORMAL = duck("raw_flows").rstrip() + f", r AS ({_RAW_NORMAL}) "
_TRY = 'try_cast("{}" AS DOUBLE)'


@query("non_numeric_counts", _NORMAL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count("{c}") AS filled, count(*) FILTER ("{c}" IS NOT NULL AND {_TRY.format(c)} IS NULL) AS non_numeric FROM r"""
    for c in _RAW_FEATURES))
def non_numeric_counts(spark, sf):
    return nz.non_numeric_counts(nz.normalize(view(spark, sf, "raw_flows")), _RAW_FEATURES)


@query("infinite_columns", _NORMAL + "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (isinf({_TRY.format(c)})) AS infinite_rows FROM r""" for c in _RAW_FEATURES
) + ") WHERE infinite_rows > 0")
def infinite_columns(spark, sf):
    return nz.infinite_columns(nz.normalize(view(spark, sf, "raw_flows")), _RAW_FEATURES)


def _clean(c: str) -> str:
    t = _TRY.format(c)
    return f"CASE WHEN {t} IS NULL OR isnan({t}) OR isinf({t}) THEN 0.0 ELSE {t} END"


@query("feature_matrix_clean", _NORMAL + "SELECT " + ", ".join(
    f'{_clean(f) if f in _RAW_FEATURES else "cast(0 AS DOUBLE)"} AS "{f}"' for f in sc.FEATURES) + " FROM r")
def feature_matrix_clean(spark, sf):
    return nz.feature_matrix(view(spark, sf, "raw_flows"))


_MAP_KEYS = ["Flow Duration", "Flow Bytes/s", "Idle Max"]


@query("map_feature_vector", _NORMAL + f"""SELECT "Destination Port" AS port, {_clean('Flow Duration')} AS v0, {_clean('Flow Bytes/s')} AS v1,
 cast(0 AS DOUBLE) AS v2 FROM r""")
def map_feature_vector(spark, sf):
    flows = nz.normalize(view(spark, sf, "raw_flows"))
    pairs = [x for c in _RAW_FEATURES for x in (F.lit(c), nz.quoted(c))]
    records = flows.select(nz.quoted("Destination Port").alias("port"), F.create_map(*pairs).alias("record"))
    out = nz.map_vector(records, "record", _MAP_KEYS)
    return out.select("port", *[F.col("vector")[i].alias(f"v{i}") for i in range(len(_MAP_KEYS))])


@query("drop_forbidden", _NORMAL + 'SELECT * EXCLUDE ("Label") FROM r')
def drop_forbidden(spark, sf):
    return nz.drop_forbidden(nz.normalize(view(spark, sf, "raw_flows")))


@query("drop_constant_columns", _NORMAL + 'SELECT * EXCLUDE ("Fwd Header Length.1") FROM r')
def drop_constant_columns(spark, sf):
    return nz.drop_constant(nz.normalize(view(spark, sf, "raw_flows")))


_RAW_ALL = [*_RAW_FEATURES, "Fwd Header Length.1", "Label"]


@query("constant_columns", _NORMAL + "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", min("{c}") AS low, max("{c}") AS high FROM r""" for c in _RAW_ALL
) + ") WHERE low IS NOT DISTINCT FROM high")
def constant_columns(spark, sf):
    return nz.constant_columns(nz.normalize(view(spark, sf, "raw_flows")), _RAW_ALL)


@query("drop_invalid_rows", _NORMAL + "SELECT " + ", ".join(f'{_TRY.format(c)} AS "{c}"' for c in _RAW_FEATURES)
       + ', "Label" FROM r WHERE ' + " AND ".join(f"coalesce(isfinite({_TRY.format(c)}), false)" for c in _RAW_FEATURES))
def drop_invalid_rows(spark, sf):
    clean = nz.drop_invalid_rows(nz.normalize(view(spark, sf, "raw_flows")), _RAW_FEATURES)
    return clean.drop("Fwd Header Length.1")


_DOH_SQL = {f: f"{c} * {factor}::DOUBLE" for c, (f, factor) in sc.DOH_TO_FEATURE.items()}


@query("doh_feature_map", duck("doh_rows") + "SELECT row_id, " + ", ".join(
    f'{_DOH_SQL.get(f, "cast(0 AS DOUBLE)")} AS "{f}"' for f in sc.FEATURES) + " FROM doh_rows")
def doh_feature_map(spark, sf):
    return nz.doh_to_features(view(spark, sf, "doh_rows").drop("Label"))


@query("ordered_projection", _NORMAL + 'SELECT "Label", ' + ", ".join(f'"{c}"' for c in _RAW_FEATURES) + " FROM r")
def ordered_projection(spark, sf):
    return nz.ordered(nz.normalize(view(spark, sf, "raw_flows")), ["Label"])


@query("category_fill", duck("raw_labels") + """SELECT row_id, CASE WHEN row_id % 7 = 0 THEN 'Unknown Malicious'
 WHEN trim(raw_label) = 'BENIGN' THEN 'Benign' ELSE trim(raw_label) END AS attack_category FROM raw_labels""")
def category_fill(spark, sf):
    raw = view(spark, sf, "raw_labels").select("row_id", F.when(F.col("row_id") % 7 != 0, F.trim("raw_label")).alias("cat"))
    return nz.fill_category(raw, "cat", F.lit(True)).drop("cat")


@query("split_group_id", duck("scored") + """SELECT row_id, CASE WHEN row_id % 3 > 0 THEN capture_id WHEN row_id % 2 > 0 THEN dataset
 ELSE cast(row_id AS VARCHAR) END AS split_group FROM scored""")
def split_group_id(spark, sf):
    rows = view(spark, sf, "scored").select(
        "row_id", F.when(F.col("row_id") % 3 > 0, F.col("capture_id")).alias("capture_id"),
        F.when(F.col("row_id") % 2 > 0, F.col("dataset")).alias("dataset"))
    return nz.split_group(rows, "row_id").select("row_id", "split_group")


# ---- labels ------------------------------------------------------------------------------------

_EXACT = duck("raw_labels").rstrip() + ", " + values([(k, *v) for k, v in sc.EXACT_LABELS.items()], "lookup", "raw, verdict, category")


@query("label_exact_map", _EXACT + """ SELECT row_id, raw_label, coalesce(verdict, CASE WHEN raw_label NOT LIKE '%Web Attack%' AND
 lower(trim(raw_label)) = 'benign' THEN 'BENIGN' ELSE 'MALICIOUS' END) AS binary_label, coalesce(category, CASE WHEN raw_label LIKE '%Web Attack%'
 THEN 'Web Attack' WHEN lower(trim(raw_label)) = 'benign' THEN 'Benign' ELSE 'Other Attack' END) AS attack_category
 FROM raw_labels LEFT JOIN lookup ON trim(raw_label) = raw""")
def label_exact_map(spark, sf):
    return labels.exact_label(view(spark, sf, "raw_labels"), "raw_label")


@query("label_substring_map", duck("raw_labels") + "SELECT row_id, CASE WHEN c = 'BENIGN' THEN 'BENIGN' " + " ".join(
    f"WHEN contains(c, '{k}') THEN '{v}'" for k, v in sc.LABEL_FRAGMENTS
) + " ELSE 'Other Attack' END AS attack_category FROM (SELECT row_id, regexp_replace(trim(raw_label), '[^\\x00-\\x7F]', '', 'g') AS c FROM raw_labels)")
def label_substring_map(spark, sf):
    raw = view(spark, sf, "raw_labels")
    return raw.select("row_id", labels.substring_label(F.col("raw_label")).alias("attack_category"))


@query("label_passthrough", duck("raw_labels") + """SELECT row_id, CASE WHEN upper(trim(raw_label)) = 'BENIGN' THEN 'BENIGN' ELSE 'MALICIOUS' END
 AS binary_label, CASE WHEN upper(trim(raw_label)) = 'BENIGN' THEN 'Benign' ELSE trim(raw_label) END AS attack_category FROM raw_labels""")
def label_passthrough(spark, sf):
    return labels.passthrough_label(view(spark, sf, "raw_labels"), "raw_label").drop("raw_label")


@query("doh_labels", duck("doh_rows") + """SELECT row_id, Label AS original_label, CASE WHEN Label = 'Malicious' THEN 'MALICIOUS' ELSE 'BENIGN' END
 AS binary_label, CASE WHEN Label = 'Malicious' THEN 'Encrypted Tunnel' ELSE 'Benign' END AS attack_category, true AS is_encrypted
 FROM doh_rows""")
def doh_labels(spark, sf):
    rows = view(spark, sf, "doh_rows").select("row_id", "Label")
    # Level 1 tells DoH from other HTTPS; level 2 holds the DoH rows only.
    level1 = rows.withColumn("Label", F.when(F.col("Label") == "NonDoH", "NonDoH").otherwise("DoH"))
    return labels.doh_labels(level1, rows.where(F.col("Label") != "NonDoH"))


@query("binary_target", _EXACT + """ SELECT row_id, CASE WHEN coalesce(verdict, CASE WHEN raw_label NOT LIKE '%Web Attack%' AND
 lower(trim(raw_label)) = 'benign' THEN 'BENIGN' ELSE 'MALICIOUS' END) = 'MALICIOUS' THEN 1 ELSE 0 END AS target
 FROM raw_labels LEFT JOIN lookup ON trim(raw_label) = raw""")
def binary_target(spark, sf):
    return labels.binary_target(labels.exact_label(view(spark, sf, "raw_labels"), "raw_label")).select("row_id", "target")


@query("truth_precedence", duck("raw_labels") + """SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'THREAT' ELSE 'BENIGN' END AS "Expected_Verdict",
 cast(row_id % 2 = 0 AS INT) AS y FROM raw_labels""")
def truth_precedence(spark, sf):
    rows = view(spark, sf, "raw_labels").select(
        "row_id", F.when(F.col("row_id") % 2 == 0, "THREAT").otherwise("BENIGN").alias("Expected_Verdict"),
        F.col("raw_label").alias("Label"))
    return rows.select("row_id", "Expected_Verdict", labels.truth_target(rows).alias("y"))


@query("truth_benign_set", duck("raw_labels") + """SELECT row_id, CASE WHEN row_id % 9 <> 0 AND (upper(trim(raw_label)) IN ('BENIGN', 'NORMAL', '0',
 'NONDOH', 'LEGITIMATE', 'SAFE') OR trim(raw_label) = 'Bot') THEN 'BENIGN' ELSE 'MALICIOUS' END AS truth FROM raw_labels""")
def truth_benign_set(spark, sf):
    rows = view(spark, sf, "raw_labels").select("row_id", F.when(F.col("row_id") % 9 != 0, F.col("raw_label")).alias("label"))
    return rows.select("row_id", labels.benign_by_values("label", "Bot").alias("truth"))


@query("truth_distinct_values", duck("raw_labels") + "SELECT DISTINCT raw_label AS value FROM raw_labels")
def truth_distinct_values(spark, sf):
    rows = view(spark, sf, "raw_labels").withColumnRenamed("raw_label", "Label")
    return labels.distinct_values(rows, labels.truth_columns(rows)[0])


_CATALOG = duck("raw_labels").rstrip() + ", " + values(sc.LABEL_CATALOG, "catalog", "dataset, raw, verdict, family, category")


@query("label_catalog_join", _CATALOG + """ SELECT row_id, d AS dataset, verdict, family, category FROM (SELECT *, CASE WHEN row_id % 5 = 0
 THEN 'CIRA-CIC-DoHBrw-2020' ELSE 'CICIDS2017' END AS d, CASE WHEN row_id % 5 = 0 THEN 'Malicious' ELSE trim(raw_label) END AS r FROM raw_labels) x
 LEFT JOIN catalog c ON x.d = c.dataset AND x.r = c.raw""")
def label_catalog_join(spark, sf):
    doh = F.col("row_id") % 5 == 0
    rows = view(spark, sf, "raw_labels").select(
        "row_id", F.when(doh, "CIRA-CIC-DoHBrw-2020").otherwise("CICIDS2017").alias("dataset"),
        F.when(doh, "Malicious").otherwise(F.col("raw_label")).alias("raw_label"))
    return labels.join_catalog(rows, F.col("dataset"), "raw_label").drop("raw_label")
