"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.scratch import batch_of, land_documents, scratch_dir
from checks.standins import measurements, raw_measurements, table
from gaugeworks.functions import cleaning
from gaugeworks.operators import incremental
from gaugeworks.operators.bank import bank_frames, window_bank
from gaugeworks.operators.dedup import distinct_rows
from gaugeworks.operators.frames import Frame, forward_frames
from gaugeworks.operators.joins import full_outer, not_in
from gaugeworks.operators.marts import GRAIN_INTERVAL, at_boundary, mart, rename_by_pattern, select_by_suffix
from gaugeworks.operators.mode import forward_mode
from gaugeworks.operators.nested import field, flatten, flatten_two_level, malformed_documents, parse_documents, subdocument
from gaugeworks.sources import documents, tables
from gaugeworks.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- documents in files -------------------------------------------------------------------------


def _readings_per_batch(raw: DataFrame, column: str) -> DataFrame:
    records = flatten_two_level(parse_documents(raw, column), "doc", "records", "r")
    typed = records.select(batch_of("filename").alias("batch"), field("r", "StationId", "bigint").alias("id"))
    return typed.groupBy("batch").agg(F.count("*").alias("readings"), F.sum("id").alias("id_sum"))


@query
def scan_documents(spark, sf_dir):
    landing = scratch_dir(spark)
    land_documents(table(spark, sf_dir, "events"), landing)
    return _readings_per_batch(documents.scan_documents(spark, landing), "value")


@query
def unloaded_files(spark, sf_dir):
    landing = scratch_dir(spark)
    land_documents(table(spark, sf_dir, "events"), landing)
    listing = documents.list_files(spark, landing, "*.txt")
    loaded = listing.where(batch_of("filename") % 2 == 0)
    return documents.unloaded_files(listing, loaded).select(batch_of("filename").alias("batch"))


@query
def raw_load(spark, sf_dir):
    """Two landings, three loads: the last finds nothing new."""
    root, events = scratch_dir(spark), table(spark, sf_dir, "events")
    for part in ("event_type = 'view'", "event_type <> 'view'"):
        land_documents(events.where(part), f"{root}/landing")
        documents.raw_load(spark, f"{root}/landing", f"{root}/raw", "*.txt")
    documents.raw_load(spark, f"{root}/landing", f"{root}/raw", "*.txt")
    return _readings_per_batch(tables.read(spark, f"{root}/raw"), "raw_data")


@query
def stream_ingest(spark, sf_dir):
    root, events = scratch_dir(spark), table(spark, sf_dir, "events")
    for part in ("event_type = 'view'", "event_type <> 'view'"):
        land_documents(events.where(part), f"{root}/landing")
        ingest_available(spark, f"{root}/landing", f"{root}/raw", f"{root}/checkpoint")
    return _readings_per_batch(tables.read(spark, f"{root}/raw"), "raw_data")


@query
def raw_load_after_stream(spark, sf_dir):
    """A stream and then a batch load fill one raw table."""
    root, events = scratch_dir(spark), table(spark, sf_dir, "events")
    land_documents(events.where("event_type = 'view'"), f"{root}/landing")
    ingest_available(spark, f"{root}/landing", f"{root}/raw", f"{root}/checkpoint")
    land_documents(events.where("event_type <> 'view'"), f"{root}/landing")
    documents.raw_load(spark, f"{root}/landing", f"{root}/raw", "*.txt")
    ingest_available(spark, f"{root}/landing", f"{root}/raw", f"{root}/checkpoint")
    return _readings_per_batch(tables.read(spark, f"{root}/raw"), "raw_data")


# --- nested data --------------------------------------------------------------------------------


def _event_documents(spark, sf_dir) -> DataFrame:
    """One document per event: two records under one key, one under another, an empty array, a scalar."""
    record = "named_struct('StationId', CAST(user_id AS STRING), 'Id', event_id, 'Seq', {seq}, 'Reading', {reading})"
    one, two, three = (record.format(seq=i, reading=r) for i, r in enumerate(("value", "CAST(value AS STRING)", "value * 2")))
    records = f"named_struct('Station', array({one}, {two}), 'Other', array({three}), 'Empty', array(), 'Note', 'text')"
    document = f"to_json(named_struct('result', named_struct('fields', array(event_type)), 'records', {records}))"
    return table(spark, sf_dir, "events").select(F.expr(document).alias("value"))


@query
def flatten_two_level_(spark, sf_dir):
    rows = flatten_two_level(parse_documents(_event_documents(spark, sf_dir)), "doc", "records", "r")
    return rows.select(
        field("r", "StationId").alias("station_id"),
        field("r", "Id", "bigint").alias("event_id"),
        field("r", "Seq", "int").alias("seq"),
        field("r", "Reading", "double").alias("reading"),
    )


QUERIES["flatten_two_level"] = QUERIES.pop("flatten_two_level_")


@query
def flatten_deep_path(spark, sf_dir):
    station = "array(named_struct('StationID', c_custkey, 'Name', c_name), named_struct('StationID', -c_custkey, 'Name', ''))"
    document = f"to_json(named_struct('records', named_struct('data', named_struct('stationStatus', named_struct('station', {station})))))"
    docs = parse_documents(table(spark, sf_dir, "customer").select(F.expr(document).alias("value")))
    rows = flatten(docs, "doc", "records.data.stationStatus.station", "s")
    return rows.select(field("s", "StationID", "bigint").alias("station_id"), field("s", "Name").alias("name"))


@query
def flatten_root_array(spark, sf_dir):
    document = "to_json(named_struct('Data', array(named_struct('id', s_suppkey, 'bal', s_acctbal))))"
    docs = parse_documents(table(spark, sf_dir, "supplier").select(F.expr(document).alias("value")))
    rows = flatten(docs, "doc", "Data", "s")
    return rows.select(field("s", "id", "bigint").alias("id"), field("s", "bal", "double").alias("bal"))


@query
def doc_level_field(spark, sf_dir):
    rows = flatten_two_level(parse_documents(_event_documents(spark, sf_dir)), "doc", "records", "r")
    return rows.select(
        field("r", "Id", "bigint").alias("event_id"), field("doc", "result.fields[0]").alias("event_type")
    )


@query
def json_path_cast(spark, sf_dir):
    docs = parse_documents(table(spark, sf_dir, "events"), "props")
    return docs.select("event_id", field("doc", "k", "double").alias("k"), field("doc", "none.k", "double").alias("missing"))


@query
def decimal_cast(spark, sf_dir):
    document = F.expr("to_json(named_struct('price', o_totalprice))")
    docs = parse_documents(table(spark, sf_dir, "orders").select("o_orderkey", document.alias("value")))
    return docs.select("o_orderkey", field("doc", "price", "decimal(10,2)").alias("price"))


@query
def array_index(spark, sf_dir):
    document = F.expr("to_json(named_struct('c', embedding))")
    docs = parse_documents(table(spark, sf_dir, "embeddings").select("vec_id", document.alias("value")))
    at = {"first": "c[0]", "second": "c[1]", "beyond": "c[100000]"}
    return docs.select("vec_id", *[field("doc", p, "float").cast("double").alias(c) for c, p in at.items()])


@query
def distinct_nested(spark, sf_dir):
    docs = parse_documents(table(spark, sf_dir, "events"), "props")
    return docs.select(subdocument(F.col("doc"), "k").alias("k"), F.to_json("doc").alias("whole")).distinct()


@query
def distinct_nested_numbers(spark, sf_dir):
    """Distinct sub-documents whose numbers are spelled in several ways."""
    n = "cast(l_orderkey % 50 AS string)"
    spelled = f"CASE l_linenumber % 3 WHEN 0 THEN {n} WHEN 1 THEN {n} || '.0' ELSE {n} || 'e0' END"
    lines = table(spark, sf_dir, "lineitem").selectExpr(f"""'{{"part":{{"b":[' || {spelled} || ',1.5],"a":"1.0"}}}}' AS value""")
    return parse_documents(lines).select(subdocument("doc", "part").alias("part")).distinct()


@query
def quarantine_malformed(spark, sf_dir):
    """Documents that do not parse; one in seven is cut short."""
    cut = F.expr("CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) ELSE props END")
    return malformed_documents(table(spark, sf_dir, "events").select("event_id", cut.alias("value")))


# --- projections and cleaning -------------------------------------------------------------------


@query
def project_rename(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("kind"), F.col("ts").alias("measure_at"), F.col("event_id").alias("id")
    )


@query
def star_exclude(spark, sf_dir):
    return table(spark, sf_dir, "events").drop("props")


def _cleaned(name: str, column: str, rule) -> None:
    def run(spark, sf_dir):
        return raw_measurements(spark, sf_dir).select("event_id", rule(column).alias("cleaned"))

    QUERIES[name] = run


_cleaned("negative_to_null", "air_temperature", cleaning.negative_to_null)
_cleaned("na_tag_to_null", "visibility", cleaning.na_tag_to_null)
_cleaned("classify_station", "station_id", cleaning.classify_station)


def _cleaned_text(name: str, text: str, rule) -> None:
    def run(spark, sf_dir):
        texts = table(spark, sf_dir, "events").select("event_id", F.expr(text).alias("text"))
        return texts.select("event_id", rule("text").alias("cleaned"))

    QUERIES[name] = run


_cleaned_text("empty_to_null", "CASE WHEN event_type = 'view' THEN '' ELSE event_type END", cleaning.empty_to_null)
_cleaned_text(
    "empty_to_null_date",
    "CASE WHEN event_type = 'view' THEN '' ELSE CAST(CAST(ts AS DATE) AS STRING) END",
    cleaning.empty_to_null_date,
)
_cleaned_text("quote_trim", "concat('\"\"', event_type, '\"', event_type, '\"')", cleaning.quote_trim)
_cleaned_text(
    "parse_timestamp",
    "concat(substr(replace(CAST(ts AS STRING), ' ', 'T'), 1, 19), '+08:00')",
    cleaning.parse_timestamp,
)


@query
def coalesce_priority(spark, sf_dir):
    raw = raw_measurements(spark, sf_dir)
    hot, gust = cleaning.negative_to_null("air_temperature"), cleaning.negative_to_null("wind_direction_gust")
    return raw.select("event_id", cleaning.first_present(hot, gust, F.lit(0.0)).alias("chosen"))


@query
def dedup_measurements(spark, sf_dir):
    return measurements(spark, sf_dir)


@query
def distinct_geo(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "documents"), ["lang", "source"])


@query
def distinct_measurements(spark, sf_dir):
    return distinct_rows(raw_measurements(spark, sf_dir).drop("event_id"))


# --- joins --------------------------------------------------------------------------------------


def _two_registries(spark, sf_dir) -> DataFrame:
    """Suppliers lead for key and name, customers for the balance; only half of the keys overlap."""
    rain = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") - 50).alias("key"), "s_name", "s_nationkey", "s_acctbal")
    weather = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_nationkey", "c_acctbal")
    return full_outer(rain, weather, "key").select(
        cleaning.first_present("l.key", "r.key").alias("station_id"),
        cleaning.first_present("l.s_name", "r.c_name").alias("name"),
        cleaning.first_present("r.c_acctbal", "l.s_acctbal").alias("balance"),
        F.col("r.c_nationkey").alias("nation_id"),
    )


@query
def full_outer_two(spark, sf_dir):
    return _two_registries(spark, sf_dir)


@query
def full_outer_three(spark, sf_dir):
    geo = table(spark, sf_dir, "nation").select((F.col("n_nationkey") - 60).alias("station_id"), "n_name", "n_regionkey")
    return full_outer(_two_registries(spark, sf_dir), geo, "station_id").select(
        cleaning.first_present("l.station_id", "r.station_id").alias("station_id"),
        cleaning.first_present("l.name", "r.n_name").alias("name"),
        "l.balance",
        "l.nation_id",
        F.col("r.n_regionkey").alias("region_id"),
    )


@query
def full_outer_heavy_key(spark, sf_dir):
    """A third of the left rows share a key."""
    key = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey * 2 END").alias("station_id")
    left = table(spark, sf_dir, "orders").select(key, "o_orderkey")
    right = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"), "c_name")
    return full_outer(left, right, "station_id", spread=16).select(
        cleaning.first_present("l.station_id", "r.station_id").alias("station_id"), "l.o_orderkey", "r.c_name"
    )


def _stations_by_status(status: str) -> Query:
    def run(spark, sf_dir):
        left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name")
        right = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey", "o_orderstatus")
        joined = full_outer(left, right, "key").select(
            cleaning.first_present("l.key", "r.key").alias("station_id"),
            F.col("l.c_name").alias("station_name"),
            "r.o_orderkey",
            F.col("r.o_orderstatus").alias("station_status"),
        )
        return joined.where(F.col("station_status") == status)

    return run


QUERIES["existing_stations"] = _stations_by_status("O")
QUERIES["revoked_stations"] = _stations_by_status("F")


@query
def left_join_enrich(spark, sf_dir):
    seen = table(spark, sf_dir, "events").select("user_id", "event_type").distinct().alias("geo")
    rain = table(spark, sf_dir, "supplier").alias("rain")
    basic = table(spark, sf_dir, "customer").alias("basic")
    return (
        seen.join(rain, F.col("user_id") == F.col("s_suppkey"), "left")
        .join(basic, F.col("user_id") == F.col("c_custkey"), "left")
        .select(
            "user_id",
            "event_type",
            F.coalesce("s_name", F.lit("none")).alias("rain_name"),
            F.coalesce("c_acctbal", "s_acctbal").alias("balance"),
        )
    )


def _not_in(null_key: bool) -> Query:
    def run(spark, sf_dir):
        key = F.nullif(F.col("s_suppkey"), F.lit(3)) if null_key else F.col("s_suppkey")
        known = table(spark, sf_dir, "supplier").select(key.alias("known"))
        return not_in(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", known, "known")

    return run


QUERIES["not_in_new_keys"] = _not_in(False)
QUERIES["not_in_with_null"] = _not_in(True)


# --- frames and marts ---------------------------------------------------------------------------


def _frame(func: str, grain: str) -> Query:
    def run(spark, sf_dir):
        events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
        frame = Frame("result", func, "value", GRAIN_INTERVAL[grain])
        return forward_frames(events, [frame], "ts", ["user_id"])

    return run


for _func in ("avg", "sum", "max"):
    for _grain in GRAIN_INTERVAL:
        QUERIES[f"window_{_func}_{_grain}"] = _frame(_func, _grain)


@query
def window_mode(spark, sf_dir):
    docs = parse_documents(table(spark, sf_dir, "events"), "props")
    events = docs.select("event_id", "ts", field("doc", "k", "double").alias("k"))
    return forward_mode(events, "k", "ts", "1 hour", "result")


@query
def window_bank_(spark, sf_dir):
    return window_bank(measurements(spark, sf_dir))


QUERIES["window_bank"] = QUERIES.pop("window_bank_")


def _boundary(grain: str) -> Query:
    return lambda spark, sf_dir: at_boundary(measurements(spark, sf_dir), grain).select(
        "station_id", "measure_at", "air_temperature"
    )


def _mart(grain: str) -> Query:
    return lambda spark, sf_dir: mart(measurements(spark, sf_dir), grain)


for _grain, _word in {"hour": "hourly", "day": "daily", "week": "weekly", "month": "monthly"}.items():
    QUERIES[f"grain_filter_{_grain}"] = _boundary(_grain)
    QUERIES[f"mart_{_word}"] = _mart(_grain)


def _two_grains(spark, sf_dir) -> DataFrame:
    return window_bank(measurements(spark, sf_dir), bank_frames(grains=("hour", "day")))


@query
def suffix_select(spark, sf_dir):
    return select_by_suffix(_two_grains(spark, sf_dir), "hour")


@query
def suffix_rename(spark, sf_dir):
    return rename_by_pattern(select_by_suffix(_two_grains(spark, sf_dir), "day"), "day")


# --- incremental --------------------------------------------------------------------------------

LOADED = "ts <= TIMESTAMP_NTZ'2024-01-20 12:00:00'"
LOADED_BUT_LATE = f"{LOADED} AND event_type <> 'error'"


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query
def global_max(spark, sf_dir):
    return _events(spark, sf_dir).agg(F.max("ts").alias("mark"))


def _past(target: str, floor: str | None) -> Query:
    def run(spark, sf_dir):
        events = _events(spark, sf_dir)
        return incremental.past_mark(events, events.where(target), "ts", floor)

    return run


QUERIES["hwm_strict"] = _past(LOADED, None)
QUERIES["hwm_strict_empty"] = _past("event_type = 'none such'", None)
QUERIES["hwm_floor"] = _past(LOADED, "2024-01-01")
QUERIES["hwm_floor_empty"] = _past("event_type = 'none such'", "2024-01-10")


def _appended(floor: str | None) -> Query:
    """First run without rows of one kind, second run with everything: the late rows stay out."""

    def run(spark, sf_dir):
        root, events = scratch_dir(spark), _events(spark, sf_dir)
        incremental.append_past_mark(events.where(LOADED_BUT_LATE), root, "ts", floor)
        incremental.append_past_mark(events, root, "ts", floor)
        incremental.append_past_mark(events, root, "ts", floor)
        return spark.read.parquet(root)

    return run


QUERIES["incremental_append"] = _appended(None)
QUERIES["incremental_append_floor"] = _appended("2024-01-01")


@query
def append_without_marker(spark, sf_dir):
    """A target whose writer put down no success marker is still a target."""
    root, events = scratch_dir(spark), _events(spark, sf_dir)
    events.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(root)
    incremental.append_past_mark(events, root, "ts")
    return spark.read.parquet(root)


@query
def incremental_append_all(spark, sf_dir):
    root, events = scratch_dir(spark), _events(spark, sf_dir)
    for _ in range(2):
        incremental.append_all(events, root)
    return spark.read.parquet(root)


@query
def full_refresh(spark, sf_dir):
    root, events = scratch_dir(spark), _events(spark, sf_dir)
    incremental.append_all(events, root)
    incremental.full_refresh(events, root)
    return tables.read(spark, root)


@query
def materialize_table(spark, sf_dir):
    root = scratch_dir(spark)
    tables.as_view(_events(spark, sf_dir), "gaugeworks_events")
    tables.overwrite(spark.table("gaugeworks_events"), root)
    return tables.read(spark, root)


@query
def delete_insert(spark, sf_dir):
    """Customers, then the same keys with the price of their dearest order for a balance."""
    root = scratch_dir(spark)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    dearest = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key"))
    incremental.delete_insert(customers, root, "key")
    for _ in range(2):
        incremental.delete_insert(dearest.agg(F.max("o_totalprice").alias("balance")), root, "key")
    return tables.read(spark, root)
