"""Declared feed tables: which columns each provider's table has, their types
and the upsert key.

The registry is plain data.  It is offered as a DataFrame
(``registry_df``) for joins and as Python objects for building projections.
Users extend it by adding rows (a provider or a table), not code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the declared feed schemas for correct results.
# Logical tables: column name and declared type, in superset order; then the
# key ("-" = keyless).
# ---------------------------------------------------------------------------
LOGICAL_TABLES_TEXT = """
trips: route_id text, service_id text, trip_id varchar(20), trip_headsign text, direction_id integer, block_id text, shape_id text, wheelchair_accessible integer | trip_id
calendar: service_id text, monday boolean, tuesday boolean, wednesday boolean, thursday boolean, friday boolean, saturday boolean, sunday boolean, start_date integer, end_date integer | service_id, start_date, end_date
routes: route_id text, agency_id text, route_short_name text, route_long_name text, route_desc text, route_type integer, route_url text, route_color text, route_text_color text, category text, status text | route_id
shapes: shape_id text, shape_pt_lat real, shape_pt_lon real, shape_pt_sequence integer, shape_dist_traveled real | shape_id, shape_pt_sequence
stops: stop_id text, stop_code text, stop_name text, stop_desc text, stop_lat real, stop_lon real, zone_id text, stop_url text, location_type integer, parent_station text, category text, route_id text, geometry text, isOKU integer, status text, search text | stop_id
stop_times: trip_id text, arrival_time text, departure_time text, stop_id text, stop_sequence integer, stop_headsign text, shape_dist_traveled real, pickup_type integer, drop_off_type integer, route_id text, direction_id integer | trip_id, stop_sequence
agency: agency_id text, agency_name text, agency_url text, agency_timezone text, agency_phone text, agency_lang text | agency_id
areas: area_id text, area_name text | area_id
fare_leg_rules: leg_group_id text, from_area_id text, to_area_id text, fare_product_id text | -
fare_media: fare_media_id text, fare_media_name text, fare_media_type integer | fare_media_id
fare_products: fare_product_id text, fare_product_name text, amount real, currency text, fare_media_id text, rider_category_id text | fare_product_id
rider_categories: rider_category_id text, rider_category_name text, is_default_fare_category integer | rider_category_id
stop_areas: area_id text, stop_id text | area_id, stop_id
calendar_dates: service_id text, date integer, exception_type integer | service_id, date
frequencies: trip_id text, start_time text, end_time text, headway_secs integer, exact_times integer | trip_id, start_time
"""

# FIXED VALUES — per provider and table, the declared columns in declared order.
# A table marked "(keyless)" has no key for that provider.
PROVIDER_TABLES_TEXT = """
[mybas-johor]
trips: route_id service_id trip_id trip_headsign direction_id block_id shape_id wheelchair_accessible
calendar: service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date
routes: route_id agency_id route_short_name route_long_name route_desc route_type route_url route_color route_text_color
shapes: shape_id shape_pt_lat shape_pt_lon shape_pt_sequence shape_dist_traveled
stops: stop_id stop_code stop_name stop_desc stop_lat stop_lon zone_id stop_url location_type parent_station
stop_times: trip_id arrival_time departure_time stop_id stop_sequence stop_headsign shape_dist_traveled pickup_type drop_off_type
agency: agency_id agency_name agency_url agency_timezone agency_phone agency_lang
areas: area_id area_name
fare_leg_rules: leg_group_id from_area_id to_area_id fare_product_id
fare_media: fare_media_id fare_media_name fare_media_type
fare_products: fare_product_id fare_product_name amount currency fare_media_id rider_category_id
rider_categories: rider_category_id rider_category_name is_default_fare_category
stop_areas: area_id stop_id

[ktmb]
trips: route_id service_id trip_id direction_id
calendar: service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date
routes: agency_id route_id route_type route_short_name route_long_name route_desc route_url route_color route_text_color
stops: stop_id stop_name stop_lat stop_lon
stop_times: trip_id arrival_time departure_time stop_id stop_sequence shape_dist_traveled
agency: agency_id agency_name agency_url agency_timezone agency_phone agency_lang

[rapid-bus-mrtfeeder]
trips: route_id service_id trip_id trip_headsign direction_id shape_id
calendar: service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date
routes: route_id agency_id route_short_name route_long_name route_type
shapes: shape_id shape_pt_lat shape_pt_lon shape_pt_sequence shape_dist_traveled
stops: stop_id stop_code stop_name stop_lat stop_lon
stop_times: trip_id arrival_time departure_time stop_id stop_sequence stop_headsign shape_dist_traveled
agency (keyless): agency_name agency_url agency_timezone agency_phone agency_lang
calendar_dates: service_id date exception_type

[rapid-rail-kl]
trips: route_id service_id trip_id trip_headsign direction_id shape_id
calendar: service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date
routes: route_id agency_id route_short_name route_long_name route_desc route_type route_color route_text_color category status
shapes: shape_id shape_pt_lon shape_pt_lat shape_pt_sequence
stops: stop_id stop_name stop_lat stop_lon category route_id geometry isOKU status search
stop_times: route_id direction_id trip_id arrival_time departure_time stop_id stop_sequence
agency: agency_id agency_name agency_url agency_timezone agency_phone agency_lang
frequencies: trip_id start_time end_time headway_secs

[rapid-bus-kl]
trips: route_id service_id trip_id shape_id trip_headsign direction_id
calendar: service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date
routes: route_id agency_id route_short_name route_long_name route_type route_color route_text_color
shapes: shape_id shape_pt_lat shape_pt_lon shape_pt_sequence
stops: stop_id stop_name stop_desc stop_lat stop_lon
stop_times: trip_id arrival_time departure_time stop_id stop_sequence stop_headsign
agency: agency_id agency_name agency_url agency_timezone agency_phone agency_lang
frequencies: trip_id start_time end_time headway_secs exact_times

[rapid-bus-penang]
trips: route_id service_id trip_id trip_headsign direction_id shape_id
calendar: service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date
routes: route_id agency_id route_short_name route_long_name route_type
shapes: shape_id shape_pt_lat shape_pt_lon shape_pt_sequence shape_dist_traveled
stops: stop_id stop_code stop_name stop_lat stop_lon
stop_times: trip_id arrival_time departure_time stop_id stop_sequence stop_headsign shape_dist_traveled
agency: agency_name agency_url agency_timezone agency_phone agency_lang agency_id
"""

# Control tables are never feed targets, even if an archive ships a file of
# that name.
CONTROL_TABLES = ("import_progress", "dataset_versions")

# Declared type -> affinity of the stored value.
AFFINITIES = {"text": "text", "varchar(20)": "text", "integer": "integer", "real": "real", "boolean": "integer"}
SPARK_TYPES = {"text": T.StringType(), "integer": T.LongType(), "real": T.DoubleType()}


@dataclass(frozen=True)
class LogicalTable:
    name: str
    columns: tuple[tuple[str, str], ...]  # (column, affinity) in superset order
    key: tuple[str, ...]  # empty = keyless

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def spark_schema(self, with_provider: bool = True) -> T.StructType:
        """Stored schema: provider, the superset columns, and the feed file a
        row came from (``_source_file``)."""
        fields = [T.StructField("provider", T.StringType())] if with_provider else []
        fields += [T.StructField(c, SPARK_TYPES[a]) for c, a in self.columns]
        if with_provider:
            fields.append(T.StructField("_source_file", T.StringType()))
        return T.StructType(fields)


@dataclass(frozen=True)
class Registry:
    tables: dict[str, LogicalTable]
    # (provider, table) -> (declared columns in order, keyed?)
    declared: dict[tuple[str, str], tuple[tuple[str, ...], bool]]

    def keyless_providers(self, table: str) -> list[str]:
        return sorted(p for (p, t), (_, keyed) in self.declared.items() if t == table and not keyed)

    def providers(self) -> list[str]:
        return sorted({p for p, _ in self.declared})

    def to_rows(self) -> list[tuple]:
        rows = []
        for (provider, table), (cols, keyed) in sorted(self.declared.items()):
            lt = self.tables[table]
            types = dict(lt.columns)
            key = lt.key if keyed else ()
            for i, c in enumerate(cols):
                k = key.index(c) + 1 if c in key else None
                rows.append((provider, table, i + 1, c, types[c], k))
        return rows


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("provider", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("key_ordinal", T.IntegerType(), True),
    ]
)


def _parse_logical(text: str) -> dict[str, LogicalTable]:
    out = {}
    for line in filter(None, (x.strip() for x in text.splitlines())):
        name, rest = line.split(":", 1)
        cols_text, key_text = rest.split("|")
        cols = tuple(
            (c.split()[0], AFFINITIES[c.split()[1]]) for c in cols_text.split(",")
        )
        key = () if key_text.strip() == "-" else tuple(k.strip() for k in key_text.split(","))
        out[name.strip()] = LogicalTable(name.strip(), cols, key)
    return out


def _parse_declared(text: str) -> dict[tuple[str, str], tuple[tuple[str, ...], bool]]:
    out = {}
    provider = None
    for line in filter(None, (x.strip() for x in text.splitlines())):
        if line.startswith("["):
            provider = line.strip("[]")
            continue
        head, cols = line.split(":", 1)
        keyed = "(keyless)" not in head
        table = head.replace("(keyless)", "").strip()
        out[(provider, table)] = (tuple(cols.split()), keyed)
    return out


def build_registry(logical_text: str = LOGICAL_TABLES_TEXT,
                   declared_text: str = PROVIDER_TABLES_TEXT) -> Registry:
    tables = _parse_logical(logical_text)
    declared = _parse_declared(declared_text)
    for (provider, table), (cols, _) in declared.items():
        known = set(tables[table].column_names)
        unknown = [c for c in cols if c not in known]
        if unknown:
            raise ValueError(f"{provider}/{table}: columns {unknown} not in logical table")
    return Registry(tables, declared)


DEFAULT = build_registry()


def registry_df(spark: SparkSession, registry: Registry = DEFAULT) -> DataFrame:
    """The registry as rows ``(provider, table, ordinal, column, type, key_ordinal)``.

    Its size is fixed by the declared schemas (a few hundred rows), not by the
    data, so it is safe to broadcast.
    """
    return spark.createDataFrame(registry.to_rows(), REGISTRY_SCHEMA)
