"""Column contracts of the warehouse tables and of the hourly feature series."""

from __future__ import annotations

from pyspark.sql import types as T

_SIMPLE = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "dbl": T.DoubleType(),
    "ts": T.TimestampType(),
}


def table_schema(text: str) -> T.StructType:
    """``"name:type ..."`` with the short types above."""
    return T.StructType([T.StructField(n, _SIMPLE[t]) for n, t in (f.split(":") for f in text.split())])


# Table, column and key names of the warehouse.
WAREHOUSE = {
    "runs": table_schema(
        "run_id:str run_name:str run_timestamp:ts source_type:str notes:str "
        "pipeline_version:str config_hash:str raw_deltas_hash:str"
    ),
    "stations": table_schema(
        "station_code:str network:str latitude:dbl longitude:dbl easting:dbl northing:dbl elevation:dbl location:str"
    ),
    "raw_deltas": table_schema(
        "run_id:str event_id:str network:str station_code:str channel:str arrival_epoch:dbl arrival_iso:ts "
        "event_reference_epoch:dbl delta_seconds:dbl"
    ),
    "station_stats": table_schema(
        "run_id:str station_code:str reference_date:ts base_count:int base_mean:dbl base_std:dbl base_median:dbl "
        "soft_count:int soft_mean:dbl soft_std:dbl soft_median:dbl soft_minus_base_mean:dbl"
    ),
    "deltas_spatial": table_schema(
        "run_id:str station_code:str reference_date:ts delta_type:str delta_value:dbl easting:dbl northing:dbl"
    ),
    "anomalies": table_schema(
        "run_id:str station_code:str timestamp:ts anomaly_type:str threshold:dbl observed_value:dbl severity:str notes:str"
    ),
    "waveform_energy_hourly": table_schema("station_code:str channel:str hour:ts rms:dbl peak:dbl"),
    "catalog_events": table_schema(
        "event_id:str time:ts latitude:dbl longitude:dbl depth_km:dbl mag_type:str magnitude:dbl "
        "event_location_name:str event_type:str"
    ),
}
KEYS = {
    "runs": ["run_id"],
    "stations": ["station_code"],
    "raw_deltas": ["run_id", "event_id", "station_code", "channel", "arrival_epoch"],
    "station_stats": ["run_id", "station_code"],
    "deltas_spatial": ["run_id", "station_code", "reference_date", "delta_type"],
    "anomalies": ["run_id", "station_code", "timestamp", "anomaly_type"],
    "ml_features_timeseries": ["timestamp"],
    "waveform_energy_hourly": ["station_code", "channel", "hour"],
    "catalog_events": ["event_id"],
}

# The hourly feature series, in output order.
FEATURES = table_schema(
    "timestamp:ts numero_eventi:long energia_max:dbl energia_media:dbl energia_std:dbl "
    "eventi_ultime_6h:long energia_max_ultime_6h:dbl energia_media_ultime_6h:dbl "
    "eventi_ultime_12h:long energia_max_ultime_12h:dbl energia_media_ultime_12h:dbl "
    "eventi_ultime_24h:long energia_max_ultime_24h:dbl energia_media_ultime_24h:dbl "
    "eventi_ultime_48h:long energia_max_ultime_48h:dbl energia_media_ultime_48h:dbl "
    "ora_del_giorno:int giorno_della_settimana:int is_notte:int is_weekend:int "
    "bvalue_rolling_24h:dbl is_data_complete:int "
    "net_rms_log_ratio_med:dbl net_peak_log_ratio_med:dbl n_stations_energy:dbl frac_stations_2x_rms:dbl "
    "net_rms_log_ratio_6h:dbl net_rms_log_ratio_max_24h:dbl frac_stations_2x_6h:dbl frac_stations_2x_max_24h:dbl "
    "eventi_catalogo_6h:dbl magnitudo_max_6h:dbl Target_Allarme:int"
)
WAREHOUSE["ml_features_timeseries"] = FEATURES
