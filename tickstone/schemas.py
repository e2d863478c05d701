"""Explicit schemas of every table the engine reads or writes.

Nothing is inferred: a bronze field that no record happens to carry still
resolves, and partition values such as ``005930`` stay text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names that already-landed data carries ------------------
SOURCE_SPOT = "coingecko"
SOURCE_HISTORY = "coingecko_market_chart"
SOURCE_FX = "frankfurter"
SOURCE_CANDLES = "twelvedata"
PRICE_SOURCES = (SOURCE_SPOT, SOURCE_HISTORY, SOURCE_FX)

# Where each source's responses lie below the bronze root.
SOURCE_FOLDERS = {
    SOURCE_SPOT: "coingecko/crypto_simple_price",
    SOURCE_HISTORY: "coingecko/crypto_market_chart",
    SOURCE_FX: "frankfurter/forex_latest",
    SOURCE_CANDLES: "twelvedata/time_series",
}

ASSET_CRYPTO = "crypto"
ASSET_FOREX = "forex"
ASSET_STOCK = "stock"

INTERVAL_SPOT = "spot"
INTERVAL_QUOTE_DAY = "1d"
INTERVAL_CANDLE_DAY = "1day"
UNKNOWN = "UNKNOWN"

PARTITIONS = ("asset_type", "symbol", "date")

# A time series is every row that agrees on these columns.  A frame that lacks
# some of them (an older gold table, say) is keyed by those it has.
SERIES_KEYS = ("asset_type", "symbol", "interval", "currency")
PRICE_VERSION_KEYS = ("asset_type", "symbol", "currency", "interval")
CANDLE_VERSION_KEYS = ("asset_type", "symbol", "interval", "ts_utc")

PRICE_TRACKED = ("ts_utc", "price")
CANDLE_TRACKED = ("open", "high", "low", "close", "volume", "currency")

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}


def _struct(text: str) -> T.StructType:
    """``name type`` pairs, without needing a running session."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- bronze ----------------------------------------------------------------
# ``data`` stays the raw JSON text of the payload: four sources share the field
# name but not its shape, and each operator parses only its own.
BRONZE = (
    _struct(
        "source string, dataset string, run_id string, ingest_ts string, "
        "coin string, vs_currency string"
    )
    .add("request", _struct("symbol string, interval string, outputsize string, base string"))
    .add("data", T.StringType())
    .add("_corrupt_record", T.StringType())
)

SPOT_PAYLOAD = "map<string, map<string, string>>"
HISTORY_PAYLOAD = "prices array<array<string>>"
FX_PAYLOAD = "base string, date string, rates map<string, string>"
CANDLE_PAYLOAD = (
    "status string, meta struct<symbol: string, currency: string>, "
    "values array<struct<datetime: string, open: string, high: string, "
    "low: string, close: string, volume: string>>"
)

MANIFEST = _struct(
    "run_id string, source string, dataset string, ingest_ts string, date string, "
    "request_params string, record_count bigint, status string"
)

# --- silver: fixed values, the names and order of stored columns -------------
PRICES = _struct(
    "ts_utc timestamp, date string, asset_type string, symbol string, interval string, "
    "currency string, price double, source string, run_id string, ingest_ts timestamp"
)

CANDLES = _struct(
    "ts_utc timestamp, date string, asset_type string, symbol string, interval string, "
    "open double, high double, low double, close double, volume double, "
    "currency string, source string, run_id string, ingest_ts timestamp"
)

# Not stored by anyone else: what of a response did not become a row.
REJECTS = _struct(
    "source string, dataset string, run_id string, ingest_ts timestamp, file string, place int, "
    "reason string, item string"
)
REJECT_PARTITIONS = ("source", "date")
STORED_REJECTS = T.StructType([*REJECTS.fields, T.StructField("date", T.StringType())])

_VERSIONS = _struct(
    "hash_diff string, valid_from timestamp, valid_to timestamp, is_current boolean"
)
PRICE_HISTORY = T.StructType(PRICES.fields + _VERSIONS.fields)
CANDLE_HISTORY = T.StructType(CANDLES.fields + _VERSIONS.fields)

# --- gold: fixed values, the names and order of stored columns ---------------
RETURNS = _struct(
    "ts_utc timestamp, date string, asset_type string, symbol string, return_1d double, "
    "close double, close_prev double, source string, interval string, currency string"
)

VOLATILITY = _struct(
    "ts_utc timestamp, date string, asset_type string, symbol string, volatility double, "
    "window_days int, interval string, currency string"
)

_PREDICTION = _struct(
    "asset_type string, symbol string, prediction_return double, action string, "
    "last_ts string, last_close double, model string, alpha double, samples int"
)
PREDICTIONS = T.StructType(
    _struct("generated_at string, interval string, currency string").fields + _PREDICTION.fields
)
PREDICTIONS_DOCUMENT = _struct("generated_at string").add(
    "predictions", T.ArrayType(_PREDICTION)
)


def series_keys(df) -> list[str]:
    """The series key columns that ``df`` has."""
    return [k for k in SERIES_KEYS if k in df.columns]
