"""Bronze payload parsers: raw JSON text in, typed silver rows and refusals out.

Each source is one column expression that turns a response into an array of items, a
quote or a bar each.  An item is typed inside the array, once: it carries its numbers and
its instant, and, where it cannot become a row, the reason and its text.  So one pass
over bronze serves all sources and both outcomes, and a bad item costs itself alone and
not its response.  A response without any item is refused as a whole, so that every
response is accounted for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import folder_value, instant, instant_of_millis, let, not_blank, number, utc_day

PRICE_COLUMNS = S.PRICES.fieldNames()
CANDLE_COLUMNS = S.CANDLES.fieldNames()
REJECT_COLUMNS = S.REJECTS.fieldNames()

# Why something did not become a row.
NO_ENVELOPE = "envelope"  # the line is no JSON object of the agreed form
NO_SOURCE = "source"  # nobody parses this source
NO_PAYLOAD = "payload"  # the payload does not have the source's form
NO_ITEMS = "empty"  # it has, and holds nothing
NOT_OK = "status"  # the response reports a failure
NO_TIME = "time"  # the item's time cannot be read
NO_PRICE = "price"  # the item's price cannot be read

_BAR = ("open", "high", "low", "close", "volume")
_FIELDS = {
    "symbol": "string", "currency": "string", "interval": "string", "ts_utc": "timestamp",
    **dict.fromkeys(("price", *_BAR), "double"),
}


def _item(reason: Column, raw: Column, **known: Column) -> Column:
    """One item; what it was read from is kept only where it is refused."""
    return F.struct(
        *(known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in _FIELDS.items()),
        reason.cast("string").alias("reason"),
        F.when(reason.isNotNull(), raw).alias("item"),
    )


def _refused(reason: str, raw: Column) -> Column:
    """The items of a response that has none."""
    return F.array(_item(F.lit(reason), raw))


def _listed(items: Column) -> Column:
    """The items of a payload, or its refusal where it has no or an empty list."""
    data = F.col("data")
    return (
        F.when(items.isNull(), _refused(NO_PAYLOAD, data))
        .when(F.size(items) == 0, _refused(NO_ITEMS, data))
        .otherwise(items)
    )


def _quote(symbol: Column, currency: Column, price: Column, at: Column, raw: Column) -> Column:
    """One quote, from its price as text."""

    def typed(value: Column) -> Column:
        reason = F.when(at.isNull(), NO_TIME).when(value.isNull(), NO_PRICE)
        return _item(reason, raw, symbol=symbol, currency=currency, ts_utc=at, price=value)

    return let(number(price), typed)


def spot_items() -> Column:
    """``{asset: {currency: price}}``, stamped with the ingestion time."""
    at = F.col("ingest_ts")

    def quotes(asset: Column) -> Column:
        def quote(q: Column) -> Column:
            raw = F.struct(asset["key"].alias("asset"), q["key"].alias("currency"), q["value"].alias("price"))
            return _quote(asset["key"], q["key"], q["value"], at, F.to_json(raw))

        nothing = F.to_json(F.struct(asset["key"].alias("asset")))
        return F.coalesce(
            F.transform(F.map_entries(asset["value"]), quote),
            F.array(_item(F.lit(NO_PRICE), nothing, symbol=asset["key"], ts_utc=at)),  # its quotes are null
        )

    return let(
        F.flatten(F.transform(F.map_entries(F.from_json("data", S.SPOT_PAYLOAD)), quotes)), _listed
    )


def history_items() -> Column:
    """``prices: [[epoch ms, price], ...]``; a short pair lacks what it does not hold."""

    def point(p: Column) -> Column:
        return let(
            instant_of_millis(F.get(p, 0)),
            lambda at: _quote(F.col("coin"), F.col("vs_currency"), F.get(p, 1), at, F.to_json(p)),
        )

    return let(F.transform(F.from_json("data", S.HISTORY_PAYLOAD)["prices"], point), _listed)


def fx_items() -> Column:
    """``base``, ``date`` and ``rates: {currency: rate}``; symbol is base + currency."""

    def of_payload(fx: Column) -> Column:
        def rates(at: Column) -> Column:
            def rate(r: Column) -> Column:
                raw = F.struct(
                    fx["base"].alias("base"), fx["date"].alias("date"),
                    r["key"].alias("currency"), r["value"].alias("rate"),
                )
                symbol = F.concat_ws("", fx["base"], r["key"])
                return _quote(symbol, r["key"], r["value"], at, F.to_json(raw))

            return F.transform(F.map_entries(fx["rates"]), rate)

        return let(let(instant(fx["date"]), rates), _listed)

    return let(F.from_json("data", S.FX_PAYLOAD), of_payload)


def candle_items(folder: Column) -> Column:
    """OHLCV bars of a response whose status is ``ok``.

    The symbol comes from the payload, else the request, else the ``symbol=``
    ``folder`` the file lies in, else it is ``UNKNOWN``.
    """

    def of_payload(p: Column) -> Column:
        symbol = F.coalesce(
            not_blank(p["meta"]["symbol"]), not_blank(F.col("request.symbol")),
            folder, F.lit(S.UNKNOWN),
        )
        interval = F.coalesce("request.interval", F.lit(S.INTERVAL_CANDLE_DAY))

        def bars(named: Column) -> Column:
            def bar(b: Column) -> Column:
                return let(instant(b["datetime"]), lambda at: _item(
                    F.when(at.isNull(), NO_TIME), F.to_json(b), symbol=named["symbol"],
                    currency=p["meta"]["currency"], interval=named["interval"], ts_utc=at,
                    **{c: number(b[c]) for c in _BAR},
                ))

            return F.transform(p["values"], bar)

        named = F.struct(symbol.alias("symbol"), interval.alias("interval"))
        return F.when(p["status"] == "ok", let(let(named, bars), _listed)).otherwise(
            _refused(NOT_OK, F.col("data"))
        )

    return let(F.from_json("data", S.CANDLE_PAYLOAD), of_payload)


def _items(bronze: DataFrame, sources: tuple[str, ...]) -> Column:
    """The items of a record of any of these sources, a refusal for all others."""
    folder = F.lit(None).cast("string")
    if "input_file" in bronze.columns:
        folder = folder_value(F.col("input_file"), "symbol")
    of = {
        S.SOURCE_SPOT: spot_items, S.SOURCE_HISTORY: history_items, S.SOURCE_FX: fx_items,
        S.SOURCE_CANDLES: lambda: candle_items(folder),
    }
    items = _refused(NO_SOURCE, F.col("data"))
    for name in sources:
        items = F.when(F.col("source") == name, of[name]()).otherwise(items)
    if "_corrupt_record" in bronze.columns:
        broken = F.col("_corrupt_record")
        items = F.when(broken.isNotNull(), _refused(NO_ENVELOPE, broken)).otherwise(items)
    return items


def _typed(bronze: DataFrame) -> DataFrame:
    """Bronze with ``ingest_ts`` as an instant, whatever type it came in."""
    if bronze.schema["ingest_ts"].dataType.typeName() == "string":
        return bronze.withColumn("ingest_ts", instant(F.col("ingest_ts")))
    return bronze


def _labelled(rows: DataFrame) -> DataFrame:
    """Items with what follows from their source."""
    source = F.col("source")
    spot, fx, candle = (source == s for s in (S.SOURCE_SPOT, S.SOURCE_FX, S.SOURCE_CANDLES))
    asset_type = F.when(fx, S.ASSET_FOREX).when(candle, S.ASSET_STOCK).when(
        source.isin(*S.PRICE_SOURCES), S.ASSET_CRYPTO
    )
    interval = F.when(spot, S.INTERVAL_SPOT).otherwise(S.INTERVAL_QUOTE_DAY)
    rows = rows.withColumns({
        "asset_type": asset_type, "interval": F.coalesce("interval", F.when(~candle, interval)),
    })
    return rows.withColumn("date", utc_day(rows))


def _rows(bronze: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """Only the items that become rows; refused ones end inside the array."""
    sent = _typed(bronze.filter(F.col("source").isin(*sources)))
    good = F.filter(_items(sent, sources), lambda x: x["reason"].isNull())
    return _labelled(sent.select("source", "run_id", "ingest_ts", F.inline(good)))


def parsed(bronze: DataFrame) -> DataFrame:
    """Every item of every record, typed rows and refusals alike, for storing once.

    ``reason`` is null for a row.  ``place`` counts a response's items from 0; ``file``
    is where it was landed, if bronze says.  :func:`price_rows`, :func:`candle_rows` and
    :func:`refusals` take their part: each item is in exactly one.
    """
    sent = _typed(bronze)
    file = F.col("input_file") if "input_file" in sent.columns else F.lit(None).cast("string")
    items = _items(sent, (*S.PRICE_SOURCES, S.SOURCE_CANDLES))
    rows = sent.select(
        "source", "dataset", "run_id", "ingest_ts", file.alias("file"),
        F.posexplode(items).alias("place", "x"),
    ).select("source", "dataset", "run_id", "ingest_ts", "file", "place", "x.*")
    return _labelled(rows)


def price_rows(items: DataFrame) -> DataFrame:
    """The silver prices among parsed items."""
    kept = F.col("reason").isNull() & F.col("source").isin(*S.PRICE_SOURCES)
    return items.filter(kept).select(*PRICE_COLUMNS)


def candle_rows(items: DataFrame) -> DataFrame:
    """The silver candles among parsed items."""
    kept = F.col("reason").isNull() & (F.col("source") == S.SOURCE_CANDLES)
    return items.filter(kept).select(*CANDLE_COLUMNS)


def refusals(items: DataFrame) -> DataFrame:
    """What did not become a row: why, its text, and where it stands."""
    return items.filter(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)


def accounts(items: DataFrame) -> DataFrame:
    """Per source and run: items read, rows made and items refused, by reason."""
    by = [F.coalesce("source", F.lit(S.UNKNOWN)).alias("source"), "run_id", "reason"]
    return items.groupBy(*by).agg(F.count(F.lit(1)).alias("items"))


def prices(bronze: DataFrame, sources: tuple[str, ...] = S.PRICE_SOURCES) -> DataFrame:
    """Silver prices of all the given quote sources, in one pass over bronze."""
    return _rows(bronze, sources).select(*PRICE_COLUMNS)


def parse_spot_map(bronze: DataFrame) -> DataFrame:
    """Spot quotes: one row per asset and currency."""
    return prices(bronze, (S.SOURCE_SPOT,))


def parse_history_pairs(bronze: DataFrame) -> DataFrame:
    """Backfilled quotes: one row per [time, price] pair."""
    return prices(bronze, (S.SOURCE_HISTORY,))


def parse_fx_rates(bronze: DataFrame) -> DataFrame:
    """Exchange rates: one row per quoted currency."""
    return prices(bronze, (S.SOURCE_FX,))


def candles(bronze: DataFrame) -> DataFrame:
    """OHLCV bars of responses whose status is ``ok`` (see :func:`candle_items`)."""
    return _rows(bronze, (S.SOURCE_CANDLES,)).select(*CANDLE_COLUMNS)


def rejects(bronze: DataFrame) -> DataFrame:
    """Bronze lines that are not valid envelopes, with the file they came from."""
    return bronze.filter(F.col("_corrupt_record").isNotNull()).select(
        *(c for c in ("source", "input_file", "_corrupt_record") if c in bronze.columns)
    )


def source_counts(bronze: DataFrame) -> DataFrame:
    """Records per source."""
    return bronze.groupBy("source").agg(F.count(F.lit(1)).alias("records"))


def candle_totals(rows: DataFrame) -> DataFrame:
    """How many candles there are, and of how many symbols."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("symbol").alias("symbols"))
