"""What does not become a row, and how often a plan reads the text of a time."""

from pyspark.sql import functions as F
from test_payloads import bronze  # noqa: F401 (a fixture)

from tickstone import schemas as S
from tickstone.operators import payloads
from tickstone.plans import jobs
from tickstone.sources import files
from tickstone.workload import bindings as B

SF = "/root/testdata/sf0.001"


def test_every_item_is_a_row_or_a_refusal(spark, bronze):  # noqa: F811
    items = payloads.parsed(files.read_bronze(spark, bronze))
    found = {}
    for r in payloads.refusals(items).collect():
        found.setdefault((r.source, r.reason), []).append((r.place, r.item))
    assert found.pop((None, "envelope")) == [(0, "{broken")]
    spot = dict(found.pop(("coingecko", "price")))
    assert spot[2] == '{"asset":"bitcoin","currency":"gbp","price":"n/a"}'
    assert spot[4] == '{"asset":"nothing"}' and len(spot) == 3
    assert found.pop(("coingecko_market_chart", "price")) == [(2, '["1700172800000"]')]
    assert found.pop(("coingecko_market_chart", "time")) == [(3, "[]")]
    times = found.pop(("twelvedata", "time"))
    assert len(times) == 4 and {p for p, _ in times} == {2} and "junk" in times[0][1]
    status = found.pop(("twelvedata", "status"))
    assert len(status) == 1 and '"status":"error"' in status[0][1].replace(" ", "")
    assert found == {}
    read, made = items.count(), payloads.price_rows(items).count() + payloads.candle_rows(items).count()
    assert read == made + payloads.refusals(items).count()
    accounted = payloads.accounts(items).agg(F.sum("items")).first()[0]
    assert accounted == read


def test_responses_without_items(spark):
    rows = [
        ("coingecko", "{}"), ("coingecko", "[1]"), ("coingecko", None), ("nobody", "{}"), (None, "{}"),
        ("coingecko_market_chart", '{"prices": []}'), ("coingecko_market_chart", "{}"),
        ("frankfurter", '{"base": "EUR"}'), ("frankfurter", '{"rates": {}}'), ("twelvedata", "{}"),
        ("twelvedata", '{"status": "ok"}'), ("twelvedata", '{"status": "ok", "values": []}'),
        ("coingecko", '{"a": {"usd": 1}}'),
    ]
    df = spark.createDataFrame(rows, "source string, data string").selectExpr(
        "source", "'d' dataset", "'r' run_id", "cast(null as string) ingest_ts", "'c' coin",
        "'usd' vs_currency", "cast(null as struct<symbol:string,interval:string>) request", "data",
    )
    got = [(r.source, r.reason) for r in payloads.refusals(payloads.parsed(df)).collect()]
    assert sorted(got, key=str) == sorted([
        ("coingecko", "empty"), ("coingecko", "payload"), ("coingecko", "payload"),
        ("nobody", "source"), (None, "source"), ("coingecko_market_chart", "empty"),
        ("coingecko_market_chart", "payload"), ("frankfurter", "payload"), ("frankfurter", "empty"),
        ("twelvedata", "status"), ("twelvedata", "payload"), ("twelvedata", "empty"),
        ("coingecko", "time"),  # its ingestion time is null
    ], key=str)


def test_the_job_stores_refusals_once(spark, bronze, tmp_path):  # noqa: F811
    silver = str(tmp_path / "silver")
    first = jobs.bronze_to_silver(spark, bronze, silver)
    assert first["rejects"] == 11
    jobs.bronze_to_silver(spark, bronze, silver)
    jobs.bronze_to_silver(spark, bronze, silver, date="2026-02-27")
    kept = files.read_table(spark, f"{silver}/rejects", S.STORED_REJECTS)
    assert kept.count() == 11
    assert {(r.source, r.date) for r in kept.select("source", "date").collect()} == {
        ("UNKNOWN", "2026-02-26"), ("coingecko", "2026-02-27"), ("coingecko_market_chart", "2026-02-27"),
        ("twelvedata", "2026-02-27"),
    }
    assert all(r.file.endswith(".gz") for r in kept.collect())


def test_time_text_is_read_once(spark):
    for make, respond in (
        (payloads.parse_spot_map, B.spot_responses), (payloads.parse_fx_rates, B.fx_responses),
        (payloads.candles, B.candle_responses),
    ):
        plan = make(respond(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
        patterns = plan.count("RLIKE") + plan.count("regexp_replace") + plan.count("regexp_extract")
        # ``ingest_ts`` and the source's own time have two patterns each, the folder one.
        assert patterns <= 5, plan
        assert plan.count("from_json") <= 1
