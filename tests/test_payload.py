"""Landed payload readers (S1-S4) on the fixture documents."""

import datetime as dt
import json

from tidemark.sources import payload

SERIES_DOC = {
    "Meta Data": {"1. Information": "Daily Prices", "2. Digital Currency Code": "BTC", "4. Market Code": "EUR"},
    "Time Series (Digital Currency Daily)": {
        "2024-05-06": {"1. open": "40100.25", "2. high": "40200.75", "3. low": "39900.5",
                       "4. close": "40050.5", "5. volume": "12.25"},
        "2024-05-07": {"1. open": "abc", "2. high": "1e3", "3. low": " 5 ",
                       "4a. close (USD)": "7", "4b. close (EUR)": "6", "5. volume": "1,000"},
        "2024-02-30": {"1. open": "1", "4. close": "1"},
    },
}
QUOTE_DOC = {"Realtime Currency Exchange Rate": {
    "1. From_Currency Code": "USD", "2. From_Currency Name": "United States Dollar",
    "3. To_Currency Code": "EUR", "4. To_Currency Name": "Euro",
    "5. Exchange Rate": "0.81250000", "6. Last Refreshed": "2024-03-05 06:07:08",
    "7. Time Zone": "UTC", "8. Bid Price": "0.81240000", "9. Ask Price": "0.81250000"}}


def _docs(spark, docs):
    return spark.createDataFrame([(i, d if isinstance(d, str) or d is None else json.dumps(d))
                                  for i, d in enumerate(docs)], "doc long, raw string")


def test_series_rows(spark):
    df = _docs(spark, [SERIES_DOC])
    rows = payload.series_rows(df, fields=("open", "high", "low", "close", "close_1", "volume"),
                               meta={"symbol": "digital_currency_code", "market": "market_code"})
    got = {r["date"]: r.asDict() for r in rows.collect()}
    assert set(got) == {"2024-05-06", "2024-05-07", None}
    a = got["2024-05-06"]
    assert (a["symbol"], a["market"], a["datetime"]) == ("BTC", "EUR", dt.datetime(2024, 5, 6))
    assert (a["open"], a["close"], a["volume"], a["close_1"]) == (40100.25, 40050.5, 12.25, None)
    b = got["2024-05-07"]
    assert (b["open"], b["high"], b["low"], b["close"], b["close_1"], b["volume"]) == (None, 1000.0, 5.0, 7.0, 6.0, None)
    assert got[None]["datetime"] is None


def test_broken_series_documents_are_rejected_not_fatal(spark):
    docs = [None, "", "null", "{}", {"Information": "rate limit"}, "not json", SERIES_DOC]
    df = _docs(spark, docs)
    rows = payload.series_rows(df, passthrough=["doc"])
    assert {r["doc"] for r in rows.collect()} == {6}
    rej = {r["doc"]: (r["reason"], r["keys_found"]) for r in payload.series_rejects(df, passthrough=["doc"]).collect()}
    assert rej[0][0] == "empty" and rej[1][0] == "empty" and rej[2][0] == "empty" and rej[3][0] == "empty"
    assert rej[4] == ("no_time_series", ["Information"])
    assert rej[5][0] == "not_a_json_object"
    assert 6 not in rej


def test_every_document_yields_rows_or_one_reject(spark):
    series = [None, "", "{}", "[1]", "5", {"Time Series X": {}}, {"Time Series X": 3}, {"Time Series X": None},
              {"Time Series X": [1]}, {"Time Series X": {"2024-01-01": 5, "2024-01-02": {"4. close": "2"}}},
              {"Time Series X": {"2024-01-01": {"x": "1", "x ": "2", "1. x": "3", "2. x": "4", "x_1": "5"}}}, SERIES_DOC]
    df = _docs(spark, series)
    rows = payload.series_rows(df, fields="discover", passthrough=["doc"]).collect()
    rej = {r.doc: r.reason for r in payload.series_rejects(df, passthrough=["doc"]).collect()}
    assert {r.doc for r in rows} == {9, 10, 11} and set(rej) == set(range(9))
    assert [rej[i] for i in (3, 5, 6, 7, 8)] == ["not_a_json_object"] + ["malformed_time_series"] * 4
    assert sorted((r.date, r.close) for r in rows if r.doc == 9) == [("2024-01-01", None), ("2024-01-02", 2.0)]
    one = next(r for r in rows if r.doc == 10)
    assert (one["x"], one["x "], one["x_1"], one["x_2"], one["x_1_1"]) == (1.0, 2.0, 3.0, 4.0, 5.0)

    quotes = [None, "{}", "x", {"Note": "limit"}, *({"Realtime Currency Exchange Rate": v} for v in ({}, 3, None, [1])),
              QUOTE_DOC]
    df = _docs(spark, quotes)
    assert [r.doc for r in payload.quote_rows(df, passthrough=["doc"]).collect()] == [8]
    rej = {r.doc: r.reason for r in payload.quote_rejects(df, passthrough=["doc"]).collect()}
    assert rej == {0: "empty", 1: "empty", 2: "not_a_json_object", 3: "no_quote", **dict.fromkeys(range(4, 8), "malformed_quote")}


def test_all_quote_fields_are_kept(spark):
    doc = {"Realtime Currency Exchange Rate": {**QUOTE_DOC["Realtime Currency Exchange Rate"], "10. Day Spread": "7"}}
    q = payload.quote_rows(_docs(spark, [QUOTE_DOC, doc]), fields="discover")
    assert q.columns == [*payload.QUOTE_FIELDS, "day_spread"]
    assert sorted(r.day_spread or "" for r in q.collect()) == ["", "7"]


def test_quote_rows_and_rejects(spark):
    df = _docs(spark, [QUOTE_DOC, {"Note": "limit"}])
    q = payload.quote_rows(df, passthrough=["doc"]).collect()
    assert len(q) == 1
    r = q[0]
    assert (r.from_currency_code, r.to_currency_code, r.exchange_rate, r.last_refreshed, r.time_zone,
            r.bid_price, r.ask_price) == ("USD", "EUR", "0.81250000", "2024-03-05 06:07:08", "UTC",
                                           "0.81240000", "0.81250000")
    rej = payload.quote_rejects(df, passthrough=["doc"]).collect()
    assert [(x.doc, x.reason) for x in rej] == [(1, "no_quote")]


def test_read_landed_files(spark, tmp_root):
    import os
    d = os.path.join(tmp_root, "landing")
    os.makedirs(d)
    for i, doc in enumerate([SERIES_DOC, {"Information": "x"}]):
        with open(os.path.join(d, f"doc{i}.json"), "w") as fh:
            json.dump(doc, fh, indent=2)
    raw = payload.read_landed(spark, d)
    assert raw.count() == 2
    assert payload.series_rows(raw).count() == 3


def test_json_field(spark):
    df = spark.createDataFrame([('{"a": {"k": 3}}',)], "raw string")
    assert df.select(payload.json_field("raw", "$.a.k")).first()[0] == "3"


def test_read_landed_json_lines(spark, tmp_root):
    import os
    d = os.path.join(tmp_root, "lines")
    os.makedirs(d)
    with open(os.path.join(d, "batch.jsonl"), "w") as fh:
        fh.write(json.dumps(SERIES_DOC) + "\n" + json.dumps({"Information": "x"}) + "\n")
    raw = payload.read_landed(spark, d, whole_files=False)
    assert raw.count() == 2
    assert payload.series_rows(raw).count() == 3
    assert [r.reason for r in payload.series_rejects(raw).collect()] == ["no_time_series"]


def test_discovered_fields(spark):
    df = _docs(spark, [SERIES_DOC])
    rows = payload.series_rows(df, fields="discover")
    assert rows.columns == ["datetime", "open", "high", "low", "close", "volume", "close_1", "date"]
    assert rows.filter("date = '2024-05-07'").first().close_1 == 6.0
