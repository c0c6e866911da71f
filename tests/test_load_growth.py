"""What a load sorts and stores grows with its documents and rows, not with pairs of them."""

from datetime import date

from helpers import daily_body, days, landing, new_warehouse, rows

from airledger.plans import etl
from airledger.plans.etl import run_etl
from airledger.schemas import FACT_DAILY
from airledger.session import Staging

FEB = date(2024, 2, 1)


def _bodies(span, values):
    return [daily_body(span, rain_sum=[value] * len(span)) for value in values]


def _loaded(warehouse):
    return rows(warehouse.table(FACT_DAILY), "district_id", "date_key", "rain_sum")


def test_documents_are_ranked_once_whatever_their_districts(spark, tmp_path, monkeypatch):
    ranked, stored = [], []
    rank, put = etl.with_ordinal, Staging.put

    def counted(stage, df, order, label):
        ranked.append(df.count())
        return rank(stage, df, order, label)

    def noted(self, df, name):
        stored.append(name)
        return put(self, df, name)

    monkeypatch.setattr(etl, "with_ordinal", counted)
    monkeypatch.setattr(Staging, "put", noted)
    span = days(FEB, 4)
    frame = landing(
        spark,
        ("all", "archive-daily", [1, 2, 3], span[0], span[3], _bodies(span, [1.0, 2.0, 3.0])),
        ("part", "archive-daily", [1, 2, 3], span[1], span[2], _bodies(span[1:3], [4.0, 5.0, 900.0])),
    )
    warehouse = new_warehouse(spark, tmp_path)
    result = run_etl(warehouse, frame, "historical-daily", start=span[0], end=span[3])
    assert ranked == [2]
    assert stored.count("rows") == 1 and "delta" not in stored
    # The shorter document is preferred, and what is wrong in it isn't replaced from the other.
    assert (result.rows_loaded, result.rows_skipped, result.total_rejected) == (10, 2, 2)
    assert _loaded(warehouse) == [
        (1, 20240201, 1.0), (1, 20240202, 4.0), (1, 20240203, 4.0), (1, 20240204, 1.0),
        (2, 20240201, 2.0), (2, 20240202, 5.0), (2, 20240203, 5.0), (2, 20240204, 2.0),
        (3, 20240201, 3.0), (3, 20240204, 3.0),
    ]


def test_a_district_named_twice_is_used_only_if_both_elements_can_be(spark, tmp_path):
    span = days(FEB, 2)
    odd = {"daily": {"time": ["2024-02-01", "someday"], "rain_sum": [7.0, 7.0]}}
    good = daily_body(span, rain_sum=[2.0, 2.0])
    frame = landing(
        spark,
        ("twice", "archive-daily", [1, 1, 2], span[0], span[1], [good, odd, good]),
        ("other", "archive-daily", [1, 3], FEB, date(2024, 2, 29), _bodies(span, [1.0, 3.0])),
    )
    warehouse = new_warehouse(spark, tmp_path)
    result = run_etl(warehouse, frame, "historical-daily", start=span[0], end=span[1])
    assert (result.rows_loaded, result.failed_districts) == (6, 0)
    assert {(d, v) for d, _, v in _loaded(warehouse)} == {(1, 1.0), (2, 2.0), (3, 3.0)}


def test_documents_without_an_id_are_delivered_but_not_loaded(spark, tmp_path):
    span = days(FEB, 2)
    frame = landing(
        spark,
        (None, "archive-daily", [1], span[0], span[1], _bodies(span, [1.0])),
        ("named", "archive-daily", [2], span[0], span[1], _bodies(span, [2.0])),
    )
    warehouse = new_warehouse(spark, tmp_path)
    result = run_etl(warehouse, frame, "historical-daily", start=span[0], end=span[1])
    assert (result.rows_loaded, result.failed_districts) == (2, 1)
    assert {d for d, _, _ in _loaded(warehouse)} == {2}
