"""Tables that several steps of a query read are derived once."""

from workload import forecasting, tables

SF = "/root/testdata/sf0.001"


def test_forecasts_derive_the_features_once(spark, monkeypatch):
    seen, features = [], forecasting.v.features
    monkeypatch.setattr(forecasting.v, "features", lambda *a: seen.append(a) or features(*a))
    assert forecasting.d17(spark, SF).count() > 0 and len(seen) == 1


def test_loads_read_the_parsed_rows(spark, monkeypatch):
    seen, land = [], tables.land
    monkeypatch.setattr(tables, "land", lambda rows, *a: seen.append(rows.inputFiles()) or land(rows, *a))
    assert tables.a5(spark, SF).count() > 0
    assert len(seen) == 3 and all("/parsed-" in f for files in seen for f in files)
