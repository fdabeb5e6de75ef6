import json

import pytest
from pyspark.sql import functions as F

from assay.plans import reports
from assay.plans.metrics import BANKING, BANKING_DEFINITION, MetricView, segment_comparison

from .helpers import rows


@pytest.fixture(scope="module")
def c360(spark):
    data = [
        ("a", 61, "56-65", "East", "affluent", "Bank A", True, "active", True, 10.0, 2, 3, 5.0),
        ("b", 65, "56-65", "East", "private", None, False, "attrited", False, 20.0, 1, 1, 1.0),
        ("c", 22, "18-25", None, "affluent", None, True, None, None, 0.5, 4, 9, 2.5),
        ("d", 23, "18-25", None, "affluent", None, True, "active", True, 40.0, 0, 0, 0.0),
    ]
    df = spark.createDataFrame(data, """customer_id string, age int, age_band string,
        region string, segment string, source_bank string, moved_from_bank boolean,
        customer_status string, is_retained boolean, total_balance double,
        debit_swipe_count long, txn_count long, total_spend double""")
    return df.withColumns({"gender": F.lit("F"), "home_state": F.lit("TN"),
                           "acquisition_channel": F.lit("branch")})


def test_definition_has_eleven_dimensions_and_ten_measures():
    assert len(BANKING.dimensions) == 11 and len(BANKING.measures) == 10
    assert BANKING.tags == {"domain": "retail_banking", "certified": "true"}


def test_global_query_with_every_measure(c360):
    row = BANKING.query(c360, list(BANKING.measures)).first().asDict()
    assert row["Customer Count"] == 4 and row["Average Balance"] == 17.625
    assert row["Total Balance"] == 70.5 and row["Median Balance"] == 15.0
    assert row["Debit Card Swipes"] == 7 and row["Total Transactions"] == 13
    assert row["Total Spend"] == 8.5 and row["Retained Customers"] == 2
    assert row["Retention Rate"] == 0.5 and row["Attrition Rate"] == 0.25


def test_null_group_and_median_by_group(c360):
    out = BANKING.query(c360, ["Median Balance", "Customer Count"], by=["Region"])
    assert out.columns == ["Region", "Median Balance", "Customer Count"]
    assert rows(out) == [("East", 15.0, 2), (None, 20.25, 2)]


def test_where_on_a_dimension_that_is_not_grouped(c360):
    out = BANKING.query(c360, ["Customer Count"], by=["Segment"],
                        where="`Moved From Bank` = true AND `Age` < 60")
    assert rows(out) == [("affluent", 2)]


def test_guards(c360):
    for measures, by in (([], []), (["Nope"], []), (["Customer Count"], ["Nope"]),
                         (["*"], []), (["Age"], []), (["Customer Count"], ["*"])):
        with pytest.raises(ValueError):
            BANKING.query(c360, measures, by)
    for where in ("total_balance > 1", "`Customer Count` > 1", "nope = 1"):
        with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
            BANKING.query(c360, ["Customer Count"], where=where)


def test_average_is_not_the_average_of_averages(c360):
    by_region = [r[1] for r in BANKING.query(c360, ["Average Balance"], by=["Age"]).collect()]
    overall = BANKING.query(c360, ["Average Balance"], by=["Segment"],
                            where="`Segment` = 'affluent'").first()[1]
    assert overall == pytest.approx((10.0 + 0.5 + 40.0) / 3)
    assert overall != pytest.approx(sum(by_region) / len(by_region))


def test_anchor_questions_agree_with_reports(c360):
    view = BANKING.query(c360, ["Average Balance", "Customer Count"],
                         where="`Age` BETWEEN 61 AND 65").first()
    report = reports.anchor_balance(c360).first()
    assert (round(view[0]), view[1]) == (report.avg_balance, report.n)
    swipes = BANKING.query(c360, ["Debit Card Swipes"], where="`Age` BETWEEN 21 AND 25").first()[0]
    assert swipes == reports.anchor_swipes(c360).first()[0] == 4


def test_empty_source(c360):
    empty = c360.limit(0)
    assert BANKING.query(empty, ["Customer Count", "Median Balance"]).first()[0] == 0
    assert BANKING.query(empty, ["Median Balance"], by=["Region"]).count() == 0


def test_segment_comparison(c360):
    out = {r.Segment: r for r in segment_comparison(c360).collect()}
    assert out["affluent"]["Swipes per Customer"] == 2.0
    assert out["private"]["Customer Count"] == 1


def test_catalogue_and_yaml_shape(spark):
    yaml = pytest.importorskip("yaml")
    again = MetricView.from_dict(yaml.safe_load(yaml.safe_dump(BANKING_DEFINITION)))
    assert again == BANKING
    found = again.catalogue(spark).filter("lower(comment) LIKE '%switch%'")
    assert rows(found, "name") == [("Moved From Bank",), ("Source Bank",)]
    assert again.catalogue(spark).count() == 21


def test_definition_from_a_file(spark, tmp_path):
    spec = {"dimensions": [{"name": "G", "expr": "g"}], "measures": [
        {"name": "M", "expr": "PERCENTILE(x * 2, 0.5)"}, {"name": "N", "expr": "COUNT(1)"}]}
    (tmp_path / "m.json").write_text(json.dumps(spec))
    view = MetricView.from_file(str(tmp_path / "m.json"))
    df = spark.createDataFrame([("a", 0.001), ("a", 0.002), ("a", 0.0035)], "g string, x double")
    assert [tuple(r) for r in view.query(df, ["M", "N"], by=["G"]).collect()] == [("a", 0.004, 3)]
