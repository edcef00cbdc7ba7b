"""Cleaning and feature rules on hand-made edge rows."""

from pyspark.sql import functions as F

from retentio.operators import features as B


def test_tenure_bin_edges(spark):
    rows = [(t,) for t in (-1.0, 0.0, 12.0, 13.0, 24.0, 48.0, 80.0, 81.0, 120.0, 121.0, None)]
    df = spark.createDataFrame(rows, "tenure double")
    v2 = {r["raw"]: (r["tenure"], r["Tenure_Bucket"]) for r in
          B.feature_engineer(df.withColumn("raw", F.col("tenure")), "v2").collect()}
    assert v2[-1.0] == (None, None)            # sanity rule nulls it
    assert v2[0.0] == (0.0, "0-1y")            # (-1, 12] includes 0
    assert v2[12.0][1] == "0-1y"               # right-closed
    assert v2[13.0][1] == "1-2y"
    assert v2[24.0][1] == "1-2y"
    assert v2[48.0][1] == "2-4y"
    assert v2[80.0][1] == "4-6y"
    assert v2[81.0][1] == "6-10y"
    assert v2[120.0] == (120.0, "6-10y")
    assert v2[121.0] == (None, None)
    v1 = {r["raw"]: r["Tenure_Bucket"] for r in
          B.feature_engineer(df.withColumn("raw", F.col("tenure")), "v1").collect()}
    assert v1[80.0] == "4-6y+"
    assert v1[81.0] is None                    # v1 has no bin above 80
    assert v1[120.0] is None


def test_lenient_total_charges(spark):
    df = spark.createDataFrame([("",), (" ",), ("abc",), ("12.5",), (None,)], "TotalCharges string")
    got = [r["TotalCharges"] for r in B.basic_clean(df).collect()]
    assert got == [None, None, None, 12.5, None]


def test_payment_simple_profiles(spark):
    df = spark.createDataFrame([("Bank transfer (automatic)",), ("AUTOMATIC pay",),
                                ("Mailed check",), (None,)], "PaymentMethod string")
    v2 = [r["Payment_Simple"] for r in B.feature_engineer(df, "v2").collect()]
    v1 = [r["Payment_Simple"] for r in B.feature_engineer(df, "v1").collect()]
    assert v2 == ["Automatic", "Automatic", "Manual", "Manual"]
    assert v1 == ["Automatic", "Manual", "Manual", "Manual"]


def test_churn_target_case(spark):
    df = spark.createDataFrame([("Yes",), ("yes",), ("No",), (None,)], "Churn string")
    assert [r["Churn_Target"] for r in B.basic_clean(df).collect()] == [1, 1, 0, 0]
    assert [r["Churn_Target"] for r in B.basic_clean(df, case_sensitive=True).collect()] == [1, 0, 0, 0]


def test_repairs_and_service_count(spark):
    cols = ("InternetService PhoneService MultipleLines OnlineSecurity OnlineBackup DeviceProtection "
            "TechSupport StreamingTV StreamingMovies Partner Dependents").split()
    row = ("No", "No", "Yes", "Yes", "Yes", "Yes", "Yes", "Yes", "Yes", "Yes", "No")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in cols))
    r = B.feature_engineer(df).first()
    assert r["OnlineSecurity"] == "No internet service"
    assert r["MultipleLines"] == "No phone service"
    assert r["Service_Count"] == 1                        # only Partner is still 'Yes'


def test_avg_historical_charge_profiles(spark):
    df = spark.createDataFrame([(100.0, None), (100.0, 4.0)], "TotalCharges double, tenure double")
    assert [r["Avg_Historical_Charge"] for r in B.feature_engineer(df, "v2").collect()] == [100.0, 20.0]
    assert [r["Avg_Historical_Charge"] for r in B.feature_engineer(df, "v1").collect()] == [None, 20.0]


def test_tenure_display(spark):
    df = spark.createDataFrame([(5.0,), (27.0,), (30.0,), (None,)], "tenure double")
    got = [r["tenure_display"] for r in B.with_tenure_display(df).collect()]
    assert got == ["5 months", "2.2 years", "2.5 years", None]


def test_segment_filters(spark):
    df = spark.createDataFrame([("low",), ("mid",), ("high",), ("unknown",)], "value_segment string")
    assert sorted(r[0] for r in B.min_segment_rank(df, "mid").collect()) == ["high", "mid"]
    assert sorted(r[0] for r in B.min_segment_list(df, "high").collect()) == ["high"]
    assert B.min_segment_list(df, "all").count() == 4


def test_load_raw_lists_candidates(spark, tmp_path):
    import pytest
    from retentio.sources import tables as SRC
    with pytest.raises(FileNotFoundError) as e:
        SRC.load_raw(spark, str(tmp_path), "mine.csv")
    assert "mine.csv" in str(e.value) and "Churn_Telco.csv" in str(e.value)
    (tmp_path / "telco_customer_churn.csv").write_text(
        "customerID,tenure,TotalCharges,Churn\n a1 ,3,12.5,Yes\nb2,x,,No\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("customerID", T.StringType()),
                           T.StructField("tenure", T.DoubleType()),
                           T.StructField("TotalCharges", T.StringType()),
                           T.StructField("Churn", T.StringType())])
    rows = SRC.load_raw(spark, str(tmp_path), schema=schema).collect()
    assert [r["tenure"] for r in rows] == [3.0, None]          # malformed value -> NULL


def test_exact_split_allocation():
    from retentio.operators.split import class_allocation
    # the published hold-out: 7,043 rows -> ceil(0.2 n) = 1,409 = 1,035 + 374
    alloc = class_allocation({0: 5174, 1: 1869}, 0.2)
    assert alloc == {0: 1035, 1: 374}
    assert sum(class_allocation({"a": 3, "b": 3, "c": 1}, 0.5).values()) == 4
