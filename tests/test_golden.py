
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.labels import canon_label
from ledgerlens.functions.scalars import pct, rnd
from ledgerlens.operators import aggs, joins, stats, windows


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_intensity_ratio_and_conversion(spark):
    # one place against the rest; totals 341578.78 and 2185797.0
    left = spark.createDataFrame([("AP", 1729.86), ("rest", 341578.78 - 1729.86)], "place string, fdi double")
    right = spark.createDataFrame([("AP", 150285.0), ("rest", 2185797.0 - 150285.0)], "place string, impl double")
    filed = spark.createDataFrame([("AP", 174194.0)], "place string, filed double")
    a = aggs.share_of_total(left, "fdi", "fdi_share")
    b = aggs.share_of_total(right, "impl", "impl_share")
    j = joins.full_join_provenance(a, b, "place", "fdi", "iem")
    j = joins.left_lookup(j, filed, "place")
    r = one(
        j.where("place = 'AP'").select(
            rnd(F.col("fdi_share"), 2).alias("fs"), rnd(F.col("impl_share"), 2).alias("isf"),
            rnd(aggs.intensity(F.col("fdi_share"), F.col("impl_share")), 4).alias("ratio"),
            rnd(pct("impl", "filed"), 1).alias("conv"), "present_in",
        )
    )
    assert (r.fs, r.isf, r.ratio, r.conv, r.present_in) == (0.51, 6.88, 0.0737, 86.3, "both")


def test_backlog_count_based_conversion(spark):
    rows = [(i < 994, 271703.0 if i == 0 else (454589.0 if i == 994 else 0.0)) for i in range(1415)]
    df = spark.createDataFrame([("Maharashtra", impl, v) for impl, v in rows], "state string, impl boolean, v double")
    r = one(aggs.backlog(df, "state", F.lit(True), F.col("impl"), "v"))
    assert (r.pending_n, r.pending_value, round(r.conversion_pct, 1)) == (421, 454589.0, 70.2)
    assert (r.filed_value, r.impl_value) == (726292.0, 271703.0)


PENDING = [
    ("Maharashtra", 421, 454589), ("Karnataka", 231, 312828), ("Odisha", 109, 232433), ("Telangana", 55, 65501),
    ("Madhya Pradesh", -2, 57617), ("Tamil Nadu", 182, 51463), ("West Bengal", 29, 46308), ("Rajasthan", 57, 40076),
    ("Delhi", 104, 31420), ("Haryana", 98, 30823), ("Chhattisgarh", 119, 27104), ("Uttar Pradesh", 31, 24909),
    ("Andhra Pradesh", -18, 23909), ("Jammu and Kashmir", 39, 11793), ("Bihar", 8, 9661), ("Assam", -7, 3604),
    ("Puducherry", 9, 2429), ("Goa", 8, 2300), ("Kerala", 14, 2236), ("Tripura", 2, 146), ("Mizoram", 1, 133),
    ("Nagaland", 1, 11), ("Chandigarh", 2, 10), ("Manipur", 1, 10), ("Arunachal Pradesh", -2, 7),
    ("Andaman and Nicobar", 1, 0), ("Lakshadweep", 1, 0), ("Sikkim", 1, -56), ("Meghalaya", -3, -1013),
    ("Daman and Diu", 8, -3484), ("Uttarakhand", -9, -4654), ("Himachal Pradesh", -3, -5180), ("Jharkhand", -25, -14988),
    ("Dadra and Nagar Haveli", -15, -15723), ("Punjab", -9, -40904), ("Gujarat", -85, -277616),
]


def test_positive_part_sums(spark):
    df = spark.createDataFrame(PENDING, "state string, n long, v long")
    n = one(aggs.sum_positive(df, "n"))[0]
    v = one(aggs.sum_positive(df, "v"))[0]
    assert (n, v) == (1532, 1431320)
    plain = one(df.agg(F.sum("n"), F.sum("v")))
    assert (plain[0], plain[1]) == (1354, 1067702)


def test_scenarios(spark):
    demand = spark.createDataFrame([(1431320.0, 365596.0)], "demand double, supply double")
    sc = spark.createDataFrame([("heavy", 1.2), ("mid", 5.0), ("light", 16.0)], "scenario string, per_acre double")
    x = joins.cross_scenarios(demand, sc)
    x = x.withColumn("acres", F.col("demand") / F.col("per_acre")).withColumn("multiple", F.col("acres") / F.col("supply"))
    from ledgerlens.functions.scalars import band

    x = x.withColumn("verdict", F.when(F.col("multiple") > 1.0, "DEFICIT").when(F.col("multiple") < 0.5, "SURPLUS").otherwise("BALANCE"))
    got = {r.scenario: (round(r.acres), round(r.multiple, 2), r.verdict) for r in x.collect()}
    assert got == {"heavy": (1192767, 3.26, "DEFICIT"), "mid": (286264, 0.78, "BALANCE"), "light": (89458, 0.24, "SURPLUS")}
    assert band is not None


def test_ledger_total(spark):
    layers = [("a", 253720, True), ("b", 104026, True), ("c", 4450, True), ("d", 3400, True), ("e", None, True), ("f", 93564662, False)]
    df = spark.createDataFrame(layers, "layer string, acres long, siteable boolean")
    sited = df.where("siteable")
    r = one(aggs.ledger_total(sited, "acres", "siteable"))
    assert r.total == 365596
    ready = one(aggs.ledger_total(df.withColumn("ready", F.col("layer") == "a"), "acres", "ready"))
    assert ready.ready_total == 253720


SECTORS = [
    (63, 4738, False), (120, 31017, False), (39, 5058, True), (75, 26528, False), (69, 13204, True), (112, 68421, True),
    (58, 4543, False), (59, 10024, False), (50, 9488, False), (51, 16082, False), (38, 8165, True), (9, 944, False),
    (39, 17220, True), (21, 3670, False), (19, 2229, False), (23, 2571, True), (33, 4654, True), (7, 6247, True),
    (6, 18224, True), (4, 38, False), (10, 738, False), (12, 4104, False), (1, 54, False), (17, 1960, False),
    (4, 1001, False), (4, 1218, False), (3, 16, False), (0, 0, True), (1, 263, False), (2, 290, False), (0, 0, False),
    (3, 322, False), (4, 212, True), (6, 2859, False), (1, None, False), (3, 9428, False), (2, 1395, False), (0, 0, False),
    (0, 0, False),
]


def test_unweighted_bucket_mean(spark):
    # one sector reports a project but no investment figure: not published (null), not zero
    df = spark.createDataFrame(SECTORS, "impl long, inv long, heavy boolean")
    got = {r.heavy: (round(r.mean_ratio, 1), round(r.pooled_ratio, 1)) for r in aggs.bucket_mean_ratio(df, "heavy", "inv", "impl").collect()}
    assert got[True][0] == 582.4 and got[False][0] == 326.0
    assert got[True][1] == 389.1 and got[False][1] == 222.3


PANEL = [
    ("Karnataka", 12.7, 28.1, 81.0), ("Tamil Nadu", 8.2, 31.6, 98.0), ("Gujarat", 6.8, 27.9, 1944.0),
    ("West Bengal", 6.7, 18.8, 13.0), ("Maharashtra", 3.6, 42.7, 1087.0), ("Telangana", 3.2, 16.5, 1660.0),
    ("Haryana", 22.8, 12.0, 285.0), ("Chhattisgarh", -8.9, 5.6, 8061.0),
]


def test_correlations(spark):
    df = spark.createDataFrame(PANEL, "state string, price double, gsdp double, fc double")
    assert round(one(stats.pearson(df, "price", "fc")).pearson_r, 2) == -0.78
    assert round(one(stats.spearman(df, "price", "fc")).spearman_rho, 3) == -0.571
    assert round(one(stats.partial_corr(df, "price", "fc", "gsdp")).partial_r, 3) == -0.847


def test_growth_pct(spark):
    df = spark.createDataFrame([("x", 2025, 2043.04), ("x", 2026, 1153.42)], "k string, yr int, v double")
    r = one(windows.growth(df, "k", "yr", "v", 1).where("yr = 2026"))
    assert round(r.growth_1_pct, 1) == -43.5


def test_peak_share_and_cv_missing_as_zero(spark):
    yrs = ["2020", "2021", "2022", "2023", "2024", "2025"]
    a = [86.0, 225.0, 284.0, 92.0, 233.0, 609.0]
    b = [5.0, None, None, None, 1.0, None]
    rows = [("A", y, v) for y, v in zip(yrs, a)] + [("B", y, v) for y, v in zip(yrs, b) if v is not None]
    df = spark.createDataFrame(rows, "s string, y string, v double")
    periods = spark.createDataFrame([(y,) for y in yrs], "y string")
    got = {r.s: (round(r.peak_share_pct, 1), round(r.cv, 2)) for r in aggs.series_profile(df, "s", "y", "v", periods).collect()}
    assert got == {"A": (39.8, 0.68), "B": (83.3, 1.83)}


def test_canonical_labels(spark):
    aliases = {"orissa": "Odisha"}
    df = spark.createDataFrame([("JAMMU AND KASHMIR",), ("Jammu & Kashmir",), (" Jammu  &Kashmir. ",), ("Orissa",)], "s string")
    got = [r[0] for r in df.select(canon_label(F.col("s"), aliases)).collect()]
    assert got == ["Jammu and Kashmir"] * 3 + ["Odisha"]


def test_exposure_sum(spark):
    df = spark.createDataFrame([("72", 10316.6), ("76", 10409.0), ("85", 999.0)], "code string, v double")
    codes = spark.createDataFrame([("72",), ("76",)], "code string")
    assert math.isclose(one(aggs.exposure(df, "code", codes, "v")).exposure, 20725.6)


@pytest.mark.parametrize("v,expected", [(0.125, 0.12), (0.135, 0.14)])
def test_half_even_rounding(spark, v, expected):
    assert one(spark.range(1).select(rnd(F.lit(v), 2)))[0] == expected


def test_demand_per_available_acre(spark):
    demand = spark.createDataFrame(
        [("Maharashtra", 454589.0), ("Karnataka", 312828.0), ("Puducherry", 2429.0), ("Andaman and Nicobar", 0.0), ("Gujarat", -277616.0)],
        "state string, pending double",
    )
    stock = spark.createDataFrame(
        [("Maharashtra", 48579.0), ("Karnataka", 13600.0), ("Puducherry", 0.0), ("Andaman and Nicobar", 21.0), ("Gujarat", 31148.0)],
        "state string, acres double",
    )
    got = {r.state: (None if r.demand_per_stock is None else round(r.demand_per_stock, 1))
           for r in joins.match_supply(demand, stock, "state", "pending", "acres").collect()}
    assert got == {"Maharashtra": 9.4, "Karnataka": 23.0, "Puducherry": None, "Andaman and Nicobar": None, "Gujarat": None}


def test_supply_verdicts(spark):
    from ledgerlens.functions.scalars import supply_verdict

    rows_ = [
        ("Maharashtra", 454589.0, 48579.0, "READY"), ("Karnataka", 312828.0, 13600.0, "READY"),
        ("Tamil Nadu", 51463.0, 40740.0, "READY"), ("Telangana", 65501.0, 2334.0, "CONSTRAINED"),
        ("Madhya Pradesh", 57617.0, 4985.0, "CONSTRAINED"), ("Odisha (before correction)", 232433.0, 5162.0, "CONSTRAINED"),
        ("Rajasthan", 40076.0, 28518.0, "LAND-RICH"), ("Haryana", 30823.0, 20491.0, "LAND-RICH"),
        ("Andhra Pradesh", 23909.0, 32872.0, "LAND-RICH"), ("Gujarat", -277616.0, 31148.0, "UNDER-UTILISED"),
        ("West Bengal", 46308.0, 149.0, "balanced/low"), ("Delhi", 31420.0, 2410.0, "balanced/low"),
    ]
    df = spark.createDataFrame(rows_, "s string, d double, st double, want string")
    bad = df.where(supply_verdict(F.col("d"), F.col("st")) != F.col("want")).collect()
    assert bad == []


IMPL_TOP15 = [
    ("Gujarat", 660254), ("Odisha", 336487), ("Maharashtra", 237988), ("Andhra Pradesh", 140445), ("Uttar Pradesh", 73954),
    ("Rajasthan", 71373), ("Madhya Pradesh", 64828), ("Punjab", 57293), ("Tamil Nadu", 44627), ("Chhattisgarh", 43550),
    ("Karnataka", 42463), ("Haryana", 25832), ("Telangana", 25134), ("Assam", 22620), ("West Bengal", 22485),
]


def test_shares_on_a_national_base(spark):
    df = spark.createDataFrame(IMPL_TOP15, "state string, v long")
    sh = {r.state: round(r.share_pct, 1) for r in aggs.share_of_total(df, "v", base_total=1951828).collect()}
    assert sh["Gujarat"] == 33.8 and sh["Karnataka"] == 2.2 and sh["West Bengal"] == 1.2
    cs = {r.pos: round(r.cum_share_pct, 1) for r in windows.cum_share(df, "v", ["state"], base_total=1951828).collect()}
    assert cs[3] == 63.3


def test_one_year_spikes(spark):
    years = ["2021", "2022", "2023", "2024", "2025"]
    data = {"Assam": [452, 633, 18778, 1528, 1229], "Punjab": [5627, 4466, 32182, 7144, 7874], "Gujarat": [104968, 39259, 61407, 208025, 246595]}
    df = spark.createDataFrame([(s, y, float(v)) for s, vs in data.items() for y, v in zip(years, vs)], "s string, y string, v double")
    got = {r.s: (round(r.max_share_pct), r.spike) for r in windows.flag_spikes(df, "s", "v", spike_share=50.0).collect()}
    assert got == {"Assam": (83, True), "Punjab": (56, True), "Gujarat": (37, False)}


DISBURSAL = [
    ("Electronics", 11324, 15554.0), ("Pharmaceuticals", 15000, 5433.0), ("Bulk Drugs", 6940, 54.81), ("Medical Devices", 3420, 157.15),
    ("Food Processing", 10900, 1084.0), ("Telecom", 12195, 1175.0), ("White Goods", 6238, 281.4), ("Solar PV", 24000, 0.0),
    ("Drones", 120, 30.0), ("Automobile", 25938, 2377.56), ("Specialty Steel", 6322, 48.0), ("Textiles", 10683, 54.5),
    ("ACC Battery", 18100, 0.0),
]


def test_delivery_pct_with_total_and_true_zeros(spark):
    df = spark.createDataFrame(DISBURSAL, "scheme string, outlay long, disbursed double")
    long_form = df.select("scheme", F.lit("outlay").alias("part"), F.col("outlay").cast("double").alias("v")).unionByName(
        df.select("scheme", F.lit("disbursed").alias("part"), F.col("disbursed").alias("v"))
    )
    # delivered share of committed: delivered rows are 'disbursed', committed rows are 'outlay'
    per = df.rollup("scheme").agg(
        F.sum("disbursed").alias("d"), F.sum("outlay").alias("o"), F.grouping_id().alias("gid")
    ).withColumn("pct", F.col("d") / F.col("o") * 100)
    got = {(r.scheme or "TOTAL"): round(r.pct, 1) for r in per.collect()}
    assert got["Electronics"] == 137.4 and got["Pharmaceuticals"] == 36.2 and got["Automobile"] == 9.2
    assert got["Solar PV"] == 0.0 and got["ACC Battery"] == 0.0  # zero disbursed is zero, not missing
    assert got["TOTAL"] == 17.4
    out = aggs.delivery_pct(long_form.withColumn("committed", F.when(F.col("part") == "outlay", F.col("v"))), "scheme",
                            F.lit(False), "committed")
    assert out.where("gid = 1").first().committed == 151180.0


def test_latest_cumulative_supersedes(spark):
    vint = spark.createDataFrame(
        [("all", "2024-11-30", 14020.0), ("all", "2025-06-30", None), ("all", "2025-12-31", 28748.0)], "k string, as_of string, disbursed double"
    )
    latest = windows.supersede(vint, "k", "as_of").first()
    assert (latest.as_of, latest.disbursed) == ("2025-12-31", 28748.0)  # never 14020 + 28748
    filled = windows.latest_per_key(vint, "k", ["as_of"], latest_non_null=["disbursed"]).first()
    assert filled.disbursed == 28748.0
