from pyspark.sql import functions as F

from massloom.operators import mods, psm as ops, ranking, ranges


def test_best_psm_is_one_row_per_spectrum_and_ignores_partitioning(spark):
    rows = [("f", f"s{i % 50}", float(i * 7 % 13) if i % 9 else None, f"P{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "filename string, scannr string, hyperscore double, peptide string")
    a = sorted(map(tuple, ops.best_psm(df).collect()))
    b = sorted(map(tuple, ops.best_psm(df.repartition(7, "peptide")).collect()))
    assert a == b and len(a) == 50


def test_numbered_is_exact_with_a_hot_group(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 100)).alias("g"),
        F.xxhash64("id").alias("v"),
    ).repartition(6)
    got = ranking.numbered(df, ["g"], ["v"], "n")
    want = df.selectExpr("g", "v", "row_number() over (partition by g order by v) as n")
    assert got.exceptAll(want).isEmpty() and got.count() == 9000


def test_numbered_without_groups(spark):
    got = ranking.numbered(spark.range(100).repartition(5), [], ["id"], "n").collect()
    assert all(r.n == r.id + 1 for r in got)


def test_rt_seconds_follows_the_median(spark):
    def flag(values):
        df = spark.createDataFrame([(float(v),) for v in values], "rt double")
        return ops.rt_seconds(df).agg(F.max("rt_sec")).first()[0] == max(values)

    assert flag([1, 400, 500]) and not flag([1, 2, 500])
    assert flag([1, 200, 500, 600]) and not flag([1, 100, 310, 600])  # medians 350 and 205
    assert ops.rt_seconds(spark.createDataFrame([(2.0,)], "rt double"), unit="min").first().rt_sec == 120.0


def test_interval_join_meets_each_pair_once(spark):
    pts = spark.range(200).select((F.col("id") / 10).alias("x"))
    iv = spark.createDataFrame([(1.0, 1.5), (-0.3, 0.2), (5.0, 9.75)], "lo double, hi double")
    got = ranges.interval_join(pts, F.col("x"), iv, F.col("lo"), F.col("hi"), 0.4)
    want = pts.join(iv, F.col("x").between(F.col("lo"), F.col("hi")))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


UNIMOD = [
    (1, "Acetyl", 42.010565, "Any N-term", "N-term", False), (1, "Acetyl", 42.010565, "Anywhere", "K", False),
    (21, "Phospho", 79.966331, "Anywhere", "S", False), (35, "Oxidation", 15.994915, "Anywhere", "M", False),
    (35, "Oxidation", 15.994915, "Anywhere", "P", True),
]


def unimod(spark):
    return spark.createDataFrame(UNIMOD, "unimod_id int, mod_name string, mono_mass double, position string, site string, hidden boolean")


def test_site_fractions_by_hand(spark):
    psm = spark.createDataFrame(
        [("[+42.010565]AMK",), ("AM[+15.9949]K",), ("AM(UniMod:35)K",), ("AMK",), ("SSP[+500.0]",), ("MM[+15.99]K",)], "peptide string")
    got = {r.mod_key: r for r in mods.site_fractions(psm, unimod(spark)).collect()}
    # unique peptides AMK, SSP, MMK; letters A1 M3 K2 S2 P1
    assert got["unimod:1"].potential_sites == 2 + 3 and got["unimod:1"].modified_sites == 1
    assert got["unimod:35"].potential_sites == 3 + 1 and got["unimod:35"].modified_sites == 2
    assert got["unimod:35"].peptides_with_mod == 2 and got["unimod:35"].fraction_modified == 0.5
    assert got["mass:+500.00000"].allowed_residues == "P" and got["mass:+500.00000"].potential_sites == 1
    assert all(0 <= r.fraction_modified <= 1 for r in got.values())


def test_fractions_do_not_depend_on_partitions(spark):
    letters = "ACDEFGHIKLMNPQRSTVWY"
    rows = [("f%d" % (i % 2), "".join(letters[(i * k) % 20] for k in range(1, 9)) + ("[+15.994915]" if i % 3 else "")) for i in range(300)]
    df = spark.createDataFrame(rows, "filename string, peptide string")
    a, b = (sorted(map(str, mods.site_fractions(x, unimod(spark), ["filename"]).collect())) for x in (df, df.repartition(9, "peptide")))
    assert a == b and a


def test_resolve_spectrum_file(spark):
    names = spark.createDataFrame([("a.mzML",), ("b",), ("c.raw",), ("d",), ("x.mzML",)], "filename string")
    files = spark.createDataFrame([("a.mzML",), ("b.mzML",), ("bb.mzML",), ("c.raw.mzML",)], "file string")
    got = {r.filename: r.actual_file for r in ops.resolve_spectrum_file(names, files).collect()}
    assert got == {"a.mzML": "a.mzML", "b": "b.mzML", "c.raw": "c.raw.mzML", "d": "d", "x.mzML": "x.mzML"}


def test_numbered_cuts_large_groups_into_ranges(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 90)).alias("g"),
        F.when(F.col("id") % 7 > 0, F.xxhash64("id") % 50).alias("v"), F.concat(F.lit("t"), "id").alias("t"), F.col("id").alias("_key_of_another"),
    ).repartition(6)
    want = df.selectExpr("*", "cast(row_number() over (partition by g order by v, t) as bigint) as n")
    got = ranking.numbered(df, ["g"], ["v", "t"], "n", most=700)
    assert got.exceptAll(want).isEmpty() and got.count() == 20_000
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in text
    whole = ranking.numbered(df, [], [F.col("t")], "n", most=700)
    assert whole.exceptAll(df.selectExpr("*", "cast(row_number() over (order by t) as bigint) as n")).isEmpty()
    assert whole.columns == [*df.columns, "n"]
