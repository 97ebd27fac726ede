"""Queries on runs and spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from massloom.catalog.registry import query, rounded
from massloom.operators import runs
from massloom.session import scratch_dir
from massloom.sources import sinks
from massloom.sources.tables import sample_spectra

STRINGS = [
    ("FTMS + p NSI Full ms [350.00-1600.00]", "HR", 1, "MS1", "??", None),
    ("ITMS + c NSI d Full ms2 501.10@cid35.00 [110.00-1010.00]", "LR", 2, "LR_IT_CID", "LR IT CID", None),
    ("ASTMS + p NSI d Full ms2 501.10@hcd30.00 [100.00-1500.00]", "HR", 2, "HR_HCD", "HR HCD", None),
    ("FTMS + p NSI d sa Full ms2 501.10@etd53.00@hcd20.00 [100.00-1500.00]", "HR", 2, "HR_EThcD", "HR EThcD", None),
    ("ITMS + p NSI d sa Full ms2 501.10@etd53.00@cid20.00 [100.00-1500.00]", "LR", 2, "LR_ETciD", "LR ETciD", None),
    ("TOFMS + p Full ms2 501.10@hcd30.00 [100.00-1500.00]", None, 2, None, None, "UnrecognizedDetector"),
    ("FTMS + p NSI d Full ms2 501.10@pqd30.00 [100.00-1500.00]", "HR", 2, None, None, "UnrecognizedFragmentation"),
    ("FTMS + p NSI d Full msx 501.10@hcd30.00 [100.00-1500.00]", "HR", None, None, None, "UnrecognizedMSLevel"),
    ("FTMS + p NSI d Full ms2 501.10 [100.00-1500.00]", "HR", 2, None, None, "CantParseFilterStr"),
    ("FTMS + c NSI d Full ms3 501.10@cid35.00 300.10@hcd55.00 [100.00-500.00]", "HR", 3, None, "??", None),
]


def _lit(v):
    return "null" if v is None else (str(v) if isinstance(v, int) else f"'{v}'")


def _case(i: int) -> str:
    return " ".join(f"when {k} then {_lit(row[i])}" for k, row in enumerate(STRINGS))


@query(f"""select filename, case spectrum_id % 10 {_case(1)} end as accuracy, cast(case spectrum_id % 10 {_case(2)} end as varchar) as ms_level,
  case spectrum_id % 10 {_case(3)} end as frag_type, case spectrum_id % 10 {_case(4)} end as frag_tag,
  case spectrum_id % 10 {_case(5)} end as error_code, count(*) as n from {{f_spectrum}} group by all""")
def p19_parse_filter_string(t):
    rows = t.sql(f"select filename, case spectrum_id % 10 {_case(0)} end as filter_string from {{f_spectrum}}")
    columns = ["accuracy", "ms_level", "frag_type", "frag_tag", "error_code"]
    return runs.with_filter_facts(rows).select("filename", *[f"f.{c}" for c in columns]).withColumn("ms_level", F.col("ms_level").cast("string")).groupBy(
        "filename", *columns).agg(F.count("*").alias("n"))


@query("""with w as (select filename, max(case when ms_level = 2 and spectrum_id % 20 <> 11 then iso_lower + iso_upper end) as largest_width
  from {f_spectrum} group by filename)
select filename, round(cast(largest_width as double), 6) as largest_width, case when largest_width is null then 'unknown' when largest_width <= 3.0 then 'DDA'
  when largest_width >= 15.0 then 'DIA' else 'ambiguous' end as acquisition_type from w""")
def p29_acquisition_type(t):
    rows = t("f_spectrum").withColumn("ms_level", F.when(F.col("spectrum_id") % 20 == 11, 1).otherwise(F.col("ms_level")))
    return rounded(runs.acquisition_type(rows), 6, "largest_width")


STATS = """select spectrum_id, filename, concat('PXD', cast(length(filename) as string)) as pxd, ms_level, filter_string, charge,
  iso_lower, iso_upper, precursor_mz, coalesce(n, 0) as n_peaks
from {f_spectrum} s left join (select l_orderkey, count(*) as n from {lineitem} group by l_orderkey) p on p.l_orderkey = s.spectrum_id"""


@query("""with s as (""" + STATS + """)
select pxd, filename, count(*) as n_spectra, count(*) filter (where ms_level = 1) as n_ms1_spectra,
  count(*) filter (where ms_level = 2) as n_ms2_spectra, count(*) filter (where ms_level = 2 and n_peaks = 0) as n_length_zero_spectra,
  count(*) filter (where ms_level = 2 and n_peaks < 10) as n_length_lt10_spectra,
  count(*) filter (where filter_string like '%@hcd%') as n_hr_hcd_spectra, count(*) filter (where filter_string like '%@cid%') as n_lr_it_cid_spectra,
  'true' as high_accuracy_precursors,
  case when count(*) filter (where filter_string like '%@hcd%') > 0 and count(*) filter (where filter_string like '%@cid%') > 0 then 'multiple'
    when count(*) filter (where filter_string like '%@hcd%') > 0 then 'HR_HCD' else 'LR_IT_CID' end as fragmentation_type
from s group by rollup(pxd, filename)""")
def a10_spectrum_stats(t):
    return runs.spectrum_stats(t.sql(STATS)).select(
        "pxd", "filename", "n_spectra", "n_ms1_spectra", "n_ms2_spectra", "n_length_zero_spectra", "n_length_lt10_spectra",
        "n_hr_hcd_spectra", "n_lr_it_cid_spectra", "high_accuracy_precursors", "fragmentation_type")


@query("""select filename, case when spectrum_id % 7 = 0 then 'unknown' else cast(charge as varchar) end as charge, count(*) as n_precursors
from {f_spectrum} where ms_level = 2 group by 1, 2""")
def a11_charge_hist(t):
    return runs.charge_hist(t.sql("""select filename, ms_level, case when spectrum_id % 7 = 0 then null else charge end as charge from {f_spectrum}"""))


@query("""select filename, cast(iso_lower + iso_upper as double) as full_width, count(*) as n_spectra from {f_spectrum} where ms_level = 2 group by 1, 2""")
def a11_isolation_hist(t):
    out = runs.isolation_hist(t("f_spectrum"))
    return out.withColumn("full_width", F.col("full_width").cast("double"))


COMPOSITE = """per as (select s.filename, case when s.filter_string like '%@hcd%' then 'HR_HCD' else 'LR_IT_CID' end as frag_type, s.spectrum_id,
    cast(floor((p.mz - 100.0::double) / (case when s.filter_string like '%@hcd%' then 0.0002::double else 0.05::double end)) as bigint) as bin, max(p.intensity) as i
  from {f_spectrum} s join {f_peak} p on p.spectrum_id = s.spectrum_id
  where s.ms_level = 2 and p.mz > 100 and p.mz < case when s.filter_string like '%@hcd%' then 400 else 460 end group by 1, 2, 3, 4),
comp as (select filename, frag_type, bin, count(*) as n_peaks, sum(i) as intensity from per group by 1, 2, 3)"""


def arrays(t):
    """Spectra with their peaks as arrays; an order has a handful of lines."""
    return t.sql("""select s.*, p.mz, p.intensity from {f_spectrum} s join (
      select spectrum_id, collect_list(mz) as mz, collect_list(intensity) as intensity from {f_peak}
      group by spectrum_id) p on p.spectrum_id = s.spectrum_id""").drop("p.spectrum_id")


@query(f"with {COMPOSITE} select * from comp")
def a12_composite(t):
    return runs.composite(arrays(t))


@query(f"with {COMPOSITE} select * from comp")
def a12_composite_from_peaks(t):
    return runs.composite_from_peaks(t("f_spectrum"), t("f_peak"))


# expected bins of each region: a hundredth of an m/z unit around the reporter at high resolution, one unit at low
REGIONS = """(select frag_type, region, label, cast(trunc((mz - width / 2 - 100) / step) as bigint) as first_bin, cast(trunc((mz + width / 2 - 100) / step) as bigint) as last_bin from (
  select 'HR_HCD' as frag_type, 0.01::double as width, 0.0002::double as step, * from (values
    ('TMT6_126', 'TMT', 126.127725::double), ('TMT6_127', 'TMT', 127.124760::double), ('TMT6_128', 'TMT', 128.134433::double), ('TMT6_129', 'TMT', 129.131468::double),
    ('TMT6_130', 'TMT', 130.141141::double), ('TMT6_131', 'TMT', 131.138176::double), ('TMT6plex', 'TMT', 230.1702::double), ('TMTpro', 'TMTpro', 305.2144::double),
    ('TMTpro+H2O', 'TMTpro', 323.22499::double), ('iTRAQ_114', 'iTRAQ', 114.11068::double), ('iTRAQ_115', 'iTRAQ', 115.107715::double), ('iTRAQ_116', 'iTRAQ', 116.111069::double),
    ('iTRAQ_117', 'iTRAQ', 117.114424::double), ('iTRAQ4_nterm', 'iTRAQ4', 145.109::double), ('iTRAQ8_118', 'iTRAQ8', 118.111459::double), ('iTRAQ8_119', 'iTRAQ8', 119.114814::double),
    ('iTRAQ8_121', 'iTRAQ8', 121.121524::double), ('iTRAQ8_113', 'iTRAQ8', 113.107325::double)) as h(region, label, mz)
  union all select 'LR_IT_CID', 1.0::double, 0.05::double, * from (values ('TMT6plex', 'TMT', 230.1702::double), ('TMT6_y1K', 'TMT', 376.2757::double), ('iTRAQ4_y1K', 'iTRAQ4', 376.2757::double),
    ('iTRAQ8_y1K', 'iTRAQ8', 451.3118::double)) as l(region, label, mz))) as v"""


PEAKS = f"""{COMPOSITE},
modes as (select c.filename, c.frag_type, v.region, v.label, first(c.bin order by c.intensity desc, c.bin) as mode_bin
  from comp c join {REGIONS} on v.frag_type = c.frag_type and c.bin >= v.first_bin and c.bin < v.last_bin
  where c.intensity > 0 group by 1, 2, 3, 4),
rings as (select m.*, d.d, coalesce(sum(c.n_peaks), 0) as n, coalesce(sum(c.intensity), 0) as i
  from modes m cross join (select unnest(range(0, 17)) as d) d left join comp c on c.filename = m.filename and c.frag_type = m.frag_type
    and abs(c.bin - m.mode_bin) = d.d group by all),
cum as (select *, sum(n) over w as cn, sum(i) over w as ci from rings
  window w as (partition by filename, frag_type, region, label, mode_bin order by d)),
gain as (select *, lag(cn) over (partition by filename, frag_type, region, label, mode_bin order by d) as pn from cum),
stops as (select * from gain where d > 0 and (cn < 1.02 * pn or d = 16)),
peaks as (select filename, frag_type, region, label, mode_bin, min(d) as extent, cast(first(cn order by d) as bigint) as n_spectra,
  first(ci order by d) as intensity, first(cn order by d) > 100 as is_found from stops group by 1, 2, 3, 4, 5)"""


@query(f"with {PEAKS} select * from peaks")
def a13_w12_reporter_peaks(t):
    return runs.reporter_peaks(runs.composite_from_peaks(t("f_spectrum"), t("f_peak")))


# a weighted parabola through the logarithms, by its normal equations
FITS = f"""{PEAKS},
pts as (select p.filename, p.frag_type, p.region, p.mode_bin, p.x, c.intensity as w from (select *, unnest(range(-2 * extent, 2 * extent)) as x from peaks where is_found) p
  join comp c on c.filename = p.filename and c.frag_type = p.frag_type and c.bin = p.mode_bin + p.x where c.intensity > 0),
mom as (select filename, frag_type, region, mode_bin, sum(w) as s0, sum(w * x) as s1, sum(w * x * x) as s2, sum(w * x * x * x) as s3, sum(w * x * x * x * x) as s4,
  sum(w * ln(w)) as t0, sum(w * x * ln(w)) as t1, sum(w * x * x * ln(w)) as t2 from pts group by 1, 2, 3, 4),
sol as (select *, nullif(s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2), 0) as det,
  t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2) as da, s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2) as db,
  s0 * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2) as dc from mom),
fits as (select filename, frag_type, region, mode_bin, da / det as a, db / det as b, dc / det as c, case when frag_type = 'HR_HCD' then 0.0002::double else 0.05::double end as width from sol)"""


@query(f"""with {FITS}, pk as (select p.* exclude (is_found), p.is_found and coalesce(f.c < 0, false) as is_found from peaks p
  left join fits f on f.filename = p.filename and f.frag_type = p.frag_type and f.region = p.region),
ms2 as (select filename, count(*) as n_ms2_spectra from {{f_spectrum}} where ms_level = 2 group by 1),
sc as (select filename, frag_type,
  sum(case when label = 'TMT' and is_found then n_spectra / n_ms2_spectra else 0 end) as tmt,
  sum(case when label = 'TMTpro' and is_found then n_spectra / n_ms2_spectra else 0 end) as tmtpro,
  sum(case when label = 'iTRAQ' and is_found then n_spectra / n_ms2_spectra else 0 end) as itraq,
  sum(case when label = 'iTRAQ4' and is_found then n_spectra / n_ms2_spectra else 0 end) as itraq4,
  sum(case when label = 'iTRAQ8' and is_found then n_spectra / n_ms2_spectra else 0 end) as itraq8
  from pk join ms2 using (filename) group by 1, 2)
select filename, frag_type, round(tmt, 6) as tmt, round(tmtpro, 6) as tmtpro, round(itraq, 6) as itraq, round(itraq4, 6) as itraq4, round(itraq8, 6) as itraq8,
  case when tmt > itraq then case when tmt > 2 then case when tmtpro > 0.7 then 'TMTpro' else 'TMT' end when tmt < 1 then 'none' else 'ambiguous' end
  when itraq > 1 then case when itraq4 > itraq8 then 'iTRAQ4' else 'iTRAQ8' end when itraq < 0.5 then 'none' else 'ambiguous' end as call from sc""")
def a13_label_calls(t):
    ms2 = t("f_spectrum").where("ms_level = 2").groupBy("filename").agg(F.count("*").alias("n_ms2_spectra"))
    comp = runs.composite_from_peaks(t("f_spectrum"), t("f_peak"))
    peaks = runs.fitted_peaks(comp, runs.reporter_peaks(comp))
    return rounded(runs.label_calls(peaks, ms2), 6, "tmt", "tmtpro", "itraq", "itraq4", "itraq8")


@query(f"""with {FITS} select filename, frag_type, region, mode_bin, case when c < 0 then round(100 + (mode_bin - b / (2 * c)) * width, 6) end as fit_mz,
  case when c < 0 then round(sqrt(-1 / (2 * c)) * width, 7) end as sigma, case when c < 0 then round(exp(a - b * b / (4 * c)), 2) end as height from fits""")
def x04_fit_peak(t):
    comp = runs.composite(arrays(t))
    fits = runs.fit_peak(comp, runs.reporter_peaks(comp))
    return rounded(rounded(rounded(fits, 6, "fit_mz"), 7, "sigma"), 2, "height")


@query()
def x04_fit_peak_linear(t):
    comp = runs.composite(arrays(t))
    fits = runs.fit_peak_linear(comp, runs.reporter_peaks(comp))
    return rounded(rounded(rounded(fits, 6, "fit_mz"), 7, "sigma"), 2, "height")


CV = """select filename, ord, accession from (select concat('run_', cast(o_custkey % 60 as string)) as filename, o_orderkey as ord,
  case o_custkey % 60 % 6 when 0 then 'MS:1000551' when 1 then case when o_orderkey % 2 = 0 then 'MS:1000562' else 'MS:1000566' end
    when 2 then case when o_orderkey % 3 = 0 then 'MS:1002523' else 'MS:1000551' end when 3 then 'MS:1000566'
    when 4 then case when o_orderkey % 3 = 0 then 'MS:1001911' else 'MS:1002416' end else 'MS:9999999' end as accession from {orders}) x"""


# what is expected of each accession that occurs: name, category, and the rank of those that only stand in
EXPECTED_MODELS = """(values ('MS:1001911', 'Q Exactive', 'pureHCD', 1), ('MS:1002523', 'Q Exactive HF', 'pureHCD', 1), ('MS:1002416', 'Orbitrap Fusion', 'variable', 1),
  ('MS:1000562', 'SCIEX instrument model', 'QTOF', 2), ('MS:1000551', 'SCIEX instrument model', 'QTOF', 3),
  ('MS:1000566', 'Conversion to mzML from mzXML from unknown instrument', 'unknown', 5)) as v(accession, name, category, rank)"""


@query(f"""with cv as ({CV}), r as (select cv.filename, v.*, row_number() over (partition by cv.filename order by v.rank nulls last,
  case when v.rank = 1 then -cv.ord else cv.ord end) as rn from cv left join {EXPECTED_MODELS} on v.accession = cv.accession)
select filename, accession, coalesce(name, 'unknown') as name, coalesce(category, 'unknown') as category from r where rn = 1""")
def p18_instrument(t):
    return runs.instrument(t.sql(CV))


RUNS = """select concat('PXD', cast(100000 + o_custkey as string)) as pxd, o_orderkey as ord,
  case o_orderkey % 5 when 0 then 'unknown' when 1 then 'Q Exactive' else 'Orbitrap Fusion' end as instrument,
  case when o_custkey % 3 = 0 then 'HR_HCD' when o_orderkey % 4 = 0 then 'LR_IT_CID' else 'HR_HCD' end as fragmentation_type,
  case when o_custkey % 4 = 0 then 'false' else 'true' end as high_accuracy_precursors,
  case o_orderkey % 6 when 0 then 'ambiguous' when 1 then 'TMT' else 'none' end as labeling,
  case when o_orderkey % 3 = 0 then 'unknown' else 'DDA' end as acquisition_type,
  case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 100 as double) / 100 end as max_label_score,
  case when o_orderkey % 3 = 0 then 0 else 5 end as n_label_scores from {orders}"""


@query(f"""with r as ({RUNS}), c as (select pxd, count(*) as n_runs,
  min(nullif(instrument, 'unknown')) as i0, max(nullif(instrument, 'unknown')) as i1, min(fragmentation_type) as f0, max(fragmentation_type) as f1,
  min(high_accuracy_precursors) as high_accuracy_precursors, min(nullif(labeling, 'ambiguous')) as l0, max(nullif(labeling, 'ambiguous')) as l1,
  max(nullif(acquisition_type, 'unknown')) as a, count(*) filter (where instrument = 'unknown') as ni from r group by pxd)
select pxd, n_runs, case when i0 is null then 'unknown' when i0 = i1 then i0 else 'multiple' end as instrument,
  case when f0 = f1 then f0 else 'multiple' end as fragmentation_type, high_accuracy_precursors,
  case when l0 is null then 'unknown' when l0 = l1 then l0 else 'multiple' end as labeling, coalesce(a, 'unknown') as acquisition_type,
  concat_ws(';', case when i0 <> i1 then 'MultipleInstruments' end, case when f0 <> f1 then 'MultipleFragTypes' end,
    case when l0 <> l1 then 'MultipleLabelingTypes' end, case when ni > 0 then 'MissingInstrument' end) as problems from c""")
def a09_study_consensus(t):
    return runs.study_consensus(t.sql(RUNS))


@query(f"""with r as ({RUNS}), f as (select pxd, first(acquisition_type order by ord) as acquisition_type, first(fragmentation_type order by ord) as fragmentation_type,
    first(high_accuracy_precursors order by ord) as high_accuracy_precursors, first(labeling order by ord) as raw,
    first(max_label_score order by ord) as s, first(n_label_scores order by ord) as n from r group by pxd),
p as (select accession as pxd from {{f_project}})
select coalesce(p.pxd, f.pxd) as pxd, case when f.pxd is null then 'DIA' else f.acquisition_type end as acquisition_type,
  coalesce(f.fragmentation_type, 'HR_HCD') as fragmentation_type, coalesce(f.high_accuracy_precursors, 'true') as high_accuracy_precursors,
  case when coalesce(f.raw, 'LFQ') = 'none' then 'LFQ' else coalesce(f.raw, 'LFQ') end as labeling, coalesce(f.raw, 'LFQ') as raw_labeling,
  f.pxd is null as dia, case when coalesce(n, 0) = 0 then 0.0 when raw in ('none', 'LFQ') then 1 - s else s end as confidence
from p full join f on p.pxd = f.pxd""")
def p34_p35_detected_params(t):
    criteria = t.sql("""select accession as pxd, 'DIA' as acquisition_type, cast(null as string) as fragmentation_type,
      cast(null as string) as high_accuracy_precursors, cast(null as string) as labeling from {f_project}""")
    return runs.detected_params(t.sql(RUNS), criteria)


@query("""with e as (select vec_id, generate_subscripts(embedding, 1) as pos, unnest(embedding)::double as x from embeddings),
k as (select vec_id, 100 + pos * 10.0 as mz, abs(x) as i from e where abs(x) > 0 and abs(100 + pos * 10.0 - 500) > 2),
r as (select *, sqrt(i) as s, max(sqrt(i)) over (partition by vec_id) as base from k),
o as (select *, row_number() over (partition by vec_id order by s desc, mz) as rn from r where s >= base * 0.3::double),
t as (select * from o where rn <= 40), g as (select vec_id, count(*) as n, sqrt(sum(s * s)) as norm from t group by 1 having count(*) >= 20)
select t.vec_id, g.n as n_peaks, round(max(s / norm), 6) as top, round(min(s / norm), 6) as low, round(sum(mz * s / norm), 4) as weighted
from t join g on g.vec_id = t.vec_id group by 1, 2""")
def f05_clean_spectra(t):
    rows = t.table("embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x, i: 100 + (i + 1) * F.lit(10.0)).alias("mz"),
        F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("intensity"),
        F.lit(500.0).alias("precursor_mz"), F.lit(2).alias("charge"))
    out = runs.clean_spectra(rows, min_intensity=0.3, max_peaks=40)
    total = F.aggregate("peaks", F.lit(0.0), lambda acc, p: acc + p["mz"] * p["intensity"])
    weights = F.transform("peaks", lambda p: p["intensity"])
    return rounded(out.select("vec_id", F.size("peaks").cast("bigint").alias("n_peaks"), F.array_max(weights).alias("top"),
                              F.array_min(weights).alias("low"), F.round(total, 4).alias("weighted")), 6, "top", "low")


@query("""with m as (select case when spectrum_id % 11 = 0 then 'run_mixed.mzML' else filename end as filename, spectrum_id,
  case when filter_string like '%@hcd%' then 'HR HCD' else 'LR IT CID' end as frag_tag from {f_spectrum} where ms_level = 2),
t as (select filename, min(frag_tag) as lo, max(frag_tag) as hi from m group by 1)
select filename, '*' as scan, lo as frag_tag from t where lo = hi
union all select m.filename, cast(m.spectrum_id as varchar), m.frag_tag from m join t on t.filename = m.filename and lo <> hi""")
def k05_fragmentation_types(t):
    rows = t("f_spectrum").withColumn("filename", F.when(F.col("spectrum_id") % 11 == 0, "run_mixed.mzML").otherwise(F.col("filename")))
    path = scratch_dir(t.spark, "fragmentation")
    sinks.write_fragmentation_types(runs.fragmentation_types(rows), path)
    cells = F.split("value", "\t")
    return t.spark.read.text(path).select("filename", cells[0].alias("scan"), cells[1].alias("frag_tag"))


@query("""select filename, spectrum_id from (select filename, spectrum_id, row_number() over (partition by filename order by spectrum_id) as rn
from {f_spectrum} where ms_level = 2 and spectrum_id in (select spectrum_id from {f_peak})) where rn <= 20""")
def s19_sample_spectra(t):
    return sample_spectra(arrays(t).select("filename", "spectrum_id", "ms_level", "mz", "intensity"), 20).select("filename", "spectrum_id")
