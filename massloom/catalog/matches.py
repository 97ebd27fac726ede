"""Queries on peptide-spectrum matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from massloom.catalog.registry import query, rounded
from massloom.functions import mass as mz, text as tx
from massloom.operators import psm as ops, ranking, reports
from massloom.plans.match_report import best_match_report



@query("""
with best as (select * from (
  select filename, scannr, hyperscore, peptide, proteins, spectrum_q, row_number() over (
    partition by filename, scannr order by hyperscore desc nulls last, peptide, proteins, spectrum_q) as rn
  from {f_psm}) where rn = 1)
select filename, count(*) as num_psms, count(distinct peptide) as num_unique_peptides,
  cast(sum(len(string_split(proteins, ';'))) as bigint) as protein_mentions,
  count(*) filter (where spectrum_q < 0.01) as confident_psms,
  count(*) filter (where spectrum_q < 0.01) >= 10 as passed
from best group by filename""")
def best_match_summary(t):
    return best_match_report(t("f_psm"))


@query("""select filename, scannr, pep_key, ptm_class_id, stripped, peptide, proteins, charge, expmass, calcmass,
  hyperscore, rt, spectrum_q, ms2_intensity from (
  select *, row_number() over (partition by filename, scannr order by hyperscore desc nulls last, pep_key,
    ptm_class_id, stripped, peptide, proteins, charge, expmass, calcmass, rt, spectrum_q, ms2_intensity) as rn
  from {f_psm}) where rn = 1""")
def w01_best_psm(t):
    return ops.best_psm(t("f_psm"))


@query("""select count(*) as num_psms, count(distinct peptide) as num_unique_peptides,
  cast(sum(len(string_split(proteins, ';'))) as bigint) as protein_mentions from {f_psm}""")
def a06_search_summary(t):
    return ops.search_summary(t("f_psm"))


@query("""select filename, count(distinct protein) as proteins_distinct from (
  select filename, unnest(string_split(proteins, ';')) as protein from {f_psm}) group by filename""")
def a06_distinct_proteins(t):
    return ops.distinct_proteins(t("f_psm"), ["filename"])


# whether the estimates of each charge's runs, united from stored sketches, are within four standard errors
@query("""select charge, count(*) as num_psms, true as peptides_fit, true as proteins_fit from {f_psm} group by charge""")
def a06_united_sketches(t):
    psm = t("f_psm")
    got = ops.united_sketches(ops.run_sketches(psm, ["filename", "charge"]), ["charge"])
    exact = ops.search_summary(psm, ["charge"]).drop("num_psms").join(ops.distinct_proteins(psm, ["charge"]), "charge")
    fits = lambda estimate, n: F.abs(F.col(estimate) - F.col(n)) <= F.col(n) * (4 * 0.8 / 64) + 1
    return got.join(exact, "charge").select(
        "charge", "num_psms", fits("unique_peptides", "num_unique_peptides").alias("peptides_fit"),
        fits("distinct_proteins", "proteins_distinct").alias("proteins_fit"))


@query("""select filename, count(*) as num_psms, count(distinct peptide) as num_unique_peptides
from {f_psm} group by filename""")
def a07_per_file_stats(t):
    return ops.per_file_stats(t("f_psm"))


@query("""select filename, round(avg(spectrum_q), 8) as mean_q, count(*) as total_psms,
  count(*) filter (where spectrum_q < 0.01) as confident_psms from {f_psm} group by filename""")
def a31_quality_stats(t):
    return rounded(ops.quality_stats(t("f_psm")), 8, "mean_q")


@query("""select filename, count(*) as total_psms, count(*) filter (where spectrum_q < 0.01) as confident_psms,
  count(*) filter (where spectrum_q < 0.01) > 1360 as passed from {f_psm} group by filename""")
def f02_quality_gate(t):
    return ops.quality_gate(t("f_psm"), q=0.01, n=1361).drop("mean_q")


@query("""select filename, count(*) as n from {f_psm} where filename in (
  select filename from {f_psm} group by filename having count(*) filter (where spectrum_q < 0.01) > 1360)
group by filename""")
def f02_passing_runs(t):
    return ops.passing(t("f_psm"), q=0.01, n=1361).groupBy("filename").agg(F.count("*").alias("n"))


@query("""select filename, scannr, hyperscore, peptide, expmass, row_number() over (
  partition by filename order by scannr, hyperscore, peptide, expmass) as psm_id from {f_psm}""")
def w06_psm_id(t):
    columns = ["scannr", "hyperscore", "peptide", "expmass"]
    return ops.with_psm_id(t("f_psm").select("filename", *columns), ["filename"], columns)


@query("""select scannr, cast(regexp_extract(scannr, 'scan=([0-9]+)', 1) as bigint) as scan, count(*) as n
from {f_psm} group by scannr""")
def p01_scan_number(t):
    return t("f_psm").groupBy("scannr").agg(F.count("*").alias("n")).select(
        "scannr", tx.scan_number(F.col("scannr")).alias("scan"), "n")


@query("""select peptide, regexp_replace(peptide, '\\[.*?\\]', '', 'g') as brackets,
  regexp_replace(peptide, '\\[.*?\\]', '', 'g') as denovo,
  regexp_replace(regexp_replace(peptide, '\\[[^\\]]*\\]', '', 'g'), '[^A-Z]', '', 'g') as letters, count(*) as n
from {f_psm} group by peptide""")
def p02_strip_mods(t):
    p = F.col("peptide")
    return t("f_psm").groupBy("peptide").agg(F.count("*").alias("n")).select(
        "peptide", *[tx.strip_mods(p, d).alias(d) for d in ("brackets", "denovo", "letters")], "n")


@query("""select aa_scores, round((cast(split_part(aa_scores, ',', 1) as double)
  + cast(split_part(aa_scores, ',', 2) as double)) / 2, 9) as aa_score_avg, count(*) as n
from {f_denovo} group by aa_scores""")
def p04_aa_score_avg(t):
    out = t("f_denovo").groupBy("aa_scores").agg(F.count("*").alias("n"))
    return rounded(out.withColumn("aa_score_avg", tx.aa_score_avg(F.col("aa_scores"))), 9, "aa_score_avg")


@query("""with s as (select sequence, charge,
    greatest(least(cast(split_part(aa_scores, ',', 1) as double), 1.0), 2.220446049250313e-16) as a,
    greatest(least(cast(split_part(aa_scores, ',', 2) as double), 1.0), 2.220446049250313e-16) as b
  from {f_denovo})
select sequence, charge, round(sum(exp(ln(a) + ln(b)) - case when charge = 2 then 0 else 1 end), 6) as score
from s group by sequence, charge""")
def p05_peptide_score(t):
    scores = F.transform(F.split("aa_scores", ","), lambda x: x.cast("double"))
    rows = t("f_denovo").select("sequence", "charge", mz.peptide_score(scores, F.col("charge") == 2).alias("s"))
    return rounded(rows.groupBy("sequence", "charge").agg(F.sum("s").alias("score")), 6, "score")


@query("""with m as (select filename, scannr, charge,
    (calcmass + charge * 1.007276466879) / charge as calc_mz, (expmass + charge * 1.007276466879) / charge as obs_mz
  from {f_psm}),
e as (select *, (calc_mz - (obs_mz - 0 * 1.00335 / charge)) / obs_mz * 1e6 as e0,
    (calc_mz - (obs_mz - 1 * 1.00335 / charge)) / obs_mz * 1e6 as e1 from m)
select filename, charge, round(min(e0), 6) as min_e0, round(max(e1), 6) as max_e1, round(min(calc_mz), 6) as min_mz,
  count(*) filter (where abs(e0) < 5 or abs(e1) < 5) as fits, count(*) as n from e group by filename, charge""")
def p06_p07_p09_mass_error(t):
    z = F.col("charge")
    rows = t("f_psm").select("filename", "charge", mz.mz(F.col("calcmass"), z).alias("calc_mz"),
                             mz.mz(F.col("expmass"), z).alias("obs_mz"))
    calc, obs = F.col("calc_mz"), F.col("obs_mz")
    out = rows.groupBy("filename", "charge").agg(
        F.min(mz.mass_error_ppm(calc, obs, z, 0)).alias("min_e0"),
        F.max(mz.mass_error_ppm(calc, obs, z, 1)).alias("max_e1"),
        F.min(calc).alias("min_mz"),
        F.count_if(mz.fits_precursor(calc, obs, z, 5.0)).alias("fits"),
        F.count("*").alias("n"),
    )
    return rounded(out, 6, "min_e0", "max_e1", "min_mz")


@query("""with k as (select median(rt) > 300 as sec from {f_psm}),
r as (select filename, median(rt * (1 + ptm_class_id * 4)) > 300 as sec from {f_psm} group by filename)
select p.filename, round(max(case when k.sec then rt else rt * 60 end), 6) as max_sec,
  round(min(case when k.sec then rt else rt * 60 end), 6) as min_sec,
  round(max(case when r.sec then rt * (1 + ptm_class_id * 4) else rt * (1 + ptm_class_id * 4) * 60 end), 6) as max_own
from {f_psm} p cross join k join r on p.filename = r.filename group by p.filename""")
def p08_rt_seconds(t):
    psm = t("f_psm")
    whole = ops.rt_seconds(psm).groupBy("filename").agg(F.max("rt_sec").alias("max_sec"), F.min("rt_sec").alias("min_sec"))
    own = psm.withColumn("rt", F.col("rt") * (1 + F.col("ptm_class_id") * 4))
    own = ops.rt_seconds(own, by=["filename"]).groupBy("filename").agg(F.max("rt_sec").alias("max_own"))
    return rounded(whole.join(own, "filename"), 6, "max_sec", "min_sec", "max_own")


@query("""with d as (select filename, peptide, expmass, calcmass, case
    when peptide like '%[+42%' then 42.010565 when peptide like '%[+15%' then 15.994915
    when peptide like '%[+79%' then 79.966331 else 0 end as moving from {f_psm})
select filename, round(min(expmass - calcmass), 6) as open_min, round(max(expmass - (calcmass - moving)), 6) as closed_max,
  round(max(expmass - (calcmass - case when moving > 70 then 0 else moving end)), 6) as static_max, count(*) as n
from d group by filename""")
def p10_delta_mass(t):
    psm = t("f_psm").select("filename", "peptide", "expmass", "calcmass")
    opened = ops.delta_mass(psm, "open").groupBy("filename").agg(
        F.min("delta_mass").alias("open_min"), F.count("*").alias("n"))
    closed = ops.delta_mass(psm).groupBy("filename").agg(F.max("delta_mass").alias("closed_max"))
    static = ops.delta_mass(psm, static=[79.966331]).groupBy("filename").agg(F.max("delta_mass").alias("static_max"))
    return rounded(opened.join(closed, "filename").join(static, "filename"), 6, "open_min", "closed_max", "static_max")


@query("""select regexp_replace(filename, '\\.mzML$', '') || '.' || regexp_extract(scannr, 'scan=([0-9]+)', 1) || '.'
  || regexp_extract(scannr, 'scan=([0-9]+)', 1) || '.' || cast(charge as varchar) as spectrum,
  min(split_part(proteins, ';', 1)) as protein, max(len(string_split(proteins, ';'))) as n_proteins, count(*) as n
from {f_psm} group by 1""")
def p11_p12_spectrum_title(t):
    proteins = F.col("proteins")
    return ops.spectrum_title(t("f_psm")).groupBy("spectrum").agg(
        F.min(tx.first_protein(proteins)).alias("protein"),
        F.max(tx.n_proteins(proteins)).cast("bigint").alias("n_proteins"), F.count("*").alias("n"))


PATHS = """select o_orderkey, concat('/data/', case when o_orderkey % 3 = 0 then 'CascadiaSequence' else 'CasanovoSequence' end,
  '/', case when o_orderkey % 5 = 0 then 'loose_' else concat('PXD', cast(100000 + o_custkey as string), '_') end,
  cast(o_orderkey as string), '_R1/Peptonizer2000_data/', cast(o_orderkey as string), '_filtered',
  cast(70 + o_orderkey % 20 as string), 'pct_slim/peptonizer_result.csv') as path from {orders}"""


@query("""select o_orderkey, 'peptonizer_result.csv' as name, 'peptonizer_result' as stem,
  (case when o_orderkey % 5 = 0 then 'loose_' else 'PXD' || (100000 + o_custkey) || '_' end) || o_orderkey || '_R1' as run_folder,
  case when o_orderkey % 5 = 0 then 'loose_' else '' end || o_orderkey || '_R1.raw' as raw_file,
  case when o_orderkey % 5 = 0 then null else 'PXD' || (100000 + o_custkey) end as pxd,
  70 + o_orderkey % 20 as threshold from {orders}""")
def p13_path_parts(t):
    return t.sql(PATHS).select("o_orderkey", tx.path_parts(F.col("path")).alias("p")).select(
        "o_orderkey", "p.name", "p.stem", "p.run_folder", "p.raw_file", "p.pxd", F.col("p.threshold").cast("bigint").alias("threshold"))


@query("""select o_orderkey, case o_orderkey % 4 when 3 then null else cast(o_custkey as varchar) end as taxid,
  o_orderkey % 4 <> 3 as valid from {orders}""")
def p14_taxid(t):
    raw = t.sql("""select o_orderkey, concat(case o_orderkey % 4 when 0 then 'NEWT:' when 1 then 'taxid:' when 2 then ''
      else 'none' end, case when o_orderkey % 4 = 3 then '' else cast(o_custkey as string) end) as accession from {orders}""")
    return raw.select("o_orderkey", tx.taxid(F.col("accession")).alias("taxid")).withColumn(
        "valid", tx.is_taxid(F.col("taxid")))


def dia_report(t):
    """The match view in the columns of a DIA report, masses written as reference ids."""
    return t.sql("""select filename as `Run`, replace(replace(replace(peptide, '[+42.010565]', '(UniMod:1)'),
        '[+15.994915]', '(UniMod:35)'), '[+79.966331]', '(UniMod:999)') as `Modified.Sequence`,
      proteins as `Protein.Ids`, charge as `Precursor.Charge`, rt as `RT`, spectrum_q as `Q.Value`,
      spectrum_q / 2 as `PG.Q.Value`, ms2_intensity as `Precursor.Quantity`, scannr as `Precursor.Id` from {f_psm}""")


def unimod(t):
    return t("f_unimod").withColumn("mono_mass", F.col("mono_mass").cast("double"))


@query("""select replace(peptide, '[+79.966331]', '(UniMod:999)') as peptide, count(*) as n
from {f_psm} group by 1""")
def p15_unimod_to_mass(t):
    rows = dia_report(t).select(F.col("`Modified.Sequence`").alias("peptide"))
    return ops.unimod_to_mass(rows, unimod(t)).groupBy("peptide").agg(F.count("*").alias("n"))


@query("""select filename as "File", charge as "Charge", stripped[1:1] as first_letter, 'DiaNN' as search_engine, count(*) as n
from {f_psm} group by 1, 2, 3""")
def p16_dia_legacy(t):
    legacy = t.sql("""select filename as `File.Name`, charge as `Precursor.Charge`, peptide as `Modified.Peptide` from {f_psm}""")
    out = ops.dia_tsv_to_psm(legacy)
    return out.groupBy("File", "Charge", F.substring("Peptide", 1, 1).alias("first_letter"), "search_engine").agg(
        F.count("*").alias("n"))


@query("""select filename, scannr as diann_precursor_id, replace(peptide, '[+79.966331]', '(UniMod:999)') as peptide,
  proteins, len(string_split(proteins, ';')) as num_proteins, charge, length(stripped) as peptide_len, rt,
  spectrum_q, spectrum_q as peptide_q, spectrum_q / 2 as protein_q, ms2_intensity, 'DiaNN' as search_engine,
  row_number() over (partition by filename order by scannr, replace(peptide, '[+79.966331]', '(UniMod:999)'), proteins, rt, ms2_intensity, charge, spectrum_q) as psm_id
from {f_psm}""")
def p17_dia_to_psm(t):
    order = ["diann_precursor_id", "peptide", "proteins", "rt", "ms2_intensity", "charge", "spectrum_q"]
    out = ops.dia_to_psm(dia_report(t), unimod(t), order=order)
    return out.select(
        "filename", "diann_precursor_id", "peptide", "proteins",
        F.col("num_proteins").cast("bigint").alias("num_proteins"), "charge",
        F.col("peptide_len").cast("bigint").alias("peptide_len"), "rt", "spectrum_q", "peptide_q", "protein_q",
        "ms2_intensity", "search_engine", "psm_id")


@query("""with n as (select distinct case o_orderkey % 3 when 0 then 'run_' || (o_custkey % 40) || '.mzML'
    when 1 then 'run_' || (o_custkey % 40) else 'run_' || (o_custkey % 40) || '.raw' end as filename, o_custkey % 40 as k, o_orderkey % 3 as m from {orders}),
f as (select distinct case when o_custkey % 40 < 10 then 'run_' || (o_custkey % 40) || '.mzML'
    when o_custkey % 40 < 20 then 'run_' || (o_custkey % 40) || '.raw.mzML' end as file from {orders} where o_custkey % 40 < 20)
select n.filename, coalesce(e.file, case when n.filename not like '%.mzML' then coalesce(a.file, p.file) end, n.filename) as actual_file
from n left join f e on e.file = n.filename left join f a on a.file = n.filename || '.mzML'
left join (select n.filename, min(f.file) as file from n join f on starts_with(f.file, n.filename) group by n.filename) p on p.filename = n.filename""")
def j20_resolve_spectrum_file(t):
    names = t.sql("""select distinct case o_orderkey % 3 when 0 then concat('run_', cast(o_custkey % 40 as string), '.mzML')
      when 1 then concat('run_', cast(o_custkey % 40 as string)) else concat('run_', cast(o_custkey % 40 as string), '.raw') end as filename from {orders}""")
    files = t.sql("""select distinct case when o_custkey % 40 < 10 then concat('run_', cast(o_custkey % 40 as string), '.mzML')
      else concat('run_', cast(o_custkey % 40 as string), '.raw.mzML') end as file from {orders} where o_custkey % 40 < 20""")
    return ops.resolve_spectrum_file(names, files)


@query("""with e as (select distinct 'run_' || (o_custkey % 25) || '.mzML' as filename from {orders}),
c as (select filename, count(*) as n from {f_psm} group by filename)
select e.filename, coalesce(n, 0) as psm_count, case when n > 0 then 'success' else 'failed' end as status
from e left join c on e.filename = c.filename""")
def a22_file_status(t):
    expected = t.sql("select distinct concat('run_', cast(o_custkey % 25 as string), '.mzML') as filename from {orders}")
    return ops.file_status(t("f_psm"), expected)


@query("""select filename, first(peptide order by scannr, peptide, hyperscore) as peptide from {f_psm} group by filename""")
def w08_first_in_order(t):
    rows = t("f_psm").withColumn("ord", F.struct("scannr", "peptide", "hyperscore"))
    return ranking.first_in_order(rows, ["filename"], "ord", ["peptide"])


@query("""select filename, peptide, charge, count(*) as n from (
  select filename, peptide, charge from {f_psm} union all
  select 'run_' || (l_suppkey % 20) as filename, sequence as peptide, charge from (
    select l_suppkey, substr(translate(md5(cast(l_partkey as varchar)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + l_partkey % 12 as int)) as sequence,
      2 + l_linenumber % 3 as charge from lineitem)) group by filename, peptide, charge""")
def u01_union_tables(t):
    a = t("f_psm").select("filename", "peptide", "charge", "hyperscore")
    b = t("f_denovo").select(F.col("run").alias("filename"), F.col("sequence").alias("peptide"), "charge")
    return reports.union_tables(a, b).groupBy("filename", "peptide", "charge").agg(F.count("*").alias("n"))
