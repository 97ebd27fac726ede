"""Queries on modifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from massloom.catalog.matches import unimod
from massloom.catalog.registry import query
from massloom.functions import modseq
from massloom.operators import mods, runs
from massloom.plans import modifications as plan

# a summary whose shifts lie near the reference masses
PTM = """select p_partkey as ord, case when p_size % 9 = 0 then concat('Unannotated mass-shift ', cast(p_size as string))
    when p_size % 10 = 0 then 'First isotopic peak' else p_type end as modification,
  case p_partkey % 5 when 0 then 42.0 when 1 then 15.98 when 2 then 79.95 when 3 then 57.01 else 2000.0 end
    + cast(p_partkey % 40 as double) / 1000 as mass_shift,
  p_size * 7 as psms, cast(p_size * 2 as double) as percent_psms from {part}"""

EVENTS = """select distinct filename, stripped,
  case when peptide like '[%' then -1 else strpos(peptide, '[') - 2 end as pos,
  case when peptide like '[%' then null else substr(peptide, strpos(peptide, '[') - 1, 1) end as residue,
  case when peptide like '[%' then 'N-term' end as term,
  cast(regexp_extract(peptide, '\\[([^\\]]+)\\]', 1) as double) as mass
from {f_psm} where peptide like '%[%'"""

SITES = """select unimod_id, mod_name, cast(mono_mass as double) as mono_mass,
  list_sort(list_distinct(list(site) filter (where position = 'Anywhere' and length(site) = 1 HIDDEN))) as residues,
  list_sort(list_distinct(list(case position when 'Any N-term' then 'N-term' when 'Any C-term' then 'C-term' end)
    filter (where position in ('Any N-term', 'Any C-term') HIDDEN))) as terms
from {f_unimod} group by 1, 2, 3"""
VISIBLE, EVERY = SITES.replace("HIDDEN", "and not hidden"), SITES.replace("HIDDEN", "")


@query(f"""with ev as ({EVENTS})
select filename, pos, residue, term, mass, count(*) as n from ev group by all""")
def p03_mod_events(t):
    rows = mods.mod_event_rows(t("f_psm"), ["filename"])
    return rows.groupBy("filename", "pos", "residue", "term", "mass").agg(F.count("*").alias("n"))


@query(f"""with sites as ({VISIBLE}),
shifts as (select distinct 15.98 + cast(p_partkey % 60 as double) / 1000 + (p_partkey % 5) * 16 as mass,
  case p_partkey % 3 when 0 then 'M' when 1 then 'S' else 'K' end as residue,
  case when p_partkey % 7 = 0 then 'N-term' end as term from {{part}}),
c as (select s.*, u.unimod_id, u.mod_name, u.mono_mass, row_number() over (partition by s.mass, s.residue, s.term order by
    case when coalesce(list_contains(u.residues, s.residue), false) or coalesce(list_contains(u.terms, s.term), false) then 0 else 1 end,
    abs(u.mono_mass - s.mass), u.unimod_id) as rn
  from shifts s join sites u on abs(u.mono_mass - s.mass) <= 0.01 + 1e-9)
select mass, residue, term, unimod_id, mod_name, mono_mass from c where rn = 1""")
def j02_match_mods(t):
    shifts = t.sql("""select 15.98 + cast(p_partkey % 60 as double) / 1000 + (p_partkey % 5) * 16 as mass,
      case p_partkey % 3 when 0 then 'M' when 1 then 'S' else 'K' end as residue,
      case when p_partkey % 7 = 0 then 'N-term' end as term from {part}""").withColumn("mass", F.col("mass").cast("double"))
    return mods.match_mods(shifts, unimod(t))


@query(f"""with sites as ({VISIBLE}),
pep as (select distinct stripped from {{f_psm}}),
letters as (select unnest(string_split(stripped, '')) as a from pep), counts as (select a, count(*) as n from letters group by a),
total as (select count(*) as n from pep)
select unimod_id, array_to_string(residues, '') as residues, array_to_string(terms, ';') as terms,
  cast(coalesce((select sum(n) from counts where list_contains(residues, a)), 0) + coalesce(len(terms), 0) * (select n from total) as bigint) as potential
from sites""")
def p37_mod_sites(t):
    sites = mods.mod_sites(unimod(t))
    counts = mods.residue_counts(t("f_psm").select("stripped"), [])
    rows = sites.withColumn("c", counts.agg(F.first(F.struct("unique_peptides", "letters"))).scalar())
    total = F.aggregate("residues", F.lit(0).cast("bigint"), lambda acc, a: acc + F.try_element_at("c.letters", a))
    joined = lambda c, sep: F.nullif(F.array_join(c, sep), F.lit(""))
    return rows.select("unimod_id", joined("residues", "").alias("residues"), joined("terms", ";").alias("terms"),
                       (total + F.size("terms") * F.col("c.unique_peptides")).alias("potential"))


FRACTIONS = f"""ev as ({EVENTS}), vis as ({VISIBLE}), every as ({EVERY}),
kinds as (select distinct residue, term, mass from ev),
cand as (select k.*, u.unimod_id, row_number() over (partition by k.mass, k.residue, k.term order by
    case when coalesce(list_contains(u.residues, k.residue), false) or coalesce(list_contains(u.terms, k.term), false) then 0 else 1 end,
    abs(u.mono_mass - k.mass), u.unimod_id) as rn from kinds k join vis u on abs(u.mono_mass - k.mass) <= 0.01 + 1e-9),
defs as (select residue, term, mass, unimod_id from cand where rn = 1),
sites as (select distinct e.filename, d.unimod_id, e.stripped, e.pos from ev e join defs d on d.mass = e.mass
  and d.residue is not distinct from e.residue and d.term is not distinct from e.term),
num as (select filename, unimod_id, count(*) as modified_sites, count(distinct stripped) as peptides_with_mod from sites group by 1, 2),
pep as (select distinct filename, stripped from {{f_psm}}),
tot as (select filename, count(*) as unique_peptides from pep group by 1),
letters as (select filename, unnest(string_split(stripped, '')) as a from pep),
counts as (select filename, a, count(*) as n from letters group by 1, 2),
pot as (select t.filename, u.unimod_id, u.mod_name, u.residues, u.terms, t.unique_peptides,
    cast(coalesce(sum(c.n) filter (where list_contains(u.residues, c.a)), 0) + coalesce(len(u.terms), 0) * t.unique_peptides as bigint) as potential_sites
  from tot t cross join every u join counts c on c.filename = t.filename group by 1, 2, 3, 4, 5, 6),
frac as (select n.filename, 'unimod:' || n.unimod_id as mod_key, n.unimod_id, p.mod_name,
    (select min(mass) from defs d where d.unimod_id = n.unimod_id) as m,
    coalesce(array_to_string(p.residues, ''), '') as allowed_residues, coalesce(array_to_string(p.terms, ';'), '') as allowed_terms,
    p.unique_peptides, n.peptides_with_mod, n.modified_sites, p.potential_sites,
    round(n.modified_sites / p.potential_sites, 6) as fraction_modified
  from num n join pot p on p.filename = n.filename and p.unimod_id = n.unimod_id where p.potential_sites > 0)"""


@query(f"with {FRACTIONS} select * exclude (m), '+' || printf('%.6f', m) as mass_shift from frac")
def a03_site_fractions(t):
    return mods.site_fractions(t("f_psm"), unimod(t), ["filename"])


@query(f"""with {FRACTIONS} select filename, count(*) as num_mods_analyzed, cast(sum(modified_sites) as bigint) as modified_sites,
  first(mod_key order by fraction_modified desc, modified_sites desc, mod_key desc) as top_mod from frac group by filename""")
def a04_site_fraction_report(t):
    return mods.site_fraction_report(mods.site_fractions(t("f_psm"), unimod(t), ["filename"]))


@query(f"""with {FRACTIONS} select filename, unimod_id, mod_name, fraction_modified from frac
where fraction_modified >= 0.05 and not (unimod_id = 21 and filename like '%1.mzML')""")
def f10_supplement_mods(t):
    named = t.sql("select distinct filename, 21 as unimod_id from {f_psm} where filename like '%1.mzML'")
    found = mods.site_fractions(t("f_psm"), unimod(t), ["filename"])
    return mods.supplement_mods(found, named, ["filename"]).select(
        "filename", "unimod_id", "mod_name", "fraction_modified")


KEPT = """modification is not null and not (modification like 'Unannotated mass-shift%' or modification like '%Isotopic peak%'
  or modification like '%isotopic peak%' or modification in ('None', 'nan'))"""


@query(f"select * from {{f_ptm_summary}} where {KEPT} and percent_psms >= 0.5")
def f03_filter_ptm(t):
    return mods.filter_ptm(t("f_ptm_summary"), 0.5)


@query(f"""select modification, mass_shift, psms, percent_psms, p_partkey from {{f_ptm_summary}}
where {KEPT} and percent_psms >= 0.005 order by psms desc, p_partkey limit 25""")
def w05_top_ptms(t):
    return mods.top_ptms(mods.filter_ptm(t("f_ptm_summary")), 25, order="p_partkey")


@query("""select modification, cast(sum(psms) as bigint) as psms from {f_ptm_summary} group by 1 order by psms desc, modification limit 5""")
def a30_ptm_classes(t):
    return mods.ptm_classes(t("f_ptm_summary"), 5)


USABLE = f"""ptm as ({PTM}), every as ({EVERY}),
best as (select p.*, u.unimod_id, u.mod_name, u.residues, u.terms, row_number() over (partition by p.ord order by
  abs(u.mono_mass - p.mass_shift), u.unimod_id) as rn from ptm p join every u on abs(u.mono_mass - p.mass_shift) <= 0.01 + 1e-9
  where abs(p.mass_shift) <= 1000),
usable as (select * from best where rn = 1 and coalesce(len(residues), 0) + coalesce(len(terms), 0) > 0)"""


@query(f"with {USABLE} select ord, modification, mass_shift, unimod_id, mod_name from usable")
def f07_usable_mods(t):
    return mods.usable_mods(t.sql(PTM).withColumn("mass_shift", F.col("mass_shift").cast("double")), unimod(t)).select(
        "ord", "modification", "mass_shift", "unimod_id", "mod_name")


MAPS = f"""{USABLE},
flat as (select unnest(list_concat(coalesce(residues, []), list_transform(coalesce(terms, []), lambda x:
    case when percent_psms >= 95 then case when x = 'N-term' then '^' else '$' end else case when x = 'N-term' then '[' else ']' end end))) as site,
  percent_psms >= 95 as fixed, mass_shift as mass, ord from usable),
maps as (select site, 'static' as kind, first(mass order by ord) as mass, min(ord) as ord from flat where fixed group by site
union all select site, 'variable', mass, min(ord) from flat where not fixed group by site, mass)"""


def maps(t):
    ptm = t.sql(PTM).withColumn("mass_shift", F.col("mass_shift").cast("double"))
    return mods.mods_to_maps(ptm, unimod(t)), ptm


@query(f"with {MAPS} select * from maps")
def a05_mods_to_maps(t):
    return maps(t)[0]


@query(f"""with {MAPS}, cls as (select modification from ptm group by 1 order by sum(psms) desc, modification limit 30)
select * from maps m where exists (select 1 from ptm p join cls using (modification) where round(p.mass_shift, 5) = round(m.mass, 5))""")
def j17_limit_mods(t):
    settings, ptm = maps(t)
    return mods.limit_mods(settings, ptm, mods.ptm_classes(ptm, 30))


@query(f"""with {USABLE},
top as (select * from ptm where {KEPT} and percent_psms >= 0.005 order by psms desc, ord limit 400),
u as (select * from usable where ord in (select ord from top)),
flat as (select unnest(list_concat(coalesce(residues, []), list_transform(coalesce(terms, []), lambda x:
    case when percent_psms >= 95 then case when x = 'N-term' then '^' else '$' end else case when x = 'N-term' then '[' else ']' end end))) as site,
  percent_psms >= 95 as fixed, mass_shift as mass, ord from u)
select site, 'static' as kind, first(mass order by ord) as mass, min(ord) as ord from flat where fixed group by site
union all select site, 'variable', mass, min(ord) from flat where not fixed group by site, mass""")
def discover_modifications(t):
    ptm = t.sql(PTM).withColumn("mass_shift", F.col("mass_shift").cast("double"))
    return plan.discover(ptm, unimod(t), n=400)


LABEL = "case o_orderkey % 8 when 0 then 'TMT' when 1 then 'TMTpro' when 2 then 'iTRAQ4' when 3 then 'iTRAQ8' when 4 then 'SILAC' when 5 then 'LFQ' when 6 then 'none' else 'TMT10' end"


# what is expected of every label, and of each class of label more
EXPECTED_MODS = """(select '*' as label_class, 'dia' as source, * from (values ('Oxidation', 35, 15.994915, 'M', false), ('Acetyl', 1, 42.010565, '*n', false),
    ('Deamidated', 7, 0.984016, 'N', false), ('Deamidated', 7, 0.984016, 'Q', false), ('Phospho', 21, 79.966331, 'S', false), ('Phospho', 21, 79.966331, 'T', false),
    ('Phospho', 21, 79.966331, 'Y', false), ('Gln->pyro-Glu', 28, -17.026549, 'Qn', false), ('Glu->pyro-Glu', 27, -18.010565, 'En', false),
    ('Carbamidomethyl', 4, 57.021464, 'C', true)) as b(mod, unimod_id, mass, site, fixed)
  union all select c, source, mod, unimod_id, case when c = 'TMTpro' and source = 'static' then 304.207 else mass end, site, true from
    (values ('TMT', 'TMT', 737, 229.162932), ('TMTpro', 'TMT', 737, 304.207146), ('iTRAQ', 'iTRAQ', 214, 144.102063), ('iTRAQ8', 'iTRAQ', 214, 304.20536)) as k(c, mod, unimod_id, mass),
    (values ('search', 'K'), ('search', '^'), ('dia', 'K'), ('dia', '*n'), ('static', '^'), ('static', 'K'), ('static', 'Y')) as p(source, site) where site <> 'Y' or mod = 'iTRAQ'
  union all select 'SILAC', source, mod, unimod_id, mass, site, false from (values ('SILAC_K', 259, 8.014199, 'K'), ('SILAC_R', 267, 10.008269, 'R')) as s(mod, unimod_id, mass, site),
    (values ('search'), ('dia')) as q(source)) as v"""


@query(f"""with l as (select distinct {LABEL} as label from {{orders}}),
k as (select label, case label when 'TMT10' then 'TMT' when 'iTRAQ4' then 'iTRAQ' when 'none' then 'LFQ' else label end as own from l)
select k.label, v.source, v.mod, v.unimod_id, cast(v.mass as double) as mass, v.site, v.fixed from k join {EXPECTED_MODS}
on v.label_class = k.own or v.label_class = '*'""")
def p20_label_mods(t):
    return runs.label_mods(t.sql(f"select {LABEL} as labeling from {{orders}}"))


@query(f"""with l as (select {LABEL} as label, count(*) as n from {{orders}} group by 1)
select label, n, case when label like 'TMT%' then 'TMT' when label like 'iTRAQ%' then 'iTRAQ' when label = 'SILAC' then 'SILAC' else 'LFQ' end as mode,
  label like 'TMT%' or label like 'iTRAQ%' as reporter_ions,
  case label when 'LFQ' then 'label_free' when 'SILAC' then 'isotope_labeling' when 'TMT10' then 'isobaric' when 'iTRAQ4' then 'isobaric' when 'iTRAQ8' then 'isobaric' end as kind,
  case when label in ('SILAC', 'TMT10', 'iTRAQ4', 'iTRAQ8') then label end as type from l""")
def p20_quantification(t):
    rows = t.sql(f"select {LABEL} as label, count(*) as n from {{orders}} group by 1")
    q = runs.quantification(F.col("label"))
    return rows.select("label", "n", q["mode"].alias("mode"), q["reporter_ions"].alias("reporter_ions"),
                       q["kind"].alias("kind"), q["type"].alias("type"))


@query("""select stripped, 'NT=' || stripped || ';AC=UNIMOD:' || charge || ';MT=Variable;TA=' || stripped[1:1] as mod
from {f_psm} group by stripped, charge""")
def p36_sdrf_mod(t):
    rows = t("f_psm").select("stripped", "charge").distinct()
    return rows.select("stripped", modseq.sdrf_mod(
        F.col("stripped"), F.col("charge"), F.lit("Variable"), F.substring("stripped", 1, 1)).alias("mod"))


