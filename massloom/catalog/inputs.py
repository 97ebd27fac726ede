"""Inputs of the registered queries: projections of the given tables in the shapes the operators take.

The same text serves Spark and the comparison SQL; the table names in braces are filled in.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS = {
    "f_psm": """
select concat('run_', cast(l_orderkey % 20 as string), '.mzML') as filename,
       concat('controllerType=0 controllerNumber=1 scan=', cast(l_orderkey * 8 + l_linenumber as string)) as scannr,
       l_partkey as pep_key,
       l_linenumber % 3 as ptm_class_id,
       substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + l_partkey % 12 as int)) as stripped,
       case l_linenumber % 4
         when 0 then concat('[+42.010565]', substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + l_partkey % 12 as int)))
         when 1 then concat(substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, 3), '[+15.994915]', substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 4, cast(4 + l_partkey % 12 as int)))
         when 2 then concat(substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + l_partkey % 12 as int)), '[+79.966331]')
         else substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + l_partkey % 12 as int))
       end as peptide,
       concat('sp|P', cast(l_suppkey as string), case when l_linenumber > 4 then concat(';sp|P', cast(l_suppkey + 1 as string)) else '' end) as proteins,
       2 + l_linenumber % 3 as charge,
       500 + l_extendedprice / 20 as expmass,
       500 + l_extendedprice / 20 - l_tax / 10 as calcmass,
       l_quantity + l_discount as hyperscore,
       l_quantity * 2 as rt,
       l_discount / 5 as spectrum_q,
       l_extendedprice as ms2_intensity
from {lineitem}
""",
    "f_denovo": """
select concat('run_', cast(l_suppkey % 20 as string)) as run,
       substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + l_partkey % 12 as int)) as sequence,
       l_discount * 10 as score,
       concat(cast(l_discount * 10 as string), ',', cast(l_tax * 10 as string)) as aa_scores,
       2 + l_linenumber % 3 as charge,
       400 + l_extendedprice / 100 as exp_mz
from {lineitem}
""",
    "f_lineage": """
select s.s_suppkey as taxon_id, s.s_name as taxon_name,
       n.n_regionkey as domain_id, s.s_nationkey as genus_id,
       case when s.s_suppkey % 11 = 0 then null else s.s_suppkey % 40 end as species_id
from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey
""",
    "f_peptide_taxa": """
select distinct substr(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + l_partkey % 12 as int)) as sequence,
       l_suppkey as taxon_id
from {lineitem}
""",
    "f_unimod": """
select * from (values
  (1, 'Acetyl', 42.010565, 'Any N-term', 'N-term', false), (1, 'Acetyl', 42.010565, 'Anywhere', 'K', false),
  (4, 'Carbamidomethyl', 57.021464, 'Anywhere', 'C', false), (7, 'Deamidated', 0.984016, 'Anywhere', 'N', false),
  (7, 'Deamidated', 0.984016, 'Anywhere', 'Q', false), (21, 'Phospho', 79.966331, 'Anywhere', 'S', false),
  (21, 'Phospho', 79.966331, 'Anywhere', 'T', false), (21, 'Phospho', 79.966331, 'Anywhere', 'Y', false),
  (27, 'Glu->pyro-Glu', -18.010565, 'Any N-term', 'E', false), (28, 'Gln->pyro-Glu', -17.026549, 'Any N-term', 'Q', false),
  (35, 'Oxidation', 15.994915, 'Anywhere', 'M', false), (35, 'Oxidation', 15.994915, 'Anywhere', 'P', true)
) as t(unimod_id, mod_name, mono_mass, position, site, hidden)
union all select cast(1000 + p_partkey as int), concat('mod_', cast(p_partkey as string)), 300 + p_partkey * 0.37, 'Anywhere',
  substr('ACDEFGHIKLMNPQRS', cast(1 + p_size % 16 as int), 1), false from {part}
""",
    "f_ptm_summary": """
select case when p_size % 9 = 0 then concat('Unannotated mass-shift ', cast(p_size as string))
            when p_size % 10 = 0 then 'First isotopic peak' else p_type end as modification,
       floor(p_retailprice) / 10 as mass_shift,
       p_size * 7 as psms, p_size * 7 / 100 as percent_psms, p_partkey
from {part}
""",
    "f_spectrum": """
select o_orderkey as spectrum_id, concat('run_', cast(o_custkey % 20 as string), '.mzML') as filename,
       case when o_orderkey % 5 = 0 then 1 else 2 end as ms_level,
       case when o_orderkey % 5 = 0 then 'FTMS + p NSI Full ms [350.00-1600.00]'
            when o_custkey % 20 = 7 then 'ITMS + c NSI d Full ms2 501.10@cid35.00 [110.00-1010.00]'
            else 'FTMS + p NSI d Full ms2 501.10@hcd30.00 [100.00-1500.00]' end as filter_string,
       2 + o_orderkey % 3 as charge,
       case when o_custkey % 20 < 10 then 0.8 else 12.5 end as iso_lower,
       case when o_custkey % 20 < 10 then 0.8 else 12.5 end as iso_upper,
       400 + o_totalprice / 1000 as precursor_mz
from {orders}
""",
    "f_peak": """
select l_orderkey as spectrum_id, 100 + l_extendedprice / 350 as mz, l_quantity as intensity from {lineitem}
union all select o_orderkey, 100 + (bin + o_orderkey % 11 % 5 - 1.5) * 0.0002, cast(60 - 12 * (o_orderkey % 11 % 5 - 2) * (o_orderkey % 11 % 5 - 2) as double) from {orders},
  (values (0, 4, 130638), (0, 4, 135623), (0, 4, 140672), (0, 4, 145657), (0, 4, 150705), (0, 4, 155690), (5, 6, 70553), (5, 6, 75538), (5, 6, 80555), (5, 6, 85572), (5, 6, 225545), (8, 8, 130638), (8, 8, 135623), (8, 8, 140672), (8, 8, 145657), (8, 8, 150705), (8, 8, 155690), (8, 8, 1026072)) as v(lo, hi, bin) where o_custkey % 20 between lo and hi
""",
    "f_taxid_source": """
select o_orderkey as file_key, concat('file_', cast(o_orderkey as string), '.raw') as raw_file,
       concat('PXD', cast(100000 + o_custkey as string)) as pxd,
       case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 4 as string) end as organism_taxid,
       case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 2 as string) end as llm_taxid,
       case when o_custkey % 2 = 0 then null else cast(o_custkey % 6 as string) end as pride_taxid
from {orders}
""",
    "f_project": """
select concat('PXD', cast(100000 + c_custkey as string)) as accession, c_custkey % 7 as raw_file_count,
       n_name as organism, case when c_custkey % 4 = 0 then null else concat('PMC', cast(c_custkey as string)) end as pmc_id,
       c_mktsegment as experiment_type, c_custkey % 3 = 0 as reannotated
from {customer} join {nation} on c_nationkey = n_nationkey
""",
    "f_event": """
select event_id, ts, concat('PXD', cast(100000 + user_id as string)) as pxd,
       case event_type when 'view' then 'fetch' when 'click' then 'organism' when 'purchase' then 'search' when 'signup' then 'llm' else 'agentic' end as process,
       case when event_type = 'error' then 'ERROR' when value > 150 then 'WARNING' when value > 20 then 'INFO' else 'DEBUG' end as level,
       case when value > 180 then 'skip' when value > 120 then 'decision' else 'step' end as category, value
from {events}
""",
    "f_taxon_score": """
select concat('PXD', cast(100000 + l_orderkey % 50 as string)) as pxd, l_suppkey as taxon_id, max(0.9 + l_discount) as score,
       min(l_orderkey % 50 + 1) as parent_taxid
from {lineitem} group by 1, 2, l_orderkey % 50
""",
}


class Inputs:
    """Tables and views of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        """One of the given tables, as it lies."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        return self.sql(VIEWS[name])

    def sql(self, text: str) -> DataFrame:
        """Spark SQL in which ``{name}`` stands for a table or a view."""
        names = set(re.findall(r"\{([a-z]\w+)\}", text))
        return self.spark.sql(text, **{n: self(n) if n in VIEWS else self.table(n) for n in names})


def plain_sql(body: str) -> str:
    """The same text for another engine: views become common table expressions."""
    used: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\{([a-z]\w+)\}", text):
            if name in VIEWS and name not in used:
                need(VIEWS[name])
                used.append(name)

    need(body)
    fill = lambda text: re.sub(r"\{([a-z]\w+)\}", r"\1", text)
    heads = [f"{name} as ({fill(VIEWS[name])})" for name in used]
    body = fill(body).strip()
    if not heads:
        return body
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(heads) + ",\n" + body[15:]
    if body.lower().startswith("with "):
        return "with " + ",\n".join(heads) + ",\n" + body[5:]
    return "with " + ",\n".join(heads) + "\n" + body
