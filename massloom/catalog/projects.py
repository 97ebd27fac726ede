"""Queries on project metadata, evidence, annotations and the sample table."""

from __future__ import annotations

from pyspark.sql import functions as F

from massloom.catalog.registry import query, rounded
from massloom.functions import text as tx
from massloom.operators import documents as docs, evidence as ev
from massloom.sources.tables import taxid_query

MAPPED = """mapped as (select pxd, raw_file, case when organism_taxid <> llm_taxid then pride_taxid
    else coalesce(organism_taxid, llm_taxid, pride_taxid, @@) end as taxid,
  case when organism_taxid = llm_taxid then 'organism_id+LLM (agreed)'
    when organism_taxid <> llm_taxid then case when pride_taxid is not null then 'PRIDE (fallback from disagreement)' end
    when organism_taxid is not null then 'organism_id' when llm_taxid is not null then 'LLM' when pride_taxid is not null then 'PRIDE'
    when @@ is not null then 'default' end as source,
  case when organism_taxid <> llm_taxid then case when pride_taxid is not null then 'TAXID_DISAGREEMENT_PRIDE_FALLBACK' else 'TAXID_DISAGREEMENT' end
    when organism_taxid is not null or llm_taxid is not null then null when pride_taxid is not null then 'USING_PRIDE_TAXID'
    when @@ is not null then 'USING_DEFAULT_TAXID' else 'NO_TAXID_FOUND' end as warning,
  organism_taxid, llm_taxid, pride_taxid as project_taxid from {f_taxid_source})"""


def mapping(t, default=None):
    src = t("f_taxid_source")
    part = lambda c: src.where(f"{c} is not null").select("pxd", "raw_file", F.col(c).alias("taxid"))
    project = src.where("pride_taxid is not null").groupBy("pxd").agg(F.min("pride_taxid").alias("taxid"))
    return ev.reconcile_taxids(src.select("pxd", "raw_file"), part("organism_taxid"), part("llm_taxid"), project, default)


@query(f"with {MAPPED.replace('@@', 'cast(null as varchar)')} select * from mapped")
def j03_reconcile_taxids(t):
    return mapping(t)


@query(f"with {MAPPED.replace('@@', chr(39) + '9606' + chr(39))} select * from mapped")
def j03_reconcile_taxids_default(t):
    return mapping(t, "9606")


@query(f"""with {MAPPED.replace('@@', 'cast(null as varchar)')}
select pxd, count(warning) as total_warnings, count(taxid) as files_with_taxid, count(*) filter (where taxid is null) as files_without_taxid,
  count(*) filter (where warning = 'TAXID_DISAGREEMENT_PRIDE_FALLBACK') as taxid_disagreement_pride_fallback,
  count(*) filter (where warning = 'TAXID_DISAGREEMENT') as taxid_disagreement, count(*) filter (where warning = 'USING_PRIDE_TAXID') as using_pride_taxid,
  count(*) filter (where warning = 'USING_DEFAULT_TAXID') as using_default_taxid, count(*) filter (where warning = 'NO_TAXID_FOUND') as no_taxid_found
from mapped group by pxd""")
def a24_taxid_report(t):
    return ev.taxid_report(mapping(t))


CHAIN_A = "select concat('PXD', cast(100000 + o_custkey as string)) as pxd, count(*) as n_files from {orders} group by 1"
CHAIN_B = "select concat('PXD', cast(100000 + o_custkey as string)) as pxd, max(o_totalprice) as top from {orders} where o_orderstatus = 'F' group by 1"


@query(f"with a as ({CHAIN_A}), b as ({CHAIN_B}) select p.accession as pxd, p.organism, a.n_files, b.top from {{f_project}} p join a on a.pxd = p.accession join b on b.pxd = p.accession")
def j04_combine_projects(t):
    base = t("f_project").select(F.col("accession").alias("pxd"), "organism")
    return ev.combine_projects(base, t.sql(CHAIN_A), t.sql(CHAIN_B), how="inner")


@query(f"with a as ({CHAIN_A}), b as ({CHAIN_B}) select p.accession as pxd, b.top from {{f_project}} p left join b on b.pxd = p.accession where b.top is not null")
def f12_drop_failed(t):
    base = t("f_project").select(F.col("accession").alias("pxd"))
    return ev.drop_failed(ev.combine_projects(base, t.sql(CHAIN_B)), ["top"])


FACTS = "select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('file_', cast(o_orderkey as string)) as stem, o_totalprice as tic from {orders} where o_orderstatus <> 'F'"


@query(f"with f as ({FACTS}) select s.pxd, s.raw_file, f.stem is not null as found, f.tic from {{f_taxid_source}} s left join f on f.pxd = s.pxd and f.stem || '.raw' = s.raw_file")
def j15_with_run_facts(t):
    files = t("f_taxid_source").select("pxd", "raw_file")
    return ev.with_run_facts(files, t.sql(FACTS)).select("pxd", "raw_file", F.col("tic").isNotNull().alias("found"), "tic")


RAW = "select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('file_', cast(o_orderkey as string), case when o_orderkey % 2 = 0 then '.raw' else '.wiff' end) as file from {orders}"
DONE = "select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('file_', cast(o_orderkey as string), '.mzML') as file from {orders} where o_orderpriority <> '1-URGENT'"


@query("select 'PXD' || (100000 + o_custkey) as pxd, 'file_' || o_orderkey as stem from orders where o_orderpriority = '1-URGENT'")
def j16_unconverted(t):
    return ev.unconverted(t.sql(RAW), t.sql(DONE)).select("pxd", "stem")


@query("""select 'PXD' || (100000 + o_custkey) as pxd, count(*) as raw_files, count(*) filter (where o_orderpriority <> '1-URGENT') as converted_files,
  count(*) filter (where o_orderpriority = '1-URGENT') as failed_files, round(count(*) filter (where o_orderpriority <> '1-URGENT') / count(*), 9) as conversion_rate
from orders group by 1""")
def j16_conversion_rate(t):
    return rounded(ev.conversion_rate(t.sql(RAW), t.sql(DONE)), 9, "conversion_rate")


@query("""select p.accession, p.organism, length(d.text) as n_chars from {f_project} p join documents d on 'PXD' || (100000 + d.doc_id) = p.accession""")
def j18_with_publication(t):
    texts = t.sql("select concat('PXD', cast(100000 + doc_id as string)) as accession, text from {documents}")
    joined = ev.with_publication(t("f_project").select("accession", "organism"), texts)
    return joined.select("accession", "organism", F.length("text").cast("bigint").alias("n_chars"))


TRUTH = "select distinct concat('PXD', cast(100000 + l_orderkey % 60 as string)) as pxd, l_suppkey as parent_taxid, l_suppkey as ord from {lineitem}"


@query(f"""with tr as ({TRUTH}), last as (select pxd, max(parent_taxid) as truth from tr group by 1)
select s.pxd, s.taxon_id, last.truth as parent_taxid from {{f_taxon_score}} s join last on last.pxd = s.pxd""")
def j19_with_truth(t):
    rows = ev.with_truth(t("f_taxon_score").drop("parent_taxid"), t.sql(TRUTH))
    return rows.where("parent_taxid is not null").select("pxd", "taxon_id", "parent_taxid")


LOG = """select concat('Feb-28 00:42:55.063 [Task submitter] INFO  Session - [', substr(md5(cast(event_id as string)), 1, 2), '/',
  substr(md5(cast(event_id as string)), 3, 6), '] ', case when event_id % 3 = 0 then 'Cached' else 'Submitted' end, ' process > ', process, ' (', process, '-', pxd, ')') as value,
  event_id from {f_event}"""
EXITS = """select substr(md5(cast(event_id as string)), 1, 2) as prefix, substr(md5(cast(event_id as string)), 3, 30) as folder, cast(event_id % 2 as int) as exit_code
  from {f_event} where value > 10"""


def attempts(t):
    from massloom.sources.tables import parse_workflow_log

    return ev.with_exit_codes(parse_workflow_log(t.sql(LOG), "value"), t.sql(EXITS))


@query("""select pxd, process, process || '-' || pxd as tag, substr(md5(cast(event_id as varchar)), 1, 2) as prefix, substr(md5(cast(event_id as varchar)), 3, 6) as short_hash,
  case when value > 10 then cast(event_id % 2 as varchar) else 'none' end as exit_code from {f_event}""")
def s14_j21_with_exit_codes(t):
    return attempts(t).select("pxd", "process", "tag", "prefix", "short_hash",
                              F.coalesce(F.col("exit_code").cast("string"), F.lit("none")).alias("exit_code"))


@query("""select acc, diss, lab, ana, count(*) as n from (select
  case o_orderkey % 3 when 0 then 'data-dependent acquisition' when 1 then 'data-independent acquisition' else 'not available' end as acc,
  case o_orderkey % 4 when 0 then 'NT=beam-type collision-induced dissociation;AC=MS:1000422' when 1 then 'NT=collision-induced dissociation;AC=MS:1000133'
    when 2 then 'NT=electron transfer higher energy collision dissociation;AC=MS:1002631' else 'not available' end as diss,
  case o_orderkey % 5 when 0 then 'label free sample' when 1 then 'TMT126' when 2 then 'TMTpro126C' when 3 then 'iTRAQ8plex-113' else 'not available' end as lab,
  case o_orderkey % 6 when 0 then 'orbitrap' when 1 then 'TOF' when 2 then 'ion trap' when 3 then 'quadrupole' when 4 then 'orbitrap' else 'none' end as ana from orders) group by all""")
def p21_cv_map(t):
    rows = t.sql("""select case o_orderkey % 3 when 0 then 'DDA' when 1 then ' dia ' else 'other' end as a,
      case o_orderkey % 4 when 0 then 'HR HCD' when 1 then 'lr_it_cid' when 2 then 'EThcD' else '??' end as d,
      case o_orderkey % 5 when 0 then 'none' when 1 then 'TMT10' when 2 then 'tmtpro' when 3 then 'iTRAQ8' else 'SILAC' end as l,
      case o_orderkey % 6 when 0 then 'Q  Exactive HF' when 1 then 'timsTOF Pro' when 2 then 'LTQ XL' when 3 then 'Triple Quadrupole 6500' when 4 then 'LTQ Orbitrap Velos' else 'abacus' end as i from {orders}""")
    return rows.select(
        tx.cv_map(F.col("a"), "acquisition").alias("acc"), tx.cv_map(F.col("d"), "dissociation").alias("diss"),
        tx.cv_map(F.col("l"), "label").alias("lab"), F.coalesce(tx.cv_map(F.col("i"), "analyzer"), F.lit("none")).alias("ana"),
    ).groupBy("acc", "diss", "lab", "ana").agg(F.count("*").alias("n"))


PROTOCOL = """select doc_id, concat(text, case doc_id % 6 when 0 then ' Reduced with DTT, alkylated with iodoacetamide, digested with trypsin.'
  when 1 then ' Cells in TCEP and chloroacetamide; Lys-C then trypsin; scan range 350-1600 m/z; NCE of 27%.'
  when 2 then ' beta-mercaptoethanol; chymotrypsin; m/z range of 3501600; collision energy 35 eV'
  when 3 then ' Asp-N; normalized collision energy was 30%; TMT labels' else '' end) as sample_protocol,
  case doc_id % 4 when 0 then 'Precursor tolerance was set to 10 ppm and fragment tolerance 0.02 Da; carbamidomethyl fixed; oxidation variable.'
  when 1 then 'phosphorylation and acetyl at the N-term were variable' else '' end as data_protocol from {documents}"""


@query(f"""select doc_id, case doc_id % 6 when 0 then 'NT=Trypsin;AC=MS:1001251' when 1 then 'NT=Lys-C;AC=MS:1001309' when 2 then 'NT=Chymotrypsin;AC=MS:1001306'
    when 3 then 'NT=Asp-N;AC=MS:1001303' else 'not available' end as cleavage_agent,
  case doc_id % 6 when 0 then 'dithiothreitol' when 1 then 'tris(2-carboxyethyl)phosphine' when 2 then 'beta-mercaptoethanol' end as reduction_reagent,
  case doc_id % 6 when 0 then 'iodoacetamide' when 1 then 'chloroacetamide' end as alkylation_reagent,
  case when doc_id % 4 = 0 then '10 ppm' end as precursor_tolerance, case when doc_id % 4 = 0 then '0.02 Da' end as fragment_tolerance,
  case when doc_id % 6 in (1, 2) then '350m/z-1600m/z' end as scan_range,
  case doc_id % 6 when 1 then '27 NCE' when 2 then '35 eV' when 3 then '30 NCE' end as collision_energy,
  concat_ws(',', case when doc_id % 4 = 0 then '4' end, case when doc_id % 6 = 3 then '730' end, case when doc_id % 4 = 0 then '35' end,
    case when doc_id % 4 = 1 then '1,21' end) as mods from ({PROTOCOL})""")
def p22_protocol_facts(t):
    out = docs.protocol_facts(t.sql(PROTOCOL))
    mods = F.array_join(F.transform("protocol_mods", lambda m: m["unimod_id"].cast("string")), ",")
    return out.withColumn("mods", mods).drop("protocol_mods", "sample_protocol", "data_protocol")


HINT_RUNS = """select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('f', cast(o_orderkey as string), '.mzML') as path,
  case when o_orderkey % 2 = 0 then 'DDA' else 'DIA' end as acquisition_type, case when o_orderkey % 3 = 0 then 'false' else 'true' end as high_accuracy_precursors,
  case when o_orderkey % 5 = 0 then 'LR_IT_CID' else 'HR_HCD' end as fragmentation_type, 'Q Exactive' as instrument, 'MS:1001911' as instrument_accession from {orders}"""
HINTS = """select concat('PXD', cast(100000 + c_custkey as string)) as pxd, ord, key, value from {customer} c lateral view inline(array(
  struct(0, 'dataset_identifier', 'x'), struct(1, 'source name', ''), struct(2, 'comment[proteomics data acquisition method]', ''),
  struct(3, 'comment[precursor mass tolerance]', ''), struct(4, 'comment[fragment mass tolerance]', '5 ppm'), struct(5, 'comment[instrument]', ''),
  struct(6, 'characteristics[age]', '42'))) h as ord, key, value where c_acctbal > 0"""


@query("""with r as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by 'f' || o_orderkey || '.mzML') as k from orders join customer on c_custkey = o_custkey where c_acctbal > 0),
c as (select *, unnest(range(1, 7)) as ord from r)
select 'PXD' || (100000 + o_custkey) as pxd, 'f' || o_orderkey || '.mzML' as path, k as sample_no, ord, case ord when 1 then 'sample ' || k || '[AG-TBA]'
  when 2 then case when o_orderkey % 2 = 0 then 'NT=data-dependent acquisition;AC=MS:1003221[DATA-I]' else 'NT=data-independent acquisition;AC=MS:1003215[DATA-I]' end
  when 3 then case when o_orderkey % 3 = 0 then '3.1 Da[DATA-DI]' else '20 ppm[DATA-DI]' end when 4 then '5 ppm[HUMAN]'
  when 5 then 'NT=Q Exactive;AC=MS:1001911[DATA]' else '42[HUMAN]' end as value from c""")
def p23_hint_rows(t):
    out = docs.hint_rows(t.sql(HINT_RUNS), t.sql(HINTS))
    return out.select("pxd", "path", "sample_no", F.col("ord").cast("bigint").alias("ord"), "value")


@query("""select p_partkey, lower(p_name || ' ' || p_type || ' ' || p_brand) like '%steel%' or lower(p_name || ' ' || p_type || ' ' || p_brand) like '%#3%' as has_keyword from part""")
def p24_has_keyword(t):
    rows = t.table("part").select("p_partkey", "p_name", "p_type", "p_brand")
    return docs.has_keyword(rows, ["STEEL", "#3"]).select("p_partkey", "has_keyword")


PROJECTS = """select concat('PXD', cast(100000 + c_custkey as string)) as accession, case when c_custkey % 3 = 0 then concat('10.1/', cast(c_custkey as string)) else '' end as doi,
  array(named_struct('pubmedID', case when c_custkey % 2 = 0 then '0' else cast(c_custkey as string) end, 'doi', cast(null as string)),
        named_struct('pubmedID', cast(c_custkey + 5 as string), 'doi', concat('10.2/', cast(c_custkey as string)))) as references,
  transform(sequence(1, cast(1 + c_custkey % 5 as int)), i -> named_struct('fileName', concat('f', cast(i as string), case when i % 2 = 0 then '.RAW' else '.txt' end), 'fileSizeBytes', cast(i * 10 as bigint),
    'publicFileLocations', array(named_struct('name', 'Aspera Protocol', 'value', 'x'), named_struct('name', case when i % 3 = 0 then 'Other' else 'FTP Protocol' end, 'value', concat('ftp://h/', cast(i as string)))))) as files,
  array(named_struct('name', n_name, 'accession', 'NEWT:9606'), named_struct('name', 'Mus', 'accession', 'NEWT:10090')) as organisms,
  array(named_struct('name', c_mktsegment)) as experimentTypes, case when c_custkey % 10 = 0 then 'We used LiP-MS here' else c_name end as sampleProcessingProtocol
  from {customer} join {nation} on c_nationkey = n_nationkey"""


@query("""select 'PXD' || (100000 + c_custkey) as accession, case when c_custkey % 2 = 0 then '' else c_custkey || ',' end || (c_custkey + 5) as ids,
  case when c_custkey % 3 = 0 then '10.1/' else '10.2/' end || c_custkey as publication_doi from customer""")
def p25_publication_ids(t):
    out = docs.publication_ids(t.sql(PROJECTS))
    return out.select("accession", F.array_join("pubmed_ids", ",").alias("ids"), "publication_doi")


FILES_SQL = "f as (select 'PXD' || (100000 + c_custkey) as accession, unnest(range(1, 2 + c_custkey % 5)) as i from customer)"


@query(f"with {FILES_SQL} select accession, i - 1 as ord, 'f' || i || case when i % 2 = 0 then '.RAW' else '.txt' end as file, i * 10 as bytes, 'ftp://h/' || i as ftp_url from f")
def p25_file_links(t):
    return docs.file_links(t.sql(PROJECTS)).withColumn("ord", F.col("ord").cast("bigint"))


@query(f"with {FILES_SQL} select accession, 'f' || i || '.RAW' as file, i * 10 as bytes from f where i = 2")
def f04_select_raw_files(t):
    return docs.select_raw_files(docs.file_links(t.sql(PROJECTS)), 1).select("accession", "file", "bytes")


@query("""select 'PXD' || (100000 + c_custkey) as accession, case when c_custkey % 2 = 0 then '0' else cast(c_custkey as varchar) end as pubmed_id,
  (1 + c_custkey % 5) // 2 as raw_file_count, n_name || '; Mus' as organism, c_mktsegment as experiment_types, c_custkey % 10 = 0 as limited_proteolysis
from customer join nation on c_nationkey = n_nationkey""")
def a19_survey(t):
    return docs.survey(t.sql(PROJECTS)).withColumn("raw_file_count", F.col("raw_file_count").cast("bigint"))


@query("select accession, raw_file_count, pmc_id from {f_project} where raw_file_count > 0 and pmc_id is not null and pmc_id <> ''")
def f06_in_scope(t):
    return docs.in_scope(t("f_project")).select("accession", "raw_file_count", "pmc_id")


@query("select accession from {f_project} where not reannotated order by raw_file_count, accession limit 500")
def f11_next_batch(t):
    return docs.next_batch(t("f_project")).select("accession")


@query("""select conv_id, turn, case conv_id % 4 when 3 then null else cast(length(text) as varchar) end as size from conversations where role = 'assistant'""")
def p26_llm_json(t):
    answers = t.table("conversations").where("role = 'assistant'")
    size = F.concat(F.lit('{"size": "'), F.length("text"), F.lit('"}'))
    answer = (
        F.when(F.col("conv_id") % 4 == 0, size)
        .when(F.col("conv_id") % 4 == 1, F.concat("text", F.lit("\n```json\n"), size, F.lit("\n```\nmore")))
        .when(F.col("conv_id") % 4 == 2, F.concat("text", F.lit("\n```\n"), size, F.lit("\n```")))
        .otherwise(F.col("text"))
    )
    return answers.select("conv_id", "turn", tx.llm_json(answer, "size STRING")["size"].alias("size"))


ANNOTATED = """select concat('PXD', cast(d.doc_id as string)) as pxd, kind, field, value, cast(quality as double) as evidence_score, 1.0 - toxic / 2.0 as format_score
  from {documents} d join {labels} l on l.doc_id = d.doc_id lateral view inline(array(
    struct('bio', 'lang', concat(d.lang, '')), struct('bio', 'source', case when d.doc_id % 3 = 0 then null else d.source end),
    struct('tech', 'text', case when d.n_chars > 500 then 'long' end), struct('tech', 'copy', case when d.doc_id % 2 = 0 then 'yes' end))) e as kind, field, value"""
ANN_SQL = """r as (select d.doc_id, quality, toxic, unnest([struct_pack(kind := 'bio', field := 'lang', value := d.lang),
  struct_pack(kind := 'bio', field := 'source', value := case when d.doc_id % 3 = 0 then null else d.source end),
  struct_pack(kind := 'tech', field := 'text', value := case when d.n_chars > 500 then 'long' end),
  struct_pack(kind := 'tech', field := 'copy', value := case when d.doc_id % 2 = 0 then 'yes' end)]) as k from documents d join labels l on l.doc_id = d.doc_id)"""


@query(f"""with {ANN_SQL} select 'PXD' || doc_id as pxd, k.kind as kind, cast(max(quality) as double) as evidence_score, cast(max(1.0 - toxic / 2.0) as double) as format_score,
  round(count(k.value) / count(*), 6) as completeness, round(0.5 * max(quality) + 0.2 * (count(k.value) / count(*)) + 0.3 * max(1.0 - toxic / 2.0), 6) as overall from r group by 1, 2""")
def p28_annotation_confidence(t):
    out = docs.annotation_confidence(t.sql(ANNOTATED))
    return rounded(out, 6, "evidence_score", "format_score", "completeness", "overall")


@query(f"""with {ANN_SQL} select coalesce(k.kind, 'all') as kind, coalesce(k.field, 'all') as field, count(k.value) as known, count(*) as total, round(count(k.value) / count(*), 6) as coverage
from r group by cube(k.kind, k.field)""")
def a34_annotation_coverage(t):
    out = rounded(docs.annotation_coverage(t.sql(ANNOTATED)), 6, "coverage")
    return out.withColumns({c: F.coalesce(c, F.lit("all")) for c in ("kind", "field")})


@query("""select o_orderkey, case when o_orderkey % 3 <> 0 and o_orderpriority <> '' then o_orderpriority when o_orderkey % 5 <> 0 then o_orderstatus else 'not available' end as value from orders""")
def p31_first_known(t):
    rows = t.sql("""select o_orderkey, case when o_orderkey % 3 = 0 then ' N/A ' else o_orderpriority end as a,
      case when o_orderkey % 5 = 0 then 'unknown' else o_orderstatus end as b from {orders}""")
    return rows.select("o_orderkey", tx.first_known(F.col("a"), F.col("b")).alias("value"))


@query("""select c_custkey, '9606,10090' || case when c_custkey % 3 = 0 then '' else ',' || c_custkey end as query from customer""")
def s13_taxid_query(t):
    rows = t.table("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit("9606"), F.lit("bad"))).otherwise(
        F.array(F.col("c_custkey").cast("string"), F.lit("10090"))).alias("extra"))
    return rows.select("c_custkey", taxid_query(F.lit("9606, 10090"), F.col("extra")).alias("query"))


PASSAGES = """select concat('PXD', cast(doc_id as string)) as pxd, array(named_struct('passages', transform(split(text, '\\n'), (p, i) ->
  named_struct('text', p, 'infons', named_struct('section_type', case i % 4 when 0 then 'TITLE' when 1 then 'abstract' when 2 then 'TABLE' else 'METHODS' end))))) as documents from {documents}"""


@query("""with p as (select doc_id, unnest(string_split(text, chr(10))) as p, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents)
select 'PXD' || doc_id as pxd, coalesce(string_agg(p, chr(10) order by i) filter (where i % 4 = 0), '') as title,
  coalesce(string_agg(p, chr(10) order by i) filter (where i % 4 = 1), '') as abstract, '' as intro, '' as results, '' as discuss, '' as fig, '' as ref, '' as suppl,
  coalesce(string_agg(p, chr(10) order by i) filter (where i % 4 = 3), '') as methods from p group by doc_id""")
def s09_a27_section_text(t):
    from massloom.sources.documents import section_text

    return section_text(t.sql(PASSAGES))


def sample_tables(t):
    files = t.sql("select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('file_', cast(o_orderkey as string), '.raw') as raw_file from {orders}")
    runs = t.sql("""select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('file_', cast(o_orderkey as string)) as stem, case when o_orderkey % 3 = 0 then 'Q Exactive' end as instrument,
      'DDA' as acquisition_type, 'TMT' as labeling, 'HR HCD' as fragmentation_tag from {orders}""")
    projects = t.sql("""select concat('PXD', cast(100000 + c_custkey as string)) as pxd, case when c_custkey % 2 = 0 then 'Digested with trypsin, oxidation' else 'Lys-C and DTT' end as sample_protocol,
      '' as data_protocol, concat(n_name, ' (human)') as organism, cast(null as string) as organism_part, 'healthy' as disease, 'Orbitrap Fusion' as study_instrument,
      cast(null as string) as study_acquisition, cast(null as string) as study_labeling, cast(null as string) as study_fragmentation from {customer} join {nation} on c_nationkey = n_nationkey""")
    annotations = docs.annotation_wide(t.sql("""select concat('PXD', cast(100000 + c_custkey as string)) as pxd, 'sex' as field, case when c_custkey % 3 = 0 then 'Female' else 'unknown' end as value from {customer}"""))
    fractions = t.sql("""select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('file_', cast(o_orderkey as string)) as stem, 21 as unimod_id, 'Phospho' as mod_name, 'STY' as allowed_residues,
      cast(o_orderkey % 10 as double) / 100 as fraction_modified from {orders}""")
    llm = t.sql("""select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('file_', cast(o_orderkey as string), '.raw') as raw_file, case when o_orderkey % 4 = 0 then 'drug' end as treatment, cast(null as string) as enrichment from {orders}""")
    return files, annotations, runs, projects, fractions, llm


@query("""with o as (select *, row_number() over (partition by o_custkey order by 'file_' || o_orderkey || '.raw') as k from orders)
select 'PXD' || (100000 + o_custkey) || '-Sample-' || k as source, lower(n_name) as organism, case when o_custkey % 3 = 0 then 'female' else 'not available' end as sex,
  case when o_orderkey % 4 = 0 then 'drug' else 'not available' end as treatment, case when o_orderkey % 3 = 0 then 'Q Exactive' else 'Orbitrap Fusion' end as instrument,
  case when o_custkey % 2 = 0 then 'NT=Trypsin;AC=MS:1001251' else 'NT=Lys-C;AC=MS:1001309' end as cleavage,
  case when o_custkey % 2 = 0 then 'NT=Oxidation;AC=UNIMOD:35;MT=Variable;TA=M' when o_orderkey % 10 >= 5 then 'NT=Phospho;AC=UNIMOD:21;MT=Variable;TA=STY' else 'not applicable' end as mod0,
  case when o_custkey % 2 = 0 and o_orderkey % 10 >= 5 then 'NT=Phospho;AC=UNIMOD:21;MT=Variable;TA=STY' else 'not applicable' end as mod1,
  case when o_custkey % 2 = 0 then 'not available' else 'dithiothreitol' end as reduction, 'orbitrap' as analyzer, 'file_' || o_orderkey || '.raw' as file
from o join customer on c_custkey = o_custkey join nation on c_nationkey = n_nationkey""")
def a29_w07_sdrf(t):
    out = docs.sdrf(*sample_tables(t))
    names = {
        "source name": "source", "characteristics[organism]": "organism", "characteristics[sex]": "sex", "characteristics[treatment]": "treatment",
        "comment[instrument]": "instrument", "comment[cleavage agent details]": "cleavage", "comment[modification parameters]#0": "mod0",
        "comment[modification parameters]#1": "mod1", "comment[reduction reagent]": "reduction", "comment[ms2 mass analyzer]": "analyzer", "comment[data file]": "file",
    }
    return out.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()])


@query("""with o as (select 'PXD' || (100000 + o_custkey) as pxd, count(*) as n from orders where o_orderstatus = 'F' group by 1), l as (select 'PXD' || (100000 + o_custkey) as pxd, max(o_totalprice) as v from orders where o_orderstatus = 'P' group by 1)
select p.accession as pxd, coalesce(o.n, -1) as files, o.n is not null as run_assessor_found, l.v is not null as search_results_found, false as llm_metadata_found from {f_project} p left join o on o.pxd = p.accession left join l on l.pxd = p.accession""")
def a28_project_document(t):
    base = t("f_project").select(F.col("accession").alias("pxd"))
    runs = t.sql("select concat('PXD', cast(100000 + o_custkey as string)) as pxd, count(*) as n from {orders} where o_orderstatus = 'F' group by 1")
    search = t.sql("select concat('PXD', cast(100000 + o_custkey as string)) as pxd, max(o_totalprice) as v from {orders} where o_orderstatus = 'P' group by 1")
    out = docs.project_document(base, run_assessor=runs, search=search)
    return out.select("pxd", F.coalesce("run_assessor.n", F.lit(-1)).alias("files"), "run_assessor_found", "search_results_found", "llm_metadata_found")
