"""Queries on peptide-taxon tables and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from massloom.catalog.registry import query, rounded
from massloom.operators import denovo, graph, inference, taxa
from massloom.plans import organisms as plan
from massloom.session import checkpoint

SCORED = """select sequence as peptide, max(score) as score, count(*) as psms from {f_denovo} group by sequence"""
RANKED = """with m as (select distinct p.sequence, l.species_id as taxon_id from {f_peptide_taxa} p join {f_lineage} l on l.taxon_id = p.taxon_id)"""


def scores(t):
    return denovo.peptide_scores(t("f_denovo").withColumnRenamed("sequence", "peptide"))


@query("""select p.sequence, p.taxon_id from {f_peptide_taxa} p
where p.sequence in (select sequence from {f_denovo} where length(sequence) > 10 and score >= 0.8)""")
def j11_lookup_taxa(t):
    """The peptides that pass the filter of de novo results, looked up in a bucketed table."""
    table = taxa.write_peptide_taxa(t("f_peptide_taxa"), "peptide_taxa", 8)
    return taxa.lookup_taxa(denovo.filter_denovo(t("f_denovo"), sequence="sequence"), table)


@query("""select p.sequence, p.taxon_id from {f_peptide_taxa} p join {f_lineage} l on l.taxon_id = p.taxon_id
where species_id is not null and (domain_id in (1, 3) or genus_id in (1, 3) or species_id in (1, 3))""")
def j10_u03_restrict_taxa(t):
    return taxa.restrict_taxa(t("f_peptide_taxa"), t("f_lineage"), [1, 3]).select("sequence", "taxon_id")


@query("""with l as (select * from {f_lineage} where genus_id > 3),
m as (select p.sequence, p.taxon_id, l.species_id, l.taxon_id is not null as known from {f_peptide_taxa} p left join l on l.taxon_id = p.taxon_id),
k as (select sequence, bool_or(known) as any_known from m group by 1)
select distinct m.sequence, coalesce(cast(case when any_known then species_id else taxon_id end as varchar), 'none') as taxon from m join k using (sequence)
where known or not any_known""")
def j09_to_rank(t):
    lineage = t("f_lineage").where("genus_id > 3")
    return taxa.to_rank(t("f_peptide_taxa"), lineage).select(
        "sequence", F.coalesce(F.col("taxon_id").cast("string"), F.lit("none")).alias("taxon"))


@query(f"""with s as ({SCORED.replace('{f_denovo}', '{f_denovo}')})
select p.sequence, p.taxon_id, s.score, s.psms from {{f_peptide_taxa}} p left join s on s.peptide = p.sequence""")
def j07_attach_scores(t):
    return taxa.attach_scores(t("f_peptide_taxa"), scores(t))


WEIGHTS = f"""s as ({SCORED}), m as (select distinct p.sequence, l.species_id as taxon_id from {{f_peptide_taxa}} p join {{f_lineage}} l on l.taxon_id = p.taxon_id),
d as (select sequence, count(*) as n from m group by 1),
w as (select m.taxon_id, sum(log10(s.psms / (d.n * d.n * d.n) + 1)) as weight, bool_or(d.n = 1) as unique_taxon
  from m join s on s.peptide = m.sequence join d on d.sequence = m.sequence where m.taxon_id is not null group by 1)"""


def ranked(t):
    return taxa.to_rank(t("f_peptide_taxa"), t("f_lineage"))


@query(f"with {WEIGHTS} select taxon_id, round(weight, 6) as weight, unique_taxon from w")
def a02_taxon_weights(t):
    return rounded(taxa.taxon_weights(ranked(t), scores(t)), 6, "weight")


RAW_WEIGHTS = WEIGHTS.replace("l.species_id as taxon_id", "p.taxon_id")


@query(f"""with {RAW_WEIGHTS}, top as (select taxon_id from w order by round(weight, 9) desc, taxon_id limit 30),
sel as (select taxon_id from top union select taxon_id from w where unique_taxon or (select count(*) from w) < 50)
select p.sequence, p.taxon_id from {{f_peptide_taxa}} p where p.taxon_id in (select taxon_id from sel)""")
def w04_j06_selected_edges(t):
    edges = checkpoint(t("f_peptide_taxa"))  # read three times
    weights = taxa.taxon_weights(edges, scores(t)).withColumn("weight", F.round("weight", 9))
    return taxa.keep_taxa(edges, taxa.selected_taxa(weights, 30, few=50))


GRAPH = """e as (select sequence, taxon_id from {f_peptide_taxa} where taxon_id <> 1869227),
many as (select taxon_id from e group by 1 having count(*) > 1), g as (select e.* from e join many using (taxon_id))"""


@query(f"with {GRAPH} select sequence, taxon_id from g")
def f08_graph_taxa(t):
    return taxa.graph_taxa(t("f_peptide_taxa"))


SCORED_EDGES = """select p.sequence, p.taxon_id, least(0.999, 0.5 + cast(length(p.sequence) as double) / 40) as score
from {f_peptide_taxa} p"""


@query(f"""with x as ({SCORED_EDGES}), many as (select taxon_id from x group by 1 having count(*) > 1)
select sequence, taxon_id, round(score, 9) as score from x where taxon_id in (select taxon_id from many)""")
def g01_peptide_taxon_graph(t):
    return rounded(graph.peptide_taxon_graph(t.sql(SCORED_EDGES)), 9, "score")


@query("""with s as (select sequence, string_agg(cast(taxon_id as varchar), ',' order by taxon_id) as k, count(*) as n_parents from {f_peptide_taxa} group by 1)
select min(sequence) as factor_id, max(n_parents) as n_parents, count(*) as n_peptides from s group by k""")
def g02_factors(t):
    return graph.factors(t("f_peptide_taxa").withColumn("score", F.lit(0.9)))


@query("""select 'taxon' as kind, cast(taxon_id as varchar) as node, count(*) as degree from {f_peptide_taxa} group by 2
union all select 'peptide', sequence, count(*) from {f_peptide_taxa} group by 2""")
def g08_degrees(t):
    return graph.degrees(t("f_peptide_taxa"))


@query("""with d as (select sequence, count(*) as n from {f_peptide_taxa} group by 1),
k as (select d.*, unnest(range(0, n + 1)) as k from d),
v as (select sequence, n, k, power(power(0.2::double, k) * (1 - 0.7::double), k) * ((1 - 0.7::double) / greatest(k, 1)) as a from k)
select sequence, n, k, round(greatest(a / (n + 1), 1e-30), 12) as absent, round(greatest((1 - a) / (n + 1), 1e-30), 12) as present from v""")
def g04_noisy_or(t):
    degree = t("f_peptide_taxa").groupBy("sequence").agg(F.count("*").cast("int").alias("n"))
    table = graph.noisy_or(F.col("n"), F.lit(0.8), F.lit(0.7))
    out = degree.withColumn("table", table).select("sequence", "n", F.posexplode("table").alias("k", "e"))
    out = out.select("sequence", "n", "k", "e.absent", "e.present")
    out = out.withColumns({c: F.col(c).cast("bigint") for c in ("n", "k")})
    return rounded(out, 12, "absent", "present")


SPARSE = """select distinct concat('c', cast(o_custkey as string)) as sequence, o_orderkey as taxon_id from {orders}"""


@query(f"""with e as ({SPARSE}), c as (select sequence, min(taxon_id) as component, count(*) + 1 as n_nodes from e group by 1)
select component, 'peptide' as kind, sequence as node, n_nodes from c where n_nodes > 2
union all select c.component, 'taxon', cast(e.taxon_id as varchar), n_nodes from c join e using (sequence) where n_nodes > 2""")
def g03_components(t):
    return graph.components(t.sql(SPARSE))


REACH = """links as (select distinct a.taxon_id as a, b.taxon_id as b from e a join e b on a.sequence = b.sequence),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
comp as (select a as taxon_id, min(b) as component from reach group by 1),
nodes as (select component, 'taxon' as kind, cast(taxon_id as varchar) as node from comp union select component, 'peptide', sequence from e join comp using (taxon_id)),
big as (select component, count(*) as n_nodes from nodes group by 1 having count(*) > 2)
select component, kind, node, n_nodes from nodes join big using (component)"""
# chains of up to fifty taxa, each sharing a peptide with the next
CHAINS = """select concat('p', cast(floor(o_orderkey / 50) as int), '_', cast(o_orderkey % 50 + i as int)) as sequence, o_orderkey as taxon_id from {orders}, (values (0), (1)) as v(i)"""


@query(f"with recursive e as ({CHAINS}), {REACH}")
def g03_components_chains(t):
    return graph.components(t.sql(CHAINS))


@query(f"with recursive e as (select distinct sequence, taxon_id from {{f_peptide_taxa}}), {REACH}")
def g03_components_dense(t):
    return graph.components(t("f_peptide_taxa"))


OVERLAP = """cls as (select taxon_id, string_agg(sequence, ',' order by sequence) as k, count(*) as n from e group by 1),
heads as (select min(taxon_id) as taxon_id, any_value(n) as n from cls group by k),
he as (select e.taxon_id, e.sequence, h.n from e join heads h using (taxon_id)),
ov as (select m.taxon_id as member, h.taxon_id as head, count(*) as shared, any_value(m.n) as n_peptides
  from he m join he h on h.sequence = m.sequence and h.taxon_id <> m.taxon_id group by 1, 2)"""
# each supplier twice: all its parts, and all but a few
LINKS = """select concat('p', cast(l_partkey as string)) as sequence, l_suppkey as taxon_id from {lineitem} union
  select concat('p', cast(l_partkey as string)), l_suppkey + 1000000 from {lineitem} where not (l_linenumber = 3 and l_quantity < 25)"""


@query(f"""with e as ({LINKS}), {OVERLAP} select member, head, shared, n_peptides, round(shared / n_peptides, 9) as overlap from ov
where shared / n_peptides > 0.9""")
def j14_class_overlap(t):
    return rounded(taxa.class_overlap(t.sql(LINKS), 0.9), 9, "overlap")


# one taxon after the other, heaviest first: it is a head unless a head so far absorbs it
@query(f"""with recursive e as ({LINKS}), n as (select taxon_id, count(*) as n from e group by 1),
sh as (select a.taxon_id as m, b.taxon_id as h, count(*) as c from e a join e b on a.sequence = b.sequence and a.taxon_id <> b.taxon_id group by 1, 2),
ov as (select m, h from sh join n on n.taxon_id = m where c / n.n > 0.9),
ord as (select taxon_id, row_number() over (order by n desc, taxon_id) as k from n),
cov as (select k, taxon_id, coalesce(list(h) filter (where h is not null), []) as hs from ord left join ov on m = taxon_id group by 1, 2),
r as (select cast(0 as bigint) as k, cast([] as bigint[]) as heads union all
  select r.k + 1, case when list_has_any(r.heads, cov.hs) then r.heads else list_append(r.heads, cov.taxon_id) end from r join cov on cov.k = r.k + 1),
heads as (select unnest(heads) as head from r where k = (select count(*) from ord))
select head, head as member from heads union all select head, m from heads join ov on h = head""")
def g07_cluster_taxa(t):
    edges = t.sql(LINKS)
    weights = edges.groupBy("taxon_id").agg(F.count("*").cast("double").alias("weight"))
    return taxa.cluster_taxa(edges, weights, 0.9)


@query("""with d as (select sequence, count(*) as n from {f_peptide_taxa} group by 1),
k as (select sequence, -ln((cast(('0x' || left(md5('1234/' || sequence), 13)) as bigint) + 0.5) / 4503599627370496.0::double) * n as key from d),
s as (select sequence from k order by key, sequence limit 500)
select p.sequence, p.taxon_id from {f_peptide_taxa} p join s using (sequence)""")
def w09_weighted_sample(t):
    return taxa.sample_peptides(t("f_peptide_taxa"), 500)


PARAMS = """select cast(l_linenumber % 3 as int) as param_id, l_suppkey as taxon_id, max(0.01 + l_discount * 9 + l_tax / 7) as score from {lineitem} group by 1, 2"""
HEAVY = """select s_suppkey as taxon_id, s_acctbal as weight from {supplier}"""
GOODNESS = f"""sc as ({PARAMS}), w as ({HEAVY}),
a as (select param_id, taxon_id, score, row_number() over (partition by param_id order by score desc, taxon_id) as rs from sc),
b as (select taxon_id, row_number() over (order by weight desc, taxon_id) as rw from w),
j as (select a.*, b.rw from a left join b using (taxon_id)),
k as (select param_id, sum(score) as total, least(count(*), (select count(*) from b)) as k from a group by 1),
depth as (select param_id, unnest(range(1, k + 1)) as d from k),
ag as (select d.param_id, d.d, count(j.taxon_id) / d.d as agreement from depth d left join j on j.param_id = d.param_id and j.rw is not null and greatest(j.rs, j.rw) <= d.d group by 1, 2),
ao as (select param_id, avg(agreement) as overlap from ag group by 1),
en as (select j.param_id, -sum(j.score / k.total * ln(j.score / k.total)) as entropy from j join k using (param_id) group by 1),
good as (select param_id, overlap, entropy, overlap / (entropy * entropy) as goodness from ao join en using (param_id))"""


@query(f"with {GOODNESS} select param_id, round(overlap, 8) as overlap, round(entropy, 8) as entropy, round(goodness, 8) as goodness from good")
def a25_goodness(t):
    return rounded(taxa.goodness(t.sql(PARAMS), t.sql(HEAVY)), 8, "overlap", "entropy", "goodness")


GRID = """select cast(l_linenumber as int) as param_id, 0.7 + cast(l_linenumber % 4 as double) / 10 as alpha, 0.6 + cast(l_linenumber % 3 as double) / 10 as beta,
  cast(l_linenumber % 2 as double) / 10 + 0.1 as prior, l_returnflag as grp, max(floor(l_quantity / 10)) as goodness from {lineitem} group by 1, 2, 3, 4, 5"""


@query(f"""with g as ({GRID}) select grp, round(alpha, 9) as alpha, round(beta, 9) as beta, round(prior, 9) as prior, cast(goodness as double) as goodness from (
  select *, row_number() over (partition by grp order by goodness desc, alpha desc, beta desc, prior desc) as rn from g) where rn = 1""")
def w10_best_params(t):
    rows = t.sql(GRID).withColumns({c: F.col(c).cast("double") for c in ("alpha", "beta", "prior", "goodness")})
    return rounded(taxa.best_params(rows, ["grp"]), 9, "alpha", "beta", "prior", "goodness")


@query("""with g as (select row_number() over () as x), a as (select unnest([0.7, 0.8, 0.9, 0.99]) as alpha), b as (select unnest([0.6, 0.7, 0.8, 0.9]) as beta), p as (select unnest([0.1, 0.3, 0.5]) as prior)
select s_suppkey, cast(alpha as double) as alpha, cast(beta as double) as beta, cast(prior as double) as prior from supplier, a, b, p""")
def j05_with_grid(t):
    return taxa.with_grid(t.table("supplier").select("s_suppkey")).drop("param_id")


RAW_POSTERIOR = """select cast(s_suppkey as string) as id, case when s_suppkey % 5 = 0 then 'n/a' else cast(s_acctbal as string) end as score,
  case when s_suppkey % 4 = 0 then 'peptide' else 'taxon' end as type from {supplier}"""


@query("""select s_suppkey as taxon_id, s_acctbal as score, s_name as taxon_name from supplier where s_suppkey % 4 <> 0 and s_suppkey % 5 <> 0""")
def a26_j08_taxon_table(t):
    return taxa.taxon_table(t.sql(RAW_POSTERIOR), t("f_lineage"))


# a tree of three taxa and four peptides for each supplier; SQL adds up all eight states of the taxa
FOREST = """select concat('p', cast(s_suppkey as string), '_', cast(j as string)) as sequence, s_suppkey * 10 + i as taxon_id,
  0.3 + cast((s_suppkey * 7 + j * 3) % 10 as double) / 15 as score from {supplier}, (values (0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (2, 3)) as v(i, j)"""


# every state of a supplier's taxa by enumeration: w is its weight, the posterior its share
ENUMERATED = """g as (select * from (select unnest([0.7::double, 0.8::double, 0.9::double, 0.99::double]) as alpha) a,
    (select unnest([0.6::double, 0.7::double, 0.8::double, 0.9::double]) as beta) b, (select unnest([0.1::double, 0.3::double, 0.5::double]) as prior) p),
st as (select s_suppkey, unnest(range(0, 8)) as st from supplier),
k as (select s_suppkey, st, sequence, any_value(score) as score, sum((st >> (taxon_id % 10)) & 1) as k from st join e on taxon_id // 10 = s_suppkey group by 1, 2, 3),
f as (select s_suppkey, st, alpha, beta, prior, power(power(1 - alpha, k) * (1 - beta), k) * (1 - beta) / greatest(k, 1) as absent, score from k, g),
w as (select s_suppkey, st, alpha, beta, prior, product((1 - score) * absent + score * (1 - absent)) * power(prior, bit_count(st)) * power(1 - prior, 3 - bit_count(st)) as w from f group by s_suppkey, st, alpha, beta, prior),
i as (select unnest([0, 1, 2]) as i),
post as (select s_suppkey * 10 + i as taxon_id, alpha, beta, prior, sum(case when (st >> i) & 1 = 1 then w else 0 end) / sum(w) as score from w, i group by 1, 2, 3, 4)"""


def _posteriors(t, out):
    out = out.join(graph.grid_params(t.spark), "param_id").select("taxon_id", "alpha", "beta", "prior", "score", "converged")
    return rounded(out, 6, "score")


@query(f"with e as ({FOREST}), {ENUMERATED} select taxon_id, alpha, beta, prior, round(score, 6) as score, true as converged from post")
def g05_posteriors_forest(t):
    return _posteriors(t, graph.taxon_posteriors(t.sql(FOREST), tol=1e-9, damping=(0.0,)))


# a loop of three taxa and three peptides for each supplier, no two suppliers alike
LOOPS = """select concat('p', cast(s_suppkey as string), '_', cast(j as string)) as sequence, s_suppkey * 10 + i as taxon_id,
  0.3 + cast((s_suppkey * 7919 + j * 3571) % 9973 as double) / 15000 as score from {supplier}, (values (0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (2, 0)) as v(i, j)"""


@query(f"with e as ({LOOPS}), {ENUMERATED} select taxon_id, alpha, beta, prior, round(score, 6) as score, true as converged from post")
def g05_taxon_posteriors(t):
    return _posteriors(t, inference.component_posteriors(t.sql(LOOPS)))


@query()
def g05_posteriors_dense(t):
    """One component of all taxa and peptides of the data, for every parameter set."""
    out = inference.component_posteriors(t.sql(SCORED_EDGES))
    return rounded(out, 6, "score").drop("residual")


# projects of two runs; the peptides of a loop differ in their matches
PROJECT = "concat('PXD', cast({} % 2 as string)) as pxd, concat('run_', cast(cast(floor({} / 2) as int) % 2 as string)) as run"
RUN_LOOPS = LOOPS.replace("select ", f"select {PROJECT.format('s_suppkey', 's_suppkey')}, ", 1)
LOOP_PSMS = f"""select {PROJECT.format('s_suppkey', 's_suppkey')}, concat('p', cast(s_suppkey as string), '_', cast(j as string)) as peptide, 0.5 as score,
  1 + (s_suppkey + j * 2) % 6 as psms from {{supplier}}, (values (0), (1), (2)) as v(j)"""


# no taxon holds nine tenths of another's peptides, so all are heads
@query(f"""with e as ({LOOPS}), {ENUMERATED}, m as ({LOOP_PSMS}),
sc as (select *, {PROJECT.format('(taxon_id // 10)', '(taxon_id // 10)')} from post),
wt as (select m.pxd, m.run, e.taxon_id, sum(log10(m.psms / 8 + 1)) as weight from e join m on m.peptide = e.sequence group by 1, 2, 3),
a as (select *, row_number() over (partition by pxd, run, alpha, beta, prior order by score desc, taxon_id) as rs from sc),
b as (select *, row_number() over (partition by pxd, run order by weight desc, taxon_id) as rw, count(*) over (partition by pxd, run) as n from wt),
j as (select a.*, b.rw from a join b using (pxd, run, taxon_id)),
tot as (select pxd, run, alpha, beta, prior, sum(score) as total, count(*) as k from a group by all),
depth as (select *, unnest(range(1, k + 1)) as d from tot),
ag as (select d.pxd, d.run, d.alpha, d.beta, d.prior, d.d, count(j.taxon_id) / any_value(d.d) as agreement from depth d left join j on j.pxd = d.pxd and j.run = d.run
  and j.alpha = d.alpha and j.beta = d.beta and j.prior = d.prior and greatest(j.rs, j.rw) <= d.d group by all),
ao as (select pxd, run, alpha, beta, prior, avg(agreement) as overlap from ag group by all),
en as (select pxd, run, alpha, beta, prior, -sum(score / total * ln(score / total)) as entropy from j join tot using (pxd, run, alpha, beta, prior) group by all),
best as (select *, row_number() over (partition by pxd, run order by overlap / (entropy * entropy) desc, alpha desc, beta desc, prior desc) as place from ao join en using (pxd, run, alpha, beta, prior))
select pxd, run, taxon_id, concat('taxon ', cast(taxon_id as varchar)) as taxon_name, alpha, beta, prior, round(score, 6) as score
from sc join best using (pxd, run, alpha, beta, prior) where place = 1""")
def g06_infer_taxa(t):
    """Four runs of two projects in one job; each gets its own best parameter set."""
    edges, by = t.sql(RUN_LOOPS), ["pxd", "run"]
    weights = taxa.taxon_weights(edges.select(*by, "sequence", "taxon_id"), t.sql(LOOP_PSMS), by)
    names = edges.select("taxon_id").distinct().withColumn("taxon_name", F.concat(F.lit("taxon "), "taxon_id"))
    out = plan.infer_taxa(edges, weights, names, by=by).join(graph.grid_params(t.spark), "param_id")
    return rounded(out.select(*by, "taxon_id", "taxon_name", "alpha", "beta", "prior", "score"), 6, "score")
