"""Queries on de novo peptides."""

from __future__ import annotations

from pyspark.sql import functions as F

from massloom.catalog.registry import query, rounded
from massloom.functions.counting import leave_one_out
from massloom.functions import mass as mz, rules
from massloom.operators import denovo as ops

PROTEINS = """select concat('P', cast(p_partkey as string)) as accession,
  translate(concat(md5(cast(p_partkey as string)), md5(cast(p_partkey + 7 as string))), '0123456789abcdef', 'AKDPFGHWKLMNPQRS') as sequence from {part}"""

CUT = r"""replace(replace(replace(regexp_replace(sequence, '([KR])', '\1|', 'g'), '|P', 'P'), 'WKP', 'WK|P'), 'MRP', 'MR|P')"""
DIGEST = f"""prot as ({PROTEINS}), pieces as (select accession, list_filter(string_split({CUT}, '|'), lambda x: x <> '') as p from prot),
spans as (select accession, array_to_string(p[a.i : a.i + m.m], '') as peptide from pieces,
  lateral (select unnest(range(1, len(p) + 1)) as i) a, (select unnest([0, 1, 2]) as m) m where a.i + m.m <= len(p)),
pep as (select distinct accession, peptide from spans where length(peptide) between 6 and 50)"""


@query(f"with {DIGEST} select * from pep")
def x01_digest(t):
    return ops.digest(t.sql(PROTEINS))


@query("""select run, sequence, score, charge from {f_denovo} where length(sequence) > 10 and score >= 0.8""")
def f01_filter_denovo(t):
    return ops.filter_denovo(t("f_denovo"), sequence="sequence").select("run", "sequence", "score", "charge")


# contaminants cut from the same hash letters as the peptides, so that some of them meet
CONTAMINANTS = """select concat('C', cast(p_partkey as string)) as accession,
  concat(substr(translate(md5(cast(p_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), 1, cast(7 + p_partkey % 12 as int)),
    'K', translate(md5(cast(p_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')) as sequence from {part} where p_size > 30"""
CONTAM_SQL = DIGEST.replace(PROTEINS, CONTAMINANTS)


@query(f"""with {CONTAM_SQL} select run, sequence as peptide, count(*) as n from {{f_denovo}}
where sequence not in (select peptide from pep) group by 1, 2""")
def j01_remove_contaminants(t):
    rows = t("f_denovo").select("run", F.col("sequence").alias("peptide"))
    kept = ops.remove_contaminants(rows, ops.digest(t.sql(CONTAMINANTS)))
    return kept.groupBy("run", "peptide").agg(F.count("*").alias("n"))


@query("""select run, sequence as peptide, max(score) as score, count(*) as psms from {f_denovo} group by 1, 2""")
def a01_peptide_scores_max(t):
    return ops.peptide_scores(t("f_denovo").withColumnRenamed("sequence", "peptide"), by=["run"])


@query("""select sequence as peptide, first(score order by exp_mz desc, score desc, charge desc) as score, count(*) as psms from {f_denovo} group by 1""")
def a01_peptide_scores_last(t):
    rows = t("f_denovo").withColumnRenamed("sequence", "peptide").withColumn("ord", F.struct("exp_mz", "score", "charge"))
    return ops.peptide_scores(rows, keep="last", order="ord")


@query("""select run, sequence from {f_denovo} where run in (select run from {f_denovo} group by run having count(*) >= 3000)""")
def f09_enough_peptides(t):
    return ops.enough_peptides(t("f_denovo").select("run", "sequence"), 3000)


@query("""select run, count(*) as num_spectra, count(*) filter (where score >= 0) as score_ge_0, count(*) filter (where score >= 0.5) as score_ge_50,
  count(*) filter (where score >= 0.9) as score_ge_90, count(*) filter (where score >= 0.95) as score_ge_95,
  count(*) filter (where score >= 0.99) as score_ge_99, min(length(sequence)) as min_length,
  cast(median(length(sequence)) as double) as median_length, max(length(sequence)) as max_length from {f_denovo} group by run""")
def a18_denovo_report(t):
    out = ops.denovo_report(t("f_denovo"))
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("min_length", "max_length")})


@query("""select run, sequence, score, rank from (select run, sequence, score, row_number() over (
  partition by run order by score desc nulls last, sequence) as rank from {f_denovo}) where rank <= 5""")
def w03_top_matches(t):
    out = ops.top_matches(t("f_denovo").select("run", "sequence", "score"), 5, ["run"])
    return out.withColumn("rank", F.col("rank").cast("bigint"))


PAIRS = """select spectrum_id, truth, charge from (select l_orderkey as spectrum_id, max(translate(md5(cast(l_partkey as string)),
  '0123456789abcdef', 'ACDEFGHIKLMNPQRS')) as truth, max(2 + l_linenumber % 3) as charge from {lineitem} group by l_orderkey)"""
PRED = """select l_orderkey as spectrum_id, min(translate(md5(cast(l_partkey as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')) as pred,
  max(l_discount * 10) as score from {lineitem} where l_discount <= 0.08 group by l_orderkey"""


@query(f"""with tr as ({PAIRS}), pr as ({PRED}) select tr.spectrum_id, truth, charge, pred, score from tr left join pr on pr.spectrum_id = tr.spectrum_id""")
def j12_pair_truth(t):
    return ops.pair_truth(t.sql(PAIRS), t.sql(PRED))


MASSES = "map {" + ", ".join(f"'{a}': {m!r}::double" for a, m in rules.RESIDUE_MASS.items()) + "}"
# running sums of both sequences of each differing pair; two residues meet where the sums are close
MEETINGS = f"""tr as ({PAIRS}), pr as ({PRED}), al as (select tr.spectrum_id, truth, charge, pred from tr left join pr on pr.spectrum_id = tr.spectrum_id),
df as (select distinct truth, pred, length(truth) as na, length(pred) as nb, greatest(length(truth), length(pred)) as n from al where truth <> pred),
la as (select truth, i, {MASSES}[truth[i]] as m from (select distinct truth, unnest(range(1, length(truth) + 1)) as i from df)),
lb as (select pred, i, {MASSES}[pred[i]] as m from (select distinct pred, unnest(range(1, length(pred) + 1)) as i from df)),
a as (select truth, i, m, sum(m) over (partition by truth order by i) as f, sum(m) over (partition by truth order by i desc) as b from la),
b as (select pred, i, m, sum(m) over (partition by pred order by i) as f, sum(m) over (partition by pred order by i desc) as b from lb),
fw as (select truth, pred, greatest(a.i, b.i) as p, abs(a.m - b.m) < 0.1 as same from df join a using (truth) join b using (pred) where abs(a.f - b.f) < 0.5),
bw as (select truth, pred, a.i, b.i as j, na, nb, n, abs(a.m - b.m) < 0.1 as same from df join a using (truth) join b using (pred) where abs(a.b - b.b) < 0.5),
hits as (select truth, pred, p from fw where same),
stop as (select truth, pred, n, (select min(k) from (select unnest(range(1, df.n + 1)) as k) where k not in (select p from hits h where h.truth = df.truth and h.pred = df.pred)) as stop from df),
over_ as (select bw.truth, bw.pred, greatest(i, j) as p, same from bw join stop using (truth, pred) where i >= stop and j >= stop),
best as (select truth, pred, p from hits where (truth, pred, p) not in (select truth, pred, p from over_) union select truth, pred, p from over_ where same),
modes as (select 'forward' as mode, truth, pred, count(*) as k from hits group by all union all select 'best', truth, pred, count(*) from best group by all
  union all select 'backward', truth, pred, count(*) from bw where same group by all),
rows_ as (select m.mode, al.*, case when truth = pred then length(truth) else coalesce((select k from modes x where x.mode = m.mode and x.truth = al.truth and x.pred = al.pred), 0) end as k
  from al, (select unnest(['best', 'forward', 'backward']) as mode) m)"""


@query(f"""with {MEETINGS} select mode, charge, round(sum(k) / (sum(coalesce(length(pred), 0)) + 1e-8::double), 9) as aa_precision,
  round(sum(k) / (sum(length(truth)) + 1e-8::double), 9) as aa_recall,
  round(count(*) filter (where pred is not null and k = greatest(length(truth), length(pred))) / (count(*) + 1e-8::double), 9) as pep_precision from rows_ group by 1, 2""")
def a16_x02_aa_match_metrics(t):
    pairs = ops.pair_truth(t.sql(PAIRS), t.sql(PRED))
    modes = [ops.aa_match_metrics(pairs, ["charge"], m).withColumn("mode", F.lit(m)) for m in ("best", "forward", "backward")]
    return rounded(modes[0].unionByName(modes[1]).unionByName(modes[2]), 9, "aa_precision", "aa_recall", "pep_precision")


@query("""select run, round(count(*) filter (where score > 0.7 and charge = 2) / count(*) filter (where score > 0.7), 9) as precision,
  round(count(*) filter (where score > 0.7 and charge = 2) / count(*), 9) as recall from {f_denovo} group by run""")
def a17_precision_recall(t):
    rows = t("f_denovo").withColumn("correct", F.col("charge") == 2)
    return rounded(ops.aa_pr_at(rows, 0.7, by=["run"]), 9, "precision", "recall")


def _mass_sql(column: str) -> str:
    terms = " + ".join(
        f"(length({column}) - length(replace({column}, '{a}', ''))) * {m!r}::double" for a, m in rules.RESIDUE_MASS.items()
    )
    return f"18.010565::double + {terms}"


@query(f"""with pep as (select sequence, {_mass_sql('sequence')} as mass from (select distinct sequence from {{f_denovo}})),
sp as (select spectrum_id, precursor_mz, charge from {{f_spectrum}}),
iso as (select sp.*, i.i, (precursor_mz - i.i * 1.00335::double / charge) * charge - charge * 1.007276466879::double as target from sp, (select unnest([0, 1]) as i) i),
pairs as (select spectrum_id, sequence, ((mass + charge * 1.007276466879::double) / charge - (precursor_mz - i * 1.00335::double / charge)) / precursor_mz * 1e6::double as ppm
  from iso join pep on mass between target - 0.25 and target + 0.25),
fit as (select spectrum_id, sequence, first(ppm order by abs(ppm)) as ppm from pairs where abs(ppm) < 50 group by 1, 2)
select spectrum_id, count(*) as n_candidates, round(min(abs(ppm)), 3) as ppm from fit group by 1""")
def j13_candidates(t):
    peptides = t("f_denovo").select("sequence").distinct().withColumn("mass", mz.sequence_mass(F.col("sequence")))
    spectra = t("f_spectrum").select("spectrum_id", "precursor_mz", "charge")
    out = ops.candidate_summary(spectra, peptides).select("spectrum_id", "n_candidates", F.abs("ppm").alias("ppm"))
    return rounded(out, 3, "ppm")


# the counts of all other parents one after another; the likelihood of k present parents is 1 / (1 + k) + (k % 3) / 10
@query("""with g as (select sequence, list(score / 2 order by score) as p from {f_denovo} group by 1),
o as (select sequence, p, unnest(range(1, len(p) + 1)) as i from g),
c as (select sequence, i, list_reduce(list_prepend([1.0::double], list_transform(p[1:i - 1] || p[i + 1:], lambda x: [x])),
  lambda acc, x: list_transform(range(1, len(acc) + 2), lambda k: coalesce(acc[k], 0) * (1 - x[1]) + coalesce(case when k > 1 then acc[k - 1] end, 0) * x[1])) as c from o),
l as (select sequence, i, list_sum(list_transform(range(0, len(c)), lambda k: c[k + 1] * (1 / (1.0::double + k) + (k % 3) / 10.0::double))) as absent,
  list_sum(list_transform(range(0, len(c)), lambda k: c[k + 1] * (1 / (2.0::double + k) + ((k + 1) % 3) / 10.0::double))) as present from c)
select sequence, cast(i as int) as place, round(absent / (absent + present), 9) as absent, round(present / (absent + present), 9) as present from l""")
def x03_leave_one_out(t):
    """All rows of a sequence are parents: groups of up to some fifty, on both sides of the short form's limit."""
    groups = t("f_denovo").groupBy("sequence").agg(F.sort_array(F.collect_list(F.col("score") / 2)).alias("p"))
    counts = F.sequence(F.lit(0), F.size("p"))
    likelihood = F.transform(counts, lambda k: 1 / (1.0 + k) + (k % 3) / 10.0)
    out = groups.select("sequence", F.posexplode(leave_one_out(F.col("p"), likelihood)).alias("place", "m"))
    return rounded(out.select("sequence", (F.col("place") + 1).alias("place"), "m.absent", "m.present"), 9, "absent", "present")
