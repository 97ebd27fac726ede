"""Queries on events, evaluations, batches and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from massloom.catalog.projects import DONE, RAW, attempts
from massloom.catalog.registry import query, rounded
from massloom.operators import reports as ops
from massloom.streaming import events as st, projects

SUMMARY = """select pxd, count(*) as total_events, count(*) filter (where level = 'ERROR') as error_events, count(*) filter (where level = 'WARNING') as warning_events,
  count(*) filter (where level = 'INFO') as info_events, count(*) filter (where level = 'DEBUG') as debug_events, count(*) filter (where category = 'decision') as decisions,
  count(*) filter (where category = 'skip') as skips, coalesce(bool_or(category = 'skip' and process = 'search'), false) as search_skipped,
  string_agg(distinct process, ';' order by process) as processes, min(ts) as first_ts, max(ts) as last_ts,
  case when count(*) filter (where level = 'ERROR') > 0 then 'completed_with_errors' when count(*) filter (where level = 'WARNING') > 0 then 'completed_with_warnings'
    else 'completed_successfully' end as status from {f_event} group by pxd"""


@query(SUMMARY)
def a14_event_summary(t):
    return ops.event_summary(t("f_event"))


@query("""select pxd, kind, process, ts from (select pxd, 'decision' as kind, process, ts from {f_event} where category = 'decision'
union all select pxd, 'skip', process, ts from {f_event} where category = 'skip')""")
def a14_event_findings(t):
    return ops.event_findings(t("f_event")).drop("message")


@query(f"""with s as ({SUMMARY}), d as (select pxd, date_diff('second', date_trunc('second', first_ts), date_trunc('second', last_ts)) as secs, first_ts, last_ts from s),
e as (select pxd, secs - case when last_ts - interval (secs) second < first_ts then 1 else 0 end as secs from d)
select pxd, case when secs // 3600 > 0 then (secs // 3600) || 'h ' || (secs % 3600 // 60) || 'm ' || (secs % 60) || 's'
  when secs % 3600 // 60 > 0 then (secs % 3600 // 60) || 'm ' || (secs % 60) || 's' else (secs % 60) || 's' end as duration from e""")
def p27_run_duration(t):
    return ops.run_duration(ops.event_summary(t("f_event"))).select("pxd", "duration")


@query("""select pxd, strftime(ts, '%Y-%m-%dT%H:%M:%S') as at, process, level, category from (
  select *, row_number() over (partition by pxd order by ts desc, event_id desc) as rn from {f_event}) where rn <= 20""")
def p27_w08_run_timeline(t):
    return ops.run_timeline(t("f_event"), 20, ["ts", "event_id"]).drop("message")


@query("""with e as (select distinct pxd, p.process from {f_event} cross join (select unnest(['fetch', 'organism', 'search', 'llm', 'agentic']) as process) p)
select pxd, process from e except select pxd, process from {f_event} where value > 100""")
def u04_missing_outputs(t):
    expected = t("f_event").select("pxd").distinct().withColumn(
        "process", F.explode(F.array(*[F.lit(p) for p in ("fetch", "organism", "search", "llm", "agentic")])))
    return ops.missing_outputs(expected, t("f_event").where("value > 100"), ["pxd", "process"])


@query("""select pxd from {f_event} union select accession from {f_project} where raw_file_count > 4""")
def u05_all_projects(t):
    b = t("f_project").where("raw_file_count > 4").select(F.col("accession").alias("pxd"))
    return ops.all_projects(t("f_event"), b)


@query("select distinct pxd, process from {f_event}")
def u02_distinct_pairs(t):
    return ops.distinct_pairs(t("f_event"), ["pxd", "process"])


PROBLEMS = "select pxd, level, process as code, event_id as ord from {f_event} where level in ('ERROR', 'WARNING')"


@query(f"with p as ({PROBLEMS}) select pxd, level, code, count(*) as n, max(ord) as last_ord from p group by 1, 2, 3")
def a32_problem_summary(t):
    return ops.problem_summary(t.sql(PROBLEMS))


@query(f"""with p as ({PROBLEMS}) select pxd, case when count(*) filter (where level = 'ERROR') > 0 then 'ERROR' else 'OK' end as state,
  coalesce(first(code order by ord desc) filter (where level = 'ERROR'), 'OK') as code from p group by 1""")
def a32_last_error(t):
    return ops.last_error(t.sql(PROBLEMS))


EVAL = """a as (select *, score > 0.95 as hit, case when taxon_id = parent_taxid then case when score > 0.95 then 'TP' else 'FN' end when score > 0.95 then 'FP' else 'TN' end as assessment from {f_taxon_score}),
c as (select pxd, max(parent_taxid) as parent_taxid, count(*) filter (where assessment = 'TP') as tp, count(*) filter (where assessment = 'FP') as fp, count(*) filter (where assessment = 'TN') as tn,
  count(*) filter (where assessment = 'FN') as fn, first(taxon_id order by score desc, taxon_id) as best_taxon_id from a group by 1),
m as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall from c),
ev as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0.0 end as f1 from m)"""


@query(f"with {EVAL} select pxd, taxon_id, round(score, 9) as score, hit, assessment from a")
def p32_assess_hits(t):
    return rounded(ops.assess_hits(t("f_taxon_score")).drop("parent_taxid"), 9, "score")


@query(f"with {EVAL} select pxd, parent_taxid, tp, fp, tn, fn, best_taxon_id, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1 from ev")
def a15_taxon_eval(t):
    return rounded(ops.taxon_eval(t("f_taxon_score")), 9, "precision", "recall", "f1")


@query(f"with {EVAL} select count(*) filter (where best_taxon_id = parent_taxid) as matched, count(*) as total, round(count(*) filter (where best_taxon_id = parent_taxid) / count(*), 9) as accuracy from ev")
def a15_overall_accuracy(t):
    return rounded(ops.overall_accuracy(ops.taxon_eval(t("f_taxon_score"))), 9, "accuracy")


@query("select pxd, first(taxon_id order by score desc, taxon_id) as taxon_id, round(max(score), 9) as score from {f_taxon_score} group by pxd")
def w02_top_taxon(t):
    return rounded(ops.top_taxon(t("f_taxon_score")), 9, "score")


COUNTS = "select cast(floor(o_totalprice / 100) as bigint) as raw_file_count from {orders}"


@query(f"""with c as ({COUNTS}), e as (select min(raw_file_count)::double as lo, max(raw_file_count)::double as hi, count(*) as total from c),
b as (select case when hi > lo then least(floor((raw_file_count::double - lo) / ((hi - lo) / 300)), 299) else 0 end as bin, lo, hi, total from c, e),
g as (select bin, lo, hi, total, count(*) as n from b group by all)
select cast(bin as bigint) as bin, round(lo + (bin + 1) * ((hi - lo) / 300), 6) as upper, n, round(sum(n) over (order by bin) / total, 9) as cdf from g""")
def a20_raw_count_cdf(t):
    out = ops.raw_count_cdf(t.sql(COUNTS))
    return rounded(out, 9, "cdf").withColumns({"upper": F.round("upper", 6), "bin": F.col("bin").cast("bigint")})


DOCS = """select o_orderkey as id, case when o_orderkey % 9 = 0 then null when o_orderkey % 3 = 0 then 'DIA' else 'DDA' end as acquisition_type, case when o_custkey % 4 = 0 then 'TMT' else 'LFQ' end as labeling,
  o_orderpriority as organism, o_custkey % 5 as n_files, o_orderkey % 2 = 0 as run_assessor_found, o_orderkey % 5 > 0 as organism_results_found, o_custkey % 2 = 0 as search_results_found,
  o_custkey % 3 = 0 as site_fractions_found, o_custkey as psms, o_orderkey % 100 as predictions from {orders}"""


def _stats(key: str, value: str, group: str) -> str:
    rates = ", ".join(f"round(avg(case when {f} then 1.0 else 0.0 end), 9) as {f}_rate" for f in (
        "run_assessor_found", "organism_results_found", "search_results_found", "site_fractions_found"))
    return f"""select '{key}' as key, {value} as value, count(*) as projects, {rates}, cast(sum(psms) as bigint) as total_psms, round(avg(psms), 6) as mean_psms,
      cast(sum(predictions) as bigint) as total_predictions from d {group}"""


@query("with d as (" + DOCS + ") " + " union all ".join(
    [_stats("all", "''", "")] + [_stats(k, f"coalesce(cast({k} as varchar), 'Unknown')", f"group by {k}") for k in ("acquisition_type", "labeling", "organism", "n_files")]))
def a21_batch_stats(t):
    rates = [f"{f}_rate" for f in ("run_assessor_found", "organism_results_found", "search_results_found", "site_fractions_found")]
    out = ops.batch_stats(t.sql(DOCS))
    return rounded(out, 9, *rates).withColumn("mean_psms", F.round("mean_psms", 6))


@query("""select pxd, bool_or(process = 'fetch' and value > 10 and event_id % 2 = 0) as fetch_completed, bool_or(process = 'search' and value > 10 and event_id % 2 = 0) as search_completed,
  count(*) filter (where process = 'fetch') as fetch_attempts, count(*) filter (where process = 'search') as search_attempts from {f_event} group by 1""")
def a23_completion_matrix(t):
    return ops.completion_matrix(attempts(t), ["fetch", "search"])


@query("""select distinct pxd, process, substr(md5(cast(event_id as varchar)), 3, 30) as folder from {f_event} where value > 10""")
def a23_attempt_folders(t):
    return ops.attempt_folders(attempts(t))


FLAGS = """select concat('PXD', cast(100000 + c_custkey as string)) as pxd, c_custkey % 2 = 0 as a, c_custkey % 3 <> 0 as b, c_custkey % 5 <> 0 as c, c_custkey % 7 <> 0 as d, c_custkey % 11 <> 0 as e from {customer}"""
NUM = "cast(a as int) + cast(b as int) + cast(c as int) + cast(d as int) + cast(e as int)"


@query(f"""with f as (select *, {NUM} as k from ({FLAGS})) select pxd, cast(k as bigint) as sections_found, case when k = 5 then 'COMPLETE' when k >= 3 then 'PARTIAL' else 'FAILED' end as status,
  case when k = 5 then 'COMPLETE' when k >= 1 then 'PARTIAL' else 'FAILED' end as loose from f""")
def p33_completion_status(t):
    names = ["a", "b", "c", "d", "e"]
    strict = ops.completion_status(t.sql(FLAGS), names)
    loose = ops.completion_status(t.sql(FLAGS), names, "loose").select("pxd", F.col("status").alias("loose"))
    return strict.join(loose, "pxd").select("pxd", F.col("sections_found").cast("bigint").alias("sections_found"), "status", "loose")


@query(f"""with f as (select *, {NUM} as k from ({FLAGS})), r as (select 'PXD' || (100000 + o_custkey) as pxd, count(*) as raw_files, count(*) filter (where o_orderpriority = '1-URGENT') as failed from orders group by 1)
select f.pxd, case when k = 5 then 'COMPLETE' when k >= 3 then 'PARTIAL' else 'FAILED' end as status, coalesce(round((raw_files - failed) / raw_files, 9), -1) as conversion_rate
from f left join r on r.pxd = f.pxd""")
def a33_completion_report(t):
    out = ops.completion_report(t.sql(FLAGS), t.sql(RAW), t.sql(DONE), ["a", "b", "c", "d", "e"])
    return rounded(out.select("pxd", "status", F.coalesce("conversion_rate", F.lit(-1.0)).alias("conversion_rate")), 9, "conversion_rate")


RESULTS = """select concat('PXD', cast(100000 + o_custkey as string)) as pxd, concat('f', cast(o_orderkey % 5 as string)) as raw_file, cast(70 + o_orderkey % 3 * 10 as int) as threshold from {orders}"""


@query(f"with r as ({RESULTS}) select pxd, count(distinct raw_file) as num_files_processed, count(*) as total_predictions, string_agg(distinct cast(threshold as varchar), ',' order by cast(threshold as varchar)) as filter_thresholds_used from r group by 1")
def a08_organism_summary(t):
    return ops.organism_summary(t.sql(RESULTS))


def stream(t):
    """The event view over a file stream of the given table."""
    raw = t.spark.readStream.schema(t.table("events").schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    raw.createOrReplaceTempView("massloom_event_stream")
    from massloom.catalog.inputs import VIEWS

    return t.spark.sql(VIEWS["f_event"].replace("{events}", "massloom_event_stream")).withColumn("ts", F.col("ts").cast("timestamp"))


def plain_time(df, *columns):
    """Times without a zone, as in the table."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(SUMMARY)
def t01_stream_event_summary(t):
    return plain_time(st.run_available(st.stream_event_summary(stream(t)), "t01", "complete"), "first_ts", "last_ts")


# a project's last event completes it; the newest project stays open, as nothing moves event time past it
@query(f"select * from ({SUMMARY}) where last_ts < (select max(ts) from {{f_event}})")
def t01_stream_project_summaries(t):
    last = t("f_event").groupBy("pxd").agg(F.max(F.struct("ts", "event_id")).alias("l")).select("pxd", F.col("l.event_id").alias("last_id"))
    done = F.col("event_id") == F.col("last_id")
    out = projects.stream_project_summaries(stream(t).join(last, "pxd"), done, watermark="0 seconds")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(key)
    t.spark.conf.set(key, projects.STORE)
    try:
        return plain_time(st.run_available(out, "t01p"), "first_ts", "last_ts")
    finally:
        t.spark.conf.set(key, before)


@query("""with w as (select time_bucket(interval 1 hour, ts) as window_start, process, level, count(*) as n from {f_event} group by 1, 2, 3)
select window_start, window_start + interval 1 hour as window_end, process, level, n from w
where window_start + interval 1 hour <= (select max(ts) - interval 1 hour from {f_event})""")
def t02_stream_event_windows(t):
    return plain_time(st.run_available(st.stream_event_windows(stream(t)), "t02"), "window_start", "window_end")


@query("""with w as (select unnest([time_bucket(interval 30 minute, ts), time_bucket(interval 30 minute, ts) - interval 30 minute]) as window_start, process, level from {f_event})
select window_start, window_start + interval 1 hour as window_end, process, level, count(*) as n from w
where window_start + interval 1 hour <= (select max(ts) - interval 1 hour from {f_event}) group by 1, 2, 3, 4""")
def t02_stream_sliding_windows(t):
    return plain_time(
        st.run_available(st.stream_event_windows(stream(t), "1 hour", "30 minutes"), "t02s"), "window_start", "window_end")


@query("""with e as (select *, case when ts - lag(ts) over (partition by pxd order by ts, event_id) < interval 30 minute then 0 else 1 end as fresh from {f_event}),
s as (select *, sum(fresh) over (partition by pxd order by ts, event_id) as k from e)
select pxd, min(ts) as started, max(ts) as last_ts, count(*) as n_events, count(*) filter (where level = 'ERROR') as errors from s group by pxd, k
having max(ts) + interval 30 minute <= (select max(ts) - interval 1 hour from {f_event})""")
def t03_stream_sessions(t):
    return plain_time(st.run_available(st.stream_sessions(stream(t)), "t03").drop("seconds"), "started", "last_ts")


@query("select pxd, process, count(*) as n from (select distinct pxd, process, ts, event_id from {f_event}) group by 1, 2")
def t04_stream_dedupe(t):
    rows = stream(t)
    twice = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = st.run_available(st.stream_dedupe(twice, ["event_id"]), "t04")
    return once.groupBy("pxd", "process").agg(F.count("*").alias("n"))
