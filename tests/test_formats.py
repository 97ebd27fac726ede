import json


from massloom.operators import documents as ops, reports, runs
from massloom.sources import documents as docs, sinks, tables
from massloom.streaming import events as st


def test_unimod_xml(spark, tmp_path):
    (tmp_path / "u.xml").write_text(
        '<t><modifications><modifications_row record_id="1" full_name="Acetyl" code_name="Ac" mono_mass="42.010565"/>'
        '<modifications_row record_id="2" full_name="None"/></modifications>'
        '<positions><positions_row record_id="2" position="Anywhere"/></positions>'
        '<specificity><specificity_row mod_key="1" one_letter="K" position_key="2" hidden="yes"/>'
        '<specificity_row mod_key="1" position_key="2"/></specificity></t>')
    flat = docs.unimod_flat(docs.read_unimod(spark, str(tmp_path / "u.xml"))).collect()
    assert [tuple(r) for r in flat] == [(1, "Acetyl", 42.010565, "Anywhere", "K", True)]


def test_hints(spark, tmp_path):
    (tmp_path / "PXD000001_hints.txt").write_text("# c\n\nsource name=\nkey=a=b\nkey=c\n=bad\n")
    rows = docs.read_hints(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.key, r.value, r.bad) for r in rows] == [("source name", "", False), ("key", "a=b", False), ("key", "c", False), (None, None, True)]


def test_study_layouts(spark, tmp_path):
    study = {"files": {"/d/a.mzML": {"spectra_stats": {"acquisition_type": "DDA"}, "instrument_model": {"name": "X"}}}, "search_criteria": {"labeling": "TMT"}}
    (tmp_path / "PXD000001_study.json").write_text(json.dumps(study, indent=1))
    (tmp_path / "PXD000002_study.json").write_text(json.dumps({"pxd_id": "PXD000002", "runAssessor": study}, indent=1))
    got = docs.study_runs(docs.read_study(spark, str(tmp_path))).collect()
    assert {(r.pxd, r.stem, r.acquisition_type, r.instrument) for r in got} == {("PXD000001", "a", "DDA", "X"), ("PXD000002", "a", "DDA", "X")}


def test_mztab_plain_fallback(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("MTD\tx\nsequence\tscore\nAC[+57]D\t0.9\nEE\tnull\n")
    (tmp_path / "b.mztab").write_text("MTD\tx\nPSH\tsequence\tsearch_engine_score[1]\nPSM\t[Acetyl]-AA\t0.5\nPRT\tz\n")
    got = tables.read_mztab(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.mztab")]).collect()
    assert {(r.stripped_sequence, r.score) for r in got} == {("ACD", 0.9), ("EE", None), ("AA", 0.5)}


def test_projects_keep_file_order(spark, tmp_path):
    (tmp_path / "p.csv").write_text("PXD\n PXD3 \n\nPXD1\nPXD2\n")
    assert [r.pxd for r in tables.read_projects(spark, str(tmp_path / "p.csv"), limit=2).collect()] == ["PXD3", "PXD1"]


def test_output_manifest_prefers_new_names(spark, tmp_path):
    for name in ("search_results.tsv", "results.sage.tsv"):
        f = tmp_path / "PXD000009" / "search" / "dda_search" / "Open" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("x")
    r = docs.output_manifest(spark, str(tmp_path)).first()
    assert (r.pxd, r.output, r.rel_path) == ("PXD000009", "open_search", "dda_search/Open/search_results.tsv")


EVENTS = [
    {"timestamp": f"2024-01-01T00:{i:02d}:00Z", "pxd": f"PXD{i % 3}", "process": ["fetch", "search"][i % 2],
     "level": ["INFO", "ERROR", "WARNING"][i % 3], "category": ["step", "skip", "decision"][i % 3], "message": f"m{i}", "details": {"spectrum_q": str(i)}}
    for i in range(30)
]


def write_log(root):
    for part, rows in (("", EVENTS[:10]), ("fetch", EVENTS[10:20]), ("search", EVENTS[20:])):
        (root / part).mkdir(parents=True, exist_ok=True)
        (root / part / "log.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n{bad line\n")
    (root / "other").mkdir()
    (root / "other" / "log.jsonl").write_text(json.dumps(EVENTS[0]) + "\n")


def test_stream_summary_equals_batch(spark, tmp_path):
    write_log(tmp_path)
    batch = docs.read_events(spark, str(tmp_path))
    assert batch.count() == 30 and len(docs.read_events(spark, str(tmp_path), keep_bad=True).collect()) == 33
    stream = st.stream_events(spark, str(tmp_path))
    live = st.run_available(st.stream_dedupe(stream, ["timestamp", "pxd"]), "dedupe")
    a = reports.event_summary(batch).orderBy("pxd").collect()
    b = reports.event_summary(live).orderBy("pxd").collect()
    assert a == b and len(a) == 3
    running = st.run_available(st.stream_event_summary(stream), "summary", "complete")
    assert running.count() == 3
    kinds = {r.kind: r["count"] for r in reports.event_findings(batch).groupBy("kind").count().collect()}
    assert kinds == {"skip": 10, "decision": 10, "quality": 30}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("PXD1", 1, "a", "x"), ("PXD1", 2, "b", "y")], "pxd string, sample_no int, `file` string, `mod#0` string")
    sinks.write_sdrf(rows, str(tmp_path / "sdrf"))
    text = spark.read.text(str(tmp_path / "sdrf")).select("value").collect()
    assert {r.value for r in text} == {"file\tmod", "a\tx", "b\ty"}
    sinks.write_documents(spark.createDataFrame([("PXD1", None, 2)], "pxd string, a string, b int"), str(tmp_path / "docs"))
    assert json.loads(spark.read.text(str(tmp_path / "docs")).first().value) == {"pxd": "PXD1", "a": None, "b": 2}


def test_fragmentation_file(spark):
    rows = [("one", f"scan={i}", 2, "FTMS + c d Full ms2 1@hcd3 [1]") for i in range(3)]
    rows += [("two", "scan=1", 2, "FTMS + c d Full ms2 1@hcd3 [1]"), ("two", "scan=2", 2, "ITMS + c d Full ms2 1@cid3 [1]")]
    df = spark.createDataFrame(rows, "filename string, spectrum_id string, ms_level int, filter_string string")
    got = {tuple(r) for r in runs.fragmentation_types(df).collect()}
    assert got == {("one", "*", "HR HCD"), ("two", "1", "HR HCD"), ("two", "2", "LR IT CID")}


def test_fit_peak_recovers_a_gaussian(spark):
    import math

    comp = spark.createDataFrame(
        [("f", "HR_HCD", 130000 + i, 50, 1000 * math.exp(-((i - 0.4) ** 2) / 8)) for i in range(-40, 41)],
        "filename string, frag_type string, bin bigint, n_peaks bigint, intensity double")
    peaks = spark.createDataFrame([("f", "HR_HCD", "r", "TMT", 130000, 4, True)], "filename string, frag_type string, region string, label string, mode_bin bigint, extent int, is_found boolean")
    r = runs.fit_peak(comp, peaks).first()
    assert abs(r.fit_mz - (100 + 130000.4 * 0.0002)) < 1e-6 and abs(r.sigma - 0.0004) < 1e-6 and abs(r.height - 1000) < 1e-3


def test_keyword_and_wide_annotations(spark):
    rows = spark.createDataFrame([("PXD1", "species", "unknown"), ("PXD1", "organism", "Human"), ("PXD1", "sex", "n/a")], "pxd string, field string, value string")
    r = ops.annotation_wide(rows).first()
    assert r.ann_organism == "Human" and r.ann_sex is None
    assert ops.has_keyword(spark.createDataFrame([("uses LiP-MS",)], "t string")).first().has_keyword


def test_match_tables_are_read_by_their_own_headers(spark, tmp_path):
    import pytest

    (tmp_path / "a.tsv").write_text("filename\tscannr\tpeptide\thyperscore\nf1\ts1\tAAK\t10.0\n")
    (tmp_path / "b.tsv").write_text("hyperscore\tpeptide\tfilename\n20.0\tAAAK\tf2\n")
    (tmp_path / "bad.tsv").write_text("not a table\n")
    with pytest.warns(UserWarning, match="bad.tsv"):
        rows = tables.read_psm(spark, str(tmp_path)).collect()
    assert {(r.filename, r.scannr, r.peptide, r.hyperscore) for r in rows} == {("f1", "s1", "AAK", 10.0), ("f2", None, "AAAK", 20.0)}
    with pytest.raises(ValueError), pytest.warns(UserWarning):
        tables.read_psm(spark, str(tmp_path / "bad.tsv"))


def test_fasta_records_begin_at_line_starts(spark, tmp_path):
    (tmp_path / "p.fasta").write_text(">sp|P1 Gln->Glu x\nAC\nde\n>sp|P2\nFF\n")
    got = {(r.accession, r.description, r.sequence) for r in tables.read_fasta(spark, str(tmp_path / "p.fasta")).collect()}
    assert got == {("sp|P1", "sp|P1 Gln->Glu x", "ACDE"), ("sp|P2", "sp|P2", "FF")}


def test_workflow_log_lines(spark, tmp_path):
    (tmp_path / "x.log").write_text(
        "Jan-01 [main] INFO - [ab/012345] Submitted process > search (PXD1 run)\n[cd/6789ab] Cached process > llm (PXD2)\n"
        "[cd/6789ab] Aborted process > llm (PXD2)\nno task (PXD3)\n[ef/6789ab] Submitted process > x (none)\n")
    got = [tuple(r) for r in tables.read_workflow_log(spark, str(tmp_path / "x.log")).orderBy("pxd").collect()]
    assert got == [("PXD1", "search", "PXD1 run", "ab", "012345"), ("PXD2", "llm", "PXD2", "cd", "6789ab")]


def test_a_document_with_unlisted_sections_comes_back_whole(spark):
    inner = {"files": {"/d/a.mzML": {"n": 3, "odd key \" é": [1, None, {"x": 1.5}]}}, "search_criteria": {"labeling": "TMT"}, "never heard of": [True, "\\ \n", {}]}
    given = {
        "P1": inner, "P2": {"pxd_id": "P2", "runAssessor": inner, "extra": {"deep": [[1], [2, 3]]}, "files": "the nested one wins"},
        "P3": {}, "P4": {"null section": None, "n": 12345678901234567890}, "P5": None,
    }
    rows = [(k, json.dumps(v) if v is not None else "{not json") for k, v in given.items()] + [("P6", None)]
    parsed = docs.study_documents(spark.createDataFrame(rows, "pxd string, text string"), "text")
    sections = docs.study_sections(parsed)
    back = {r.pxd: json.loads(r.json) for r in docs.whole_documents(sections).collect()}
    lifted = {**{k: v for k, v in given["P2"].items() if k != "runAssessor"}, **inner}
    assert back == {"P1": inner, "P2": lifted, "P4": given["P4"]}
    bad = {r.pxd for r in parsed.where("body is null").collect()}
    assert bad == {"P5", "P6"}
    [got] = docs.section(sections.where("pxd = 'P1'"), "search_criteria", "labeling string, missing int").collect()
    assert got.search_criteria.labeling == "TMT" and got.search_criteria.missing is None
