import datetime as dt
import json

import pytest

from paygrain import session
from paygrain.plans import sheets
from paygrain.plans.sheets import ingest_sheets, read_sheet
from paygrain.sources import cells, snapshots
from paygrain.sources.schemas import CELLS_SCHEMA, all_strings

SCHEMA = all_strings(["a", "b"])
T1, T2 = dt.datetime(2025, 3, 1, 6, 0, 0), dt.datetime(2025, 3, 2, 6, 0, 0)


def test_raw_json_forms(spark, tmp_path):
    rows = [{"a": "1", "b": "x"}, {"a": "2"}]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "wrapped.json").write_text(json.dumps({"data": rows}))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "wrapped_lines.json").write_text("\n".join(json.dumps({"data": [r]}) for r in rows))
    for name in ("array", "wrapped", "lines", "wrapped_lines"):
        form = {"lines": "lines" in name, "wrapped": "wrapped" in name}
        df = snapshots.read_raw_json(spark, str(tmp_path / f"{name}.json"), SCHEMA, **form)
        assert sorted((r.a, r.b) for r in df.collect()) == [("1", "x"), ("2", None)]


def test_bad_json_raises_or_is_kept(spark, tmp_path):
    path = str(tmp_path / "bad.json")
    (tmp_path / "bad.json").write_text('{"a": "1", "data": "own"}\n{"a": \n')
    schema = all_strings(["a", "data"])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        snapshots.read_raw_json(spark, path, schema, lines=True).collect()
    df = snapshots.read_raw_json(spark, path, schema, lines=True, corrupt="bad").cache()
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "own", None), (None, None, '{"a": ')]
    (tmp_path / "wrapped.json").write_text('{"data": [{"a": "1"}]}\n{"data": \n')
    df = snapshots.read_raw_json(spark, str(tmp_path / "wrapped.json"), schema, True, True, "bad")
    assert sorted(map(tuple, df.collect()), key=str) == [("1", None, None), (None, None, '{"data": ')]


def test_benchmark_formats(spark, tmp_path):
    (tmp_path / "b.csv").write_text("Job Title,salary\nClerk,10\n")
    (tmp_path / "b.json").write_text(json.dumps([{"Job Title": "Clerk", "salary": 10}]))
    for name in ("b.csv", "b.json"):
        row = snapshots.read_benchmark(spark, str(tmp_path / name)).first()
        assert (row["Job Title"], row["salary"]) == ("Clerk", "10")
    with pytest.raises(ValueError):
        snapshots.read_benchmark(spark, "b.xlsx")


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.latest_snapshot(spark, root, "jobs_source") is None
    for stamp, n in ((T1, 1), (T2, 2)):
        df = spark.range(n).selectExpr("string(id) AS a", "'x' AS b")
        assert snapshots.write_processed(df, root, "jobs_source", stamp) == n
        assert snapshots.write_raw(df, root, "raw_source", stamp) == n
    for stamp in ("zzz", "20250303_060000"):  # a malformed name; a write that has not ended
        snapshots.begin_snapshot(spark, root, "jobs_source", stamp)
    df.write.parquet(f"{root}/jobs_source/snapshot_ts=20250303_060000")
    snapshots.commit_snapshot(spark, root, "jobs_source", "zzz", 0)
    assert [s for s, _ in snapshots.list_snapshots(spark, root, "jobs_source")] == [
        "20250301_060000", "20250302_060000", "zzz",
    ]
    late = T2 + dt.timedelta(hours=23)
    assert snapshots.recent_snapshot(spark, root, "jobs_source", late).count() == 2
    assert snapshots.recent_snapshot(spark, root, "jobs_source", T2 + dt.timedelta(hours=24)) is None
    assert snapshots.recent_snapshot(spark, root, "jobs_source", T2 + dt.timedelta(hours=30), 48).count() == 2
    df = snapshots.latest_snapshot(spark, root, "raw_source", SCHEMA)
    assert df.columns == ["a", "b", "snapshot_ts"] and df.count() == 2
    assert {r.snapshot_ts for r in df.collect()} == {"20250302_060000"}


def test_a_rewrite_that_dies_hides_the_snapshot(spark, tmp_path, monkeypatch):
    root, df = str(tmp_path), spark.range(3).selectExpr("string(id) AS a", "'x' AS b")
    for stamp in (T1, T2):
        snapshots.write_processed(df, root, "s", stamp)
    write = snapshots.write_counted

    def dies(df, path, *args):
        write(df.limit(1), path, *args)
        raise OSError("lost")

    monkeypatch.setattr(snapshots, "write_counted", dies)
    with pytest.raises(OSError):
        snapshots.write_processed(df, root, "s", T2)
    assert [s for s, _ in snapshots.list_snapshots(spark, root, "s")] == ["20250301_060000"]
    assert snapshots.latest_snapshot(spark, root, "s").count() == 3
    monkeypatch.setattr(snapshots, "write_counted", write)
    snapshots.write_processed(df, root, "s", T2)
    assert [s for s, _ in snapshots.list_snapshots(spark, root, "s")] == ["20250301_060000", "20250302_060000"]
    log = {(r.source, r.stamp): r.n_rows for r in snapshots.snapshot_log(spark, root).collect()}
    assert log == {("s", "20250301_060000"): 3, ("s", "20250302_060000"): 3}
    # Landed by another tool: known once it is committed.
    df.write.json(snapshots.snapshot_path(root, "other", T1))
    assert snapshots.latest_snapshot(spark, root, "other", SCHEMA) is None
    snapshots.commit_snapshot(spark, root, "other", "20250301_060000", 3)
    assert snapshots.latest_snapshot(spark, root, "other", SCHEMA).count() == 3


def test_no_private_handles():
    import pathlib

    import paygrain

    core = pathlib.Path(paygrain.__file__).parent
    for folder in ("sources", "plans", "operators", "functions"):
        for path in (core / folder).glob("*.py"):
            assert "_jvm" not in path.read_text() and "_jsc" not in path.read_text(), path


def test_sweep_empties_ended_runs_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda spark: str(tmp_path))
    assert session.sweep_scratch(spark) == []
    mine = session.materialize(spark.range(5), "mine")
    folders = {}
    for run in ("ended", "open", "again", "swept"):
        session._log_run(spark, run, "begin")
        folders[run] = f"{tmp_path}/paygrain/run-{run}/table-1"
        spark.range(7).write.parquet(folders[run])
    session._log_run(spark, "ended", "end")
    for event in ("end", "begin"):
        session._log_run(spark, "again", event)
    assert session.sweep_scratch(spark) == ["ended"]
    assert not (tmp_path / "paygrain" / "run-ended" / "table-1").exists()
    assert [spark.read.parquet(folders[r]).count() for r in ("open", "again", "swept")] == [7, 7, 7]
    assert session.sweep_scratch(spark) == [] and mine.count() == 5
    assert session.sweep_scratch(spark, dt.timedelta(hours=1)) == []
    assert session.sweep_scratch(spark, dt.timedelta(0)) == ["again", "open", "swept"]
    assert mine.count() == 5
    session.end_run(spark)
    assert session.sweep_scratch(spark) == [spark.sparkContext.applicationId]
    # Used again after that, the application has a folder once more.
    assert session.materialize(spark.range(3), "later").count() == 3


def test_run_metadata(spark, tmp_path):
    for stage in ("one", "two"):
        snapshots.record_run(spark, str(tmp_path), stage, 5, 4, ["a"], ["x"], T1, {"t": 0.85}, {"k": 1})
    rows = snapshots.read_runs(spark, str(tmp_path)).orderBy("stage").collect()
    assert [r.stage for r in rows] == ["one", "two"]
    assert rows[0].thresholds == {"t": 0.85} and json.loads(rows[0].details) == {"k": 1}


def grid(workbook, sheet, rows):
    return [(workbook, sheet, i, j, v) for i, row in enumerate(rows) for j, v in enumerate(row) if v is not None]


SHEETS = (
    grid("w1", "Data", [[" Top Jobs ", ""], ["as of", "2024"], ["Title", "", " Pay ", "Kind"], ["Clerk", "a", "10 "],
                        ["", " ", ""], ["Typist", None, None], ["x", "y", "z"], ["x", "y", "z"], ["x", "y", "z"]])
    + grid("w1", "Cover", [["Hello"], ["you"]])
    + grid("w2", "Small", [["a", "b"], ["1", "2"], ["3", "4"]])
    + grid("w2", "Blank", [["", ""], [" ", ""]])
)


def test_profile(spark):
    df = spark.createDataFrame(SHEETS, CELLS_SCHEMA)
    got = {r.sheet: (r.data_rows, r.max_column, r.max_row, r.keep) for r in cells.profile_sheets(df).collect()}
    # The second workbook has no sheet that qualifies and keeps all.
    assert got == {"Data": (8, 4, 9, True), "Cover": (2, 1, 2, False), "Small": (3, 2, 3, True), "Blank": (0, 2, 2, True)}


def test_sheet_to_table(spark):
    df = spark.createDataFrame(SHEETS, CELLS_SCHEMA)
    rows = cells.sheet_rows(df)
    table, title = cells.sheet_to_table(rows, "w1", "Data")
    assert title == "Top Jobs" and table.columns == ["Title", "col_1", "Pay", "Kind"]
    assert sorted(map(tuple, table.collect())) == [("Clerk", "a", "10", ""), ("Typist", "", "", "")] + [
        ("x", "y", "z", "")
    ] * 3
    # No row with more than two cells: the first row is the header.
    table, title = cells.sheet_to_table(rows, "w2", "Small")
    assert table.columns == ["a", "b"] and title == "a" and table.count() == 2
    assert cells.sheet_to_table(rows, "w2", "Blank") is None
    assert cells.sheet_rows(df, max_rows=1).where("sheet = 'Data'").count() == 1
    long = spark.createDataFrame(grid("w", "s", [["a", "b", "c"]] + [["1", "2", "3"]] * 1500), CELLS_SCHEMA)
    assert cells.sheet_rows(long).count() == 1500
    twice = spark.createDataFrame(grid("w", "s", [["a", "a", "b"], ["1", "2", "3"]]), CELLS_SCHEMA)
    with pytest.raises(ValueError, match="repeated"):
        cells.sheet_to_table(cells.sheet_rows(twice), "w", "s")


def test_ingest_sheets(spark, tmp_path):
    df, root = spark.createDataFrame(SHEETS, CELLS_SCHEMA), str(tmp_path)
    runs = {r.stage: r for r in ingest_sheets(df, root, T1).collect()}
    assert set(runs) == {"w1/lighthouse_data", "w2/lighthouse_small", "w2/lighthouse_blank"}
    data = runs["w1/lighthouse_data"]
    assert (data.input_rows, data.output_rows, data.columns) == (9, 5, ["Title", "col_1", "Pay", "Kind"])
    assert json.loads(data.details) == {"workbook": "w1", "sheet": "Data", "title": "Top Jobs"}
    assert runs["w2/lighthouse_blank"].output_rows == 0
    table = read_sheet(spark, root, "w1", "Data")
    assert table.columns == ["Title", "col_1", "Pay", "Kind"] and table.count() == 5
    assert read_sheet(spark, root, "w2", "Blank") is None and read_sheet(spark, root, "w1", "Cover") is None


def test_numbered_workbooks_and_stray_cells(spark, tmp_path):
    root = str(tmp_path)
    body = [["Id", "Name", "Pay"], *[[str(i), f"n{i}", "5"] for i in range(40)]]
    rows = grid("007", "Data", body) + grid("7", "Data", [["Id", "Name", "Other"], *[["1", "a", "b"]] * 9])
    rows += [("007", "Data", 5, 16_000, "stray")]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx int, col_idx int, value string")
    sparse, heads = cells.sparse_rows(df)
    sizes = {len(r.filled) for r in sparse.where("workbook = '007'").collect()}
    assert sizes == {3, 4} and heads.where("width = 16001").count() == 1
    runs = {r.stage: r for r in ingest_sheets(df, root, T1).collect()}
    assert len(runs["007/lighthouse_data"].columns) == 16_001 and runs["7/lighthouse_data"].output_rows == 9
    files = list(tmp_path.glob("sheets/snapshot_ts=*/workbook=*/slug=*/*.parquet"))
    assert len(files) == 2 and sum(f.stat().st_size for f in files) < 20_000
    table = read_sheet(spark, root, "007", "Data")
    assert len(table.columns) == 16_001 and table.columns[:4] == ["Id", "Name", "Pay", "col_3"]
    got = table.select("Id", "col_3", "col_16000").where("col_16000 <> ''").collect()
    assert [tuple(r) for r in got] == [("4", "", "stray")]
    assert table.count() == 40 and read_sheet(spark, root, "7", "Data").columns[2] == "Other"
    odd = ['"', "\\", "a\tb\nc", "{}", "é漢", "null", "1.50", "NaN"]
    ingest_sheets(spark.createDataFrame(grid("odd", "Data", [[f"c.{j}" for j in range(8)], *[odd] * 9]), df.schema), root, T2)
    got = read_sheet(spark, root, "odd", "Data")
    assert got.columns == [f"c.{j}" for j in range(8)] and {tuple(r) for r in got.collect()} == {tuple(odd)}
    assert read_sheet(spark, root, "07", "Data") is None


def test_many_sheets_share_files(spark, tmp_path):
    root, count = str(tmp_path), sheets.OWN_FILES + 200
    body = [["Id", "Name", "Pay"], *[[str(i), f"n{i}", ""] for i in range(6)]]
    rows = [r for k in range(count) for r in grid(f"{k:04d}", "Data", body)] + grid("0007", "Cover", [["x"]])
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx int, col_idx int, value string")
    runs = ingest_sheets(df, root, T1)
    assert runs.count() == count and runs.where("output_rows = 6 AND input_rows = 7").count() == count
    # Files grow with the rows, not with the sheets.
    assert len(list(tmp_path.glob("sheets/**/*.parquet"))) < 50
    table = read_sheet(spark, root, "0007", "Data")
    assert table.columns == ["Id", "Name", "Pay"]
    assert sorted(map(tuple, table.collect())) == [(str(i), f"n{i}", "") for i in range(6)]
    assert read_sheet(spark, root, "7", "Data") is None and read_sheet(spark, root, "0007", "Cover") is None


def test_landed_lines_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(snapshots.JSON_OPTIONS, "maxRecordsPerFile", 1_000)
    root, n = str(tmp_path), 5_000
    df = spark.range(0, n, 1, 2).selectExpr("CAST(id AS STRING) AS a", "concat('é \"', id % 7, '\\n') AS data")
    assert snapshots.write_raw(df, root, "raw_source", T1) == n
    files = list(tmp_path.glob("raw_source/snapshot_ts=*/*.json*"))
    lines = df.selectExpr("sum(octet_length(to_json(struct(*))) + 1) AS size").first().size
    assert sum(f.stat().st_size for f in files) * 3 < lines
    # A packed file is read by one task, so its rows are bounded.
    assert len(files) >= n / 1_000
    back = snapshots.latest_snapshot(spark, root, "raw_source", df.schema).drop("snapshot_ts")
    assert back.exceptAll(df).isEmpty() and back.count() == n
