from __future__ import annotations

import io
import json
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snaploom.sources.records import records
from snaploom.sources import external, files, workbook
from snaploom.sources.contracts import Contract, ContractError, validated_csv


@pytest.mark.parametrize(
    ("header", "problem"),
    [(["A", "A"], "repeated"), (["A"], "missing"), (["A", "B", "C"], "unexpected"), ([], "no header"), (["A", "b", "B"], "repeated"), (["A", "B"], None), (["A", "b", "_id"], None)],
)
def test_headers(header, problem):
    contract = Contract(("A", "B"), ignored=("_id",), aliases={"b": "B"}, extra_allowed=False)
    if problem:
        with pytest.raises(ContractError, match=problem):
            contract.names(header)
    else:
        assert [n for n in contract.names(header) if n] == ["A", "B"]


def test_order_counts_where_it_is_given(tmp_path):
    told = tmp_path / "c.json"
    told.write_text(json.dumps({"required_columns": ["A"], "ordered_columns": ["A", "B"]}))
    with pytest.raises(ContractError, match="order"):
        Contract.load(told).names(["B", "A"])
    told.write_text("{}")
    with pytest.raises(ContractError):
        Contract.load(told)


def test_csv_keeps_numbers_blanks_quotes_and_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes('﻿A,_id,b\n1,9,"say ""hi"", \nthere"\n,8,\n"",7,z\n'.encode())
    df = validated_csv(spark, path, Contract(("A", "B"), ignored=("_id",), aliases={"b": "B"}))
    assert [tuple(r) for r in df.collect()] == [(2, "1", 'say "hi", \nthere'), (3, "", ""), (4, "", "z")]
    path.write_text("A,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="malformed record 3"):
        validated_csv(spark, path, Contract(("A", "B"), aliases={"b": "B"})).collect()


def test_download_falls_back_and_is_verified(tmp_path):
    (tmp_path / "s.toml").write_text('[sources.a]\nurls = ["http://one", "http://two?x-amz-date=1&k=2"]\nleast_bytes = 3\n')
    spec = files.load_specs(tmp_path / "s.toml")[0]
    body = {"http://one": b"x", spec.urls[1]: b"hello"}
    got = files.fetch(spec, tmp_path / "raw", lambda u: io.BytesIO(body[u]))
    assert got["url"] == "http://two?k=2" and got["bytes"] == 5
    files.verify(got["path"], got)
    with pytest.raises(files.SourceError):
        files.verify(got["path"], got | {"sha256": "0"})
    with pytest.raises(files.SourceError, match="MD5"):
        files.fetch(spec, tmp_path / "raw", lambda u: io.BytesIO(b"hello"), expected_md5="0")
    assert len(list((tmp_path / "raw").iterdir())) == 1
    first = files.stable_manifest([got | {"retrieved_at": "1"}])
    assert files.stable_manifest([got | {"retrieved_at": "2"}], first) == first


def test_canonical_json_and_writing_at_once(tmp_path):
    assert files.canonical_json({"b": 1, "a": "é"}) == '{"a":"é","b":1}'
    assert files.digest({"b": 1, "a": 2}) == files.digest({"a": 2, "b": 1})
    with pytest.raises(ValueError):
        files.canonical_json(float("nan"))
    files.write_at_once(tmp_path / "o", files.canonical_json([1], pretty=True))
    assert (tmp_path / "o").read_text() == "[\n  1\n]\n" and len(list(tmp_path.iterdir())) == 1


def test_ledgers(spark, tmp_path):
    rows = [(3, "removed", [1], [2]), (1, "retained", None, None), (2, "retained", None, None), (4, "retained", None, None)]
    d = spark.createDataFrame(rows, "source_index bigint, decision string, matched array<bigint>, retained array<bigint>")
    assert sorted(r.source_index for r in files.review_ledger(d).collect()) == [1, 2, 3]
    files.write_ledger(d, str(tmp_path / "l"))
    lines = [json.loads(x) for p in sorted((tmp_path / "l").glob("part-*")) for x in p.read_text().splitlines()]
    assert [x["source_index"] for x in lines] == [1, 2, 3, 4] and lines[0]["matched"] is None


def _book(path, cells):
    sheet = "".join(f'<c r="{at}"{kind}>{body}</c>' for at, kind, body in cells)
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Table B" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Name</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData><row>{sheet}</row></sheetData></worksheet>")


def test_workbook_grid_and_cross_foot(spark, tmp_path):
    path = tmp_path / "b.xlsx"
    _book(path, [("A1", ' t="s"', "<v>0</v>"), ("B2", "", "<v>1</v>"), ("C2", "", "<v>2</v>"), ("D2", "", "<f>B2+C2</f><v>3</v>"), ("B3", ' t="inlineStr"', "<is><t>-</t></is>"), ("C3", "", "<v>5</v>"), ("D3", "", "<v>6</v>"), ("B4", "", "<v>1</v>"), ("C4", "", "<v>7</v>"), ("AA9", "", "<f>B2</f>")])
    g = workbook.grid(spark, path, "Table B")
    got = {r.cell: (r.row, r.col, r.value, r.is_formula) for r in g.collect()}
    assert got["A1"] == (1, 1, "Name", False) and got["AA9"] == (9, 27, None, True) and got["D2"][3]
    assert [tuple(r) for r in workbook.cross_foot(g, (2, 3), (2, 3), 4, 4).collect()] == [("row", 3, 5, 6)]
    with pytest.raises(workbook.WorkbookError):
        workbook.cells(path, "Other")
    (tmp_path / "no.xlsx").write_text("x")
    with pytest.raises(workbook.WorkbookError):
        workbook.cells(tmp_path / "no.xlsx", "Table B")


def test_pages():
    book = {None: {"records": [{"id": "a"}], "offset": "1"}, "1": {"records": [{"id": "b"}]}}
    assert [r["id"] for r in external.pages(book.__getitem__)] == ["a", "b"]
    for bad in ({"records": [{"id": "a"}]}, {"records": [{"id": "c"}], "offset": "1"}, {"records": [], "offset": "2"}, {}):
        with pytest.raises(external.ExternalError):
            list(external.pages((book | {"1": bad}).__getitem__))


def test_page_folder_source(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.json").write_text(json.dumps({"records": [{"id": f"r{n}", "fields": {"a": n, "b": "x", "c": None}}]}))
    external.register(spark)
    got = spark.read.format("page_folder").load(str(tmp_path)).orderBy("id")
    assert [(r.id, r.fields) for r in got.collect()] == [(f"r{n}", {"a": str(n), "b": "x", "c": None}) for n in range(3)]


def test_writer_compares_and_sets():
    table = {f"r{i}": {"v": i} for i in range(25)}
    calls = Counter()

    def patch(rows):
        calls["patch"] += 1
        if calls["patch"] == 1:
            raise OSError("again")
        assert len(rows) <= 10
        for k, v in rows.items():
            table[k].update(v)

    w = external.Writer(read=lambda ids: {i: dict(table[i]) for i in ids}, patch=patch, sleep=lambda s: None)
    updates = [external.Update(f"r{i}", {"v": i}, {"v": -i}) for i in range(25)]
    assert w.apply(updates) == {"written": 24, "already_current": 1}
    assert w.apply(updates) == {"written": 0, "already_current": 25}
    table["r3"]["v"] = 99
    with pytest.raises(external.ConflictError) as e:
        w.apply(updates)
    assert e.value.ids == ["r3"]
    with pytest.raises(external.ExternalError):
        w.apply([updates[0], updates[0]])


def test_streams(spark, tmp_path):
    from snaploom.streaming import snapshots

    rows = spark.range(40).select((F.col("id") % 8).alias("key"), F.timestamp_seconds(F.col("id") * 600).alias("at"), F.col("id").alias("value"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    snapshots.newest_rows(stream, str(tmp_path / "out"), str(tmp_path / "c"), "key", "at", "value").awaitTermination(120)
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out").iterdir())
    assert sorted((r.key, r.value) for r in spark.read.parquet(str(tmp_path / f"out/version={last}")).collect()) == [(k, 32 + k) for k in range(8)]
    for name, df in (("once", snapshots.without_repeats(stream, ["key"], "at")), ("counts", snapshots.window_counts(stream, "at", ["key"]))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert spark.table("once").select("key").distinct().count() == spark.table("once").count() == 8
    assert spark.table("counts").agg(F.max("n")).first()[0] >= 1


def test_records_span_splits_of_a_file(spark, tmp_path):
    want = ['a,"b', "x" * 50, '"', "", 'plain,"with ""doubled"" quotes, and\n\nlines"', "é,ü", 'c,"' + "\n".join(["line"] * 40) + '"', "last"]
    want[0:3] = [want[0] + "\n" + want[1] + "\n" + want[2]]
    (tmp_path / "one.csv").write_text("\n".join(want), encoding="utf-8")
    (tmp_path / "two.csv").write_bytes("p,q\r\nr,\"s\r\nt\"\r\n".encode())
    (tmp_path / "three.csv").write_text("")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    for size in ("20b", "77b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        got = records(spark, str(tmp_path)).orderBy("file", "physical_line").collect()
        assert [r.raw_line for r in got if r.file.endswith("one.csv")] == want
        assert [(r.physical_line, r.raw_line) for r in got if r.file.endswith("two.csv")] == [(1, "p,q"), (2, 'r,"s\r\nt"')]
        assert [r.physical_line for r in got if r.file.endswith("one.csv")] == [1, 4, 5, 8, 9, 49]
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_creates_are_acknowledged_and_never_sent_twice():
    sent, waits = [], []

    def post(rows):
        sent.append(rows)
        if len(sent) == 1:
            raise external.RateLimited(7)
        return {f"rec{r['key']}": dict(r) for r in rows}

    writer = external.Writer(lambda ids: {}, lambda rows: None, batch=2, sleep=waits.append, post=post, allowed=frozenset({"key", "n"}))
    assert writer.create([{"key": "a", "n": 1}, {"key": "b", "n": 2}, {"key": "c", "n": 3}], "key") == {"a": "reca", "b": "recb", "c": "recc"}
    assert waits[0] == 7 and len(sent) == 3
    for rows in ([{"key": "a"}, {"key": "a"}], [{"n": 1}], [{"key": "a", "other": 1}]):
        with pytest.raises(external.ExternalError):
            writer.create(rows, "key")

    def lost(rows):
        sent.append(rows)
        raise OSError

    n = len(sent)
    with pytest.raises(external.AmbiguousWrite) as error:
        external.Writer(None, None, post=lost).create([{"key": "a"}], "key")
    assert error.value.names == ["a"] and len(sent) == n + 1
    for answer in ({}, {"x": {"key": "b"}}, {"x": {"key": "a", "n": 2}}):
        with pytest.raises(external.NotAcknowledged):
            external.Writer(None, None, post=lambda rows, answer=answer: answer, sleep=waits.append).create([{"key": "a", "n": 1}], "key")
    with pytest.raises(external.NotAcknowledged):
        external.Writer(lambda ids: {"a": {"n": 1}}, lambda rows: {"a": {"n": 3}}, sleep=waits.append).apply([external.Update("a", {"n": 1}, {"n": 2})])
    with pytest.raises(external.ExternalError):
        external.Writer(lambda ids: {"b": {}}, None).read_one("a")


def test_waiting_times_and_schemas():
    assert [external.retry_after(t, 0) for t in (None, "", "3", "1.5", "soon", "Thu, 01 Jan 1970 00:01:00 GMT")] == [None, None, 3, 1.5, None, 60]
    fields = [{"id": "f1", "name": "A", "type": "text"}, {"id": "f2", "name": "B", "type": "number"}]
    assert set(external.checked_schema(fields, {"f2": "number"})) == {"f1", "f2"}
    for bad, managed in ((fields, {"f3": "text"}), (fields, {"f1": "number"}), ([*fields, fields[0]], {})):
        with pytest.raises(external.SchemaChanged):
            external.checked_schema(bad, managed)


def test_compliance_lines_tell_what_is_wrong(spark):
    from snaploom.sources import compliance

    lines = ["Jurisdiction,Cycle,Status,Updated", "", " ,,", '"Elk Grove",6th cycle,In,2024-05-01 10:00', "Élk Grove,7,Out,", "Fort, Old,6th,In,5/1/2024", "Y,8,Perhaps,soon"]
    rows = compliance.compliance_rows(spark.createDataFrame([(x,) for x in lines], "line string"), "line", {"IN": "in", "OUT": "out"})
    got = {(r.key, r.cycle, r.status, str(r.updated), tuple(r.problems)) for r in rows.collect()}
    assert got == {("ELK GROVE", 6, "in", "2024-05-01", ("repeated name",)), ("ELK GROVE", 7, "out", "None", ("repeated name",)), ("FORT", None, None, "None", ("columns", "cycle", "status", "updated")), ("Y", None, None, "None", ("cycle", "status", "updated"))}
    assert compliance.within(rows, 1, 5).count() == 4
    with pytest.raises(Exception, match="unlikely number"):
        compliance.within(rows, 5, 9).collect()
