"""Landed files that are pruned before they are read, and streamed as they are."""

import hashlib
import io
import os
import zipfile
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from quillstone.sources import catalogue, incremental, readers

OLD, NEW = datetime(2024, 1, 5, tzinfo=UTC), datetime(2024, 2, 5, 12, 30, tzinfo=UTC)


@pytest.fixture
def folder(tmp_path):
    def write(name, data, when=NEW):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(data if isinstance(data, bytes) else data.encode())
        os.utime(path, (when.timestamp(),) * 2)
        return str(path)

    write("a/old.csv", "ID,Name\n1,old\n", OLD)
    write("a/new.csv", 'ID,Name,Note\n2," new ","two\r\nlines, ""quoted"""\n3,short\n\n4,long,x,extra\n')
    write("a/_SUCCESS", "")
    write("a/.hidden.csv", "ID\n9\n")
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x/one.csv", "id;name\n5;é\n6;f\n".encode("cp1252"))
        z.writestr("two.CSV", 'id,name\n7,"g\nh"\n')
        z.writestr("readme.md", "no table")
    write("a/some.zip", archive.getvalue())
    book = io.BytesIO()
    cells = lambda *xs: "<row>" + "".join(f'<c r="{r}" t="{t}"><v>{v}</v></c>' for r, t, v in xs) + "</row>"
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{incremental.SHEET[1:-1]}"><si><t>Name</t></si><si><r><t>in</t></r><r><t>k</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{incremental.SHEET[1:-1]}"><sheetData>{cells(("A1", "n", "ID"), ("C1", "s", "0"))}{cells(("A2", "n", "8"), ("C2", "s", "1"))}<row/>{cells(("B4", "n", "9"))}</sheetData></worksheet>')
    write("a/book.xlsx", book.getvalue())
    return tmp_path / "a"


def rows_of(df):
    return sorted(((r["path"].rsplit("/", 1)[1], r["member"], r["place"], r["row"]) for r in df.collect()), key=str)


def test_all_forms(spark, folder):
    want = [
        ("book.xlsx", None, 0, {"id": "8", "col_1": "", "name": "ink"}), ("book.xlsx", None, 1, {"id": "", "col_1": "9", "name": ""}), ("new.csv", None, 0, {"id": "2", "name": "new", "note": 'two\r\nlines, "quoted"'}),
        ("new.csv", None, 1, {"id": "3", "name": "short", "note": ""}), ("new.csv", None, 2, {"id": "4", "name": "long", "note": "x"}), ("old.csv", None, 0, {"id": "1", "name": "old"}),
        ("some.zip", "two.CSV", 0, {"id": "7", "name": "g\nh"}), ("some.zip", "x/one.csv", 0, {"id": "5", "name": "é"}), ("some.zip", "x/one.csv", 1, {"id": "6", "name": "f"}),
    ]
    df = incremental.landed(spark, str(folder))
    assert rows_of(df) == sorted(want, key=str)
    assert df.rdd.getNumPartitions() == 5  # one for each file, and for each table of the archive
    assert {r["modified"].timestamp() for r in df.select("modified").distinct().collect()} == {OLD.timestamp(), NEW.timestamp()}


def test_the_cursor_prunes_in_planning(spark, folder):
    for since, files in ((NEW, 4), (datetime(2024, 2, 5, 12, 30, 1, tzinfo=UTC), 0), (OLD, 5)):
        df = incremental.landed(spark, str(folder), since=since)
        assert df.rdd.getNumPartitions() == max(files, 1) and len({x[:2] for x in rows_of(df)}) == files and ("old.csv" in {x[0] for x in rows_of(df)}) == (since == OLD)
    plan = incremental.landed(spark, str(folder), since=NEW)._jdf.queryExecution().executedPlan().toString()
    assert "modified" in plan.split("landed_files", 1)[1] and "Filter (modified" not in plan  # what is pushed is not tested again
    assert incremental.landed(spark, str(folder)).filter("member = 'two.CSV'").rdd.getNumPartitions() == 1
    odd = incremental.landed(spark, str(folder)).filter("row['id'] = '7'")
    assert rows_of(odd) == [("some.zip", "two.CSV", 0, {"id": "7", "name": "g\nh"})]


def test_limit_clears_the_cursor(spark, folder):
    df = incremental.landed(spark, str(folder), since=datetime(2030, 1, 1, tzinfo=UTC), limit=4)
    assert [x[:3] for x in rows_of(df)] == [("book.xlsx", None, 0), ("book.xlsx", None, 1), ("new.csv", None, 0), ("new.csv", None, 1)]
    assert incremental.landed(spark, str(folder), limit=0).count() == 0 and incremental.landed(spark, str(folder), limit=99).count() == 9


def test_files_read_before_are_skipped(spark, folder, tmp_path):
    seen = tmp_path / "seen.txt"
    seen.write_text("".join(hashlib.sha256((folder / n).read_bytes()).hexdigest() + "\n" for n in ("old.csv", "some.zip")))
    assert {x[0] for x in rows_of(incremental.landed(spark, str(folder), seen=str(seen)))} == {"book.xlsx", "new.csv"}


def test_dates_in_paths_and_agreement_with_the_table_reader(spark, tmp_path):
    rows = spark.range(500).select(F.concat(F.lit("2024-03-0"), F.col("id") % 5 + 1).alias("day"), F.col("id").cast("string").alias("id"), F.concat(F.lit('a "b", \n'), F.col("id")).alias("text"))
    rows.write.partitionBy("day").options(header=True, quoteAll=True, escape='"').csv(f"{tmp_path}/t")
    df = incremental.landed(spark, f"{tmp_path}/t", since=datetime(2024, 3, 4, tzinfo=UTC), dated=r"day=(\d{4}-\d{2}-\d{2})")
    got = sorted((int(r["row"]["id"]), r["row"]["text"]) for r in df.collect())
    assert got == [(i, f'a "b", \n{i}') for i in range(500) if i % 5 + 1 >= 4]
    plain = readers.read_table(spark, f"{tmp_path}/t/day=2024-03-04")
    assert sorted((int(r["id"]), r["text"]) for r in plain.collect()) == [x for x in got if x[0] % 5 == 3]


def test_rows_stream(tmp_path):
    """A member of many rows passes in batches; no more than one is held."""
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        with z.open("big.csv", "w", force_zip64=True) as out:
            out.write(b"id,text\n")
            for i in range(200_000):
                out.write(b'%d,"%s"\n' % (i, b"x" * 100))
    import tracemalloc

    reader = incremental.LandedReader({"path": str(tmp_path)})
    (part,) = reader.partitions()
    tracemalloc.start()
    sizes = [b.num_rows for b in reader.read(part)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 200_000 and max(sizes) == incremental.ROWS and peak < 12 << 20


def test_a_source_since_its_last_run(spark, tmp_path):
    for day, (when, text) in {"1": (OLD, "licencersn,businessname,status\n1,A,Issued\n"), "2": (NEW, "licencersn,businessname,status\n2,B,Issued\n")}.items():
        (tmp_path / f"{day}.csv").write_text(text)
        os.utime(tmp_path / f"{day}.csv", (when.timestamp(),) * 2)
    runs = spark.createDataFrame([("vancouver", "COMPLETED", datetime(2024, 1, 20)), ("vancouver", "FAILED", datetime(2024, 3, 1)), ("calgary", "COMPLETED", datetime(2024, 3, 1))], "source_key string, run_status string, completed_at timestamp")
    ids = lambda **more: sorted(r["source_record_id"] for r in catalogue.read_since(spark, "vancouver", str(tmp_path), **more).collect())
    assert ids(runs=runs) == ["2"] and ids() == ["1", "2"] and ids(runs=runs.limit(0)) == ["1", "2"] and ids(runs=runs, limit=1) == ["1"]
    plain = {r["source_record_id"]: r for r in catalogue.read(spark, "vancouver", str(tmp_path)).collect()}
    assert {r["source_record_id"]: r for r in catalogue.read_since(spark, "vancouver", str(tmp_path)).collect()} == plain
    with pytest.raises(ValueError):
        catalogue.read_since(spark, "bc_indigenous", str(tmp_path))
