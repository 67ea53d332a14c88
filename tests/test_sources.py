import csv
import io
import os

import pytest
from pyspark.sql import functions as F

from balcao import vocab
from balcao.sources import grids, hr_files, latest, lines, snapshots, staging
from balcao.sources.records import scan_records
from tests.conftest import rows


def write(folder, name, content, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
    return path


@pytest.fixture
def small_splits(spark):
    """Cut text files into many splits, as large files are."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_are_numbered_across_splits(spark, tmp_path, small_splits):
    for n, count in enumerate((400, 3, 0, 57)):
        write(tmp_path, f"a b+{n}%.csv", "".join(f"line {i} {'x' * (i % 40)}\n" for i in range(count)))
    found = lines.read_lines(spark, str(tmp_path), "*.csv")
    assert found.select(F.spark_partition_id()).distinct().count() > 5
    by_file = {}
    for r in found.collect():
        by_file.setdefault(os.path.basename(r.file), []).append((r.row_idx, bytes(r.raw).decode()))
    assert {f: len(v) for f, v in by_file.items()} == {"a b+0%.csv": 400, "a b+1%.csv": 3, "a b+3%.csv": 57}
    for found_lines in by_file.values():
        assert sorted(found_lines) == [
            (i, f"line {i} {'x' * (i % 40)}") for i in range(len(found_lines))
        ]


def records_of(spark, folder, **options):
    cells, facts = scan_records(spark, str(folder), "*.csv", **options)
    by_file = {}
    for r in cells.collect():
        by_file.setdefault(os.path.basename(r.file), []).append((r.row_idx, list(r.cells)))
    return {f: [c for _, c in sorted(v)] for f, v in by_file.items()}, {
        os.path.basename(r.file): r for r in facts.collect()
    }


@pytest.mark.parametrize("chunk", [2, 10**6])
def test_records_with_quotes_and_line_breaks(spark, tmp_path, chunk):
    write(tmp_path, "q.csv", 'a;b;c\n"x;1";"line 1\nline 2\n\nline 4";"say ""hi"""\n\n"";2;\n1;"y\nz";3\n')
    write(tmp_path, "plain.csv", "a,b\r\n1,\r\n,2\r\n")
    write(tmp_path, "open.csv", 'a;b\n"never closed;1\n2;3\n')
    found, facts = records_of(spark, tmp_path, chunk_rows=chunk)
    assert found["q.csv"] == [
        ["a", "b", "c"],
        ["x;1", "line 1\nline 2\n\nline 4", 'say "hi"'],
        [""],
        ["", "2", ""],
        ["1", "y\nz", "3"],
    ]
    assert found["plain.csv"] == [["a", "b"], ["1", ""], ["", "2"]]
    # Never closed: no records, and the facts say so.
    assert "open.csv" not in found
    assert {f for f, r in facts.items() if r.is_open} == {"open.csv"}


@pytest.mark.parametrize("chunk", [2, 10**6])
def test_quotes_inside_cells_are_ordinary_characters(spark, tmp_path, chunk):
    texts = {
        "odd.csv": 'a;b\nLOJA 32" TV;1\nx;2\n',
        "even.csv": 'a;b\nTV 32";1\nx;2\nTV 19";3\ny;4\n',
        "mixed.csv": 'p"q;"r ""s""; t";u"\n"v\nw"x;""\n;"";"a"b"c;"d\n""e";f\n',
        "cells.csv": ";".join(f'"c;{i}"' for i in range(2000)) + "\n" + '""""\n" "\n',
    }
    for name, text in texts.items():
        write(tmp_path, name, text)
    found, facts = records_of(spark, tmp_path, delimiter=";", chunk_rows=chunk)
    assert not any(r.is_open for r in facts.values())
    for name, text in texts.items():
        assert found[name] == [r or [""] for r in csv.reader(io.StringIO(text, newline=""), delimiter=";")]


def test_a_record_of_very_many_quoted_cells(spark, tmp_path):
    write(tmp_path, "wide.csv", ";".join(f'"{i}"' for i in range(20_000)) + "\nx\n")
    found, _ = records_of(spark, tmp_path, delimiter=";")
    assert found["wide.csv"] == [[str(i) for i in range(20_000)], ["x"]]


def test_record_numbers_count_records_not_lines(spark, tmp_path):
    write(tmp_path, "q.csv", '"a\nb"\n\nx\n"c\nd";e\ny\n')
    cells, _ = scan_records(spark, str(tmp_path), "*.csv", ";", chunk_rows=2)
    assert sorted((r.row_idx, r.cells[0]) for r in cells.collect()) == [
        (0, "a\nb"),
        (1, ""),
        (2, "x"),
        (3, "c\nd"),
        (4, "y"),
    ]


def test_encoding_and_delimiter_are_found_per_file(spark, tmp_path):
    write(tmp_path, "latin.csv", "São;Pão\n1,5;25\n", "latin1")
    write(tmp_path, "utf.csv", "São,Pão\n1;2,3\n")
    write(tmp_path, "bom.csv", b"\xef\xbb\xbfS\xc3\xa3o,b\n1,2\n")
    write(tmp_path, "late.csv", "a,b\n" + "," * 2100 + "\n" + ";" * 9000 + "\n")
    write(tmp_path, "tie.csv", "a;b,c\n")
    found, facts = records_of(spark, tmp_path)
    assert found["latin.csv"][0] == ["São", "Pão"]
    assert found["utf.csv"][0] == ["São", "Pão"]
    assert found["bom.csv"][0] == ["São", "b"]
    assert {f: r.delimiter for f, r in facts.items()} == {
        "latin.csv": ";",
        "utf.csv": ",",
        "bom.csv": ",",
        "late.csv": ",",
        "tie.csv": ",",
    }


def test_grid_headers_resolve_per_file(spark, tmp_path):
    write(tmp_path, "a.csv", "title\n\n Code   name ;;Value\n1;x;2\n;;\n")
    write(tmp_path, "b.csv", "t\n\nValue;code name\n9;8\n")
    sheet = grids.with_header(grids.scan_grids(spark, str(tmp_path)).cells, 2, ("code name", "value"))
    found = sheet.select(
        grids.cell("code name").alias("code"),
        grids.cell("unnamed: 1").alias("second"),
        grids.cell("value").alias("value"),
        grids.cell("absent").alias("absent"),
    )
    assert rows(found) == sorted([("1", "x", "2", None), (None, None, None, None), ("8", None, "9", None)], key=repr)


HEAD = "CPF;Nome;Cargo atual;Cidade;Sexo;Deficiência;País de nascimento;Data de nascimento;Idade;Data de admissão;Data de desligamento;Salário atual"


def staff_line(cpf, name, city="X", sep=";"):
    return sep.join([cpf, name, "GERENTE", city, "F", "N", "BR", "1/1/90", "30", "1/1/20", "", "1"])


def test_hr_folder(spark, tmp_path):
    write(tmp_path, "COLABORADORES - 07.csv", f"{HEAD};Email\n{staff_line('012', 'José')}; a@b \n", "latin1")
    reordered = ",".join(reversed(HEAD.split(";")))
    line = ",".join(reversed(staff_line("2", '"Bia\n""B"""').split(";")))
    write(tmp_path, "Colaboradores-3 x.CSV", b"\xef\xbb\xbf" + f"{reordered}\n\n{line}\n".encode())
    write(tmp_path, "colaboradores -  12.csv", f"Centro de custo;{HEAD}\nM;{staff_line('nan', 'Caio', 'NULL')}\nM;4;D\n")
    write(tmp_path, "COLABORADORES - 1.csv", "")
    write(tmp_path, "COLABORADORES - 2.csv", f"{HEAD}\n\n")
    write(tmp_path, "COLABORADORES - 4.csv", f"{HEAD}\n{staff_line('1', 'A')};extra\n")
    write(tmp_path, "COLABORADORES - 5.csv", f'{HEAD}\n{staff_line("1", chr(34) + "A")}\n')
    write(tmp_path, "outros.csv", f"{HEAD}\n{staff_line('1', 'A')}\n")
    write(tmp_path, "COLABORADORES - 6.txt", "ignored")
    scan = hr_files.scan_hr_folder(spark, str(tmp_path))
    assert scan.staff.columns == list(vocab.HR_COLUMNS)
    assert rows(scan.staff, "Filial", "CPF", "Nome", "e-mail", "Cidade") == [
        (12, "4", "D", "", None),
        (12, None, "Caio", "", None),
        (3, "2", 'Bia\n"B"', "", "X"),
        (7, "012", "José", "a@b", "X"),
    ]
    assert rows(scan.rejected, "label", "reason") == [
        ("COLABORADORES - 1.csv", "empty"),
        ("COLABORADORES - 2.csv", "empty"),
        ("COLABORADORES - 4.csv", "row wider than header"),
        ("COLABORADORES - 5.csv", "unpaired quotes"),
        ("outros.csv", "no branch in name"),
    ]
    exported = rows(hr_files.hr_export(scan.staff), "Filial", "Nome", "Data de desligamento")
    assert ("3", "Bia 'B'", "") in exported


def test_latest_report(spark, tmp_path):
    for n, (name, when) in enumerate([("a.csv", 100), ("b.csv", 300), ("c.csv", 200), ("z.txt", 900)]):
        path = write(tmp_path, name, str(n))
        os.utime(path, (when, when))
    write(tmp_path, "d.csv/part-00000.csv", "1")
    os.utime(tmp_path / "d.csv" / "part-00000.csv", (250, 250))
    files = lines.list_files(spark, str(tmp_path), "*.csv")
    assert latest.latest_reports(files).first()["report"].endswith("/b.csv")
    assert latest.latest_reports(files.where("false")).first() is None
    per = files.withColumn("kind", F.when(F.col("label") == "b.csv", "x").otherwise("y"))
    found = {r.kind: os.path.basename(r.report) for r in latest.latest_reports(per, "kind").collect()}
    assert found == {"x": "b.csv", "y": "d.csv"}


def test_snapshots(spark, tmp_path, frame):
    folder = str(tmp_path / "calc")
    df = frame("b string, a double", ("x", 1.0))
    assert snapshots.write_snapshot(df, folder, "2026-03-01", ["a", "missing", "b"])
    newer = df.withColumn("a", F.lit(2.0))
    assert snapshots.write_snapshot(newer, folder, "2026-03-02", ["a", "missing", "b"])
    current = snapshots.latest_snapshot(spark, folder)
    assert current.columns == ["a", "missing", "b"] and rows(current) == [(2.0, None, "x")]
    assert snapshots.write_snapshot(current.withColumn("a", F.lit(3.0)), folder, "2026-03-03")
    assert rows(snapshots.latest_snapshot(spark, folder)) == [(3.0, None, "x")]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        snapshots.write_snapshot(df, folder, "2026-03-03")


def test_empty_results_replace_nothing(spark, tmp_path, frame):
    full = frame("a string", ("x",))
    empty = full.where("a = 'y'")
    folder = str(tmp_path / "t")
    assert snapshots.write_snapshot(full, folder, "1")
    assert not snapshots.write_snapshot(empty, folder, "2")
    with pytest.raises(snapshots.EmptyOutput):
        snapshots.write_snapshot(empty, folder, "3", if_empty="fail")
    assert rows(snapshots.latest_snapshot(spark, folder)) == [("x",)]
    cleared = snapshots.latest_snapshot(spark, folder, even_if_empty=True)
    assert cleared.columns == ["a"] and cleared.isEmpty()


def test_newest_snapshot_is_the_last_written_whatever_its_name(spark, tmp_path, frame):
    folder = str(tmp_path / "t")
    for name in ("9", "10", "r9", "r10", "001"):
        assert snapshots.write_snapshot(frame("a string", (name,)), folder, name)
        assert rows(snapshots.latest_snapshot(spark, folder)) == [(name,)]
        assert rows(snapshots.latest_snapshot(spark, folder, even_if_empty=True)) == [(name,)]
    with pytest.raises(ValueError, match="name"):
        snapshots.write_snapshot(frame("a string", ("x",)), folder, "a/b")


def test_snapshots_keep_the_order_of_rows(spark, tmp_path, frame):
    df = frame("a int, b string", *[(i, f"x{99 - i}") for i in range(100)])
    snapshots.write_snapshot(df.repartition(7).orderBy(F.desc("a")), str(tmp_path / "t"), "1")
    found = snapshots.latest_snapshot(spark, str(tmp_path / "t"), with_order=True)
    assert [r.a for r in sorted(found.collect(), key=lambda r: r.row_idx)] == list(range(99, -1, -1))


def test_files_too_short_for_their_header_are_reported(spark, tmp_path):
    write(tmp_path, "a.csv", "t\n\ncode;value\n1;2\n")
    write(tmp_path, "b.csv", "t\n")
    cells = grids.scan_grids(spark, str(tmp_path)).cells
    assert rows(grids.with_header(cells, 2).select("row_idx")) == [(3,)]
    with pytest.raises(Exception, match="missing columns code in .*b.csv"):
        grids.with_header(cells, 2, ("code",)).collect()


def test_grids_that_never_close_a_cell_are_rejected(spark, tmp_path):
    write(tmp_path, "a.csv", 'x;"y\nz\n')
    write(tmp_path, "b.csv", "1;2\n")
    scan = grids.scan_grids(spark, str(tmp_path))
    assert rows(scan.rejected, "label", "reason") == [("a.csv", "unpaired quotes")]
    assert rows(scan.cells, "cells") == [(["1", "2"],)]


def test_blank_missing(frame):
    df = frame("a double, b string", (float("nan"), None), (float("-inf"), "x"), (1.5, ""))
    assert rows(snapshots.blank_missing(df)) == [("", ""), ("", "x"), ("1.5", "")]


def test_staged_tables_live_in_the_checkpoint_folder(spark, frame):
    table = staging.staged(frame("a int", (1,), (2,)), "t")
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert all(folder in f for f in table.inputFiles())
    assert rows(table) == [(1,), (2,)]
