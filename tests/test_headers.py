"""CSV files whose headers differ, by the names of each."""

import pytest

from millrace.sources import captured


@pytest.mark.parametrize("broadcast", [0, 20_000])
def test_every_file_by_its_own_names(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(captured, "HEADERS", broadcast)
    files = {
        "a.csv": 'id,name,pay\n1,"x\ny",2.5\n2,NA,\n',
        "b.csv": '﻿pay,"id",more,even more\n7,3,q,r\nnone,4,q,r\n',
        "c.csv": "name,name,id\nfirst,second,5\n",
        "d.csv": "",
        "e.csv": "id,name\n",
        "f.csv": "other\nz\n",
        "g.csv": "id,name\n6,n,too,many\n",
        "skipped.txt": "id\n99\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = captured.read_by_name(spark, str(tmp_path), "id int, name string, pay double").collect()
    got = sorted(((r.path.rsplit("/", 1)[1], r.id, r.name, r.pay) for r in rows), key=repr)
    assert got == [("a.csv", 1, "x\ny", 2.5), ("a.csv", 2, None, None), ("b.csv", 3, None, 7.0), ("b.csv", 4, None, None), ("c.csv", 5, "first", None), ("f.csv", None, None, None), ("g.csv", 6, "n", None)]


def test_no_files_are_no_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert captured.read_by_name(spark, str(tmp_path), "id int").collect() == []


def test_many_kinds_of_headers_are_one_read(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{i}.csv").write_text(f"{','.join(f'x{j}' for j in range(i % 7))}{',' if i % 7 else ''}id,k{i}\n{'0,' * (i % 7)}{i},v\n")
    df = captured.read_by_name(spark, str(tmp_path), "id int")
    assert sorted(r.id for r in df.collect()) == [*range(60)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2  # rows and headers
