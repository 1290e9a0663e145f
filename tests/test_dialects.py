import os

import pytest

from areatab.sources.dialects import file_dialects, read_mixed


def _write(folder, name, text, encoding="utf-8"):
    with open(os.path.join(folder, name), "w", encoding=encoding) as f:
        f.write(text)


def _mixed(folder):
    _write(folder, "a.csv", 'id;nombre;x\n01;Ñandú;1,5\n02;"a;b";2\n')
    _write(folder, "b.csv", 'id,nombre,x\n03,año,9\n04,"p,q;r",;\n', "latin-1")
    _write(folder, "c.csv", "id|nombre|x\n\n05|z|\n")
    _write(folder, "d.csv", "id;nombre;x\n")


def test_each_file_is_judged_by_its_lines(spark, tmp_dir):
    _mixed(tmp_dir)
    _write(tmp_dir, "e.csv", "uno\n1\n2,5\n")
    found = {r.archivo: tuple(r)[1:] for r in file_dialects(spark, tmp_dir).collect()}
    head = ["id", "nombre", "x"]
    assert found["a.csv"] == (";", "UTF-8", True, True, 3, 2, head)
    assert found["b.csv"] == (",", "ISO-8859-1", True, True, 3, 2, head)
    assert found["c.csv"] == ("|", "UTF-8", False, True, 3, 1, head)
    assert found["d.csv"] == (";", "UTF-8", False, True, 3, 0, head)
    assert found["e.csv"] == (None, "UTF-8", False, True, 1, 2, ["uno"])


def test_rows_of_all_dialects_stay_text(spark, tmp_dir):
    _mixed(tmp_dir)
    rows = sorted(tuple(r) for r in read_mixed(spark, tmp_dir, ["id", "nombre", "x"]).collect())
    assert rows == [("01", "Ñandú", "1,5"), ("02", "a;b", "2"), ("03", "año", "9"), ("04", "p,q;r", ";"), ("05", "z", None)]
    with pytest.raises(ValueError, match="more than one dialect"):
        read_mixed(spark, tmp_dir, ["id", "nombre", "x"], strict=True)


def test_other_columns_or_ragged_lines_are_refused(spark, tmp_dir):
    _mixed(tmp_dir)
    with pytest.raises(ValueError, match="differs"):
        read_mixed(spark, tmp_dir, ["id", "x", "nombre"])
    _write(tmp_dir, "f.csv", "id;nombre;x\n06;y;1;more\n07;y;1\n08;y;1\n")
    with pytest.raises(ValueError, match="f.csv"):
        read_mixed(spark, tmp_dir, ["id", "nombre", "x"])


def test_one_dialect_passes_strictly(spark, tmp_dir):
    _write(tmp_dir, "a.csv", "id;n\n1;x\n")
    _write(tmp_dir, "b.csv", "id;n\n2;y\n")
    assert read_mixed(spark, tmp_dir, ["id", "n"], strict=True).count() == 2
