import os

from pyspark.sql import functions as F

from areatab.operators.catalog import catalog, variables_excluding_names, variables_excluding_patterns
from areatab.operators.labels import clean_labels
from areatab.sources.files import describe, read_delimited, read_dictionary, read_label_files, read_mapped_label_files


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_delimited_keeps_codes_and_reads_latin1(spark, tmp_dir):
    p = os.path.join(tmp_dir, "PERSONA.csv")
    _write(p, 'IDPROV;IDDPTO;NOMBRE;P01\n02;007;"Año; viejo";1\n06;014;Ñandú;\n', encoding="iso-8859-1")
    df = read_delimited(spark, p, encoding="ISO-8859-1")
    rows = df.collect()
    assert df.columns == ["IDPROV", "IDDPTO", "NOMBRE", "P01"]
    assert rows[0].IDPROV == "02" and rows[0].IDDPTO == "007"  # no integer inference
    assert rows[0].NOMBRE == "Año; viejo" and rows[1].NOMBRE == "Ñandú"
    assert rows[1].P01 is None


def test_label_files_by_name_lower_and_upper(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "persona_labels_p01.csv"), "valor;etiqueta\n1;Varón\n2;Mujer\n1;Duplicado\nNA;junk\n")
    _write(os.path.join(tmp_dir, "hogar_labels_h10.csv"), "valor;etiqueta\n1;Red pública\n")
    lab = read_label_files(spark, tmp_dir, "lower")
    codes = {r[0] for r in lab.select("codigo_variable").distinct().collect()}
    assert codes == {"PERSONA_P01", "HOGAR_H10"}
    ordered = lab.withColumn("orden", F.struct("archivo", "linea"))
    clean = {(r.codigo_variable, r.valor_categoria): r.etiqueta_categoria for r in clean_labels(ordered, "orden").collect()}
    assert clean[("PERSONA_P01", "1")] == "Varón"  # first row wins
    assert ("PERSONA_P01", "NA") not in clean

    up = os.path.join(tmp_dir, "up")
    os.makedirs(up)
    _write(os.path.join(up, "PERSONA-P05-LABELS.csv"), "v;l\n1;Sí\n")
    lab2 = read_label_files(spark, up, "upper").collect()
    assert lab2[0].codigo_variable == "PERSONA_P05" and lab2[0].etiqueta_categoria == "Sí"


def test_mapped_label_files(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "persona_labels_sexo.csv"), "v;l\n1;Varón\n2;Mujer\n")
    _write(os.path.join(tmp_dir, "otro.csv"), "v;l\n1;x\n")
    m = spark.createDataFrame([("PERSONA_SEXO", "persona_labels_sexo.csv"), ("PERSONA_EDAD", None)], "codigo_variable string, label_file string")
    out = read_mapped_label_files(spark, tmp_dir, m).collect()
    assert {(r.codigo_variable, r.valor_categoria) for r in out} == {("PERSONA_SEXO", "1"), ("PERSONA_SEXO", "2")}


def test_xml_dictionary_nested(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dict.xml")
    _write(p, """<Dictionary>
<Entity name="VIVIENDA"><Variable name="V01" description="Tipo"/><Variable name="V02"/>
  <Entity name="HOGAR"><Variable name="H01" description="Agua"/></Entity>
</Entity>
</Dictionary>""")
    rows = {(r.codigo_variable, r.etiqueta_variable, r.entidad, r.nombre_variable) for r in read_dictionary(spark, p).collect()}
    assert rows == {("VIVIENDA_V01", "Tipo", "VIVIENDA", "V01"), ("VIVIENDA_V02", None, "VIVIENDA", "V02"),
                    ("HOGAR_H01", "Agua", "HOGAR", "H01")}


def test_variable_discovery():
    cols = ["IDPROV", "IDDPTO", "SEXO", "EDAD", "REF_ID", "P04D", "CONDACT", "ESTADOC"]
    assert variables_excluding_names(cols, ["IDPROV", "IDDPTO"]) == ["SEXO", "EDAD", "REF_ID", "P04D", "CONDACT", "ESTADOC"]
    # unanchored, case-sensitive: 'ACT' also removes CONDACT, 'C$' removes ESTADOC
    assert variables_excluding_patterns(cols, ["REF_ID", "IDPROV", "IDDPTO", "ACT", "P04D", "C$"]) == ["SEXO", "EDAD"]
    assert variables_excluding_patterns(["hogar_ref_id", "P2"], ["ref_id"], lower=True) == ["P2"]


def test_catalog_and_describe(spark):
    cat = catalog(spark, {"persona": ["p1", "p2"], "hogar": ["h1"]}).collect()
    assert {r.codigo_variable for r in cat} == {"PERSONA_P1", "PERSONA_P2", "HOGAR_H1"}
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    d = describe(spark, {"t": df}).collect()
    assert [(r.columna, r.posicion, r.tipo) for r in d] == [("a", 1, "int"), ("b", 2, "string")]


def test_columns_in_another_order_are_not_mixed(spark, tmp_dir):
    import pytest

    a, b = os.path.join(tmp_dir, "a.csv"), os.path.join(tmp_dir, "b.csv")
    _write(a, "IDPROV;SEXO\n7;1\n")
    _write(b, "SEXO;IDPROV\n2;24\n")
    assert read_delimited(spark, a).unionByName(read_delimited(spark, b)).collect() == [("7", "1"), ("24", "2")]
    with pytest.raises(Exception, match="header|CSV"):
        read_delimited(spark, [a, b]).collect()


def test_malformed_rows_fail_or_are_counted(spark, tmp_dir):
    import pytest

    from areatab.sources.files import malformed_rows

    p = os.path.join(tmp_dir, "p.csv")
    _write(p, "A;B\n01;1\n02;2;9;9\n03\n04;\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_delimited(spark, p).collect()
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_delimited(spark, p).select("A").collect()
    kept = read_delimited(spark, p, malformed="keep")
    assert [tuple(r) for r in malformed_rows(kept).collect()] == [("p.csv", 4, 2, 0)]


def test_label_file_names_with_more_parts(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "PERSONA-P05-B-LABELS.csv"), "v;l\n1;Sí\n")
    assert [r.codigo_variable for r in read_label_files(spark, tmp_dir, "upper").collect()] == ["PERSONA_P05"]


def test_xml_dictionary_wrapped(spark, tmp_dir):
    import pytest

    p = os.path.join(tmp_dir, "dict.xml")
    _write(p, """<D><Entity name="V"><Variables><Variable name="A" description="a"/><Variable name="B" description="b"/></Variables>
<Entities><Entity name="H"><Group><Variables><Variable name="C"/></Variables></Group></Entity></Entities></Entity></D>""")
    found = {(r.codigo_variable, r.etiqueta_variable) for r in read_dictionary(spark, p).collect()}
    assert found == {("V_A", "a"), ("V_B", "b"), ("H_C", None)}
    q = os.path.join(tmp_dir, "none.xml")
    _write(q, '<D><Entity name="V"><Other x="1"/></Entity></D>')
    with pytest.raises(ValueError, match="Variable"):
        read_dictionary(spark, q)


def test_published_dictionaries(spark):
    from areatab.sources.inline import variables_1991, variables_2001

    assert (variables_1991(spark).count(), variables_2001(spark).count()) == (24, 81)
    assert variables_1991(spark).where("codigo_variable = 'PERSONA_SEXO'").first().label_file == "persona_labels_sexo.csv"


def test_broken_label_files_are_set_apart(spark, tmp_dir):
    import gzip

    from areatab.sources.files import check_label_files, read_sound_label_files

    head = "valor;etiqueta\n"
    _write(os.path.join(tmp_dir, "persona_labels_p01.csv"), head + '1;Varón\n2;"Mu;jer"\n')
    _write(os.path.join(tmp_dir, "persona_labels_p02.csv"), head + "1;a;b\n")
    _write(os.path.join(tmp_dir, "persona_labels_p03.csv"), head + "1;año\n", "latin-1")
    _write(os.path.join(tmp_dir, "persona_labels_p04.csv"), head)
    _write(os.path.join(tmp_dir, "persona_labels_p05.csv"), "codigo;texto\n1;x\n")
    _write(os.path.join(tmp_dir, "other.csv"), head + "1;x\n")
    for name, cut in (("p06", None), ("p07", -9)):
        with open(os.path.join(tmp_dir, f"hogar_labels_{name}.csv.gz"), "wb") as f:
            f.write(gzip.compress((head + "".join(f"{k};label {k}\n" for k in range(500))).encode())[:cut])
    checks = check_label_files(spark, tmp_dir, header=("valor", "etiqueta"))
    found = {r.archivo: (r.estado, r.motivo, r.n_filas) for r in checks.collect()}
    assert found == {
        "persona_labels_p01.csv": ("success", None, 2), "persona_labels_p02.csv": ("error", "campos", 1), "persona_labels_p03.csv": ("error", "texto", 1),
        "persona_labels_p04.csv": ("empty", None, 0), "persona_labels_p05.csv": ("error", "cabecera", 1), "other.csv": ("error", "nombre", 1),
        "hogar_labels_p06.csv.gz": ("success", None, 500), "hogar_labels_p07.csv.gz": ("error", "ilegible", 0),
    }
    rows = read_sound_label_files(spark, tmp_dir, checks)
    assert {r.codigo_variable: r.n for r in rows.groupBy("codigo_variable").agg(F.count("*").alias("n")).collect()} == {"PERSONA_P01": 2, "HOGAR_P06": 500}
    # without names for the header any two columns will do
    assert {r.archivo: r.estado for r in check_label_files(spark, tmp_dir).collect()}["persona_labels_p05.csv"] == "success"
