import os

from areatab.plans.vintages import crosswalk_departments, tabulate_flat, tabulate_linked
from areatab.sources.files import read_delimited, read_label_files, read_mapped_label_files
from areatab.sources.inline import crosswalk_1991, provinces_1991


def _w(d, name, text):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)
    return os.path.join(d, name)


def _rows(long):
    return {(r.id_geo, r.codigo_variable, r.valor_categoria): (r.etiqueta_categoria, r.conteo) for r in long.collect()}


def test_flat_model_end_to_end(spark, tmp_dir):
    p = _w(tmp_dir, "personas.csv",
           "IDPROV;IDDPTO;IDFRAC;IDRADIO;IDVIV;IDHOG;IDPER;SEXO;EDAD\n"
           "2;7;1;1;1;1;1;1;30\n2;7;1;1;1;1;2;2;\n2;7;1;2;2;1;1;1;5\n19;14;3;4;1;1;1;;40\n")
    dep = _w(tmp_dir, "depto.csv", "provin_ref_id;depto;nombdepto\n2;007;Col�n\n21;014;Rosario\n99;001;Nada\n")
    lab_dir = os.path.join(tmp_dir, "labels")
    _w(lab_dir, "persona_labels_sexo.csv", "v;l\n1;Var�n\n2;Mujer\n")
    m = spark.createDataFrame([("PERSONA_SEXO", "persona_labels_sexo.csv", "Sexo"), ("PERSONA_EDAD", None, "Edad")],
                              "codigo_variable string, label_file string, etiqueta_variable string")
    departments = crosswalk_departments(read_delimited(spark, dep), crosswalk_1991(spark))
    long, meta = tabulate_flat(
        {"PERSONA": read_delimited(spark, p)},
        provinces_1991(spark),
        departments,
        raw_labels=read_mapped_label_files(spark, lab_dir, m),
        variable_labels=m.select("codigo_variable", "etiqueta_variable"),
    )
    got = _rows(long)
    assert got[("020070101", "PERSONA_SEXO", "1")] == ("Varón", 1)
    assert got[("020070101", "PERSONA_EDAD", "Sin dato")] == ("Sin dato", 1)  # empty field kept as 'Sin dato'
    assert got[("190140304", "PERSONA_SEXO", "Sin dato")] == ("Sin dato", 1)
    assert got[("020070102", "PERSONA_EDAD", "5")] == ("5", 1)
    assert sum(v[1] for k, v in got.items() if k[1] == "PERSONA_SEXO") == 4  # totals invariant
    r = long.filter("id_geo = '190140304'").first()
    assert (r.valor_provincia, r.etiqueta_provincia, r.valor_departamento, r.etiqueta_departamento) == ("19", "Santa Fe", "014", "Rosario")
    r = long.filter("id_geo = '020070101'").first()
    assert r.etiqueta_departamento == "Colón" and r.valor_fraccion == "01" and r.valor_radio == "01"
    md = {(x.codigo_variable, x.valor_categoria): x.etiqueta_variable for x in meta.collect()}
    assert md[("PERSONA_SEXO", "1")] == "Sexo" and md[("PERSONA_EDAD", "30")] == "Edad"


def test_linked_model_end_to_end(spark, tmp_dir):
    d = os.path.join(tmp_dir, "linked")
    files = {
        "prov": "prov_ref_id;idprov;nomprov\n1;02;Buenos Aires\n",
        "dpto": "dpto_ref_id;prov_ref_id;iddpto;nomdpto\n10;1;007;Mor�n\n",
        "frac": "frac_ref_id;dpto_ref_id;idfrac\n100;10;01\n",
        "radio": "radio_ref_id;frac_ref_id;idradio;nomradio\n1000;100;01;Centro\n1001;100;02;Norte\n",
        "seg": "seg_ref_id;radio_ref_id\n5000;1000\n5001;1001\n5002;9999\n",
        "vivienda": "vivienda_ref_id;seg_ref_id;V4\n1;5000;1\n2;5001;2\n3;5002;1\n",
        "hogar": "hogar_ref_id;vivienda_ref_id;H10\n11;1;1\n12;2;\n13;3;1\n",
        "persona": "persona_ref_id;hogar_ref_id;P2\n101;11;1\n102;11;2\n103;12;1\n104;13;2\n",
    }
    t = {k: read_delimited(spark, _w(d, f"{k}.csv", v)) for k, v in files.items()}
    lab_dir = os.path.join(tmp_dir, "lab")
    _w(lab_dir, "persona_labels_p2.csv", "v;l\n1;Var�n\n2;Mujer\nNA;junk\n")
    _w(lab_dir, "vivienda_labels_v4.csv", "v;l\n1;Casa\n1;Duplicada\n2;NOTAPPLICABLE\n")
    for how, hot in (("inner", None), ("left", None), ("inner", 1)):
        long, meta = tabulate_linked(
            t["prov"], t["dpto"], t["frac"], t["radio"], t["seg"], t["vivienda"], t["hogar"], t["persona"],
            raw_labels=read_label_files(spark, lab_dir, "lower"), how=how, hot_rows=hot,
        )
        got = _rows(long)
        assert got == {
            ("020070101", "VIVIENDA_V4", "1"): ("Casa", 1),
            ("020070102", "VIVIENDA_V4", "2"): ("No aplica", 1),
            ("020070101", "HOGAR_H10", "1"): ("1", 1),
            ("020070101", "PERSONA_P2", "1"): ("Varón", 1),
            ("020070101", "PERSONA_P2", "2"): ("Mujer", 1),
            ("020070102", "PERSONA_P2", "1"): ("Varón", 1),
        }, how
        r = long.filter("id_geo = '020070102'").first()
        assert (r.etiqueta_provincia, r.etiqueta_departamento) == ("Buenos Aires", "Morón")
        assert (r.etiqueta_fraccion, r.etiqueta_radio) == (None, "Norte")
        assert {x.entidad for x in meta.collect()} == {"VIVIENDA", "HOGAR", "PERSONA"}


def test_linked_case_sensitive_2010_exclusion(spark, tmp_dir):
    from areatab.plans.vintages import EXCLUDE_2010, EXCLUDE_2010_EXTRA

    d = os.path.join(tmp_dir, "l2010")
    dims = {
        "prov": "PROV_REF_ID;IDPROV;NOMPROV\n1;6;Buenos Aires\n",
        "dpto": "DPTO_REF_ID;PROV_REF_ID;IDDPTO;NOMDPTO\n10;1;7;Alsina\n",
        "frac": "FRAC_REF_ID;DPTO_REF_ID;IDFRAC\n100;10;1\n",
        "radio": "RADIO_REF_ID;FRAC_REF_ID;IDRADIO\n1000;100;1\n",
        "seg": "SEG_REF_ID;RADIO_REF_ID\n5000;1000\n",
        "vivienda": "VIVIENDA_REF_ID;SEG_REF_ID;V01;TIPVV;CONDACTX\n1;5000;1;2;9\n",
        "hogar": "HOGAR_REF_ID;VIVIENDA_REF_ID;V01;H05;TOTPERC\n11;1;3;4;5\n",
    }
    t = {k: read_delimited(spark, _w(d, f"{k}.csv", v)) for k, v in dims.items()}
    long, _ = tabulate_linked(t["prov"], t["dpto"], t["frac"], t["radio"], t["seg"], t["vivienda"], t["hogar"],
                              exclude=EXCLUDE_2010, extra_exclude=EXCLUDE_2010_EXTRA, case_sensitive=True,
                              how="left", null_policy="drop_blank")
    codes = {r[0] for r in long.select("codigo_variable").distinct().collect()}
    # 'ACT' removes CONDACTX, 'C$' removes TOTPERC, 'V01$' removes V01 for households only
    assert codes == {"VIVIENDA_V01", "VIVIENDA_TIPVV", "HOGAR_H05"}


def test_flat_model_with_level_labels_on_rows(spark, tmp_dir):
    p = _w(tmp_dir, "viv.csv",
           "IDPROV;PROV_LABEL;IDDPTO;DPTO_LABEL;IDFRAC;FRAC_LABEL;IDRADIO;RAD_LABEL;TIPO\n"
           "02;Caba;007;Comuna 7;01;Fr 1;01;Rd 1;1\n02;Caba;007;Comuna 7;01;Fr 1;01;Rd 1;2\n"
           "06;Buenos Aires;014;Ayacucho;02;Fr 2;03;Rd 3;1\n")
    levels = {"provincia": "PROV_LABEL", "departamento": "DPTO_LABEL", "fraccion": "FRAC_LABEL", "radio": "RAD_LABEL"}
    long, meta = tabulate_flat({"VIVIENDA": read_delimited(spark, p)}, level_labels=levels, null_policy="drop")
    got = {(r.id_geo, r.valor_categoria): r for r in long.collect()}
    assert set(got) == {("020070101", "1"), ("020070101", "2"), ("060140203", "1")}
    r = got[("060140203", "1")]
    assert (r.valor_provincia, r.etiqueta_provincia, r.valor_departamento, r.etiqueta_departamento) == ("06", "Buenos Aires", "014", "Ayacucho")
    assert (r.valor_fraccion, r.etiqueta_fraccion, r.valor_radio, r.etiqueta_radio, r.conteo) == ("02", "Fr 2", "03", "Rd 3", 1)
    assert {x.codigo_variable for x in meta.collect()} == {"VIVIENDA_TIPO"}  # label columns are not variables


def _linked_frames(spark, names="nomdpto", frac=(("1", "10", "100"), ("2", "10", "101"))):
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    return (
        t([("1", "2", "C�rdoba")], "prov_ref_id string, idprov string, nomprov string"),
        t([("10", "1", "7", None)], f"dpto_ref_id string, prov_ref_id string, iddpto string, {names} string"),
        t(list(frac), "frac_ref_id string, dpto_ref_id string, idfrac string"),
        t([("1", "1", "1"), ("2", "2", "1")], "radio_ref_id string, frac_ref_id string, idradio string"),
        t([("1", "1"), ("2", "2")], "seg_ref_id string, radio_ref_id string"),
        t([("1", "1", "a", ""), ("2", "2", "a", "x"), ("3", "9", "a", "x")], "VIVIENDA_REF_ID string, SEG_REF_ID string, V01 string, V02 string"),
    )


def test_wide_codes_stay_apart(spark):
    from areatab.operators.areas import wide_codes
    from areatab.plans.vintages import tabulate_linked

    long, _ = tabulate_linked(*_linked_frames(spark))
    got = {(r.id_geo, r.valor_fraccion, r.conteo) for r in long.where("codigo_variable = 'VIVIENDA_V01'").collect()}
    assert got == {("0200710001", "100", 1), ("0200710101", "101", 1)}
    wide = wide_codes(_linked_frames(spark)[2], {"idfrac": 2})
    assert sorted(map(tuple, wide.collect())) == [("idfrac", "100", 1), ("idfrac", "101", 1)]


def test_2001_department_column_and_2010_preset(spark):
    from areatab.plans.vintages import tabulate_linked, tabulate_linked_2010

    frames = _linked_frames(spark, names="nomdepto")
    labels_ = spark.createDataFrame([("VIVIENDA_V01", "b", "MISSING", "f", 1)], "codigo_variable string, valor_categoria string, etiqueta_categoria string, archivo string, linea int")
    old, _ = tabulate_linked(*frames, raw_labels=labels_)
    row = old.where("codigo_variable = 'VIVIENDA_V01'").first()
    assert (row.etiqueta_departamento, row.etiqueta_categoria) == ("Sin dato", "a")
    new, _ = tabulate_linked_2010(*frames, raw_labels=labels_)
    rows = new.collect()
    # blanks and dwellings without an area fall away, nothing is made up
    assert sorted((r.codigo_variable, r.valor_categoria, r.conteo) for r in rows) == [("VIVIENDA_V01", "a", 1), ("VIVIENDA_V01", "a", 1), ("VIVIENDA_V02", "x", 1)]
    assert {(r.etiqueta_departamento, r.etiqueta_categoria, r.etiqueta_provincia) for r in rows} == {(None, None, "C�rdoba")}


def test_duplicate_dimension_keys_are_named(spark):
    import pytest

    from areatab.operators.areas import duplicate_keys, require_unique

    dim = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), (None, "d"), (None, "e")], "k string, v string")
    assert [tuple(r) for r in duplicate_keys(dim, ["k"]).collect()] == [("1", 2)]
    require_unique({"dim": (dim, ["k", "v"])})
    with pytest.raises(ValueError, match="dim: duplicate keys"):
        require_unique({"dim": (dim, ["k"])})
