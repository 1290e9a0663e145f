import os

from areatab.__main__ import main
from areatab.operators.publish import read_long


def _w(d, name, text, encoding="utf-8"):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding=encoding) as f:
        f.write(text)
    return os.path.join(d, name)


def test_cli_linked_latin1(spark, tmp_dir):
    d = os.path.join(tmp_dir, "in")
    enc = "iso-8859-1"
    paths = {
        "prov": _w(d, "PROV.csv", "PROV_REF_ID;IDPROV;NOMPROV\n1;02;Córdoba\n", enc),
        "dpto": _w(d, "DPTO.csv", "DPTO_REF_ID;PROV_REF_ID;IDDPTO;NOMDPTO\n10;1;7;Río Cuarto\n", enc),
        "frac": _w(d, "FRAC.csv", "FRAC_REF_ID;DPTO_REF_ID;IDFRAC\n100;10;1\n", enc),
        "radio": _w(d, "RADIO.csv", "RADIO_REF_ID;FRAC_REF_ID;IDRADIO\n1000;100;1\n", enc),
        "seg": _w(d, "SEG.csv", "SEG_REF_ID;RADIO_REF_ID\n5000;1000\n", enc),
        "vivienda": _w(d, "VIVIENDA.csv", "VIVIENDA_REF_ID;SEG_REF_ID;V01\n1;5000;1\n2;5000;\n", enc),
    }
    lab = os.path.join(tmp_dir, "lab")
    _w(lab, "VIVIENDA-V01-LABELS.csv", "v;l\n1;Casa\n")
    dic = _w(tmp_dir, "dict.xml", '<D><Entity name="VIVIENDA"><Variable name="V01" description="Tipo de vivienda"/></Entity></D>')
    out = os.path.join(tmp_dir, "out")
    args = ["linked", "--out", out, "--encoding", "ISO-8859-1", "--labels-dir", lab, "--labels-style", "upper",
            "--how", "left", "--dictionary", dic, "--null-policy", "drop_blank"]
    for k, v in paths.items():
        args += [f"--{k}", v]
    stats = main(args)
    assert (stats["total_rows"], stats["unique_vars"], stats["unique_geos"]) == (1, 1, 1)
    r = read_long(spark, out + "/largo").first()
    assert (r.id_geo, r.etiqueta_provincia, r.etiqueta_departamento, r.etiqueta_categoria, r.conteo) == (
        "020070101", "Córdoba", "Río Cuarto", "Casa", 1)
    m = spark.read.parquet(out + "/metadatos").first()
    assert m.etiqueta_variable == "Tipo de vivienda" and m.entidad == "VIVIENDA"


def test_cli_resume_skips_done_variables(spark, tmp_dir):
    d = os.path.join(tmp_dir, "in")
    p = _w(d, "viv.csv", "IDPROV;IDDPTO;IDFRAC;IDRADIO;TIPO;AGUA\n2;7;1;1;1;2\n2;7;1;2;1;\n")
    out = os.path.join(tmp_dir, "out")
    first = main(["flat", "--out", out, "--entity", f"VIVIENDA={p}", "--resume"])
    assert sorted(first["computed"]) == ["VIVIENDA_AGUA", "VIVIENDA_TIPO"] and first["skipped"] == []
    again = main(["flat", "--out", out, "--entity", f"VIVIENDA={p}", "--resume"])
    assert again["computed"] == [] and sorted(again["skipped"]) == ["VIVIENDA_AGUA", "VIVIENDA_TIPO"]
    assert (again["total_rows"], again["unique_vars"]) == (first["total_rows"], 2)
