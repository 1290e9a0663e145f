from areatab.operators.labels import add_sentinel, attach_labels, clean_labels


def test_clean_labels_first_row_junk_and_recode(spark):
    raw = spark.createDataFrame(
        [("V_A", "1", "Uno", 1), ("V_A", "1", "Otro", 2), ("V_A", "NA", "junk", 3), ("V_A", None, "x", 4),
         ("V_A", "9", "MISSING", 5), ("V_A", "8", "NOTAPPLICABLE", 6)],
        "codigo_variable string, valor_categoria string, etiqueta_categoria string, linea long")
    out = {(r.valor_categoria, r.etiqueta_categoria) for r in clean_labels(raw, "linea").collect()}
    assert out == {("1", "Uno"), ("9", "Sin dato"), ("8", "No aplica")}


def test_sentinel_and_attach_keep_rows(spark):
    labels = spark.createDataFrame([("V_A", "1", "Uno")], "codigo_variable string, valor_categoria string, etiqueta_categoria string")
    codes = spark.createDataFrame([("V_A",), ("V_B",)], "codigo_variable string")
    sl = add_sentinel(labels, codes)
    assert sl.count() == 3
    long = spark.createDataFrame([("a", "V_A", "1", 3), ("a", "V_A", "2", 1), ("a", "V_B", "Sin dato", 2)],
                                 "id_geo string, codigo_variable string, valor_categoria string, conteo long")
    out = attach_labels(long, sl)
    assert out.count() == long.count()
    got = {(r.valor_categoria, r.etiqueta_categoria) for r in out.collect()}
    assert got == {("1", "Uno"), ("2", "2"), ("Sin dato", "Sin dato")}


def test_leading_zero_keys_match_only_when_asked(spark):
    labels = spark.createDataFrame([("V_A", "01", "Uno")], "codigo_variable string, valor_categoria string, etiqueta_categoria string")
    long = spark.createDataFrame([("a", "V_A", "1", 3)], "id_geo string, codigo_variable string, valor_categoria string, conteo long")
    assert attach_labels(long, labels).first().etiqueta_categoria == "1"  # no match: falls back to the code
    r = attach_labels(long, labels, strip_leading_zeros=True).first()
    assert r.etiqueta_categoria == "Uno" and r.valor_categoria == "1"
