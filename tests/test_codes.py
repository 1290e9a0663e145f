from areatab.functions.codes import area_key, code_entity, code_name, format_code, pad_code, split_area_key, to_int


def test_pad_and_key(spark):
    df = spark.createDataFrame([("02", "007", "01", "01"), ("2", "7", "1", "1"), ("2", None, "1", "1")], "p string, d string, f string, r string")
    out = df.select(area_key("p", "d", "f", "r").alias("k"), pad_code("p", 2).alias("p2")).collect()
    assert out[0].k == "020070101"  # published example
    assert out[1].k == "020070101"
    assert out[2].k is None  # a missing level leaves no key
    assert out[1].p2 == "02"


def test_pad_truncates_and_format_does_not(spark):
    df = spark.createDataFrame([(1234,), (None,), (5,)], "x int")
    out = df.select(pad_code("x", 2).alias("p"), format_code("x", 2).alias("f")).collect()
    assert out[0].p == "12" and out[0].f == "1234"
    assert out[1].f is None  # not the text 'null'
    assert out[2].f == "05"


def test_to_int_never_raises(spark):
    df = spark.createDataFrame([("12",), ("x1",), (None,)], "s string")
    assert [r[0] for r in df.select(to_int("s")).collect()] == [12, None, None]


def test_split_key_and_code_parts(spark):
    df = spark.createDataFrame([("020070101", "PERSONA_A_B")], "k string, c string")
    parts = df.select(*split_area_key("k")).first()
    assert tuple(parts) == ("02", "007", "01", "01")
    r = df.select(code_entity("c"), code_name("c")).first()
    assert tuple(r) == ("PERSONA", "A")  # names with '_' are cut, as published


def test_null_safe_chain_and_repaired_area_names(spark):
    from areatab.operators.areas import join_chain, label_areas

    base = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    dim = spark.createDataFrame([(1, "uno"), (None, "nulo")], "k int, name string")
    assert join_chain(base, [(dim, "k")]).count() == 1
    assert {r.name for r in join_chain(base, [(dim, "k")], null_safe=True).collect()} == {"uno", "nulo"}

    long = spark.createDataFrame([("020070101", 5)], "id_geo string, conteo long")
    prov = spark.createDataFrame([(2, "Entre R�os")], "idprov int, nomprov string")
    dpto = spark.createDataFrame([(2, 7, "Jun�n")], "idprov int, iddpto int, nomdpto string")
    r = label_areas(long, prov, dpto, repair_rules="2001").first()
    assert r.etiqueta_departamento == "Junín" and r.valor_provincia == "02" and r.valor_departamento == "007"
    assert r.etiqueta_provincia == "Entre R�os"  # no 2001 rule covers it (kept damaged, as published)
