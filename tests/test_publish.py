import os

from pyspark.sql import functions as F

from areatab.operators.publish import (LONG_COLUMNS, dataset_stats, pending_variables, produced_variables, read_long,
                                       run_manifest, to_long, to_metadata, write_by_variable, write_long)


def _long(spark):
    rows = [("020070101", "PERSONA_P1", "1", 5), ("020070102", "PERSONA_P1", "2", 3), ("010010101", "HOGAR_H1", "1", 2)]
    df = spark.createDataFrame(rows, "id_geo string, codigo_variable string, valor_categoria string, conteo int")
    return to_long(df.withColumn("etiqueta_categoria", F.col("valor_categoria")))


def test_long_schema_and_sorted_roundtrip(spark, tmp_dir):
    long = _long(spark)
    assert tuple(long.columns) == LONG_COLUMNS
    assert dict(long.dtypes)["conteo"] == "bigint"
    path = os.path.join(tmp_dir, "long")
    write_long(long, path, partitions=2)
    back = read_long(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(path))


def test_per_variable_overwrite_is_per_partition(spark, tmp_dir):
    path = os.path.join(tmp_dir, "byvar")
    long = _long(spark)
    write_by_variable(long, path)
    # rerun one variable with new counts: the other variable stays
    write_by_variable(long.filter("codigo_variable = 'HOGAR_H1'").withColumn("conteo", F.lit(9).cast("long")), path)
    back = read_long(spark, path)
    got = {(r.codigo_variable, r.conteo) for r in back.collect()}
    assert ("HOGAR_H1", 9) in got and ("PERSONA_P1", 5) in got and ("HOGAR_H1", 2) not in got
    # codes in partition folders come back as text
    assert dict(back.dtypes)["codigo_variable"] == "string"


def test_metadata_manifest_stats(spark):
    long = _long(spark)
    vl = spark.createDataFrame([("PERSONA_P1", "Sexo")], "codigo_variable string, etiqueta_variable string")
    meta = {(r.codigo_variable, r.valor_categoria): (r.nombre_variable, r.etiqueta_variable, r.entidad) for r in to_metadata(long, vl).collect()}
    assert meta[("PERSONA_P1", "1")] == ("P1", "Sexo", "PERSONA")
    assert meta[("HOGAR_H1", "1")] == ("H1", "H1", "HOGAR")  # label falls back to the name
    req = spark.createDataFrame([("PERSONA_P1",), ("HOGAR_H1",), ("PERSONA_X",)], "codigo_variable string")
    prod = produced_variables(long)
    assert {r[0] for r in pending_variables(req, prod).collect()} == {"PERSONA_X"}
    man = {r.codigo_variable: (r.status, r.n_rows) for r in run_manifest(req, prod).collect()}
    assert man == {"PERSONA_P1": ("success", 2), "HOGAR_H1": ("success", 1), "PERSONA_X": ("missing", 0)}
    s = dataset_stats(long).first()
    assert (s.total_rows, s.unique_vars, s.unique_geos) == (3, 2, 3)


def test_year_column_for_stacking(spark):
    a = to_long(_long(spark), year=2001)
    b = to_long(_long(spark), year=2010)
    assert a.columns[0] == "anio" and tuple(a.columns[1:]) == LONG_COLUMNS
    stacked = a.unionByName(b)
    assert stacked.groupBy("anio", "id_geo", "codigo_variable", "valor_categoria").count().filter("count > 1").count() == 0


def test_metadata_prefers_dictionary_names(spark):
    long = to_long(spark.createDataFrame(
        [("020070101", "PERSONA_P07_A", "1", 2)], "id_geo string, codigo_variable string, valor_categoria string, conteo long"))
    d = spark.createDataFrame([("PERSONA_P07_A", "Lugar", "P07_A", "PERSONA")],
                              "codigo_variable string, etiqueta_variable string, nombre_variable string, entidad string")
    r = to_metadata(long, d).first()
    assert (r.nombre_variable, r.etiqueta_variable, r.entidad) == ("P07_A", "Lugar", "PERSONA")
    r2 = to_metadata(long, d.select("codigo_variable", "etiqueta_variable")).first()
    assert r2.nombre_variable == "P07"  # cut at '_' when no dictionary name is given, as published


def test_clustered_layout_skips_row_groups_for_areas_and_for_variables(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from areatab.operators.publish import LONG_COLUMNS, write_clustered

    codes = [f"PERSONA_P{k:02d}" for k in range(16)]
    data = [(f"{a:09d}", c, v, a) for a in range(256) for c in codes for v in ("1", "2")]
    long = to_long(spark.createDataFrame(data, "id_geo string, codigo_variable string, valor_categoria string, conteo long"))
    path = os.path.join(tmp_dir, "z")
    write_clustered(long, path, codes, partitions=2, row_group=128, cells=16)
    back = read_long(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect())) and tuple(back.columns) == LONG_COLUMNS
    groups = []
    for f in glob.glob(f"{path}/*.parquet"):
        m = pq.ParquetFile(f).metadata
        at = {m.schema.column(i).name: i for i in range(m.num_columns)}
        for g in range(m.num_row_groups):
            row = m.row_group(g)
            assert row.num_rows <= 128
            groups.append({c: (row.column(at[c]).statistics.min, row.column(at[c]).statistics.max) for c in ("id_geo", "codigo_variable")})
    read = lambda c, v: sum(g[c][0] <= v <= g[c][1] for g in groups)
    assert len(groups) >= 64
    # of n row groups a filter on either side reads about the square root
    assert max(read("id_geo", f"{a:09d}") for a in range(0, 256, 5)) <= len(groups) / 4
    assert max(read("codigo_variable", c) for c in codes) <= len(groups) / 4


def test_clustered_layout_keeps_null_areas_and_unknown_variables(spark, tmp_dir):
    from areatab.operators.publish import write_clustered

    long = to_long(spark.createDataFrame([(None, "A", "1", 1), ("x", "B", "1", 2), ("x", "A", None, 3)], "id_geo string, codigo_variable string, valor_categoria string, conteo long"))
    write_clustered(long, os.path.join(tmp_dir, "z"), ["A"], partitions=2)
    assert sorted(r.conteo for r in read_long(spark, os.path.join(tmp_dir, "z")).collect()) == [1, 2, 3]
