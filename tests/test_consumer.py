from areatab.operators.consumer import join_geometry_late, preview, variable_slice
from areatab.operators.publish import to_long, to_metadata
from areatab.sources.views import RECIPES, recipe, register


def _long(spark):
    rows = [("020070102", "PERSONA_P1", "2", 3), ("020070101", "PERSONA_P1", "1", 5), ("010010101", "HOGAR_H1", "1", 2),
            ("010010101", "HOGAR_H1", "2", 1)]
    df = spark.createDataFrame(rows, "id_geo string, codigo_variable string, valor_categoria string, conteo long")
    return to_long(df)


def test_preview_is_totally_ordered_and_slice_filters(spark):
    long = _long(spark)
    assert [r.id_geo for r in preview(long, 2).collect()] == ["010010101", "010010101"]
    assert {r.codigo_variable for r in variable_slice(long, "HOGAR_H1").collect()} == {"HOGAR_H1"}


def test_sql_recipes_on_views(spark):
    long = _long(spark)
    meta = to_metadata(long)
    radios = spark.createDataFrame([("020070101", -58.0, -34.0)], "id_geo string, lon double, lat double")
    register({"largo": long, "metadatos": meta, "radios": radios})
    assert [tuple(r) for r in recipe(spark, "variables").collect()] == [("HOGAR_H1", "H1"), ("PERSONA_P1", "P1")]
    cats = recipe(spark, "categories_per_variable").collect()
    assert [(r.codigo_variable, r.num_categories) for r in cats] == [("HOGAR_H1", 2), ("PERSONA_P1", 2)]
    counts = {r.file: r.row_count for r in recipe(spark, "row_counts").collect()}
    assert counts == {"metadatos": 4, "largo": 4, "radios": 1}
    j = recipe(spark, "join_geometry", code="PERSONA_P1").collect()
    assert [(r.id_geo, r.valor_categoria, r.conteo) for r in j] == [("020070101", "1", 5)]
    assert set(RECIPES) == {"variables", "categories_per_variable", "row_counts", "join_geometry"}


def _layer(spark):
    rows = [("a", 0.0, 0.0, 1.0, 1.0, b"A"), ("b", 5.0, 5.0, 6.0, 6.0, b"B"), ("c", 179.0, 0.0, 179.5, 1.0, b"C"), ("d", 2.0, 2.0, 3.0, 3.0, None), (None, 0.0, 0.0, 1.0, 1.0, b"N")]
    return spark.createDataFrame(rows, "id_geo string, min_lon double, min_lat double, max_lon double, max_lat double, geometry binary")


def test_geometry_is_fetched_for_areas_in_view(spark):
    long = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5), ("z", 6), (None, 7)], "id_geo string, conteo long")

    def found(window=None):
        return sorted((r.conteo, r.geometry and bytes(r.geometry)) for r in join_geometry_late(long, _layer(spark), window=window).collect())

    assert found() == [(1, b"A"), (2, b"A"), (3, b"B"), (4, b"C"), (5, None)]
    assert found((0.5, 0.5, 2.0, 2.0)) == [(1, b"A"), (2, b"A"), (5, None)]  # borders count
    assert found((170.0, -5.0, 0.5, 5.0)) == [(1, b"A"), (2, b"A"), (4, b"C")]  # past the antimeridian
    assert found((50.0, 50.0, 60.0, 60.0)) == []
