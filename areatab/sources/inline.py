"""Inline literal lookup tables (size fixed by the code, safe to broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# 1991 province codes and names, and the crosswalk from the
# 1991 province code to the department file's province reference id.
# ---------------------------------------------------------------------------
PROVINCES_1991 = (
    (1, "Salta"),
    (2, "Buenos Aires"),
    (3, "Ciudad Autónoma de Buenos Aires"),
    (4, "San Luis"),
    (5, "Entre Ríos"),
    (6, "La Rioja"),
    (7, "Santiago del Estero"),
    (8, "Chaco"),
    (10, "San Juan"),
    (11, "Catamarca"),
    (12, "La Pampa"),
    (13, "Mendoza"),
    (14, "Misiones"),
    (16, "Formosa"),
    (17, "Neuquén"),
    (18, "Río Negro"),
    (19, "Santa Fe"),
    (20, "Tucumán"),
    (21, "Chubut"),
    (22, "Tierra del Fuego"),
    (23, "Corrientes"),
    (24, "Córdoba"),
    (25, "Jujuy"),
    (26, "Santa Cruz"),
)

# (idprov, provin_ref_id)
CROSSWALK_1991 = (
    (1, 17),
    (2, 2),
    (3, 1),
    (4, 19),
    (5, 8),
    (6, 12),
    (7, 22),
    (8, 6),
    (10, 18),
    (11, 3),
    (12, 11),
    (13, 13),
    (14, 14),
    (16, 9),
    (17, 15),
    (18, 16),
    (19, 21),
    (20, 23),
    (21, 7),
    (22, 24),
    (23, 5),
    (24, 4),
    (25, 10),
    (26, 20),
)


# ---------------------------------------------------------------------------
# The published variable dictionaries. 1991: variable, file with
# its category labels (None: no such file), label. 2001: variable, label.
# ---------------------------------------------------------------------------
VARIABLES_1991 = (
    ("PERSONA_PARENT", "persona_labels_parentes.csv", "Parentesco"),
    ("PERSONA_SEXO", "persona_labels_sexo.csv", "Sexo"),
    ("PERSONA_EDAD", None, "Edad"),
    ("PERSONA_LUGARNAC", "persona_labels_naciocodi.csv", "Lugar de nacimiento"),
    ("PERSONA_ASISTE", "persona_labels_asistencia.csv", "Asistencia escolar"),
    ("PERSONA_NIVEL", "persona_labels_nivelasist.csv", "Nivel educativo"),
    ("PERSONA_NIVELMAX", "persona_labels_ultimoapro.csv", "Máximo nivel aprobado"),
    ("PERSONA_NIVELCOM", "persona_labels_complcurso.csv", "Nivel completo"),
    ("HOGAR_CUARTOS", None, "Cantidad de cuartos"),
    ("HOGAR_DESAGUE", "hogar_labels_desaginh.csv", "Desagüe"),
    ("HOGAR_TENENCIA", "hogar_labels_propvivh.csv", "Tenencia de la vivienda"),
    ("HOGAR_BANO", "hogar_labels_inodoroh.csv", "Baño"),
    ("HOGAR_TIPOH", None, "Tipo de hogar"),
    ("HOGAR_TIPOHOG", None, "Tipo de hogar (detallado)"),
    ("VIVIENDA_LOCALIDA", None, "Localidad"),
    ("VIVIENDA_AREA", None, "Área"),
    ("VIVIENDA_USO", None, "Uso de la vivienda"),
    ("VIVIENDA_TIPOVIV", "vivienda_labels_tipoviv.csv", "Tipo de vivienda"),
    ("VIVIENDA_DESTINO", None, "Destino"),
    ("VIVIENDA_PISO", "vivienda_labels_pisos.csv", "Material del piso"),
    ("VIVIENDA_AGUA", "vivienda_labels_agua.csv", "Provisión de agua"),
    ("VIVIENDA_AGUAOBT", "vivienda_labels_obtagua.csv", "Obtención del agua"),
    ("VIVIENDA_TIPOCASA", None, "Tipo de casa"),
    ("VIVIENDA_VILLA", None, "Villa de emergencia"),
)

VARIABLES_2001 = (
    ("PERSONA_P1", "Parentesco"),
    ("PERSONA_P2", "Sexo"),
    ("PERSONA_P3", "Edad"),
    ("PERSONA_P4", "Sabe leer y escribir"),
    ("PERSONA_P5", "Usa computadora"),
    ("PERSONA_P7A", "Lugar de nacimiento"),
    ("PERSONA_P7PROV", "Provincia de nacimiento"),
    ("PERSONA_P7PAIS", "País de nacimiento"),
    ("PERSONA_P8A", "Residencia hace 5 años"),
    ("PERSONA_P8PROV", "Provincia hace 5 años"),
    ("PERSONA_P8PAIS", "País hace 5 años"),
    ("PERSONA_P9A", "Trabaja en otro lugar"),
    ("PERSONA_P9PROV", "Provincia de trabajo"),
    ("PERSONA_P9PAIS", "País de trabajo"),
    ("PERSONA_P19DIS", "Disciplina de estudio"),
    ("PERSONA_P20", "Estado civil"),
    ("PERSONA_P21", "Vive en pareja"),
    ("PERSONA_P22", "Tiene hijos nacidos vivos"),
    ("PERSONA_P295", "Calificación ocupacional"),
    ("PERSONA_P36", "Tamaño del establecimiento"),
    ("PERSONA_P37", "Aportes jubilatorios"),
    ("PERSONA_P38T", "Horas trabajadas"),
    ("PERSONA_P40", "Busca trabajo"),
    ("PERSONA_CP1", "Tiene documento"),
    ("PERSONA_CP3", "Asistencia escolar"),
    ("PERSONA_CP4", "Nivel educativo"),
    ("PERSONA_CP5", "Edad (menores de 5)"),
    ("PERSONA_CP7", "Categoría ocupacional"),
    ("PERSONA_CP9", "Descuento jubilatorio"),
    ("PERSONA_CP12", "Años de estudio aprobados"),
    ("PERSONA_CP63", "Condición de actividad"),
    ("PERSONA_EDADAGRU", "Grupo de edad (3 grupos)"),
    ("PERSONA_EDADQUI", "Grupo de edad quinquenal"),
    ("PERSONA_RAMA2", "Rama de actividad (CIIU)"),
    ("PERSONA_RAMA91", "Rama de actividad (1991)"),
    ("HOGAR_H1", "Cantidad de personas"),
    ("HOGAR_H10", "Provisión de agua"),
    ("HOGAR_CH6", "Tenencia de la vivienda"),
    ("HOGAR_CH9", "Desagüe del inodoro"),
    ("HOGAR_CH10", "Cocina"),
    ("HOGAR_CH12", "Material de paredes"),
    ("HOGAR_CH13", "Material de techos"),
    ("HOGAR_CH14", "Condición ocupacional jefe/cónyuge"),
    ("HOGAR_CH23", "Heladera"),
    ("HOGAR_CH24", "Lavarropas"),
    ("HOGAR_CH25", "Teléfono"),
    ("HOGAR_CH26", "Computadora e internet"),
    ("HOGAR_CH28", "Calidad de materiales (CALMAT)"),
    ("HOGAR_CH33", "Privación material"),
    ("HOGAR_CH51", "Ingreso total del hogar"),
    ("HOGAR_CH82", "Tipo de hogar"),
    ("HOGAR_CHNBI", "Necesidades básicas insatisfechas"),
    ("HOGAR_CHNBI1", "NBI: Vivienda inconveniente"),
    ("HOGAR_CHNBI2", "NBI: Condiciones sanitarias"),
    ("HOGAR_CHNBI3", "NBI: Hacinamiento"),
    ("HOGAR_CHNBI4", "NBI: Inasistencia escolar"),
    ("HOGAR_CHNBI5", "NBI: Capacidad de subsistencia"),
    ("HOGAR_HACIAGRU", "Hacinamiento (personas por cuarto)"),
    ("VIVIENDA_TIPOVIV", "Tipo de relevamiento"),
    ("VIVIENDA_URP", "Área urbana/rural"),
    ("VIVIENDA_V0T", "Motivo vivienda desocupada"),
    ("VIVIENDA_V4", "Tipo de vivienda"),
    ("VIVIENDA_CV12", "Material de paredes"),
    ("VIVIENDA_CV13", "Material de techos"),
    ("VIVIENDA_CV94", "Viviendas 1994"),
    ("VIVIENDA_CV94RA", "Radios 1994"),
    ("VIVIENDA_CV951", "Segmento 1995"),
    ("VIVIENDA_CV952", "Vivienda 1995"),
    ("VIVIENDA_CC4", "Cobertura: entrevista completa"),
    ("VIVIENDA_CC5", "Cobertura: rechazo"),
    ("VIVIENDA_CC6", "Cobertura: ausencia"),
    ("VIVIENDA_CC7", "Cobertura: otra causa"),
    ("VIVIENDA_CC9", "Cobertura: vivienda desocupada"),
    ("VIVIENDA_CC10", "Cobertura: uso no habitacional"),
    ("VIVIENDA_CC11", "Cobertura: en construcción"),
    ("VIVIENDA_CC12", "Cobertura: demolida"),
    ("VIVIENDA_LOC", "Código de localidad"),
    ("VIVIENDA_MUNI", "Código de municipio"),
    ("VIVIENDA_AGLO", "Código de aglomerado"),
    ("VIVIENDA_CANTPERS", "Cantidad de personas"),
    ("VIVIENDA_CANTHOG", "Cantidad de hogares"),
)


def lookup(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A DataFrame from literal rows with an explicit schema (no inference)."""
    return spark.createDataFrame(list(rows), schema)


def provinces_1991(spark: SparkSession) -> DataFrame:
    return lookup(spark, PROVINCES_1991, "idprov int, nomprov string")


def variables_1991(spark: SparkSession) -> DataFrame:
    return lookup(spark, VARIABLES_1991, "codigo_variable string, label_file string, etiqueta_variable string")


def variables_2001(spark: SparkSession) -> DataFrame:
    return lookup(spark, VARIABLES_2001, "codigo_variable string, etiqueta_variable string")


def crosswalk_1991(spark: SparkSession) -> DataFrame:
    return lookup(spark, CROSSWALK_1991, "idprov int, provin_ref_id int")
