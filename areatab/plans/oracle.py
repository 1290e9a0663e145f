"""DuckDB SQL equivalents of the registered queries (correctness oracle).

Written the way the reference writes them: one GROUP BY per variable glued
with UNION ALL, plain joins, COALESCE fallbacks. Tables are the driver's
pre-registered views. Column names match the Spark results exactly.
"""

from __future__ import annotations

RC = "�"

# -- shared definitions ------------------------------------------------------
G = """g AS (
  SELECT c_custkey, r_regionkey, r_name, n_nationkey, n_name,
         lpad(CAST(r_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0')
      || lpad(CAST(c_custkey % 4 AS VARCHAR), 2, '0') || lpad(CAST((c_custkey // 4) % 5 AS VARCHAR), 2, '0') AS id_geo
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

# broken dwelling file (negative balances missing), left joins all the way
GL = """gl AS (
  SELECT c_custkey,
         lpad(CAST(r_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0')
      || lpad(CAST(c_custkey % 4 AS VARCHAR), 2, '0') || lpad(CAST((c_custkey // 4) % 5 AS VARCHAR), 2, '0') AS id_geo
  FROM (SELECT * FROM customer WHERE c_acctbal >= 0) c
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

H = "h AS (SELECT orders.*, g.id_geo FROM orders JOIN g ON o_custkey = g.c_custkey)"
P = "p AS (SELECT lineitem.*, h.id_geo FROM lineitem JOIN h ON l_orderkey = h.o_orderkey)"
V = "v AS (SELECT customer.*, g.id_geo FROM customer JOIN g ON customer.c_custkey = g.c_custkey)"
HL = "hl AS (SELECT orders.*, gl.id_geo FROM orders LEFT JOIN gl ON o_custkey = gl.c_custkey)"
PL = "pl AS (SELECT lineitem.*, hl.id_geo FROM lineitem LEFT JOIN hl ON l_orderkey = hl.o_orderkey)"
VL = "vl AS (SELECT c.*, gl.id_geo FROM (SELECT * FROM customer WHERE c_acctbal >= 0) c LEFT JOIN gl ON c.c_custkey = gl.c_custkey)"

PERSONA = {
    "PERSONA_RETURNFLAG": "nullif(l_returnflag, 'A')",
    "PERSONA_STATUS": "l_linestatus",
    "PERSONA_LINENUMBER": "CAST(l_linenumber AS VARCHAR)",
}
HOGAR = {
    "HOGAR_STATUS": "o_orderstatus",
    "HOGAR_PRIORITY": "split_part(o_orderpriority, '-', 1)",
}
VIVIENDA = {"VIVIENDA_SEGMENT": "c_mktsegment"}
ALL_CODES = list(PERSONA) + list(HOGAR) + list(VIVIENDA)

LABEL_ROWS = """(VALUES ('PERSONA_RETURNFLAG', 'N', 'Nuevo', 1),
        ('PERSONA_RETURNFLAG', 'N', 'Otro', 2),
        ('PERSONA_RETURNFLAG', 'R', 'MISSING', 3),
        ('PERSONA_STATUS', 'O', 'NOTAPPLICABLE', 4),
        ('PERSONA_STATUS', 'NA', 'junk', 5),
        ('PERSONA_STATUS', NULL, 'nulo', 6)) t(codigo_variable, valor_categoria, etiqueta_categoria, linea)"""

RAW = f"""raw AS (
  SELECT codigo_variable, valor_categoria, etiqueta_categoria, CAST(linea AS BIGINT) AS linea FROM {LABEL_ROWS}
  UNION ALL
  SELECT 'HOGAR_PRIORITY', split_part(o_orderpriority, '-', 1), split_part(o_orderpriority, '-', 2), o_orderkey + 1000
  FROM orders)"""

CL = """cl AS (
  SELECT codigo_variable, valor_categoria,
         CASE arg_min(etiqueta_categoria, linea) WHEN 'NOTAPPLICABLE' THEN 'No aplica' WHEN 'MISSING' THEN 'Sin dato'
              ELSE arg_min(etiqueta_categoria, linea) END AS etiqueta_categoria
  FROM raw WHERE valor_categoria IS NOT NULL AND valor_categoria <> 'NA'
  GROUP BY codigo_variable, valor_categoria)"""

_codes_values = ", ".join(f"('{c}')" for c in ALL_CODES)
SL = f"""sl AS (
  SELECT codigo_variable, valor_categoria, etiqueta_categoria FROM cl
  UNION ALL
  SELECT vc.codigo_variable, 'Sin dato', 'Sin dato' FROM (VALUES {_codes_values}) vc(codigo_variable)
  WHERE NOT EXISTS (SELECT 1 FROM cl WHERE cl.codigo_variable = vc.codigo_variable AND cl.valor_categoria = 'Sin dato'))"""

VARIABLE_LABELS = """(VALUES ('PERSONA_RETURNFLAG', 'Indicador de devolución'),
        ('PERSONA_STATUS', 'Estado de la línea'),
        ('PERSONA_LINENUMBER', 'Número de línea'),
        ('HOGAR_STATUS', 'Estado del pedido'),
        ('HOGAR_PRIORITY', 'Prioridad')) vlab(codigo_variable, etiqueta_variable)"""

PROVINCES_1991 = """(VALUES (1, 'Salta'), (2, 'Buenos Aires'), (3, 'Ciudad Autónoma de Buenos Aires'), (4, 'San Luis'),
        (5, 'Entre Ríos'), (6, 'La Rioja'), (7, 'Santiago del Estero'), (8, 'Chaco'), (10, 'San Juan'),
        (11, 'Catamarca'), (12, 'La Pampa'), (13, 'Mendoza'), (14, 'Misiones'), (16, 'Formosa'), (17, 'Neuquén'),
        (18, 'Río Negro'), (19, 'Santa Fe'), (20, 'Tucumán'), (21, 'Chubut'), (22, 'Tierra del Fuego'),
        (23, 'Corrientes'), (24, 'Córdoba'), (25, 'Jujuy'), (26, 'Santa Cruz')) pv(idprov, nomprov)"""

CROSSWALK_1991 = """(VALUES (1, 17), (2, 2), (3, 1), (4, 19), (5, 8), (6, 12), (7, 22), (8, 6), (10, 18), (11, 3),
        (12, 11), (13, 13), (14, 14), (16, 9), (17, 15), (18, 16), (19, 21), (20, 23), (21, 7), (22, 24),
        (23, 5), (24, 4), (25, 10), (26, 20)) cw(idprov, provin_ref_id)"""


# The published variable dictionaries (code, label file, label; code, label).
VARIABLES_1991 = """(VALUES
        ('PERSONA_PARENT', 'persona_labels_parentes.csv', 'Parentesco'), ('PERSONA_SEXO', 'persona_labels_sexo.csv', 'Sexo'),
        ('PERSONA_EDAD', NULL, 'Edad'), ('PERSONA_LUGARNAC', 'persona_labels_naciocodi.csv', 'Lugar de nacimiento'),
        ('PERSONA_ASISTE', 'persona_labels_asistencia.csv', 'Asistencia escolar'),
        ('PERSONA_NIVEL', 'persona_labels_nivelasist.csv', 'Nivel educativo'),
        ('PERSONA_NIVELMAX', 'persona_labels_ultimoapro.csv', 'Máximo nivel aprobado'),
        ('PERSONA_NIVELCOM', 'persona_labels_complcurso.csv', 'Nivel completo'),
        ('HOGAR_CUARTOS', NULL, 'Cantidad de cuartos'), ('HOGAR_DESAGUE', 'hogar_labels_desaginh.csv', 'Desagüe'),
        ('HOGAR_TENENCIA', 'hogar_labels_propvivh.csv', 'Tenencia de la vivienda'),
        ('HOGAR_BANO', 'hogar_labels_inodoroh.csv', 'Baño'), ('HOGAR_TIPOH', NULL, 'Tipo de hogar'),
        ('HOGAR_TIPOHOG', NULL, 'Tipo de hogar (detallado)'), ('VIVIENDA_LOCALIDA', NULL, 'Localidad'),
        ('VIVIENDA_AREA', NULL, 'Área'), ('VIVIENDA_USO', NULL, 'Uso de la vivienda'),
        ('VIVIENDA_TIPOVIV', 'vivienda_labels_tipoviv.csv', 'Tipo de vivienda'), ('VIVIENDA_DESTINO', NULL, 'Destino'),
        ('VIVIENDA_PISO', 'vivienda_labels_pisos.csv', 'Material del piso'),
        ('VIVIENDA_AGUA', 'vivienda_labels_agua.csv', 'Provisión de agua'),
        ('VIVIENDA_AGUAOBT', 'vivienda_labels_obtagua.csv', 'Obtención del agua'), ('VIVIENDA_TIPOCASA', NULL, 'Tipo de casa'),
        ('VIVIENDA_VILLA', NULL, 'Villa de emergencia')) v91(codigo_variable, label_file, etiqueta_variable)"""

VARIABLES_2001 = """(VALUES
        ('PERSONA_P1', 'Parentesco'), ('PERSONA_P2', 'Sexo'), ('PERSONA_P3', 'Edad'), ('PERSONA_P4', 'Sabe leer y escribir'),
        ('PERSONA_P5', 'Usa computadora'), ('PERSONA_P7A', 'Lugar de nacimiento'),
        ('PERSONA_P7PROV', 'Provincia de nacimiento'), ('PERSONA_P7PAIS', 'País de nacimiento'),
        ('PERSONA_P8A', 'Residencia hace 5 años'), ('PERSONA_P8PROV', 'Provincia hace 5 años'),
        ('PERSONA_P8PAIS', 'País hace 5 años'), ('PERSONA_P9A', 'Trabaja en otro lugar'),
        ('PERSONA_P9PROV', 'Provincia de trabajo'), ('PERSONA_P9PAIS', 'País de trabajo'),
        ('PERSONA_P19DIS', 'Disciplina de estudio'), ('PERSONA_P20', 'Estado civil'), ('PERSONA_P21', 'Vive en pareja'),
        ('PERSONA_P22', 'Tiene hijos nacidos vivos'), ('PERSONA_P295', 'Calificación ocupacional'),
        ('PERSONA_P36', 'Tamaño del establecimiento'), ('PERSONA_P37', 'Aportes jubilatorios'),
        ('PERSONA_P38T', 'Horas trabajadas'), ('PERSONA_P40', 'Busca trabajo'), ('PERSONA_CP1', 'Tiene documento'),
        ('PERSONA_CP3', 'Asistencia escolar'), ('PERSONA_CP4', 'Nivel educativo'), ('PERSONA_CP5', 'Edad (menores de 5)'),
        ('PERSONA_CP7', 'Categoría ocupacional'), ('PERSONA_CP9', 'Descuento jubilatorio'),
        ('PERSONA_CP12', 'Años de estudio aprobados'), ('PERSONA_CP63', 'Condición de actividad'),
        ('PERSONA_EDADAGRU', 'Grupo de edad (3 grupos)'), ('PERSONA_EDADQUI', 'Grupo de edad quinquenal'),
        ('PERSONA_RAMA2', 'Rama de actividad (CIIU)'), ('PERSONA_RAMA91', 'Rama de actividad (1991)'),
        ('HOGAR_H1', 'Cantidad de personas'), ('HOGAR_H10', 'Provisión de agua'), ('HOGAR_CH6', 'Tenencia de la vivienda'),
        ('HOGAR_CH9', 'Desagüe del inodoro'), ('HOGAR_CH10', 'Cocina'), ('HOGAR_CH12', 'Material de paredes'),
        ('HOGAR_CH13', 'Material de techos'), ('HOGAR_CH14', 'Condición ocupacional jefe/cónyuge'), ('HOGAR_CH23', 'Heladera'),
        ('HOGAR_CH24', 'Lavarropas'), ('HOGAR_CH25', 'Teléfono'), ('HOGAR_CH26', 'Computadora e internet'),
        ('HOGAR_CH28', 'Calidad de materiales (CALMAT)'), ('HOGAR_CH33', 'Privación material'),
        ('HOGAR_CH51', 'Ingreso total del hogar'), ('HOGAR_CH82', 'Tipo de hogar'),
        ('HOGAR_CHNBI', 'Necesidades básicas insatisfechas'), ('HOGAR_CHNBI1', 'NBI: Vivienda inconveniente'),
        ('HOGAR_CHNBI2', 'NBI: Condiciones sanitarias'), ('HOGAR_CHNBI3', 'NBI: Hacinamiento'),
        ('HOGAR_CHNBI4', 'NBI: Inasistencia escolar'), ('HOGAR_CHNBI5', 'NBI: Capacidad de subsistencia'),
        ('HOGAR_HACIAGRU', 'Hacinamiento (personas por cuarto)'), ('VIVIENDA_TIPOVIV', 'Tipo de relevamiento'),
        ('VIVIENDA_URP', 'Área urbana/rural'), ('VIVIENDA_V0T', 'Motivo vivienda desocupada'),
        ('VIVIENDA_V4', 'Tipo de vivienda'), ('VIVIENDA_CV12', 'Material de paredes'), ('VIVIENDA_CV13', 'Material de techos'),
        ('VIVIENDA_CV94', 'Viviendas 1994'), ('VIVIENDA_CV94RA', 'Radios 1994'), ('VIVIENDA_CV951', 'Segmento 1995'),
        ('VIVIENDA_CV952', 'Vivienda 1995'), ('VIVIENDA_CC4', 'Cobertura: entrevista completa'),
        ('VIVIENDA_CC5', 'Cobertura: rechazo'), ('VIVIENDA_CC6', 'Cobertura: ausencia'),
        ('VIVIENDA_CC7', 'Cobertura: otra causa'), ('VIVIENDA_CC9', 'Cobertura: vivienda desocupada'),
        ('VIVIENDA_CC10', 'Cobertura: uso no habitacional'), ('VIVIENDA_CC11', 'Cobertura: en construcción'),
        ('VIVIENDA_CC12', 'Cobertura: demolida'), ('VIVIENDA_LOC', 'Código de localidad'),
        ('VIVIENDA_MUNI', 'Código de municipio'), ('VIVIENDA_AGLO', 'Código de aglomerado'),
        ('VIVIENDA_CANTPERS', 'Cantidad de personas'), ('VIVIENDA_CANTHOG', 'Cantidad de hogares')) v01(codigo_variable, etiqueta_variable)"""

# Fixed: column order of the driver tables profiled by describe_table.
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
}


def _freq(src: str, variables: dict[str, str], policy: str) -> str:
    parts = []
    for code, e in variables.items():
        if policy == "keep":
            val, cond = f"coalesce({e}, 'Sin dato')", "TRUE"
        elif policy == "drop":
            val, cond = e, f"{e} IS NOT NULL"
        else:
            val, cond = e, f"{e} IS NOT NULL AND {e} <> ''"
        parts.append(
            f"SELECT id_geo, '{code}' AS codigo_variable, {val} AS valor_categoria, CAST(count(*) AS BIGINT) AS conteo "
            f"FROM {src} WHERE id_geo IS NOT NULL AND {cond} GROUP BY id_geo, {val}"
        )
    return "\nUNION ALL\n".join(parts)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FREQ_ALL = "f AS (" + _freq("p", PERSONA, "keep") + "\nUNION ALL\n" + _freq("h", HOGAR, "keep") + "\nUNION ALL\n" + _freq("v", VIVIENDA, "keep") + ")"

LONG_SELECT = """SELECT f.id_geo,
       printf('%02d', CAST(substr(f.id_geo, 1, 2) AS INTEGER)) AS valor_provincia,
       r.r_name AS etiqueta_provincia,
       printf('%03d', CAST(substr(f.id_geo, 3, 3) AS INTEGER)) AS valor_departamento,
       coalesce(n.n_name, 'Sin dato') AS etiqueta_departamento,
       substr(f.id_geo, 6, 2) AS valor_fraccion,
       CAST(NULL AS VARCHAR) AS etiqueta_fraccion,
       substr(f.id_geo, 8, 2) AS valor_radio,
       CAST(NULL AS VARCHAR) AS etiqueta_radio,
       f.codigo_variable, f.valor_categoria,
       coalesce(sl.etiqueta_categoria, f.valor_categoria) AS etiqueta_categoria,
       f.conteo
FROM f
LEFT JOIN region r ON CAST(substr(f.id_geo, 1, 2) AS INTEGER) = r.r_regionkey
LEFT JOIN nation n ON CAST(substr(f.id_geo, 1, 2) AS INTEGER) = n.n_regionkey
                  AND CAST(substr(f.id_geo, 3, 3) AS INTEGER) = n.n_nationkey
LEFT JOIN sl ON f.codigo_variable = sl.codigo_variable AND f.valor_categoria = sl.valor_categoria"""

LONG = "long AS (" + LONG_SELECT + ")"
LONG_CTES = (G, H, P, V, FREQ_ALL, RAW, CL, SL, LONG)

METADATA = f"""meta AS (
  SELECT DISTINCT valor_categoria, etiqueta_categoria, long.codigo_variable,
         split_part(long.codigo_variable, '_', 2) AS nombre_variable,
         coalesce(vlab.etiqueta_variable, split_part(long.codigo_variable, '_', 2)) AS etiqueta_variable,
         split_part(long.codigo_variable, '_', 1) AS entidad
  FROM long LEFT JOIN {VARIABLE_LABELS} ON long.codigo_variable = vlab.codigo_variable)"""

CATALOG = """cat AS (
  SELECT DISTINCT split_part(codigo_variable, '_', 1) AS entidad, split_part(codigo_variable, '_', 2) AS nombre_variable,
         codigo_variable FROM long)"""

LONG_COLS = ("id_geo, valor_provincia, etiqueta_provincia, valor_departamento, etiqueta_departamento, "
             "valor_fraccion, etiqueta_fraccion, valor_radio, etiqueta_radio, codigo_variable, valor_categoria, "
             "etiqueta_categoria, conteo")

_requested = ", ".join(f"('{c}')" for c in ALL_CODES + ["PERSONA_EDAD"])
PRODUCED = ("prod AS (SELECT codigo_variable, CAST(count(*) AS BIGINT) AS n_rows FROM (" + _freq("p", PERSONA, "keep")
            + "\nUNION ALL\n" + _freq("h", HOGAR, "keep") + ") GROUP BY codigo_variable)")
REQUESTED = f"req AS (SELECT DISTINCT codigo_variable FROM (VALUES {_requested}) rq(codigo_variable))"

POINTS = """pts AS (
  SELECT c_custkey AS id,
         6378137.0::DOUBLE * radians(-74 + (c_custkey * 7919 % 4000)::DOUBLE / 100.0::DOUBLE) AS x,
         6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(-55 + (c_custkey * 104729 % 3300)::DOUBLE / 100.0::DOUBLE) / 2)) AS y
  FROM customer)"""
LONLAT = """ll AS (
  SELECT id, round(degrees(x / 6378137.0::DOUBLE), 9) AS lon,
         round(degrees(2 * atan(exp(y / 6378137.0::DOUBLE)) - pi() / 2), 9) AS lat FROM pts)"""
DLL = "dll AS (SELECT ll.id AS c_custkey, ll.lon, ll.lat, g.id_geo FROM ll JOIN g ON ll.id = g.c_custkey)"

SLICE_FREQ = "f AS (" + _freq("h", {"HOGAR_STATUS": "o_orderstatus"}, "keep") + ")"

DAMAGED = (f"dmg AS (SELECT doc_id, translate(text, 'áéíóúñüÁÉÍÓÚÑ', '{RC * 13}') AS text "
           "FROM documents)")


def _repair_sql(expr: str, rules) -> str:
    out = expr
    for pattern, replacement, kind in rules:
        pat = pattern.replace("'", "''")
        rep = replacement.replace("'", "''")
        if kind == "literal":
            out = f"replace({out}, '{pat}', '{rep}')"
        else:
            if pat.endswith("\\b"):
                # this engine has no look-ahead: the next character is matched and put back,
                # and a second pass meets what that character began
                pat, rep = pat[:-2] + "([^\\pL\\pM\\pN_]|$)", rep + "\\1"
                out = f"regexp_replace({out}, '{pat}', '{rep}', 'g')"
            out = f"regexp_replace({out}, '{pat}', '{rep}', 'g')"
    return f"CASE WHEN strpos({expr}, '{RC}') > 0 THEN {out} ELSE {expr} END"


def _repair_query(rules) -> str:
    fixed = _repair_sql("text", rules)
    return (_with(DAMAGED) + f"SELECT doc_id, text, CAST(length(text) - length(replace(text, '{RC}', '')) AS BIGINT) AS left_bad "
            f"FROM (SELECT doc_id, {fixed} AS text FROM dmg)")


def _tile_sql() -> str:
    n = "pow(2.0, z)"
    tx = f"floor((lon + 180.0) / 360.0 * {n})"
    lat = "greatest(least(lat, 85.0511287798066), -85.0511287798066)"
    ty = f"floor((1.0 - ln(tan(radians({lat})) + 1.0 / cos(radians({lat}))) / pi()) / 2.0 * {n})"
    top = f"(CAST({n} AS BIGINT) - 1)"
    return (f"SELECT z, least(greatest(CAST({tx} AS BIGINT), 0), {top}) AS tx, "
            f"least(greatest(CAST({ty} AS BIGINT), 0), {top}) AS ty FROM ll, (SELECT CAST(range AS INTEGER) AS z FROM range(0, 11)) zz")


def oracle_sql() -> dict[str, str]:
    from areatab.functions.textfix import RULES_1991, RULES_2001, RULES_CORRECTED

    q: dict[str, str] = {}
    q["freq_drop_nulls"] = _with(G, H, P) + _freq("p", PERSONA, "drop")
    q["freq_keep_nulls"] = _with(G, H, P) + _freq("p", PERSONA, "keep")
    q["freq_stream"] = q["freq_keep_nulls"]
    q["freq_native_codes"] = _with(G, H, P) + _freq(
        "p", {"PERSONA_LINENUMBER": "CAST(l_linenumber AS VARCHAR)", "PERSONA_SHIPYEAR": "CAST(year(l_shipdate) AS VARCHAR)"}, "keep")
    blank = dict(PERSONA)
    blank["PERSONA_RETURNFLAG"] = "CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END"
    q["freq_drop_blank"] = _with(G, H, P) + _freq("p", blank, "drop_blank")
    q["freq_hogar"] = _with(G, H) + _freq("h", HOGAR, "drop")
    q["freq_salted"] = _with(G, H, P) + _freq("p", PERSONA, "drop") + "\nUNION ALL\n" + _freq("h", HOGAR, "drop")
    q["freq_vivienda"] = _with(G, V) + _freq("v", VIVIENDA, "drop")
    q["freq_left_chain"] = _with(GL, HL, PL) + _freq("pl", PERSONA, "drop") + "\nUNION ALL\n" + _freq("hl", HOGAR, "drop")
    status = ("st AS (SELECT id_geo, 'PERSONA_STATUS' AS codigo_variable, l_linestatus AS valor_categoria FROM p "
              "UNION ALL SELECT id_geo, 'HOGAR_STATUS', o_orderstatus FROM h "
              "UNION ALL SELECT id_geo, 'HOGAR_VACIA', nullif(o_orderstatus, o_orderstatus) FROM h)")
    named = ("FROM st JOIN region ON CAST(substr(st.id_geo, 1, 2) AS INTEGER) = r_regionkey "
             "JOIN nation ON CAST(substr(st.id_geo, 1, 2) AS INTEGER) = n_regionkey AND CAST(substr(st.id_geo, 3, 3) AS INTEGER) = n_nationkey "
             "WHERE valor_categoria IS NOT NULL GROUP BY ALL")
    q["freq_by_levels"] = _with(G, H, P, status) + (
        f"SELECT r_name, n_name, codigo_variable, valor_categoria, CAST(count(*) AS BIGINT) AS conteo {named}"
    )
    q["freq_four_levels"] = _with(G, H, P, status) + (
        "SELECT substr(st.id_geo, 1, 2) AS valor_provincia, r_name AS etiqueta_provincia, "
        "substr(st.id_geo, 3, 3) AS valor_departamento, n_name AS etiqueta_departamento, "
        "substr(st.id_geo, 6, 2) AS valor_fraccion, 'Fraccion ' || substr(st.id_geo, 6, 2) AS etiqueta_fraccion, "
        "substr(st.id_geo, 8, 2) AS valor_radio, 'Radio ' || substr(st.id_geo, 8, 2) AS etiqueta_radio, "
        f"codigo_variable, valor_categoria, CAST(count(*) AS BIGINT) AS conteo {named}"
    )
    q["freq_all"] = _with(G, H, P, V) + _freq("p", PERSONA, "keep") + "\nUNION ALL\n" + _freq("h", HOGAR, "keep") + "\nUNION ALL\n" + _freq("v", VIVIENDA, "keep")
    q["total_check"] = _with(G, H, P, "f AS (" + _freq("p", PERSONA, "keep") + ")") + (
        "SELECT codigo_variable, CAST(sum(conteo) AS BIGINT) AS total, "
        "(SELECT CAST(count(*) AS BIGINT) FROM p) AS expected, "
        "CAST(sum(conteo) AS BIGINT) = (SELECT count(*) FROM p) AS ok FROM f GROUP BY codigo_variable"
    )
    q["area_lookup"] = _with(G) + "SELECT c_custkey, id_geo, r_name, n_name FROM g"
    q["area_lookup_left"] = (
        "SELECT c_custkey, lpad(CAST(r.r_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') "
        "|| lpad(CAST(c_custkey % 4 AS VARCHAR), 2, '0') || lpad(CAST((c_custkey // 4) % 5 AS VARCHAR), 2, '0') AS id_geo, "
        "r.r_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
        "LEFT JOIN (SELECT * FROM region WHERE r_name <> 'MIDDLE EAST') r ON n_regionkey = r.r_regionkey"
    )
    q["area_key"] = (
        "SELECT c_custkey, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS valor_provincia, "
        "lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS valor_departamento, "
        "lpad(CAST(c_custkey % 4 AS VARCHAR), 2, '0') AS valor_fraccion, "
        "lpad(CAST((c_custkey // 4) % 5 AS VARCHAR), 2, '0') AS valor_radio, "
        "lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') "
        "|| lpad(CAST(c_custkey % 4 AS VARCHAR), 2, '0') || lpad(CAST((c_custkey // 4) % 5 AS VARCHAR), 2, '0') AS id_geo "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey"
    )
    q["area_code_format"] = (
        "SELECT c_custkey, printf('%02d', n_regionkey) AS valor_provincia, printf('%03d', c_nationkey) AS valor_departamento, "
        "printf('%02d', c_custkey % 4) AS valor_fraccion, printf('%06d', c_custkey) AS valor_vivienda "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey"
    )
    cov = []
    for ent, src in (("PERSONA", "pl"), ("HOGAR", "hl"), ("VIVIENDA", "vl")):
        cov.append(
            f"SELECT '{ent}' AS entidad, round(avg(CASE WHEN id_geo IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100, 2)::DOUBLE AS pct, "
            f"CAST(count(*) AS BIGINT) AS n FROM {src}"
        )
    q["join_coverage"] = _with(GL, HL, PL, VL) + "\nUNION ALL\n".join(cov)
    q["crosswalk_codes"] = (
        "SELECT cw.idprov, cw.provin_ref_id, c.n FROM (SELECT c_nationkey AS provin_ref_id, CAST(count(*) AS BIGINT) AS n "
        f"FROM customer GROUP BY c_nationkey) c JOIN {CROSSWALK_1991} ON c.provin_ref_id = cw.provin_ref_id"
    )
    q["inline_lookup"] = (
        "SELECT printf('%02d', c.idprov) AS valor_provincia, coalesce(pv.nomprov, 'Sin dato') AS etiqueta_provincia, c.n "
        "FROM (SELECT c_nationkey AS idprov, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY c_nationkey) c "
        f"LEFT JOIN {PROVINCES_1991} ON c.idprov = pv.idprov"
    )
    q["inline_dictionaries"] = (
        "SELECT a.codigo_variable, a.label_file, a.etiqueta_variable, v01.codigo_variable AS codigo_2001, c.n "
        "FROM (SELECT CAST(o_orderkey % 24 AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1) c "
        f"JOIN (SELECT *, row_number() OVER (ORDER BY codigo_variable) - 1 AS k FROM {VARIABLES_1991}) a ON a.k = c.k "
        f"LEFT JOIN {VARIABLES_2001} ON a.etiqueta_variable = v01.etiqueta_variable"
    )
    q["label_areas"] = _with(G, H, P, "f AS (" + _freq("p", PERSONA, "drop") + ")") + (
        "SELECT f.id_geo, printf('%02d', CAST(substr(f.id_geo, 1, 2) AS INTEGER)) AS valor_provincia, r.r_name AS etiqueta_provincia, "
        "printf('%03d', CAST(substr(f.id_geo, 3, 3) AS INTEGER)) AS valor_departamento, "
        "coalesce(n.n_name, 'Sin dato') AS etiqueta_departamento, substr(f.id_geo, 6, 2) AS valor_fraccion, "
        "substr(f.id_geo, 8, 2) AS valor_radio, f.codigo_variable, f.valor_categoria, f.conteo FROM f "
        "LEFT JOIN region r ON CAST(substr(f.id_geo, 1, 2) AS INTEGER) = r.r_regionkey "
        "LEFT JOIN nation n ON CAST(substr(f.id_geo, 1, 2) AS INTEGER) = n.n_regionkey "
        "AND CAST(substr(f.id_geo, 3, 3) AS INTEGER) = n.n_nationkey"
    )
    q["clean_labels"] = _with(RAW, CL) + "SELECT codigo_variable, valor_categoria, etiqueta_categoria FROM cl"
    q["recode_labels"] = _with(RAW) + (
        "SELECT codigo_variable, valor_categoria, CASE etiqueta_categoria WHEN 'NOTAPPLICABLE' THEN 'No aplica' "
        "WHEN 'MISSING' THEN 'Sin dato' ELSE etiqueta_categoria END AS etiqueta_categoria, linea FROM raw"
    )
    q["sentinel_labels"] = _with(RAW, CL, SL) + "SELECT codigo_variable, valor_categoria, etiqueta_categoria FROM sl"
    q["label_categories"] = _with(G, H, P, "f AS (" + _freq("p", PERSONA, "keep") + ")", RAW, CL, SL) + (
        "SELECT f.id_geo, f.codigo_variable, f.valor_categoria, coalesce(sl.etiqueta_categoria, f.valor_categoria) AS etiqueta_categoria, "
        "f.conteo FROM f LEFT JOIN sl ON f.codigo_variable = sl.codigo_variable AND f.valor_categoria = sl.valor_categoria"
    )
    q["publish_long"] = _with(*LONG_CTES) + f"SELECT {LONG_COLS} FROM long"
    q["long_roundtrip"] = q["publish_long"]
    q["census_job"] = q["publish_long"]
    q["linked_model"] = q["publish_long"]
    q["census_job_changed"] = q["publish_long"]
    q["csv_linked"] = q["publish_long"]
    q["label_files"] = q["label_files_upper"] = q["label_files_mapped"] = q["clean_labels"]
    q["label_files_quarantine"] = _with(RAW) + (
        "SELECT lower(split_part(codigo_variable, '_', 1)) || '_labels_' || lower(split_part(codigo_variable, '_', 2)) || '.csv' AS archivo, "
        "'success' AS estado, CAST(NULL AS VARCHAR) AS motivo, CAST(count(*) AS BIGINT) AS n_filas, CAST(count(*) AS BIGINT) AS n_etiquetas "
        "FROM (SELECT DISTINCT codigo_variable, valor_categoria, etiqueta_categoria FROM raw) GROUP BY codigo_variable "
        "UNION ALL SELECT archivo, estado, motivo, CAST(n AS BIGINT), CAST(m AS BIGINT) FROM (VALUES "
        "('persona_labels_rota.csv', 'error', 'campos', 2, 0), ('persona_labels_latin.csv', 'error', 'texto', 1, 0), "
        "('persona_labels_vacia.csv', 'empty', NULL, 0, 0), ('persona_labels_coma.csv', 'error', 'cabecera', 1, 0), "
        "('notas.csv', 'error', 'nombre', 1, 0), ('persona_labels_zip.csv.gz', 'error', 'ilegible', 0, 0), "
        "('persona_labels_sana.csv.gz', 'success', NULL, 1, 1)) odd(archivo, estado, motivo, n, m)"
    )
    # 2010: the missing province leaves its areas without a key, a missing name stays NULL
    persona_2010 = dict(PERSONA)
    persona_2010["PERSONA_STATUS"] = "CASE WHEN l_linestatus = 'F' THEN '' ELSE l_linestatus END"
    kept = "WHERE NOT EXISTS (SELECT 1 FROM region WHERE r_name = 'MIDDLE EAST' AND printf('%02d', r_regionkey) = substr(f.id_geo, 1, 2))"
    f_2010 = "f AS (" + "\nUNION ALL\n".join(
        (_freq("p", persona_2010, "drop_blank"), _freq("h", HOGAR, "drop_blank"), _freq("v", VIVIENDA, "drop_blank"))) + ")"
    long_2010 = LONG_SELECT.replace("coalesce(n.n_name, 'Sin dato')", "CASE WHEN n.n_nationkey % 5 <> 0 THEN n.n_name END").replace(
        "coalesce(sl.etiqueta_categoria, f.valor_categoria)", "sl.etiqueta_categoria")
    plain_labels = """sl AS (SELECT codigo_variable, valor_categoria, arg_min(etiqueta_categoria, linea) AS etiqueta_categoria
      FROM raw WHERE valor_categoria IS NOT NULL AND valor_categoria <> 'NA' GROUP BY codigo_variable, valor_categoria)"""
    q["linked_2010"] = _with(G, H, P, V, f_2010, RAW, plain_labels, f"long AS ({long_2010} {kept})") + f"SELECT {LONG_COLS} FROM long"
    wide_frac = "CASE WHEN c_custkey % 4 >= 2 THEN c_custkey % 4 + 98 ELSE c_custkey % 4 END"
    wide_g = G.replace("lpad(CAST(c_custkey % 4 AS VARCHAR), 2, '0')", "fr").replace(
        "FROM customer JOIN", f"FROM (SELECT *, CASE WHEN c_custkey % 4 >= 2 THEN CAST({wide_frac} AS VARCHAR) "
        f"ELSE lpad(CAST({wide_frac} AS VARCHAR), 2, '0') END AS fr FROM customer) customer JOIN")
    q["linked_wide_codes"] = _with(wide_g, H) + (
        "SELECT id_geo, substr(id_geo, 6, length(id_geo) - 7) AS valor_fraccion, 'HOGAR_STATUS' AS codigo_variable, "
        "o_orderstatus AS valor_categoria, CAST(count(*) AS BIGINT) AS conteo FROM h WHERE o_orderstatus IS NOT NULL GROUP BY ALL"
    )
    q["csv_flat"] = _with(G, V, "f AS (" + _freq("v", VIVIENDA, "keep") + ")") + (
        "SELECT f.id_geo, 'Jardín ' || replace(n_name, 'P', 'p') || ' público' AS etiqueta_departamento, "
        "f.codigo_variable, f.valor_categoria, f.conteo "
        "FROM f JOIN nation ON CAST(substr(f.id_geo, 1, 2) AS INTEGER) = n_regionkey AND CAST(substr(f.id_geo, 3, 3) AS INTEGER) = n_nationkey"
    )
    q["xml_dictionary"] = _with(*LONG_CTES) + (
        "SELECT long.codigo_variable, any_value(vlab.etiqueta_variable) AS etiqueta_variable, "
        "split_part(long.codigo_variable, '_', 1) AS entidad, split_part(long.codigo_variable, '_', 2) AS nombre_variable, "
        f"CAST(count(*) AS BIGINT) AS n_rows FROM long LEFT JOIN {VARIABLE_LABELS} ON long.codigo_variable = vlab.codigo_variable "
        "GROUP BY long.codigo_variable"
    )
    level_long = LONG_SELECT.replace(
        "coalesce(n.n_name, 'Sin dato') AS etiqueta_departamento", "n.n_name AS etiqueta_departamento").replace(
        "CAST(NULL AS VARCHAR) AS etiqueta_fraccion", "'Fraccion ' || substr(f.id_geo, 6, 2) AS etiqueta_fraccion").replace(
        "CAST(NULL AS VARCHAR) AS etiqueta_radio", "'Radio ' || substr(f.id_geo, 8, 2) AS etiqueta_radio").replace(
        "printf('%02d', CAST(substr(f.id_geo, 1, 2) AS INTEGER))", "substr(f.id_geo, 1, 2)").replace(
        "printf('%03d', CAST(substr(f.id_geo, 3, 3) AS INTEGER))", "substr(f.id_geo, 3, 3)")
    q["flat_level_labels"] = _with(G, H, P, "f AS (" + _freq("p", PERSONA, "keep") + ")", RAW, CL, SL,
                                   "long AS (" + level_long + ")") + f"SELECT {LONG_COLS} FROM long"
    q["flat_model"] = _with(*LONG_CTES) + f"SELECT {LONG_COLS} FROM long WHERE codigo_variable LIKE 'PERSONA%'"
    q["variable_partition_roundtrip"] = _with(*LONG_CTES) + f"SELECT {LONG_COLS} FROM long WHERE codigo_variable = 'HOGAR_STATUS'"
    q["clustered_roundtrip"] = _with(*LONG_CTES) + (
        f"SELECT {LONG_COLS} FROM long WHERE id_geo BETWEEN '01' AND '03' AND codigo_variable IN ('HOGAR_STATUS', 'PERSONA_STATUS')")
    q["csv_mixed"] = ("SELECT CAST(c_custkey AS VARCHAR) AS \"CLAVE\", 'Jardín; ' || c_mktsegment || ', año' AS \"NOMBRE\", "
                      "c_mktsegment AS \"SEGMENTO\" FROM customer")
    q["csv_dialects"] = (
        "SELECT CASE c_custkey % 3 WHEN 0 THEN ';' WHEN 1 THEN ',' ELSE chr(9) END AS separador, "
        "CASE c_custkey % 3 WHEN 1 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS juego, c_custkey % 3 <> 2 AS comillas, true AS regular, "
        "3 AS n_campos, CAST(count(*) AS BIGINT) AS n_filas FROM customer GROUP BY c_custkey % 3")
    q["publish_metadata"] = _with(*LONG_CTES, METADATA) + "SELECT * FROM meta"
    q["dataset_stats"] = _with(*LONG_CTES) + (
        "SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(DISTINCT codigo_variable) AS BIGINT) AS unique_vars, "
        "CAST(count(DISTINCT id_geo) AS BIGINT) AS unique_geos FROM long"
    )
    q["dataset_stats_merged"] = q["dataset_stats"]
    ranges = [f"SELECT '{t}' AS tabla, CAST(count(*) AS BIGINT) AS n, CAST(min({k}) AS BIGINT) AS menor, CAST(max({k}) AS BIGINT) AS mayor FROM {t}"
              for t, k in (("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"), ("orders", "o_orderkey"),
                           ("lineitem", "l_orderkey"))]
    ranges.append("SELECT 'largo', CAST(count(*) AS BIGINT), CAST(min(conteo) AS BIGINT), CAST(max(conteo) AS BIGINT) FROM long")
    q["footer_ranges"] = _with(*LONG_CTES) + "\nUNION ALL\n".join(ranges)
    q["footer_variables"] = _with(*LONG_CTES) + "SELECT codigo_variable, CAST(count(*) AS BIGINT) AS n_rows FROM long GROUP BY codigo_variable"
    q["published_snapshot"] = _with(*LONG_CTES, METADATA) + (
        "SELECT codigo_variable, n_filas, n_categorias FROM "
        "(SELECT codigo_variable, CAST(count(*) AS BIGINT) AS n_filas FROM long GROUP BY codigo_variable) JOIN "
        "(SELECT codigo_variable, CAST(count(*) AS BIGINT) AS n_categorias FROM meta GROUP BY codigo_variable) USING (codigo_variable)"
    )
    counts = [f"SELECT '{t}' AS tabla, CAST(count(*) AS BIGINT) AS n FROM {t}" for t in ("region", "nation", "customer", "orders", "lineitem")]
    counts.append("SELECT 'largo' AS tabla, CAST(count(*) AS BIGINT) AS n FROM long")
    q["table_counts"] = _with(*LONG_CTES) + "\nUNION ALL\n".join(counts)
    q["variable_catalog"] = _with(*LONG_CTES, CATALOG) + "SELECT entidad, nombre_variable, codigo_variable FROM cat"
    q["duplicate_variable_names"] = _with(*LONG_CTES, CATALOG) + (
        "SELECT nombre_variable, entidad, codigo_variable FROM cat WHERE nombre_variable IN "
        "(SELECT nombre_variable FROM cat GROUP BY nombre_variable HAVING count(*) > 1) ORDER BY nombre_variable, entidad"
    )
    q["pending_variables"] = _with(G, H, P, PRODUCED, REQUESTED) + (
        "SELECT codigo_variable FROM req WHERE codigo_variable NOT IN (SELECT codigo_variable FROM prod)"
    )
    q["resume_counts"] = _with(G, H, P, PRODUCED, REQUESTED) + (
        "SELECT CAST(sum(CASE WHEN prod.codigo_variable IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_done, "
        "CAST(sum(CASE WHEN prod.codigo_variable IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_todo "
        "FROM req LEFT JOIN prod ON req.codigo_variable = prod.codigo_variable"
    )
    q["run_manifest"] = _with(G, H, P, PRODUCED, REQUESTED) + (
        "SELECT req.codigo_variable, CASE WHEN prod.n_rows IS NULL THEN 'missing' ELSE 'success' END AS status, "
        "CAST(coalesce(prod.n_rows, 0) AS BIGINT) AS n_rows, CAST(NULL AS BOOLEAN) AS con_mensaje "
        "FROM req LEFT JOIN prod ON req.codigo_variable = prod.codigo_variable "
        "UNION ALL SELECT * FROM (VALUES ('VIVIENDA_VACIA', 'empty', CAST(0 AS BIGINT), CAST(NULL AS BOOLEAN)), "
        "('VIVIENDA_ROTA', 'error', CAST(0 AS BIGINT), TRUE)) odd"
    )
    q["distinct_variables"] = _with(*LONG_CTES, METADATA) + (
        "SELECT DISTINCT codigo_variable, etiqueta_variable FROM meta ORDER BY codigo_variable"
    )
    q["categories_per_variable"] = _with(*LONG_CTES, METADATA) + (
        "SELECT codigo_variable, etiqueta_variable, CAST(count(*) AS BIGINT) AS num_categories FROM meta "
        "GROUP BY codigo_variable, etiqueta_variable ORDER BY num_categories DESC, codigo_variable"
    )
    q["preview"] = _with(*LONG_CTES) + f"SELECT {LONG_COLS} FROM long ORDER BY id_geo, codigo_variable, valor_categoria LIMIT 10"
    slice_long = "long AS (" + LONG_SELECT + ")"
    q["variable_slice"] = _with(G, H, SLICE_FREQ, RAW, CL, SL, slice_long) + f"SELECT {LONG_COLS} FROM long"
    q["reproject_points"] = _with(POINTS, LONLAT) + "SELECT id, lon, lat FROM ll"
    q["bbox"] = _with(G, POINTS, LONLAT, DLL) + (
        "SELECT id_geo, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat FROM dll GROUP BY id_geo"
    )
    q["tile_counts"] = _with(POINTS, LONLAT) + (
        f"SELECT z, tx, ty, CAST(count(*) AS BIGINT) AS n FROM ({_tile_sql()}) GROUP BY z, tx, ty"
    )
    q["join_geometry"] = _with(G, H, SLICE_FREQ, RAW, CL, SL, slice_long, POINTS, LONLAT, DLL) + (
        "SELECT long.id_geo, long.codigo_variable, long.valor_categoria, long.etiqueta_categoria, long.conteo, t.lon, t.lat "
        "FROM long JOIN (SELECT id_geo, arg_min(lon, c_custkey) AS lon, arg_min(lat, c_custkey) AS lat FROM dll GROUP BY id_geo) t "
        "ON long.id_geo = t.id_geo"
    )
    tr = "tr AS (SELECT id_geo, arg_min(lon, c_custkey) AS lon, arg_min(lat, c_custkey) AS lat FROM dll GROUP BY id_geo)"
    q["geo_profile"] = _with(G, POINTS, LONLAT, DLL, tr) + (
        "SELECT CAST(count(*) AS BIGINT) AS n_rows, 3 AS n_columns, 'EPSG:4326' AS crs, min(lon) AS min_lon, "
        "min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat FROM tr"
    )
    q["sql_recipes"] = _with(G, H, SLICE_FREQ, RAW, CL, SL, slice_long, POINTS, LONLAT, DLL, tr) + (
        "SELECT g.id_geo, g.lon, g.lat, c.codigo_variable, c.valor_categoria, c.etiqueta_categoria, c.conteo "
        "FROM tr g JOIN long c ON g.id_geo = c.id_geo WHERE c.codigo_variable = 'HOGAR_STATUS'"
    )
    q["export_geometry"] = q["join_geometry"]
    q["wkb_points"] = _with(POINTS, LONLAT) + "SELECT id, 'Point' AS kind, lon, lat FROM ll"
    side = "(1000.0::DOUBLE * (c_custkey % 3 + 1))"
    second = "c_custkey % 5 = 0"
    q["wkb_polygons"] = (
        f"SELECT c_custkey AS id, CASE WHEN {second} THEN 'MultiPolygon' ELSE 'Polygon' END AS kind, "
        "CASE WHEN c_custkey % 2 = 0 THEN 3857 END AS srid, "
        f"CASE WHEN {second} THEN 2 ELSE 1 END AS n_parts, CASE WHEN {second} THEN 3 ELSE 2 END AS n_rings, "
        f"round({side} * {side} * (CASE WHEN {second} THEN 1.75 ELSE 0.75 END)::DOUBLE, 1) AS area FROM customer"
    )
    wide = f"{side} * CASE WHEN c_custkey % 5 = 0 THEN 3 ELSE 1 END"
    boxes = (f"bx AS (SELECT c_custkey, x, y, x + {wide} AS x2, y + {side} AS y2 FROM pts JOIN customer ON id = c_custkey), "
             "bl AS (SELECT c_custkey, round(degrees(x / 6378137.0::DOUBLE), 9) AS min_lon, "
             "round(degrees(2 * atan(exp(y / 6378137.0::DOUBLE)) - pi() / 2), 9) AS min_lat, "
             "round(degrees(x2 / 6378137.0::DOUBLE), 9) AS max_lon, "
             "round(degrees(2 * atan(exp(y2 / 6378137.0::DOUBLE)) - pi() / 2), 9) AS max_lat FROM bx)")
    q["reproject_rings"] = _with(POINTS, boxes) + (
        f"SELECT c_custkey AS id, CASE WHEN {second} THEN 15 ELSE 10 END AS n_points, min_lon, min_lat, max_lon, max_lat FROM bl"
    )
    q["bbox_polygons"] = _with(G, POINTS, boxes) + (
        "SELECT id_geo, min(min_lon) AS min_lon, min(min_lat) AS min_lat, max(max_lon) AS max_lon, max(max_lat) AS max_lat "
        "FROM bl JOIN g USING (c_custkey) GROUP BY id_geo"
    )
    # every tile of each square's box, less those strictly inside its hole, once for each plot
    world = "40075016.68557849"
    line = lambda e, n: f"CAST(floor((({e}) / {world}::DOUBLE + 0.5::DOUBLE) * {n}) AS BIGINT)"
    down = lambda e, n: f"CAST(floor((0.5::DOUBLE - ({e}) / {world}::DOUBLE) * {n}) AS BIGINT)"
    n = "pow(2.0, z)"
    squares = (
        f"sq AS (SELECT c_custkey, x, y, s, x + s AS x2, y + s AS y2, x + s / 4 AS hx, y AS hy, true AS hole FROM "
        f"(SELECT c_custkey, x, y, {side} AS s FROM pts JOIN customer ON id = c_custkey) "
        f"UNION ALL SELECT c_custkey, x + s * 2, y, s, x + s * 2 + s, y + s, 0, 0, false FROM "
        f"(SELECT c_custkey, x, y, {side} AS s FROM pts JOIN customer ON id = c_custkey) WHERE {second})")
    grid = (
        f"gr AS (SELECT c_custkey, z, hole, {line('x', n)} AS a, {line('x2', n)} AS b, {down('y2', n)} AS c, {down('y', n)} AS d, "
        f"{line('hx', n)} AS ha, {line('hx + s / 2', n)} AS hb, {down('hy + s / 2', n)} AS hc, {down('hy', n)} AS hd "
        "FROM sq, (SELECT CAST(range AS INTEGER) AS z FROM range(0, 17)) zz)")
    q["tile_cover_polygons"] = _with(POINTS, squares, grid) + (
        "SELECT z, tx, ty, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT c_custkey, z, tx, ty FROM "
        "(SELECT *, unnest(range(c, d + 1)) AS ty FROM (SELECT *, unnest(range(a, b + 1)) AS tx FROM gr)) "
        "WHERE NOT (hole AND tx > ha AND tx < hb AND ty > hc AND ty < hd)) GROUP BY z, tx, ty"
    )
    tract = ("tract AS (SELECT * FROM (SELECT g.id_geo, bl.*, row_number() OVER (PARTITION BY g.id_geo ORDER BY c_custkey) AS k "
             "FROM bl JOIN g USING (c_custkey)) WHERE k = 1)")
    q["join_geometry_polygons"] = _with(G, H, SLICE_FREQ, RAW, CL, SL, slice_long, POINTS, boxes, tract) + (
        "SELECT long.id_geo, codigo_variable, valor_categoria, etiqueta_categoria, conteo, min_lon, min_lat, max_lon, max_lat, "
        f"CASE WHEN {second} THEN 'MultiPolygon' ELSE 'Polygon' END AS kind, CASE WHEN {second} THEN 3 ELSE 2 END AS n_rings, "
        f"round({side} * {side} * (CASE WHEN {second} THEN 1.75 ELSE 0.75 END)::DOUBLE, 1) AS area "
        "FROM long JOIN tract ON long.id_geo = tract.id_geo "
        "WHERE max_lon >= -66.0 AND min_lon <= -52.0 AND max_lat >= -42.0 AND min_lat <= -28.0"
    )
    q["repair_text_2001"] = _repair_query(RULES_2001)
    q["repair_text_1991"] = _repair_query(RULES_1991)
    q["repair_text_corrected"] = _repair_query(RULES_CORRECTED)
    q["repair_text_literal"] = _repair_query([r for r in RULES_2001 if r[2] == "literal"])
    prof = []
    for t, cols in TABLE_COLUMNS.items():
        for i, col in enumerate(cols):
            prof.append(
                f"SELECT '{t}' AS tabla, '{col}' AS columna, {i + 1} AS posicion, CAST(count(*) AS BIGINT) AS n_filas, "
                f"CAST(count(*) - count({col}) AS BIGINT) AS n_nulos FROM {t}"
            )
    q["describe_table"] = "\nUNION ALL\n".join(prof)
    return q
