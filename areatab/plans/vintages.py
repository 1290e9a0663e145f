"""End-to-end tabulation of census files, for the two input models.

Flat model: every entity file carries the area codes (province, department,
fraction, radio) on each row; variables are all other non-key columns.

Linked model: the area hierarchy is a chain of dimension files
(province <- department <- fraction <- radio <- segment) joined by reference
ids, and entity files point to their parent (person -> household -> dwelling
-> segment).

Both return ``(long, metadata)`` DataFrames in the published schemas, built
from the same operators as everything else: one aggregate per run, area key
rolled down the chain, dimensions broadcast after a size check, labels
cleaned before they are joined, names attached after aggregation. Inputs are
DataFrames (see ``sources.files`` for readers); column names are matched
case-insensitively by lower-casing them first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.functions.codes import area_key, split_area_key, to_int, widen_code
from areatab.functions.textfix import repair
from areatab.operators import areas, catalog, labels, publish
from areatab.operators.frequency import frequencies_multi

# Key columns of the flat model, excluded from the variables.
FLAT_KEYS = ("idprov", "iddpto", "idfrac", "idradio", "segmento", "manzana", "idviv", "idhog", "idper")
# Unanchored exclusion patterns of the linked model, tested on
# lower-cased names (2001 style).
LINKED_EXCLUDE = ("ref_id", "id_geo", "idprov", "nomprov", "iddpto", "nomdpto", "idfrac", "idradio")
# The 2010-style list, tested case-sensitively on the names as
# written, with one extra household pattern.
EXCLUDE_2010 = ("REF_ID", "id_geo", "IDPROV", "NOMPROV", "IDDPTO", "NOMDPTO", "IDFRAC", "IDRADIO",
                "MARCA_", "CLAVE", "ACT", "CODOCUP", "CONDACT",
                "EDADAGRU", "EDADQUI", "JEFEBAJAED", "RAMA", "CARACTER",
                "P04D", "P04M", "P04A", "C$")
EXCLUDE_2010_EXTRA = {"HOGAR": ("V01$",)}


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


# How the years of the linked model differ: arguments of ``linked_plan`` and the NULL policy.
PRESETS: dict[str, dict] = {
    "2001": {"how": "inner", "null_policy": "drop"},
    "2010": {
        "how": "left", "null_policy": "drop_blank", "exclude": EXCLUDE_2010, "extra_exclude": EXCLUDE_2010_EXTRA,
        "case_sensitive": True, "repair_rules": None, "recode": False, "sentinel_labels": False,
        "fallback_to_value": False, "missing_department": None,
    },
}


def _labels(raw: DataFrame | None, codes: DataFrame, rules, junk=("NA",), recode: bool = True, sentinel: bool = True) -> DataFrame:
    """Cleaned, repaired, recoded labels plus one 'Sin dato' label per variable (each step optional)."""
    if raw is None:
        schema = "codigo_variable string, valor_categoria string, etiqueta_categoria string"
        base = codes.sparkSession.createDataFrame([], schema)
    else:
        r = raw if "orden" in raw.columns else raw.withColumn("orden", F.struct("archivo", "linea"))
        base = labels.clean_labels(r, "orden", junk=junk, recode=False)
        if rules is not None:
            base = base.withColumn("etiqueta_categoria", repair("etiqueta_categoria", rules))
        if recode:
            base = base.withColumn("etiqueta_categoria", labels.recode_labels("etiqueta_categoria"))
    return labels.add_sentinel(base, codes) if sentinel else base.select(*labels.KEY, "etiqueta_categoria")


# Published label column of each area level.
LEVEL_LABELS = {
    "provincia": "etiqueta_provincia",
    "departamento": "etiqueta_departamento",
    "fraccion": "etiqueta_fraccion",
    "radio": "etiqueta_radio",
}


def flat_plan(
    entities: Mapping[str, DataFrame],
    provinces: DataFrame | None = None,
    departments: DataFrame | None = None,
    raw_labels: DataFrame | None = None,
    repair_rules="1991",
    level_labels: Mapping[str, str] | None = None,
) -> tuple[dict, Callable[[DataFrame], DataFrame]]:
    """Flat model as ``(sources, publish_fn)``, like :func:`linked_plan`.

    Flat model. ``entities`` maps ENTITY -> rows with area codes on each row.

    ``provinces``: (idprov int, nomprov); ``departments``: (idprov int,
    iddpto int, nomdpto), e.g. after a crosswalk; ``raw_labels``: label rows
    (codigo_variable, valor_categoria, etiqueta_categoria, archivo, linea).

    ``level_labels`` maps a level (provincia, departamento, fraccion, radio)
    to a label column carried on the rows, as some sources deliver each
    level's value and label with every row. Counts are still aggregated on
    ``id_geo`` only; the labels are attached afterwards from one row per area
    (a grouped aggregate, bounded by the number of areas), replacing the
    dimension lookups.
    """
    level_labels = {k: v.lower() for k, v in (level_labels or {}).items()}
    unknown = set(level_labels) - set(LEVEL_LABELS)
    if unknown:
        raise ValueError(f"unknown levels {sorted(unknown)}; use {sorted(LEVEL_LABELS)}")
    sources, codes, area_rows = {}, [], []
    for ent, df in entities.items():
        d = _lower(df)
        names = catalog.variables_excluding_names(d.columns, FLAT_KEYS + tuple(level_labels.values()))
        vars_ = {f"{ent.upper()}_{v.upper()}": v for v in names}
        codes += list(vars_)
        d = d.withColumn("id_geo", area_key("idprov", "iddpto", "idfrac", "idradio"))
        sources[ent.upper()] = (d, vars_)
        if level_labels:
            area_rows.append(d.select("id_geo", *[F.col(c).alias(LEVEL_LABELS[lv]) for lv, c in level_labels.items()]))
    spark = next(iter(sources.values()))[0].sparkSession
    code_df = spark.createDataFrame([(c,) for c in codes], "codigo_variable string")
    lab = _labels(raw_labels, code_df, repair_rules)
    if level_labels:
        rows = area_rows[0]
        for other in area_rows[1:]:
            rows = rows.unionByName(other)
        label_cols = [LEVEL_LABELS[lv] for lv in level_labels]
        if repair_rules is not None:
            rows = rows.select("id_geo", *[repair(c, repair_rules).alias(c) for c in label_cols])
        names = rows.filter(F.col("id_geo").isNotNull()).groupBy("id_geo").agg(*[F.min(c).alias(c) for c in label_cols])
        parts = split_area_key("id_geo")
        codes_cols = {"valor_provincia": parts[0], "valor_departamento": parts[1], "valor_fraccion": parts[2],
                      "valor_radio": parts[3]}
        def publish_levels(freq: DataFrame) -> DataFrame:
            long = freq.withColumns(codes_cols).join(names, "id_geo", "left")
            return publish.to_long(labels.attach_labels(long, lab))

        return sources, publish_levels
    if provinces is None:
        raise ValueError("provinces are required unless level_labels are given")
    provs = provinces
    dptos = departments
    if repair_rules is not None and dptos is not None:
        dptos = dptos.withColumn("nomdpto", repair("nomdpto", repair_rules))
    if dptos is None:
        dptos = spark.createDataFrame([], "idprov int, iddpto int, nomdpto string")
    def publish_dims(freq: DataFrame) -> DataFrame:
        return publish.to_long(labels.attach_labels(areas.label_areas(freq, provs, dptos), lab))

    return sources, publish_dims


def tabulate_flat(*args, variable_labels: DataFrame | None = None, null_policy: str = "keep", **kwargs):
    """Flat model: ``(long, metadata)``; arguments as :func:`flat_plan`."""
    sources, publish_fn = flat_plan(*args, **kwargs)
    freq = frequencies_multi(list(sources.values()), null_policy=null_policy)
    long = publish_fn(freq)
    return long, publish.to_metadata(long, variable_labels)


def area_lookup_linked(
    prov: DataFrame, dpto: DataFrame, frac: DataFrame, radio: DataFrame, how: str = "inner", repair_rules=None,
    missing_department: str | None = "Sin dato",
) -> DataFrame:
    """Radio-level lookup ``(radio_ref_id, id_geo, published area columns...)``.

    Codes are padded to at least 2+3+2+2 and never cut, so a fraction 100
    stays apart from 101 (see ``areas.wide_codes`` for a report); a radio whose
    chain breaks under ``how='left'`` keeps its row with a NULL key. The
    department's name may be called ``nomdpto`` or ``nomdepto``.
    """
    p, d, f, r = (_lower(x) for x in (prov, dpto, frac, radio))
    if "nomdpto" not in d.columns and "nomdepto" in d.columns:
        d = d.withColumnRenamed("nomdepto", "nomdpto")
    if repair_rules is not None:
        p = p.withColumn("nomprov", repair("nomprov", repair_rules))
        d = d.withColumn("nomdpto", repair("nomdpto", repair_rules))
    # fraction and radio names exist only in some sources
    rname = F.col("nomradio") if "nomradio" in r.columns else F.lit(None).cast("string")
    fname = F.col("nomfrac") if "nomfrac" in f.columns else F.lit(None).cast("string")
    g = areas.join_chain(
        r.select("radio_ref_id", "frac_ref_id", "idradio", rname.alias("nomradio")),
        [
            (f.select("frac_ref_id", "dpto_ref_id", "idfrac", fname.alias("nomfrac")), "frac_ref_id"),
            (d.select("dpto_ref_id", "prov_ref_id", "iddpto", "nomdpto"), "dpto_ref_id"),
            (p.select("prov_ref_id", "idprov", "nomprov"), "prov_ref_id"),
        ],
        how=how,
    )
    return g.select(
        "radio_ref_id",
        area_key("idprov", "iddpto", "idfrac", "idradio", cut=False).alias("id_geo"),
        widen_code("idprov", 2).alias("valor_provincia"),
        F.col("nomprov").alias("etiqueta_provincia"),
        widen_code("iddpto", 3).alias("valor_departamento"),
        F.coalesce(F.col("nomdpto"), F.lit(missing_department)).alias("etiqueta_departamento"),
        widen_code("idfrac", 2).alias("valor_fraccion"),
        F.col("nomfrac").alias("etiqueta_fraccion"),
        widen_code("idradio", 2).alias("valor_radio"),
        F.col("nomradio").alias("etiqueta_radio"),
    )


def linked_plan(
    prov: DataFrame,
    dpto: DataFrame,
    frac: DataFrame,
    radio: DataFrame,
    seg: DataFrame,
    vivienda: DataFrame,
    hogar: DataFrame | None = None,
    persona: DataFrame | None = None,
    raw_labels: DataFrame | None = None,
    how: str = "inner",
    exclude: Sequence[str] = LINKED_EXCLUDE,
    repair_rules="2001",
    case_sensitive: bool = False,
    extra_exclude: Mapping[str, Sequence[str]] | None = None,
    hot_rows: int | None = None,
    recode: bool = True,
    sentinel_labels: bool = True,
    fallback_to_value: bool = True,
    missing_department: str | None = "Sin dato",
) -> tuple[dict, Callable[[DataFrame], DataFrame]]:
    """Linked model as ``(sources, publish_fn)``; see :func:`tabulate_linked`.

    ``sources`` maps each entity to ``(rows with id_geo, {code: column})``;
    ``publish_fn`` turns a frequency table into the published long table.
    Feed both to ``plans.job.run_resumable`` for a resumable run.

    Linked model (``how='inner'`` as in SQL runs, ``'left'`` as in data-frame runs).

    Entities: vivienda(vivienda_ref_id, seg_ref_id, vars...),
    hogar(hogar_ref_id, vivienda_ref_id, vars...), persona(hogar_ref_id, vars...).
    Variables are the columns matching none of ``exclude`` (+ the entity's
    ``extra_exclude``), tested on the names as written when
    ``case_sensitive``, else on lower-cased names; e.g.
    ``exclude=EXCLUDE_2010, extra_exclude=EXCLUDE_2010_EXTRA, case_sensitive=True``.
    ``hot_rows`` salts the entity joins for parents with more children than
    that (see ``operators.skew``). ``repair_rules`` (None: names and labels
    stay as they are), ``recode``, ``sentinel_labels`` (one 'Sin dato' label a
    variable), ``fallback_to_value`` (a missing label is the value) and
    ``missing_department`` differ by year: see ``PRESETS``.
    """
    originals = {"VIVIENDA": vivienda, "HOGAR": hogar, "PERSONA": persona}
    lookup = area_lookup_linked(prov, dpto, frac, radio, how, repair_rules, missing_department)
    seg_area = areas.roll_down(_lower(seg), "seg_ref_id", "radio_ref_id", lookup, "radio_ref_id", how=how)
    v = _lower(vivienda)
    # dwellings get their area from the segments, and are the map of the households: one join serves both
    located = areas.attach_area(v, "seg_ref_id", seg_area, "seg_ref_id", how=how, hot_rows=hot_rows)
    viv_area = located.select("vivienda_ref_id", "id_geo")
    sources, codes = {}, []

    def add(ent: str, rows: DataFrame) -> None:
        pats = list(exclude) + list((extra_exclude or {}).get(ent, ()))
        names = catalog.variables_excluding_patterns(originals[ent].columns, pats, lower=not case_sensitive)
        vars_ = {f"{ent}_{n.upper()}": n.lower() for n in names}
        codes.extend(vars_)
        sources[ent] = (rows, vars_)

    attach = lambda rows, fk, amap: areas.attach_area(rows, fk, amap, fk, how=how, hot_rows=hot_rows)
    add("VIVIENDA", located)
    if hogar is not None:
        h = _lower(hogar)
        add("HOGAR", attach(h, "vivienda_ref_id", viv_area))
        if persona is not None:
            hog_area = areas.roll_down(h, "hogar_ref_id", "vivienda_ref_id", viv_area, "vivienda_ref_id", how=how,
                                       hot_rows=hot_rows)
            add("PERSONA", attach(_lower(persona), "hogar_ref_id", hog_area))
    spark = v.sparkSession
    code_df = spark.createDataFrame([(c,) for c in codes], "codigo_variable string")
    lab = _labels(raw_labels, code_df, repair_rules, recode=recode, sentinel=sentinel_labels)
    cols = [c for c in lookup.columns if c not in ("radio_ref_id", "id_geo")]
    # one row per area (radios of one area carry the same codes and names;
    # min keeps the choice deterministic if a file disagrees)
    names = lookup.filter(F.col("id_geo").isNotNull()).groupBy("id_geo").agg(*[F.min(c).alias(c) for c in cols])

    def publish_fn(freq: DataFrame) -> DataFrame:
        # one row an area: the hash is built on the names, whatever their estimate
        long = freq.join(names.hint("shuffle_hash"), "id_geo", "left")
        return publish.to_long(labels.attach_labels(long, lab, fallback_to_value))

    return sources, publish_fn


def tabulate_linked(*args, variable_labels: DataFrame | None = None, null_policy: str = "drop", **kwargs):
    """Linked model: ``(long, metadata)``; arguments as :func:`linked_plan`."""
    sources, publish_fn = linked_plan(*args, **kwargs)
    freq = frequencies_multi(list(sources.values()), null_policy=null_policy)
    long = publish_fn(freq)
    return long, publish.to_metadata(long, variable_labels)


def tabulate_linked_2010(*args, variable_labels: DataFrame | None = None, **kwargs):
    """The linked model as in 2010 (``PRESETS``): left joins, blank values dropped, names and labels as they are."""
    return tabulate_linked(*args, variable_labels=variable_labels, **(PRESETS["2010"] | kwargs))


def crosswalk_departments(departments_raw: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Department file keyed by another province id -> (idprov, iddpto, nomdpto); misses dropped."""
    d = _lower(departments_raw)
    out = areas.crosswalk(d, crosswalk, "provin_ref_id")
    return out.select("idprov", to_int("depto").alias("iddpto"), F.col("nombdepto").alias("nomdpto"))
