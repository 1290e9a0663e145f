"""The census model over the driver's tables.

Entity chain and area hierarchy used by every registered query:

    PERSONA  = lineitem   (l_orderkey -> HOGAR)
    HOGAR    = orders     (o_custkey  -> VIVIENDA)
    VIVIENDA = customer   (c_nationkey -> department)
    department = nation   (n_regionkey -> province)
    province   = region

The area key ``id_geo`` has the published 2+3+2+2 layout: province code,
department code, then fraction and radio codes derived from the dwelling key.
Category variables per entity are listed in ``VARIABLES``; the person
``RETURNFLAG`` maps ``'A'`` to NULL so the NULL policies are exercised on a
category that holds a third of all persons.

Plan shape (checked with ``explain``): region and nation are broadcast after
a size check; ``orders`` is joined to the dwelling area map on ``o_custkey``
to form a two-column ``(o_orderkey, id_geo)`` map; ``lineitem`` is shuffled
once on ``l_orderkey`` with only the columns the variables need; the
aggregate runs partial on the map side of that join.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areatab.functions.codes import area_key
from areatab.operators import areas

def fraction_code() -> Column:
    """Fraction code of a dwelling, derived from its key (4 fractions per department).

    The modulo derives a code for every dwelling; it filters nothing.
    """
    return F.col("c_custkey") % 4


def radio_code() -> Column:
    """Radio code of a dwelling, derived from its key (5 radios per fraction)."""
    return F.expr("(c_custkey div 4) % 5")


def point_columns() -> tuple[Column, Column]:
    """EPSG:3857 coordinates of a dwelling, derived from its key."""
    lon = F.lit(-74.0) + (F.col("c_custkey") * 7919 % 4000).cast("double") / F.lit(100.0)
    lat = F.lit(-55.0) + (F.col("c_custkey") * 104729 % 3300).cast("double") / F.lit(100.0)
    x = F.lit(6378137.0) * F.radians(lon)
    y = F.lit(6378137.0) * F.ln(F.tan(F.lit(3.141592653589793 / 4) + F.radians(lat) / F.lit(2.0)))
    return x, y


# Fixed: which driver table plays which census entity.
ENTITY_TABLES = {"PERSONA": "lineitem", "HOGAR": "orders", "VIVIENDA": "customer"}


def _variables() -> dict[str, dict[str, Column]]:
    return {
        "PERSONA": {
            "PERSONA_RETURNFLAG": F.nullif(F.col("l_returnflag"), F.lit("A")),
            "PERSONA_STATUS": F.col("l_linestatus"),
            "PERSONA_LINENUMBER": F.col("l_linenumber").cast("string"),
        },
        "HOGAR": {
            "HOGAR_STATUS": F.col("o_orderstatus"),
            "HOGAR_PRIORITY": F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(1)),
        },
        "VIVIENDA": {
            "VIVIENDA_SEGMENT": F.col("c_mktsegment"),
        },
    }


# Fixed: human-readable variable labels (one variable deliberately has none,
# so the metadata falls back to the variable name).
VARIABLE_LABELS = (
    ("PERSONA_RETURNFLAG", "Indicador de devolución"),
    ("PERSONA_STATUS", "Estado de la línea"),
    ("PERSONA_LINENUMBER", "Número de línea"),
    ("HOGAR_STATUS", "Estado del pedido"),
    ("HOGAR_PRIORITY", "Prioridad"),
)

# Fixed: a small hand-written label file with a duplicate key, a special
# English label of each kind, and two junk keys. (variable, value, label, line)
LABEL_FILE = (
    ("PERSONA_RETURNFLAG", "N", "Nuevo", 1),
    ("PERSONA_RETURNFLAG", "N", "Otro", 2),
    ("PERSONA_RETURNFLAG", "R", "MISSING", 3),
    ("PERSONA_STATUS", "O", "NOTAPPLICABLE", 4),
    ("PERSONA_STATUS", "NA", "junk", 5),
    ("PERSONA_STATUS", None, "nulo", 6),
)

# Offset that puts label rows derived from data after the hand-written file.
DERIVED_LABEL_LINE0 = 1000


def _memo(fn):
    """Remember the lazy plan a method returns for given arguments.

    DataFrames are immutable plans; reusing one only saves rebuilding it on
    the driver. Every action still executes it in full.
    """

    @functools.wraps(fn)
    def wrapper(self, *args, **kwargs):
        key = (fn.__name__, args, tuple(sorted(kwargs.items())))
        plans = self._cache.setdefault("_plans", {})
        if key not in plans:
            plans[key] = fn(self, *args, **kwargs)
        return plans[key]

    return wrapper


@dataclass
class Census:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    # -- sources ---------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        """The table as a lazy scan; each table is listed and opened once."""
        df = self._cache.get(name)
        if df is None:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._cache[name] = df
        return df

    @property
    def variables(self) -> dict[str, dict[str, Column]]:
        return _variables()

    # -- area dimensions -------------------------------------------------
    @_memo
    def provinces(self, broken: bool = False) -> DataFrame:
        r = self.table("region")
        if broken:
            # a province file that lost one province
            r = r.filter(F.col("r_name") != F.lit("MIDDLE EAST"))
        return r.select(F.col("r_regionkey").alias("idprov"), F.col("r_name").alias("nomprov"))

    @_memo
    def departments(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_regionkey").alias("idprov"), F.col("n_nationkey").alias("iddpto"), F.col("n_name").alias("nomdpto")
        )

    @_memo
    def dwellings(self, broken: bool = False) -> DataFrame:
        c = self.table("customer")
        if broken:
            # a dwelling file that lost the dwellings with a negative balance
            c = c.filter(F.col("c_acctbal") >= F.lit(0.0))
        return c

    @_memo
    def dwelling_area(self, how: str = "inner", broken_provinces: bool = False, broken_dwellings: bool = False,
                      names: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
        """``(c_custkey, id_geo[, r_regionkey, r_name, n_nationkey, n_name], keep...)`` per dwelling.

        ``keep`` carries dwelling columns along, so the dwelling entity gets
        its area in the same pass instead of a self-join.
        """
        c = self.dwellings(broken_dwellings).select("c_custkey", "c_nationkey", *[k for k in keep if k not in ("c_custkey", "c_nationkey")])
        n = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_nationkey", "n_name", "n_regionkey")
        # the province code comes from the province file itself, so a
        # missing province leaves the key NULL under a left join
        r = self.provinces(broken_provinces).select(
            F.col("idprov").alias("n_regionkey"), F.col("idprov").alias("r_regionkey"), F.col("nomprov").alias("r_name")
        )
        g = areas.join_chain(c, [(n, "c_nationkey"), (r, "n_regionkey")], how=how)
        key = area_key("r_regionkey", "n_nationkey", fraction_code(), radio_code())
        g = g.withColumn("id_geo", key)
        cols = ["c_custkey", "id_geo"] + (["r_regionkey", "r_name", "n_nationkey", "n_name"] if names else [])
        cols += [k for k in keep if k not in cols]
        return g.select(*cols)

    # -- entities with area ------------------------------------------------
    @_memo
    def household_area(self, how: str = "inner", broken_dwellings: bool = False, hot_rows: int | None = None) -> DataFrame:
        """``(o_orderkey, id_geo)``: the area rolled down to households."""
        g = self.dwelling_area(how, broken_dwellings=broken_dwellings, names=False)
        return areas.roll_down(self.table("orders"), "o_orderkey", "o_custkey", g, "c_custkey", how=how, hot_rows=hot_rows)

    @_memo
    def entity(self, entity: str, how: str = "inner", broken_dwellings: bool = False,
               hot_rows: int | None = None) -> DataFrame:
        """Entity rows with ``id_geo`` (NULL under ``how='left'`` when the chain breaks).

        ``hot_rows`` salts the entity joins for parents with more children
        than that (explicit skew handling; by default AQE splits skew).
        """
        if entity == "PERSONA":
            facts = self.table("lineitem")
            m = self.household_area(how, broken_dwellings, hot_rows)
            return areas.attach_area(facts, "l_orderkey", m, "o_orderkey", how=how, hot_rows=hot_rows)
        if entity == "HOGAR":
            facts = self.table("orders")
            g = self.dwelling_area(how, broken_dwellings=broken_dwellings, names=False)
            return areas.attach_area(facts, "o_custkey", g, "c_custkey", how=how, hot_rows=hot_rows)
        if entity == "VIVIENDA":
            cols = tuple(self.table("customer").columns)
            return self.dwelling_area(how, broken_dwellings=broken_dwellings, names=False, keep=cols)
        raise ValueError(f"unknown entity {entity!r}")

    # -- labels ------------------------------------------------------------
    @_memo
    def raw_labels(self) -> DataFrame:
        """Label rows: the hand-written file, then one row per household read
        from the priority text ``'<code>-<label>'`` (massively duplicated keys)."""
        schema = "codigo_variable string, valor_categoria string, etiqueta_categoria string, linea long"
        hand = self.spark.createDataFrame(list(LABEL_FILE), schema)
        o = self.table("orders")
        derived = o.select(
            F.lit("HOGAR_PRIORITY").alias("codigo_variable"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("valor_categoria"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("etiqueta_categoria"),
            (F.col("o_orderkey") + F.lit(DERIVED_LABEL_LINE0)).alias("linea"),
        )
        return hand.unionByName(derived)

    @_memo
    def variable_codes(self) -> DataFrame:
        codes = [(code,) for ent in self.variables.values() for code in ent]
        return self.spark.createDataFrame(codes, "codigo_variable string")

    @_memo
    def variable_labels(self) -> DataFrame:
        return self.spark.createDataFrame(list(VARIABLE_LABELS), "codigo_variable string, etiqueta_variable string")

    @_memo
    def linked_tables(self) -> dict[str, DataFrame]:
        """The tables in the linked input model (reference-id chains).

        Fraction and radio dimensions are derived from the dwellings (distinct
        codes per department / fraction); every dwelling is its own segment.
        """
        cu = self.table("customer")
        frac_id = F.col("c_nationkey").cast("long") * 10 + fraction_code()
        radio_id = frac_id * 10 + radio_code()
        keyed = cu.select(
            "c_custkey", "c_nationkey", "c_mktsegment",
            frac_id.alias("frac_ref_id"), fraction_code().alias("idfrac"),
            radio_id.alias("radio_ref_id"), radio_code().alias("idradio"),
        )
        pv = self.variables["PERSONA"]
        hv = self.variables["HOGAR"]
        return {
            "prov": self.table("region").select(
                F.col("r_regionkey").alias("prov_ref_id"), F.col("r_regionkey").alias("idprov"), F.col("r_name").alias("nomprov")),
            "dpto": self.table("nation").select(
                F.col("n_nationkey").alias("dpto_ref_id"), F.col("n_regionkey").alias("prov_ref_id"),
                F.col("n_nationkey").alias("iddpto"), F.col("n_name").alias("nomdpto")),
            "frac": keyed.select("frac_ref_id", F.col("c_nationkey").alias("dpto_ref_id"), "idfrac").distinct(),
            "radio": keyed.select("radio_ref_id", "frac_ref_id", "idradio").distinct(),
            "seg": keyed.select(F.col("c_custkey").alias("seg_ref_id"), "radio_ref_id"),
            "vivienda": keyed.select(
                F.col("c_custkey").alias("vivienda_ref_id"), F.col("c_custkey").alias("seg_ref_id"),
                F.col("c_mktsegment").alias("SEGMENT")),
            "hogar": self.table("orders").select(
                F.col("o_orderkey").alias("hogar_ref_id"), F.col("o_custkey").alias("vivienda_ref_id"),
                hv["HOGAR_STATUS"].alias("STATUS"), hv["HOGAR_PRIORITY"].alias("PRIORITY")),
            "persona": self.table("lineitem").select(
                F.col("l_orderkey").alias("hogar_ref_id"), pv["PERSONA_RETURNFLAG"].alias("RETURNFLAG"),
                pv["PERSONA_STATUS"].alias("STATUS"), pv["PERSONA_LINENUMBER"].alias("LINENUMBER")),
        }

    @_memo
    def dwelling_points(self) -> DataFrame:
        """Synthetic dwelling coordinates in EPSG:3857 (lon in [-74,-34), lat in [-55,-22))."""
        x, y = point_columns()
        return self.table("customer").select(F.col("c_custkey").alias("id"), x.alias("x"), y.alias("y"))
