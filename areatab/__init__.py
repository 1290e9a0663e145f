"""areatab: small-area tabulation on Spark.

Turns entity microdata (persons, households, dwellings) linked by key chains
to an area hierarchy into one long table of counts per area, variable and
category, plus a metadata table, with every heavy step expressed as a
DataFrame plan that Catalyst optimises and Spark distributes.

Main entry points::

    from areatab import get_session, read_delimited, read_label_files, tabulate_linked
    spark = get_session()
    long, meta = tabulate_linked(prov, dpto, frac, radio, seg, vivienda, hogar, persona, raw_labels=labels)
"""

from areatab.functions.codes import area_key, format_code, pad_code
from areatab.functions.textfix import repair
from areatab.operators.frequency import check_totals, frequencies, frequencies_by_levels, frequencies_multi
from areatab.operators.labels import attach_labels, clean_labels
from areatab.operators.publish import to_long, to_metadata, write_by_variable, write_long
from areatab.plans.job import run_census
from areatab.plans.vintages import tabulate_flat, tabulate_linked
from areatab.session import get_session, scratch_path
from areatab.sources.files import read_delimited, read_dictionary, read_label_files, read_mapped_label_files

__all__ = [
    "area_key",
    "attach_labels",
    "check_totals",
    "clean_labels",
    "format_code",
    "frequencies",
    "frequencies_by_levels",
    "frequencies_multi",
    "get_session",
    "pad_code",
    "read_delimited",
    "read_dictionary",
    "read_label_files",
    "read_mapped_label_files",
    "repair",
    "run_census",
    "scratch_path",
    "tabulate_flat",
    "tabulate_linked",
    "to_long",
    "to_metadata",
    "write_by_variable",
    "write_long",
]
