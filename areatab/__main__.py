"""Command line: tabulate census files into the long and metadata tables.

    python -m areatab flat --entity PERSONA=personas.csv --departments depto.csv \\
        --label-map map.csv --labels-dir labels/ --out out/
    python -m areatab linked --prov prov.csv --dpto dpto.csv --frac frac.csv --radio radio.csv \\
        --seg seg.csv --vivienda viv.csv --hogar hog.csv --persona per.csv \\
        --labels-dir labels/ --labels-style lower --how inner --out out/

Writes ``out/largo`` (sorted by area, ZSTD) and ``out/metadatos`` and prints
one JSON line with the dataset stats. Paths may be any Hadoop-compatible URI.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from areatab.operators import publish
from areatab.operators.areas import require_unique
from areatab.operators.frequency import frequencies_multi
from areatab.plans.job import run_resumable
from areatab.plans.vintages import PRESETS, crosswalk_departments, flat_plan, linked_plan
from areatab.session import get_session
from areatab.sources.files import read_delimited, read_dictionary, read_label_files, read_mapped_label_files
from areatab.sources.inline import crosswalk_1991, provinces_1991, variables_1991, variables_2001


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m areatab", description=__doc__.split("\n")[0])
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="model", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--out", required=True)
    common.add_argument("--sep", default=";")
    common.add_argument("--encoding", default="UTF-8")
    common.add_argument("--labels-dir", default=None)
    common.add_argument("--labels-encoding", default="UTF-8")
    common.add_argument("--dictionary", default=None, help="XML variable dictionary (variable labels)")
    common.add_argument("--null-policy", choices=("keep", "drop", "drop_blank"), default=None)
    common.add_argument("--partitions", type=int, default=None, help="output range partitions")
    common.add_argument("--resume", action="store_true",
                        help="resumable run: keep variables already tabulated in --out from the same inputs")

    f = sub.add_parser("flat", parents=[common], help="area codes on every entity row")
    f.add_argument("--entity", action="append", required=True, metavar="NAME=PATH")
    f.add_argument("--departments", default=None, help="department file (provin_ref_id;depto;nombdepto)")
    f.add_argument("--label-map", default=None, help="file with codigo_variable;label_file;etiqueta_variable")
    f.add_argument("--level-label", action="append", default=[], metavar="LEVEL=COLUMN",
                   help="area label carried on the rows (provincia, departamento, fraccion, radio); repeatable")

    k = sub.add_parser("linked", parents=[common], help="reference-id chains through area files")
    for name in ("prov", "dpto", "frac", "radio", "seg", "vivienda"):
        k.add_argument(f"--{name}", required=True)
    k.add_argument("--hogar", default=None)
    k.add_argument("--persona", default=None)
    k.add_argument("--labels-style", choices=("lower", "upper"), default="lower")
    k.add_argument("--how", choices=("inner", "left"), default=None, help="default: as the year's style has it")
    k.add_argument("--hot-rows", type=int, default=None,
                   help="salt entity joins for parents with more children than this (default: AQE skew handling)")
    k.add_argument("--exclude-style", choices=("2001", "2010"), default="2001",
                   help="year's way: variables, joins, NULL policy, repairs, labels (see vintages.PRESETS)")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(args.master)
    read = lambda path: read_delimited(spark, path, sep=args.sep, encoding=args.encoding)
    var_labels = read_dictionary(spark, args.dictionary) if args.dictionary else None

    if args.model == "flat":
        entities = dict(e.split("=", 1) for e in args.entity)
        frames = {name.upper(): read(path) for name, path in entities.items()}
        departments = crosswalk_departments(read(args.departments), crosswalk_1991(spark)) if args.departments else None
        raw = None
        if args.label_map:
            m = read_delimited(spark, args.label_map, sep=args.sep)
            if args.labels_dir:
                raw = read_mapped_label_files(spark, args.labels_dir, m, sep=args.sep, encoding=args.labels_encoding)
            if var_labels is None and "etiqueta_variable" in m.columns:
                var_labels = m.select("codigo_variable", "etiqueta_variable")
        levels = dict(x.split("=", 1) for x in args.level_label) or None
        sources, publish_fn = flat_plan(frames, None if levels else provinces_1991(spark), departments, raw,
                                        level_labels=levels)
        inputs = list(frames.values())
        policy = args.null_policy or "keep"
        if var_labels is None:
            var_labels = variables_1991(spark).select("codigo_variable", "etiqueta_variable")
    else:
        t = {n: read(getattr(args, n)) for n in ("prov", "dpto", "frac", "radio", "seg", "vivienda")}
        hogar = read(args.hogar) if args.hogar else None
        persona = read(args.persona) if args.persona else None
        raw = (read_label_files(spark, args.labels_dir, args.labels_style, sep=args.sep, encoding=args.labels_encoding)
               if args.labels_dir else None)
        keys = {"prov": "PROV_REF_ID", "dpto": "DPTO_REF_ID", "frac": "FRAC_REF_ID", "radio": "RADIO_REF_ID", "seg": "SEG_REF_ID",
                "vivienda": "VIVIENDA_REF_ID"}
        require_unique({n: (t[n], [k]) for n, k in keys.items()} | ({"hogar": (hogar, ["HOGAR_REF_ID"])} if hogar is not None else {}))
        # all that differs between the years; --how and --null-policy given by hand win
        preset = dict(PRESETS[args.exclude_style])
        policy = args.null_policy or preset["null_policy"]
        del preset["null_policy"]
        preset["how"] = args.how or preset["how"]
        sources, publish_fn = linked_plan(
            t["prov"], t["dpto"], t["frac"], t["radio"], t["seg"], t["vivienda"], hogar, persona,
            raw_labels=raw, hot_rows=args.hot_rows, **preset)
        inputs = [x for x in [*t.values(), hogar, persona] if x is not None]
        if var_labels is None and args.exclude_style == "2001":
            var_labels = variables_2001(spark)

    if args.resume:
        res = run_resumable(spark, sources, publish_fn, args.out, inputs, var_labels, policy)
        long_dir, meta_dir = res.largo, res.metadatos
        back = publish.read_long(spark, long_dir)
        extra = {"computed": res.computed, "skipped": res.skipped, "manifiesto": res.manifiesto}
    else:
        freq = frequencies_multi(list(sources.values()), null_policy=policy)
        long_dir, meta_dir = os.path.join(args.out, "largo"), os.path.join(args.out, "metadatos")
        publish.write_long(publish_fn(freq), long_dir, partitions=args.partitions)
        back = publish.read_long(spark, long_dir)
        publish.export(publish.to_metadata(back, var_labels), meta_dir)
        extra = {}
    stats = publish.dataset_stats(back).first().asDict()
    stats.update({"largo": long_dir, "metadatos": meta_dir, **extra})
    print(json.dumps(stats))
    return stats


if __name__ == "__main__":
    main(sys.argv[1:])
