"""Command line for the three runs: Stage 1 per (table, year), Stage 2 per table, QC per
(table, year). Run with ``python -m panelforge`` (or submit a two-line script calling
``panelforge.cli.main``); the session comes from the environment (master, checkpoint folder,
shuffle sizing).

    python -m panelforge select --table-config enrolment.yaml --year 2018 \\
        --var datapaths.dirs.input=/raw --var datapaths.dirs.intermediate=/inter
    python -m panelforge build --dataset-config dataset.yaml --table claims \\
        --basepath /inter --output /out
    python -m panelforge qc --table-config enrolment.yaml --year 2018 --var ...

Table configs may hold ``${name}`` placeholders; ``${year}`` is the run's year and other names
come from ``--var name=value`` (a missing one is an error).
"""

from __future__ import annotations

import argparse
import json
import logging
import re
import sys

_PLACEHOLDER = re.compile(r"\$\{([^}]+)\}")


def resolve_placeholders(value, variables: dict[str, str]):
    """Replace ``${name}`` in every string of a loaded config (lists and dicts walked)."""
    if isinstance(value, str):
        def sub(m: re.Match) -> str:
            key = m.group(1).strip()
            if key not in variables:
                raise KeyError(f"no value for ${{{key}}}; pass --var {key}=...")
            return str(variables[key])

        return _PLACEHOLDER.sub(sub, value)
    if isinstance(value, list):
        return [resolve_placeholders(v, variables) for v in value]
    if isinstance(value, dict):
        return {k: resolve_placeholders(v, variables) for k, v in value.items()}
    return value


def _load_yaml(path: str) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)


def _vars(pairs: list[str], year: int | None) -> dict[str, str]:
    out = dict(p.split("=", 1) for p in pairs)
    if year is not None:
        out["year"] = str(year)
    return out


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("panelforge").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="panelforge")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("select", "qc"):
        p = sub.add_parser(name)
        p.add_argument("--table-config", required=True)
        p.add_argument("--year", type=int, required=True)
        p.add_argument("--var", action="append", default=[])
        if name == "qc":
            p.add_argument("--sample-n", type=int, default=100)
    b = sub.add_parser("build")
    b.add_argument("--dataset-config", required=True)
    b.add_argument("--table", required=True)
    b.add_argument("--basepath", required=True)
    b.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    from panelforge.plans import build_table, process_year, run_qc
    from panelforge.specs import SelectSpec

    spark = _session()
    if args.command == "build":
        tables = _load_yaml(args.dataset_config)["tables"]
        if args.table not in tables:
            raise KeyError(f"{args.dataset_config} describes no table {args.table!r}, only {sorted(tables)}")
        build_table(spark, args.table, tables[args.table], args.basepath, args.output)
        return 0
    conf = resolve_placeholders(_load_yaml(args.table_config), _vars(args.var, args.year))
    spec = SelectSpec.from_dict(conf)
    if args.command == "select":
        process_year(spark, spec, args.year)
        return 0
    out = spec.output_path(args.year)
    qc = run_qc(spark, spec, out, args.year, qc_dir=out[: -len(".parquet")] + ".qc", sample_n=args.sample_n)
    print(json.dumps({k: qc[k] for k in ("status", "table", "year", "warnings", "errors")}))
    return 0 if qc["status"] != "error" else 1


if __name__ == "__main__":
    sys.exit(main())
