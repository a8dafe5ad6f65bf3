"""The jobs from the command line: ``python -m strata sheets public_sheets``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from strata.operators.profile import profile_layer
from strata.operators.reconcile import reconcile_layers
from strata.plans import relational, schedules, sheets, tickets
from strata.session import WRITERS
from strata.sources.sheets import export_layer

JOBS = {
    "tickets": "raw table, as database.table",
    "schedules": "raw database",
    "sheets": "source database",
    "finance": "raw database",
    "crm": "raw database",
}


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="strata")
    commands = parser.add_subparsers(dest="command", required=True)
    for job, source in JOBS.items():
        command = commands.add_parser(job, help=f"rebuild the {job} layers")
        command.add_argument("source", help=source)
        command.add_argument("--subject", help="name of the subject in the layer databases")
        if job != "tickets":
            command.add_argument("--threads", type=int, default=WRITERS, help="tables at once")
    profile = commands.add_parser("profile", help="rows, columns and bytes of the tables of a layer")
    profile.add_argument("database")
    reconcile = commands.add_parser("reconcile", help="compare two layers")
    reconcile.add_argument("source")
    reconcile.add_argument("target")
    export = commands.add_parser("export", help="write a layer as text sheets")
    export.add_argument("database")
    export.add_argument("folder")
    return parser.parse_args(arguments)


def print_rows(report: DataFrame) -> None:
    """Print a report; it has a row per table, or per column of a table."""
    print("\t".join(report.columns))
    for row in report.collect():
        print("\t".join(str(value) for value in row))


def run_command(spark: SparkSession, arguments: list[str]) -> None:
    options = vars(parse(arguments))
    command = options.pop("command")
    if command == "profile":
        print_rows(profile_layer(spark, options["database"]))
    elif command == "reconcile":
        print_rows(reconcile_layers(spark, options["source"], options["target"]))
    elif command == "export":
        export_layer(spark, options["database"], options["folder"])
    else:
        run = {
            "tickets": tickets.run,
            "schedules": schedules.run,
            "sheets": sheets.run,
            "finance": relational.run_finance,
            "crm": relational.run_crm,
        }[command]
        source = options.pop("source")
        run(spark, source, **{k: v for k, v in options.items() if v is not None})


if __name__ == "__main__":
    parse(sys.argv[1:])  # stops at a wrong command before Spark starts
    session = SparkSession.builder.appName("strata").getOrCreate()
    run_command(session, sys.argv[1:])
    session.stop()
