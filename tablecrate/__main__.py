"""`python -m tablecrate export|import|info|verify|describe|check`: a thin shell over the job functions."""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from tablecrate import config as configs
from tablecrate.errors import CrateError
from tablecrate.functions.seal import password_from
from tablecrate.operators.quality import constraint_report
from tablecrate.plans.export_plan import describe_plan
from tablecrate.reports.describe import describe
from tablecrate.reports.info import render_info
from tablecrate.reports.render import render
from tablecrate.session import job_session
from tablecrate.sources.jdbc import Connection
from tablecrate.sources.ledger import damaged_files
from tablecrate.sinks.export import export_snapshot
from tablecrate.sinks.load import load_snapshot
from tablecrate.sources.manifests import open_snapshot


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tablecrate", description=__doc__)
    parser.add_argument("--dry-run", action="store_true", help="show what would be done")
    commands = parser.add_subparsers(dest="command", required=True)

    export = commands.add_parser("export", help="write selected tables as a snapshot")
    export.add_argument("--config", required=True)
    export.add_argument("--out", required=True)
    export.add_argument("--password")
    export.add_argument("--concurrency", type=int)
    export.add_argument("--attempts", type=int)
    export.add_argument("--retry-delay-ms", type=int)
    export.add_argument("--attempt-timeout-ms", type=int)

    _add_connection(export)

    load = commands.add_parser("import", help="load a snapshot into the catalog")
    load.add_argument("--in", dest="snapshot", required=True)
    load.add_argument("--mode", choices=["replace", "append"], default="replace")
    load.add_argument("--concurrency", type=int, default=1)
    load.add_argument("--ddl-only", action="store_true")
    load.add_argument("--password")
    load.add_argument("--warehouse", help="folder for new tables; default: the schema's own")
    load.add_argument("--batch-id", help="makes an append repeatable")

    info = commands.add_parser("info", help="show what a snapshot holds")
    info.add_argument("--in", dest="snapshot", required=True)
    info.add_argument("--objects", action="store_true")
    info.add_argument("--format", choices=["text", "json"], default="text")
    info.add_argument("--password")

    verify = commands.add_parser("verify", help="name the payload files that are not as exported")
    verify.add_argument("--in", dest="snapshot", required=True)
    verify.add_argument("--password")

    check = commands.add_parser("check", help="count what breaks the configured constraints")
    check.add_argument("--config", required=True)

    facts = commands.add_parser("describe", help="describe the configured source relations")
    facts.add_argument("--config", required=True)
    facts.add_argument("--out")
    facts.add_argument("--format", choices=["markdown", "sql", "json"], default="markdown")
    facts.add_argument("--statistics", nargs="?", const="basic", default=None)
    facts.add_argument("--statistics-source", choices=["catalog", "compute"], default="catalog")
    facts.add_argument("--exact", action="store_true", help="exact distinct counts")
    facts.add_argument("--no-comments", action="store_true")
    _add_connection(facts)
    return parser


def _add_connection(command: argparse.ArgumentParser) -> None:
    group = command.add_argument_group("JDBC source, instead of the session catalog")
    group.add_argument("--host")
    group.add_argument("--port", type=int)
    group.add_argument("--dbname")
    group.add_argument("--username", "--user", dest="user")
    group.add_argument("--pgpassword", dest="db_password")


def _connection(options: argparse.Namespace, config: configs.JobConfig) -> dict[str, str] | None:
    """Flags win over the config; without either the catalog is the source."""
    given = {
        "host": options.host,
        "port": options.port,
        "dbname": options.dbname,
        "user": options.user,
        "password": options.db_password,
    }
    given = {name: value for name, value in given.items() if value is not None}
    if not given and config.connection is None:
        return None
    return replace(config.connection or Connection(), **given).options(dict(os.environ))


def _statistics(text: str | None) -> str | int | None:
    if text is None or text == "basic":
        return text
    if not text.isdigit() or int(text) < 1:
        raise CrateError(f"--statistics takes a number of at least 1, got {text!r}")
    return int(text)


def run(arguments: list[str], spark: SparkSession | None = None) -> str:
    """Run one command; returns what it prints."""
    options = _arguments().parse_args(arguments)
    if options.command in ("export", "import") and (options.concurrency or 1) < 1:
        raise CrateError("--concurrency must be at least 1")
    spark = job_session(spark or SparkSession.builder.appName("tablecrate").getOrCreate())
    if options.command == "export":
        return _export(spark, options)
    if options.command == "import":
        return _import(spark, options)
    if options.command == "info":
        password = password_from(options.password, dict(os.environ))
        snapshot = open_snapshot(spark, options.snapshot, password)
        return render_info(snapshot, options.format, options.objects)
    if options.command == "verify":
        password = password_from(options.password, dict(os.environ))
        damage = damaged_files(spark, open_snapshot(spark, options.snapshot, password))
        return _lines(damage.orderBy("object", "file"))
    if options.command == "check":
        return _check(spark, options)
    return _describe(spark, options)


def _check(spark: SparkSession, options: argparse.Namespace) -> str:
    constraints = configs.load(options.config).constraints
    if options.dry_run:
        return "".join(f"{'.'.join(c.relation)} {c.kind} {c.name}\n" for c in constraints)
    return _lines(constraint_report(spark, constraints).orderBy("relation", "constraint", "kind"))


def _export(spark: SparkSession, options: argparse.Namespace) -> str:
    config = configs.load(options.config)
    general = config.general.override(
        concurrency=options.concurrency,
        attempts=options.attempts,
        retry_delay_ms=options.retry_delay_ms,
        attempt_timeout_ms=options.attempt_timeout_ms,
    )
    config = configs.JobConfig(config.objects, general, config.connection, config.constraints)
    if options.dry_run:
        return _lines(describe_plan(spark, config.objects).orderBy("position"))
    manifest = export_snapshot(
        spark,
        config,
        options.out,
        password=password_from(options.password, dict(os.environ)),
        connection_options=_connection(options, config),
    )
    rows = sum(item.rows or 0 for item in manifest.objects)
    return f"exported {len(manifest.objects)} objects, {rows} rows to {options.out}\n"


def _import(spark: SparkSession, options: argparse.Namespace) -> str:
    password = password_from(options.password, dict(os.environ))
    if options.dry_run:
        return render_info(open_snapshot(spark, options.snapshot, password), "text", True)
    loaded = load_snapshot(
        spark,
        options.snapshot,
        mode=options.mode,
        schema_only=options.ddl_only,
        password=password,
        warehouse=options.warehouse,
        batch_id=options.batch_id,
        workers=options.concurrency,
    )
    return _lines(loaded)


def _describe(spark: SparkSession, options: argparse.Namespace) -> str:
    config = configs.load(options.config)
    if options.dry_run:
        return "".join(f"{schema}.{name}\n" for schema, name in config.unique_sources())
    description = describe(
        spark,
        config,
        statistics=_statistics(options.statistics),
        source=options.statistics_source,
        exact=options.exact,
        include_comments=not options.no_comments,
        connection_options=_connection(options, config),
    )
    text = render(description, options.format)
    if options.out is None:
        return text
    target = Path(options.out)
    target.parent.mkdir(parents=True, exist_ok=True)
    staged = target.with_name(target.name + ".tmp")
    staged.write_text(text, encoding="utf-8")
    staged.replace(target)
    return ""


def _lines(report) -> str:
    """A report of one row per object, as JSON lines."""
    return "".join(row[0] + "\n" for row in report.selectExpr("to_json(struct(*))").collect())


def main() -> None:
    try:
        sys.stdout.write(run(sys.argv[1:]))
    except CrateError as error:
        sys.exit(f"error: {error}")


if __name__ == "__main__":
    main()
