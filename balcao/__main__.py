"""Command line: ``spark-submit`` or ``python -m balcao <step> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from balcao.operators.people import CHECKED
from balcao.plans.workspace import REPORTS, Workspace
from balcao.session import build_session
from balcao.sources.snapshots import KEEP, KEEP_SECONDS


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="balcao")
    parser.add_argument("--root", required=True, help="folder of tables and manual lists")
    parser.add_argument(
        "--run", default=f"{dt.datetime.now():%Y-%m-%dT%H%M%S}", help="name of this run's snapshots"
    )
    steps = parser.add_subparsers(dest="step", required=True)
    report = steps.add_parser("load-report", help="flatten the newest report of a folder")
    report.add_argument("kind", choices=sorted(REPORTS))
    report.add_argument("folder")
    report.add_argument("--delimiter", help="the cells' delimiter; found out if not given")
    report.add_argument("--quarantine", action="store_true", help="set commissions of unreadable branches aside")
    hr = steps.add_parser("load-hr", help="merge a folder of HR files")
    hr.add_argument("folder")
    hr.add_argument("--changed-only", action="store_true", help="read only files that changed since the last load")
    match = steps.add_parser("match-people", help="match HR and point-of-sale staff")
    pads = match.add_mutually_exclusive_group()
    pads.add_argument("--pad-tax-ids", action="store_true")
    pads.add_argument("--repair-tax-ids", action="store_true", help="pad only where the check digits confirm it")
    close = steps.add_parser("close", help="calculate the month")
    close.add_argument("--quarantine", action="store_true", help="set rows with unreadable keys aside")
    steps.add_parser("check", help="check what the tables promise; exits with 1 if anything is broken")
    expire = steps.add_parser("expire", help="delete old snapshots")
    expire.add_argument("--keep", type=int, default=KEEP, help="newest filled snapshots of each table to keep")
    expire.add_argument("--keep-days", type=float, default=KEEP_SECONDS / 86_400, help="nothing younger is deleted")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> int:
    """Run one step. The exit code is 1 where a step has written no rows."""
    options = parse(arguments)
    workspace = Workspace(build_session(), options.root)
    if options.step == "load-report":
        filled = workspace.load_report(
            options.kind, options.folder, options.run, delimiter=options.delimiter, quarantine=options.quarantine
        )
    elif options.step == "load-hr" and options.changed_only:
        print(workspace.load_changed_hr(options.folder, options.run))
        filled = True
    elif options.step == "load-hr":
        workspace.load_hr(options.folder, options.run).show(truncate=False)
        filled = True
    elif options.step == "match-people":
        filled = workspace.match_people(options.run, CHECKED if options.repair_tax_ids else options.pad_tax_ids)
    elif options.step == "check":
        broken = workspace.check().where("rows > 0").orderBy("rule").collect()  # one row for each rule
        for rule in broken:
            print(f"{rule.rule}: {rule.rows} rows, {rule['keys']} keys, such as {', '.join(rule.shown)}")
        return 1 if broken else 0
    elif options.step == "expire":
        for table, folders in workspace.expire(options.keep, options.keep_days).items():
            print(table, *folders)
        filled = True
    else:
        filled = workspace.close(options.run, options.quarantine)
    if not filled:
        print(f"{options.step}: no rows, nothing is replaced", file=sys.stderr)
    return 0 if filled else 1


if __name__ == "__main__":
    sys.exit(main())
