"""A folder of tables and the steps that fill it, from report files to payouts.

``<root>/tables/<name>/snapshot=<run>`` holds what the steps write, and
``<root>/manual/<name>`` what people maintain by hand as CSV (with headings).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab
from balcao.operators import people, reports
from balcao.operators.contracts import WORKSPACE_RULES, check_contracts
from balcao.operators.ordered import ROW
from balcao.plans import export
from balcao.plans.monthly import MonthTables, close_month
from balcao.sources.columns import in_order, require, trimmed
from balcao.sources.commits import CommitLog
from balcao.sources.grids import scan_grids
from balcao.sources.hr_files import CSV, hr_export, scan_hr_folder
from balcao.sources.latest import latest_reports
from balcao.sources.ledger import Ledger, Loaded
from balcao.sources.lines import list_files
from balcao.sources.snapshots import (
    NoSnapshot,
    blank_missing,
    expire_snapshots,
    latest_snapshot,
    newest_version,
    write_snapshot,
)
from balcao.sources.tabs import read_tab

_MANUAL_ROWS = 1 << 62  # rows kept by hand come behind all written ones

# Per report: table name, how to flatten it, its columns, and what an empty result means.
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame], tuple[str, ...], str]] = {
    "sellers": ("VENDAS_VENDEDOR", reports.seller_report, vocab.SELLER_COLUMNS, "skip"),
    "hb_sellers": ("VENDAS_VENDEDOR_HB", reports.hb_seller_report, vocab.HB_COLUMNS, "skip"),
    "channel": ("VENDAS_548", reports.channel_report, vocab.CHANNEL_COLUMNS, "skip"),
    "commissions": ("COMISSOES", reports.commission_report, vocab.COMMISSION_COLUMNS, "skip"),
    "branch_totals": ("VENDAS_FILIAL", reports.branch_totals, vocab.BRANCH_SALES_COLUMNS, "skip"),
    "pos_staff": ("users_trier", reports.pos_staff, ("Código", "Funcionário", "CPF"), "fail"),
}


class UnreadableReport(ValueError):
    """Raised where a report file cannot be taken apart."""


class Workspace:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table_folder(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def version(self, name: str) -> int:
        """The state of a table that a run starts from; another run's commit in between is an error."""
        return newest_version(self.spark, self.table_folder(name))

    def table(
        self, name: str, even_if_empty: bool = False, with_order: bool = False
    ) -> DataFrame | None:
        """Newest snapshot of a table, or none if it was never written."""
        folder = self.table_folder(name)
        return self._if_present(
            lambda: latest_snapshot(self.spark, folder, even_if_empty, with_order)
        )

    def manual(self, name: str) -> DataFrame | None:
        """A list kept by hand, its rows in the order of the file."""
        return self._if_present(lambda: read_tab(self.spark, f"{self.root}/manual/{name}.csv"))

    @staticmethod
    def _if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
        try:
            return read()
        except NoSnapshot:
            return None
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _needed(self, name: str, found: DataFrame | None) -> DataFrame:
        if found is None:
            raise FileNotFoundError(f"table {name} is missing in {self.root}")
        return found

    def load_report(
        self, kind: str, folder: str, run: str, glob: str = CSV, delimiter: str | None = None, quarantine: bool = False
    ) -> bool:
        """Flatten the newest report of a folder into its table; whether it has rows.

        A report that cannot be read as a whole is an error and replaces nothing. With
        ``quarantine`` commissions of a branch that is no number go to a table of their own
        instead of failing the load.
        """
        table, flatten, columns, if_empty = REPORTS[kind]
        base = self.version(table)
        newest = latest_reports(list_files(self.spark, folder, glob)).first()
        if newest is None:
            raise FileNotFoundError(f"no report files in {folder}")
        scan = scan_grids(self.spark, newest["report"], "*", delimiter)
        broken = scan.rejected.first()
        if broken is not None:
            raise UnreadableReport(f"{broken.label}: {broken.reason}")
        if quarantine and kind == "commissions":
            rows, bad = reports.split_commission_report(scan.cells)
            write_snapshot(bad, self.table_folder("quarantine_COMISSOES"), run)
        else:
            rows = flatten(scan.cells)
        return write_snapshot(
            blank_missing(export.br_numbers(in_order(rows, columns))), self.table_folder(table), run, None, if_empty, base
        )

    def load_changed_hr(self, folder: str, run: str) -> Loaded:
        """Merge the HR files of a folder, reading only those that changed since the last load."""
        ledger = Ledger(self.spark, self.table_folder("users_sci_files"))
        found = ledger.load(
            folder, CSV, run, lambda spark, places: scan_hr_folder(spark, places, with_file=True).staff
        )
        if found.committed:
            staff = ledger.table().select(*vocab.HR_COLUMNS).orderBy("Filial")
            write_snapshot(hr_export(staff), self.table_folder("users_sci"), run, None, "fail")
        return found

    def load_hr(self, folder: str, run: str) -> DataFrame:
        """Merge the HR files of a folder; returns the files that were left out."""
        scan = scan_hr_folder(self.spark, folder)
        staff = scan.staff.orderBy("Filial")
        write_snapshot(hr_export(staff), self.table_folder("users_sci"), run, None, "fail")
        return scan.rejected

    def match_people(self, run: str, pad_tax_ids: bool | str = False) -> bool:
        """Match HR and point-of-sale staff; without matches the table becomes empty."""
        hr = self._needed("users_sci", self.table("users_sci"))
        pos = self._needed("users_trier", self.table("users_trier"))
        matched = people.match_people(hr, pos, pad_tax_ids).orderBy(*people.people_order())
        return write_snapshot(
            export.people_view(matched), self.table_folder("filtered_user"), run
        )

    def previous_calc(self) -> DataFrame | None:
        """The last calc table; targets in the manual table ``targets`` take its place."""
        parts = [
            found.select("ID", "Meta", (F.col(ROW) + first).alias(ROW))
            for first, found in (
                (0, self.table("calc", with_order=True)),
                (_MANUAL_ROWS, self.manual("targets")),
            )
            if found is not None
        ]
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def month_tables(self) -> MonthTables:
        return MonthTables(
            people=require(
                self._needed("filtered_user", self.table("filtered_user", even_if_empty=True)),
                vocab.PEOPLE_COLUMNS,
                "filtered_user",
            ),
            seller_sales=self._needed("VENDAS_VENDEDOR", self.table("VENDAS_VENDEDOR")),
            commissions=self._needed("COMISSOES", self.table("COMISSOES")),
            branch_sales=self.table("VENDAS_FILIAL", with_order=True),
            branch_targets=self.manual("META_FILIAL"),
            channel_sales=self.table("VENDAS_548"),
            trainees=self.manual("TRAINEES"),
            second_targets=self.manual("2_META"),
            leave=self.manual("AFASTAMENTOS"),
            previous=self.previous_calc(),
        )

    def close(self, run: str, quarantine: bool = False) -> bool:
        """Calculate the month and write the scorecard and the calc table.

        With ``quarantine`` rows with unreadable keys are written to a table of that name and
        the month goes on without them. Of two runs that started from the same calc table one
        fails with ``LostRace``.
        """
        base = self.version("calc")
        tables = self.month_tables()
        result = close_month(tables, self.spark, quarantine=quarantine)
        if result.quarantine is not None:
            write_snapshot(result.quarantine, self.table_folder("quarantine"), run)
        if result.scorecard is not None:
            card = export.scorecard_view(result.scorecard)
            write_snapshot(
                export.in_branch_text_order(card), self.table_folder("META_GERENTE"), run
            )
        view = export.in_branch_order(export.calc_view(result.calc))
        return write_snapshot(view, self.table_folder("calc"), run, base=base)

    def check(self) -> DataFrame:
        """All rules of the tables that are there (``contracts.WORKSPACE_RULES``) and what breaks them."""
        written = {
            name: self.table(name, with_order=True)
            for name in sorted({r.table for r in WORKSPACE_RULES} - set(vocab.MANUAL_TABLES))
        }
        found = written | {name: self.manual(name) for name in vocab.MANUAL_TABLES}
        return check_contracts({n: trimmed(df) for n, df in found.items() if df is not None}, WORKSPACE_RULES, self.spark)

    def expire(self, keep: int, keep_days: float) -> dict[str, list[str]]:
        """Delete old snapshots of all tables by the retention rule; what went, by table."""
        names = CommitLog(self.spark, f"{self.root}/tables").folders()
        gone = {n: expire_snapshots(self.spark, self.table_folder(n), keep, keep_days * 86_400) for n in sorted(names)}
        return {name: folders for name, folders in gone.items() if folders}
