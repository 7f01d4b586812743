"""The reconciliation job: gate, cleanse, reconcile, score, summarise, write."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..config import JobConfig
from ..functions import col, in_year
from ..operators.anomaly import detect_anomalies
from ..operators.cleanse import (
    cleanse_bank,
    cleanse_gl,
    cleanse_sales,
    per_reference,
    reconciled_columns,
)
from ..operators.quality import enforce, quality_scorecard
from ..operators.reconcile import three_way_reconciliation
from ..operators.summary import monthly_summary
from ..sources.scan import ingest_audit, load_ledgers
from ..sources.sinks import next_to, publish, refuse_overlap, write_csv, write_table
from ..sources.staging import remove, scratch_path, stage

Ledgers = tuple[DataFrame, DataFrame, DataFrame]


@dataclass(frozen=True)
class JobResult:
    """The tables a run has written, the scorecard of its sources, and their row and column counts."""

    transactions: DataFrame
    summary: DataFrame
    scorecard: DataFrame
    audit: DataFrame


def gate_all(ledgers: Ledgers, config: JobConfig) -> DataFrame:
    """Scorecards of the three raw ledgers, computed in one job.

    Raises on NULLs in their gated columns, and on amounts that are no money in rows of the period, which the
    job would convert.
    """
    sales, gl, bank = ledgers
    s, g, b = config.sales, config.gl, config.bank
    year, grace = config.year, config.grace_days
    of_account = (col(g.account) == config.account_type) & in_year(gl, g.date, year, grace)
    checks = [
        (sales, "Sales", [s.key, s.net, s.date], s.date, [s.net, s.gross], in_year(sales, s.date, year)),
        (gl, "GL", [g.reference, g.net], g.date, [g.net, g.gross, g.tax], of_account),
        (bank, "Bank", [b.reference, b.settled], b.date, [b.settled, b.fee],
         in_year(bank, b.date, year, grace)),
    ]
    cards = [
        quality_scorecard(df, name, columns, [day], amounts, config.blank_is_null, used)
        for df, name, columns, day, amounts, used in checks
    ]
    gated = {name: columns[: config.gated_columns] for _, name, columns, *_ in checks}
    card = _small(reduce(DataFrame.unionByName, cards))
    return enforce(card, gated)


def _small(report: DataFrame) -> DataFrame:
    """A report of a few rows per ledger, computed once and kept by the driver."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def cleanse_all(ledgers: Ledgers, config: JobConfig) -> Ledgers:
    sales, gl, bank = ledgers
    grace = config.grace_days
    clean_gl = cleanse_gl(gl, config.year, config.account_type, grace, config.gl)
    clean_bank = cleanse_bank(bank, config.year, grace, config.bank)
    if config.grain == "reference":
        clean_gl = per_reference(clean_gl, config.gl.reference, config.gl.date)
        clean_bank = per_reference(clean_bank, config.bank.reference, config.bank.date)
    elif config.grain != "date":
        raise ValueError(f"grain must be 'date' or 'reference', not {config.grain!r}")
    read = sales.select(*map(col, reconciled_columns(config.sales)))
    return cleanse_sales(read, config.year, config.sales), clean_gl, clean_bank


def reconcile(ledgers: Ledgers, config: JobConfig) -> DataFrame:
    """Raw ledgers to reconciled rows; lazy."""
    return three_way_reconciliation(
        *cleanse_all(ledgers, config),
        tolerance=config.variance_tolerance,
        late_after_days=config.late_after_days,
        sales_columns=config.sales,
        gl_columns=config.gl,
        bank_columns=config.bank,
    )


def process(
    ledgers: Ledgers, config: JobConfig, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Gate the raw ledgers, then reconcile and score them: (scorecard, scored rows).

    The reconciled rows are staged in ``folder``, or else in the shared folder, because scoring reads them
    three times: twice for the statistics, which need two columns, and once for the rows.
    """
    scorecard = gate_all(ledgers, config)
    scored = detect_anomalies(
        stage(reconcile(ledgers, config), "reconciled", folder),
        config.z_threshold,
        config.high_multiple,
        null_category=config.null_category,
        folder=folder,
    )
    return scorecard, scored


#: The tables of a run, below its output path.
OUTPUTS = ("transaction_level", "summary", "summary_csv")


def write_outputs(scored: DataFrame, config: JobConfig) -> tuple[DataFrame, DataFrame]:
    """Write ``transaction_level/``, ``summary/`` and ``summary_csv/``; the written transactions and summary.

    The summary is computed from the written transactions and the CSV from the written summary, so that
    no step is computed twice. All three are written beside the output path and take the place of the last run's together;
    a failure on the way leaves the last run as it was.
    """
    spark, out, sources = scored.sparkSession, config.output_path.rstrip("/"), config.source_paths
    refuse_overlap(out, sources)
    staged = next_to(out)
    try:
        transactions = write_table(scored, f"{staged}/{OUTPUTS[0]}", config.output_format, sources=sources)
        months = monthly_summary(transactions, config.green_from, config.amber_from)
        summary = write_table(months, f"{staged}/{OUTPUTS[1]}", config.output_format, sources=sources)
        write_csv(summary.orderBy("period"), f"{staged}/{OUTPUTS[2]}", sources)
        publish(spark, staged, out, OUTPUTS)
    finally:
        remove(spark, staged)

    def published(name: str, like: DataFrame) -> DataFrame:
        return spark.read.format(config.output_format).schema(like.schema).load(f"{out}/{name}")

    return published(OUTPUTS[0], transactions), published(OUTPUTS[1], summary).orderBy("period")


def run(spark: SparkSession, config: JobConfig) -> JobResult:
    """The whole job: sources in, counted, checked and processed, outputs written, staged tables removed."""
    refuse_overlap(config.output_path, config.source_paths)
    ledgers = load_ledgers(spark, config)
    audit = _small(ingest_audit(dict(zip(("sales", "gl", "bank"), ledgers))))
    folder = scratch_path(spark, "run", config.staging_folder)
    refuse_overlap(folder, config.source_paths)
    try:
        scorecard, scored = process(ledgers, config, folder)
        transactions, summary = write_outputs(scored, config)
    finally:
        remove(spark, folder)
    return JobResult(transactions, summary, scorecard, audit)
