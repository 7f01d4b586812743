import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave import JobConfig, run
from tallyweave.functions import money
from tallyweave.operators import QualityError
from tallyweave.plans import gate_all, process
from tallyweave.sources import (
    ingest_audit, refuse_overlap, scan_parquet, stage, write_csv, write_table,
)
from tallyweave.sources import staging
from tallyweave.plans.derived import ledgers, order_base
from tallyweave.config import SALES_SCHEMA


@pytest.fixture(scope="module")
def sources(spark, tables, tmp_path_factory):
    """The derived ledgers as the job expects them: Parquet folders with money as double."""
    root = tmp_path_factory.mktemp("sources")
    paths = []
    for name, df in zip(("sales", "gl", "bank"), ledgers(order_base(spark, tables()))):
        plain = [
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
        paths.append(str(root / name))
        df.select(*plain).write.parquet(paths[-1])
    return paths


def config(sources, out, **changes):
    return JobConfig(*sources, str(out), 1998, **({"gated_columns": 1} | changes))


@pytest.fixture(scope="module")
def result(spark, sources, tmp_path_factory):
    out = tmp_path_factory.mktemp("out") / "run"
    return out, run(spark, config(sources, out))


def test_job_writes_and_returns_its_tables(spark, result):
    out, job = result
    assert spark.read.parquet(f"{out}/transaction_level").count() == job.transactions.count() == 249
    assert [r["period"] for r in job.summary.collect()] == [f"1998-{m:02d}" for m in range(1, 13)]
    assert {r["table_name"] for r in job.scorecard.collect()} == {"Sales", "GL", "Bank"}
    assert job.transactions.columns[0] == "product_category"


def test_job_totals_are_the_measured_ones(result):
    _, job = result
    totals = job.summary.agg(
        F.sum("total_transactions"), F.sum("total_source_revenue"), F.sum("matched_revenue"),
        F.sum("total_unreconciled"), F.sum("anomalies_detected"),
    ).collect()[0]
    assert tuple(totals) == (
        249, Decimal("82700929.39"), Decimal("68840737.38"), Decimal("11922347.22"), 3
    )


def test_csv_is_one_file_with_header_in_order(result):
    out, job = result
    files = glob.glob(f"{out}/summary_csv/*.csv")
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines[0].split(",") == job.summary.columns and len(lines) == 13
    assert lines[1:] == sorted(lines[1:])


def test_second_run_replaces_the_first(spark, sources, tmp_path):
    first = run(spark, config(sources, tmp_path / "out"))
    assert first.summary.count() == 12
    again = run(spark, config(sources, tmp_path / "out"))
    assert again.transactions.count() == 249 and again.summary.count() == 12


def contents(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(folder.rglob("*")) if p.is_file()}


@pytest.mark.parametrize("at", ["transactions", "summary", "csv", "first move", "last move"])
def test_a_failed_run_leaves_the_last_one_whole(spark, sources, tmp_path, monkeypatch, at):
    from tallyweave.plans import reconciliation
    from tallyweave.sources import sinks

    out = tmp_path / "out"
    run(spark, config(sources, out))
    (out / "notes.txt").write_text("kept")
    before, calls = contents(out), []

    def failing(real, number):
        def call(*args, **kwargs):
            calls.append(args)
            if len(calls) == number:
                raise OSError("disk full")
            return real(*args, **kwargs)

        return call

    if at in ("transactions", "summary"):
        monkeypatch.setattr(reconciliation, "write_table", failing(sinks.write_table, 1 if at == "transactions" else 2))
    elif at == "csv":
        monkeypatch.setattr(reconciliation, "write_csv", failing(sinks.write_csv, 1))
    else:
        # Three moves set the old tables aside, three bring the new ones in.
        monkeypatch.setattr(sinks, "_move", failing(sinks._move, 2 if at == "first move" else 6))
    with pytest.raises(OSError, match="disk full"):
        run(spark, config(sources, out))
    assert contents(out) == before
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    monkeypatch.undo()
    assert run(spark, config(sources, out)).summary.count() == 12 and (out / "notes.txt").read_text() == "kept"


def test_null_amounts_stop_the_job_by_default(spark, sources, tmp_path):
    with pytest.raises(QualityError, match="'net_revenue' of Sales"):
        run(spark, config(sources, tmp_path / "out", gated_columns=2))
    assert not (tmp_path / "out").exists()


def test_options(spark, sources, tables):
    raw = tuple(spark.read.parquet(p) for p in sources)

    def scored(**changes):
        return process(raw, config(sources, "/nowhere", **changes))[1]

    plain = scored()
    kept = scored(null_category="keep")
    assert kept.count() == 253 and kept.filter("product_category is null").count() == 4
    single = scored(grain="reference", null_category="keep")
    assert single.count() == single.select("transaction_id").distinct().count() == 246
    missing = F.col("reconciliation_status") == "MISSING_IN_GL"
    assert scored(grace_days=31).filter(missing).count() <= plain.filter(missing).count()
    with pytest.raises(ValueError, match="grain"):
        scored(grain="week")
    with pytest.raises(ValueError, match="null_category"):
        scored(null_category="maybe")


def test_statuses_and_months_add_up(result):
    _, job = result
    rows = job.transactions.count()
    by_status = job.transactions.groupBy("reconciliation_status").count()
    assert by_status.agg(F.sum("count")).collect()[0][0] == rows
    assert job.summary.agg(F.sum("total_transactions")).collect()[0][0] == rows


def test_input_order_does_not_matter(spark, sources):
    def outcome(shuffle):
        raw = [spark.read.parquet(p) for p in sources]
        if shuffle:
            raw = [df.orderBy(F.rand(7)).repartition(5) for df in raw]
        scored = process(tuple(raw), config(sources, "/nowhere"))[1]
        return sorted(map(repr, scored.collect()))

    assert outcome(False) == outcome(True)


def test_ingest_checks_schema_and_counts(spark, sources):
    sales = scan_parquet(spark, sources[0], SALES_SCHEMA)
    assert [tuple(r) for r in ingest_audit({"sales": sales}).collect()] == [("sales", 1530, 14)]
    with pytest.raises(ValueError, match="transaction_id is missing"):
        scan_parquet(spark, sources[1], SALES_SCHEMA)


def test_wrong_type_is_an_error(spark, tmp_path):
    wrong = spark.createDataFrame([("a", "b")], "transaction_id string, net_revenue string")
    wrong.write.parquet(str(tmp_path / "w"))
    with pytest.raises(ValueError, match="net_revenue is string, not double"):
        scan_parquet(spark, str(tmp_path / "w"), SALES_SCHEMA)


@pytest.mark.parametrize(
    "target", ["/a/b", "/a/b/", "file:///a//b", "/a/b/c", "/a", "file:/a/./b/c"]
)
def test_overlapping_target_is_refused(target):
    with pytest.raises(ValueError, match="overlaps"):
        refuse_overlap(target, ["/x", "/a/b/"])


@pytest.mark.parametrize("target", ["/a/bc", "/b", "store://a/b"])
def test_other_targets_are_fine(target):
    refuse_overlap(target, ["/a/b"])


def test_source_survives_a_refused_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = write_table(spark.range(5), path)
    with pytest.raises(ValueError, match="overlaps"):
        write_table(df.filter("id > 1"), path, sources=[path])
    with pytest.raises(ValueError, match="overlaps"):
        write_csv(df, path, sources=[path])
    assert spark.read.parquet(path).count() == 5


def test_other_formats(spark, tmp_path):
    back = write_table(spark.range(3).withColumn("t", F.lit("x")), str(tmp_path / "o"), format="orc")
    assert back.count() == 3 and glob.glob(f"{tmp_path}/o/*.orc")


def test_staged_frames_lie_in_the_shared_folder_and_are_computed_once(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    count = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    staged = stage(spark.range(10).mapInArrow(seen, "id bigint"), "numbers")
    assert all(f.removeprefix("file://").startswith(folder) for f in staged.inputFiles())
    assert staged.count() == staged.distinct().count() == 10
    assert count.value == 10


class Session:
    """As much of a session as the choice of the shared folder needs."""

    def __init__(self, named, current):
        self.settings = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "store://house/warehouse"}
        self.current = current
        self.sparkContext = self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key) or default

    def getCheckpointDir(self):
        return self.current


@pytest.mark.parametrize(
    "named, current, begins",
    [
        ("store://shared/", None, "store://shared/x-"),
        ("store://shared/", "/tmp/elsewhere/application", "store://shared/x-"),
        ("store://shared/", "store://shared/application", "store://shared/application/x-"),
        ("/data/ck", "/mnt/other/data/ck-old/app", "/data/ck/x-"),
        ("/data/ck", "/data/ck-old/app", "/data/ck/x-"),
        ("/data/ck", "file:/data/ck/app", "file:/data/ck/app/x-"),
        (None, "/set/by/caller", "/set/by/caller/x-"),
        (None, None, "store://house/warehouse/.scratch/x-"),
    ],
)
def test_the_folder_named_by_the_session_wins(named, current, begins):
    assert staging.scratch_path(Session(named, current), "x").startswith(begins)
    assert staging.scratch_path(Session(named, current), "x", "/own/").startswith("/own/x-")


def staged_folders(spark, out):
    shared = spark.conf.get("spark.checkpoint.dir")
    return sorted(glob.glob(f"{shared}/*")), sorted(glob.glob(f"{out}/_staging/*"))


def test_no_staged_folder_is_left(spark, sources, tmp_path, monkeypatch):
    before = staged_folders(spark, tmp_path / "out")
    result = run(spark, config(sources, tmp_path / "out"))
    assert staged_folders(spark, tmp_path / "out") == before
    assert {tuple(r) for r in result.audit.collect()} == {("sales", 1530, 14), ("gl", 1861, 9), ("bank", 1487, 6)}
    from tallyweave.plans import reconciliation

    def fails(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(reconciliation, "write_outputs", fails)
    with pytest.raises(RuntimeError, match="disk full"):
        run(spark, config(sources, tmp_path / "out", staging_path=str(tmp_path / "aside")))
    assert staged_folders(spark, tmp_path / "out") == before and glob.glob(f"{tmp_path}/aside/*") == []


@pytest.mark.parametrize(
    "ledger, column, where, stops",
    [
        (0, "gross_revenue", "year(transaction_date) = 1998", True),
        (0, "net_revenue", "year(transaction_date) = 1998", True),
        (0, "gross_revenue", "year(transaction_date) <> 1998", False),
        (0, "tax_amount", "true", False),  # the job does not convert it
        (1, "debit_amount", "account_type = 'REVENUE'", True),
        (1, "tax_posted", "account_type <> 'REVENUE'", False),
        (2, "fee_deducted", "true", True),
    ],
)
def test_amounts_that_would_stop_the_job_stop_the_gate(spark, sources, ledger, column, where, stops):
    raw = [spark.read.parquet(p) for p in sources]
    nan = F.lit(float("nan"))
    raw[ledger] = raw[ledger].withColumn(column, F.when(F.expr(where), nan).otherwise(F.col(column)))
    if stops:
        with pytest.raises(QualityError, match=f"'{column}'.*no money"):
            gate_all(tuple(raw), config(sources, "/nowhere"))
    else:
        gate_all(tuple(raw), config(sources, "/nowhere"))
        assert process(tuple(raw), config(sources, "/nowhere"))[1].count() == 249


def test_broadcasts_are_measured_by_type(spark):
    wide = stage(spark.range(100).select(F.expr("cast(repeat('x', 100000) as binary)").alias("b")), "wide")
    nested = stage(spark.range(3).select(F.array("id").alias("a")), "nested")
    small = stage(spark.range(3).withColumn("b", F.lit("x").cast("binary")), "small")

    def hinted(df, limit=1 << 20):
        plan = staging.broadcast_if_small(df, limit)._jdf.queryExecution().logical().toString()
        return "broadcast" in plan.lower()

    assert not hinted(wide) and not hinted(nested) and hinted(small)


def test_csv_files_are_as_many_as_asked(spark, tmp_path):
    df = spark.range(40).repartition(4)
    for files, want in ((1, 1), (2, 2), (None, 4)):
        write_csv(df, str(tmp_path / "c"), files=files)
        assert len(glob.glob(f"{tmp_path}/c/*.csv")) == want


def outcome(scored):
    return sorted(tuple(map(repr, row)) for row in scored.collect())


def test_ledgers_may_name_their_columns_otherwise(spark, sources):
    raw = tuple(spark.read.parquet(p) for p in sources)

    def renamed(df, columns):
        """All columns as ``x.<name>``, and column settings that say so."""
        settings = {field: f"x.{name}" for field, name in vars(columns).items()}
        return df.toDF(*(f"x.{name}" for name in df.columns)), type(columns)(**settings)

    plain = config(sources, "/nowhere")
    sales, sales_columns = renamed(raw[0], plain.sales)
    gl, gl_columns = renamed(raw[1], plain.gl)
    bank, bank_columns = renamed(raw[2], plain.bank)
    other = config(
        sources, "/nowhere", sales=sales_columns, gl=gl_columns, bank=bank_columns, null_category="keep"
    )
    same = config(sources, "/nowhere", null_category="keep")
    assert outcome(process((sales, gl, bank), other)[1]) == outcome(process(raw, same)[1])


def test_the_job_does_not_depend_on_ansi_mode(spark, sources):
    raw = tuple(spark.read.parquet(p) for p in sources)
    strict = outcome(process(raw, config(sources, "/nowhere"))[1])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert outcome(process(raw, config(sources, "/nowhere"))[1]) == strict
        nan = spark.createDataFrame([(float("nan"),)], "x double")
        with pytest.raises(Exception, match="no money"):
            nan.select(money("x", default=0)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_typed_dates_give_the_same_result(spark, sources):
    raw = [spark.read.parquet(p) for p in sources]
    dated = [
        df.withColumn(name, F.col(name).cast(kind))
        for df, name, kind in zip(
            raw,
            ("transaction_date", "posting_date", "settlement_date"),
            ("date", "timestamp", "timestamp_ntz"),
        )
    ]
    plain = config(sources, "/nowhere")
    assert outcome(process(tuple(dated), plain)[1]) == outcome(process(tuple(raw), plain)[1])
