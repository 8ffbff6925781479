"""The ingestion stream: landed files to bronze, clean, quarantine and late tables.

Order inside a batch, which defines the results: bronze, lineage columns, late
split, breaker, clean/corrupt split, clean write, quarantine write, state.  Late
rows are set aside before errors are counted.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.contracts import Contract
from tidewater.functions.moments import collected, utc
from tidewater.operators.alerts import note_alert
from tidewater.operators.breaker import CLOSED, BreakerState, next_state, quarantine_attempts
from tidewater.operators.compaction import Compactor
from tidewater.operators.dedup import distinct_rows
from tidewater.operators.metadata import batch_constants, inject_row_metadata
from tidewater.operators.splits import is_corrupt, is_late, split_late, split_valid
from tidewater.operators.tables import Layers, append_batch, bronze_append
from tidewater.operators.upsert import write_clean
from tidewater.sources.evolution import evolve, observed_fields
from tidewater.sources.landing import landed_schema, read_csv_files, read_landed_files, stream_file_names, stream_landing, stream_lines
from tidewater.sources.rescue import SOURCE_FILE, type_json_lines

log = logging.getLogger(__name__)

STATE_SCHEMA = (
    "domain string, total long, late long, on_time long, corrupt long, error_pct double, "
    "max_event_time timestamp, watermark timestamp, cutoff timestamp, breaker_state string, open_until timestamp, "
    "silver_rows long, elapsed_ms long, over_limit boolean, batch_time timestamp, refused boolean, checkpoint string, _batch_id long"
)


Constants = dict[str, Column]


class BatchRefused(RuntimeError):
    """The breaker is not closed and the contract asks to fail fast."""


class OtherCheckpoint(RuntimeError):
    """The tables were filled from another checkpoint."""


class ErrorRateExceeded(RuntimeError):
    """The breaker is not closed and the contract asks for an alert only."""


@dataclass
class Ingest:
    """One dataset's ingestion.  ``clock`` gives a batch its ingest time, once."""

    spark: SparkSession
    contract: Contract
    layers: Layers
    clock: Callable[[int], dt.datetime] = lambda batch_id: dt.datetime.now(dt.timezone.utc)
    _checkpoint: str | None = None

    # -- stream ---------------------------------------------------------------

    def start(self, landing: str, checkpoint: str) -> StreamingQuery:
        """Process everything that landed since the last run, then stop.

        Tables belong to one checkpoint: batches of another one would replace theirs, so it is refused.
        """
        self.layers.create(self.spark)
        Compactor(self.spark, self.layers.table("system", f"{self.contract.domain}_folds")).recover()
        if self.spark.catalog.tableExists(self.state_table):
            # Batches write from a session of their own; this one may still list the files they replaced.
            self.spark.catalog.refreshTable(self.state_table)
            others = self.spark.table(self.state_table).filter(F.col("checkpoint") != checkpoint).select("checkpoint").limit(1).collect()
            if others:
                raise OtherCheckpoint(f"{self.contract.domain}: its tables belong to checkpoint {others[0][0]!r}, not {checkpoint!r}")
        self._checkpoint = checkpoint
        by_file = self.contract.source.format in ("parquet", "csv")
        read = stream_file_names if by_file else stream_lines if self._evolves else stream_landing
        stream = read(self.spark, self.contract, landing)
        return (
            stream.writeStream.foreachBatch(lambda batch, batch_id: self.process(self._as_landed(batch), batch_id))
            .option("checkpointLocation", checkpoint)
            .queryName(f"ingest_{self.contract.domain}_{checkpoint.rsplit('/', 1)[-1]}")
            .trigger(availableNow=True)
            .start()
        )

    def run(self, landing: str, checkpoint: str) -> None:
        self.start(landing, checkpoint).awaitTermination()
        self.compact()

    def compact(self, fan: int = 8) -> int:
        """Fold the closed batches of the append tables; gives the number of partitions that went.

        A stream repeats its last batch at most, so all before the last one that left a state are closed.
        """
        c, spark = self.contract, self.spark
        if not spark.catalog.tableExists(self.state_table):
            return 0
        spark.catalog.refreshTable(self.state_table)
        last = spark.table(self.state_table).agg(F.max("_batch_id")).first()[0]
        tables = {
            self.layers.table("bronze", c.domain): (),
            self.layers.table("bronze", c.late_table): (),
            self.layers.table("quarantine", c.domain): (),
            self.state_table: (),
        }
        if c.sink.mode == "append":
            tables[self.layers.table("silver", c.domain)] = c.sink.cluster_by
        compactor = Compactor(spark, self.layers.table("system", f"{c.domain}_folds"), fan)
        return sum(compactor.compact(name, last, cluster) for name, cluster in tables.items() if spark.catalog.tableExists(name))

    @property
    def _evolves(self) -> bool:
        return self.contract.source.format == "json" and self.contract.evolution_mode != "none"

    def _as_landed(self, batch: DataFrame) -> DataFrame:
        """The batch's rows; columnar and CSV files are read once more with their own schemas or headers, as a stream has one for all.

        Only the names of the files come to the driver, as many as the read limit allows in one batch.  Where the
        contract lets fields be added, those of the batch become text columns, here and in the tables;
        stored columns keep their type, so values of another type are still rescued.
        """
        if self._evolves:
            added = evolve(self.contract.with_options(evolution_mode="additive"), observed_fields(batch, self.contract))
            return type_json_lines(batch, added)
        if self.contract.source.format not in ("parquet", "csv"):
            return batch
        files = [r[0] for r in batch.select(SOURCE_FILE).distinct().collect()]
        if not files:
            return batch.sparkSession.createDataFrame([], landed_schema(self.contract))
        read = read_landed_files if self.contract.source.format == "parquet" else read_csv_files
        return read(batch.sparkSession, self.contract, files)

    # -- one batch ------------------------------------------------------------

    def process(self, landed: DataFrame, batch_id: int) -> None:
        started, at = time.monotonic(), utc(self.clock(batch_id))
        c = self.contract
        landed = landed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Counted by plain jobs on the stored rows: a lost executor repeats its part, never adds it twice.
            latest = landed.agg(F.count("*").alias("total"), F.max(c.event_time_column).alias("latest")).first()
            if latest["total"]:
                bronze_append(landed.drop(SOURCE_FILE), self.layers, c, batch_id)
            # What is the same in every row is added by the writes, after their shuffles.
            rows = inject_row_metadata(landed, c, batch_id, at)
            constants = batch_constants(c, batch_id, at, landed.columns)

            before, refused_before = self.previous(landed.sparkSession, batch_id)
            newest = collected(latest["latest"])
            watermark, cutoff = self._cutoff(newest, before)
            counts = self._counts(rows, cutoff)
            error_pct = counts["corrupt"] / counts["on_time"] * 100 if counts["on_time"] else None
            breaker = next_state(before["breaker"], error_pct, at, c.breaker)
            clean = counts["on_time"] - counts["corrupt"]
            # A batch is refused once.  Its corrupt rows are set aside by then, so when it is run again its clean rows go in.
            refused = breaker.state != CLOSED and c.breaker.action == "fail_fast" and not refused_before

            def save_state(silver_rows: int) -> None:
                self._save_state(
                    landed.sparkSession, batch_id, at, latest["total"], newest, watermark, cutoff, counts, error_pct, breaker,
                    silver_rows, started, refused,
                )

            on_time, late = split_late(rows, c.event_time_column, cutoff)
            valid, corrupt = split_valid(on_time, c)
            if refused:
                if counts["corrupt"]:
                    self._quarantine(corrupt, constants)
                save_state(0)
                raise BatchRefused(f"{c.domain}: error rate above the limit, breaker {breaker.state}")
            if breaker.state != CLOSED and c.breaker.action == "alert_only":
                self._alert(landed.sparkSession, batch_id, "breaker", ErrorRateExceeded(c.domain), at)

            if counts["late"] and c.late_data.enabled:
                self._late(late, constants)

            def attempt(step: str, write: Callable[[], None], attempts: int) -> bool:
                """Try a write; when degraded, a final failure is recorded and the batch goes on."""
                for left in reversed(range(attempts)):
                    try:
                        write()
                        return True
                    except Exception as error:
                        if left:
                            time.sleep(c.retry_wait_seconds)
                            continue
                        self._alert(landed.sparkSession, batch_id, step, error, at)
                        if breaker.state == CLOSED or c.breaker.action != "degrade_mode":
                            raise
                return False

            stored = bool(clean) and attempt("silver", lambda: self._silver(valid, constants), 1)
            if counts["corrupt"]:
                attempt("quarantine", lambda: self._quarantine(corrupt, constants), quarantine_attempts(breaker.state, c.max_retries))
            save_state(clean if stored else 0)
        finally:
            landed.unpersist()

    def _cutoff(self, latest: dt.datetime | None, before: dict) -> tuple[dt.datetime | None, dt.datetime | None]:
        spec = self.contract.watermark
        if spec is None:
            return None, None
        watermark = latest - dt.timedelta(minutes=spec.delayed_threshold_minutes) if latest else None
        if spec.monotone and before["watermark"]:
            watermark = max(watermark, before["watermark"]) if watermark else before["watermark"]
        return watermark, watermark - dt.timedelta(minutes=spec.allowed_lateness_minutes) if watermark else None

    def _counts(self, rows: DataFrame, cutoff: dt.datetime | None) -> dict[str, int]:
        late = is_late(self.contract.event_time_column, cutoff)
        return (
            rows.agg(
                F.count_if(late).alias("late"),
                F.count_if(~late).alias("on_time"),
                F.count_if(~late & is_corrupt(self.contract)).alias("corrupt"),
            )
            .first()
            .asDict()
        )

    # -- writes ---------------------------------------------------------------

    def _silver(self, valid: DataFrame, constants: Constants) -> None:
        write_clean(valid.sparkSession, valid, self.layers, self.contract, constants)

    def _quarantine(self, corrupt: DataFrame, constants: Constants) -> None:
        name = self.layers.table("quarantine", self.contract.domain)
        rows = distinct_rows(corrupt, ["_file_path"])
        append_batch(rows, name, comment="Rows that break their contract", constants=constants)

    def _late(self, late: DataFrame, constants: Constants) -> None:
        name = self.layers.table("bronze", self.contract.late_table)
        append_batch(late, name, comment="Rows behind the cutoff", constants=constants)

    def _alert(self, spark: SparkSession, batch_id: int, step: str, error: Exception, at: dt.datetime) -> None:
        """Tell of an error once in a time of silence; without masking every time."""
        c = self.contract
        if not c.masking.enabled or note_alert(spark, self.layers, c.masking, c.domain, batch_id, step, error, at):
            log.warning("%s, batch %d, %s: %s: %s", c.domain, batch_id, step, type(error).__name__, error)

    # -- state ----------------------------------------------------------------

    @property
    def state_table(self) -> str:
        return self.layers.table("system", f"{self.contract.domain}_batches")

    def previous(self, spark: SparkSession, batch_id: int) -> tuple[dict, bool]:
        """(state, refused before): the state that this batch left if it was refused, else that of the batch before; two of its rows are read."""
        if spark.catalog.tableExists(self.state_table):
            rows = spark.table(self.state_table).filter(F.col("_batch_id").isin(batch_id, batch_id - 1)).collect()
            own = {r["_batch_id"]: r for r in rows}
            again = batch_id in own and own[batch_id]["refused"]
            row = own[batch_id] if again else own.get(batch_id - 1)
            if row:
                state = BreakerState(row["breaker_state"], collected(row["open_until"]))
                return {"breaker": state, "watermark": collected(row["watermark"])}, bool(again)
        return {"breaker": BreakerState(), "watermark": None}, False

    def _save_state(
        self, spark, batch_id, at, total, latest, watermark, cutoff, counts, error_pct, breaker: BreakerState, clean, started, refused
    ) -> None:
        elapsed = int((time.monotonic() - started) * 1000)
        row = (
            self.contract.domain, total, counts["late"], counts["on_time"], counts["corrupt"], error_pct,
            latest, watermark, cutoff, breaker.state, breaker.open_until,
            clean, elapsed, elapsed > self.contract.max_batch_minutes * 60_000, at, refused, self._checkpoint, batch_id,
        )
        line = spark.createDataFrame([row], STATE_SCHEMA)
        append_batch(line, self.state_table, comment="One row per batch: counts, watermark, breaker")
