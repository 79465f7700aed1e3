"""Runs of several stages that can be taken up again: a ledger says which tables of a run are committed.

A stage writes its tables to a folder of its own attempt and is committed by one row of the ledger, written last: a stage that was killed has no
such row, so nobody reads what it left, and running it again is safe. The ledger is append-only and small, a row per change of state; its newest
rows decide. A failed stage is tried again after each of the given waits; when these are used up the run has failed, and can be taken up at
that stage later. When a stage runs again, those behind it do so too.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import batch, history, quality, resolve
from quillstone.operators.normalised import normalised
from quillstone.operators.store import hadoop_path, removed

#: Seconds before a failed stage's next attempts.
WAITS = (60, 300, 1800, 3600)
LEDGER = "run_id string, step long, stage string, attempt int, state string, folder string, tables map<string,long>, message string, changed_at timestamp"
#: A stage: its name, and what makes its tables, by name, from those of the stages before, by "stage.table".
Stage = tuple[str, Callable[[dict[str, DataFrame]], dict[str, DataFrame]]]


class Run:
    """One run of ``stages`` below ``folder``, which driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str, stages: list[Stage], waits: tuple[float, ...] = WAITS, sleep: Callable[[float], None] = time.sleep):
        self.spark, self.run_id, self.stages, self.waits, self.sleep = spark, run_id, stages, waits, sleep
        self.folder = f"{folder.rstrip('/')}/{run_id}"
        if len({name for name, _ in stages}) < len(stages):
            raise ValueError("stages have names of their own")

    def ledger(self) -> DataFrame:
        """All changes of state of the run, in order of ``step``."""
        fs, path = hadoop_path(self.spark, f"{self.folder}/ledger")
        return self.spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger") if fs.exists(path) else self.spark.createDataFrame([], LEDGER)

    def _entries(self) -> list:
        return sorted(self.ledger().collect(), key=lambda r: r["step"])  # of one run: stages times attempts

    def _note(self, stage: str, attempt: int, state: str, folder: str | None = None, tables: dict[str, int] | None = None, message: str | None = None) -> None:
        step = len(self._entries())
        row = self.spark.createDataFrame([(self.run_id, step, stage, attempt, state, folder, tables, message)], LEDGER.rpartition(",")[0])
        row.withColumn("changed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.folder}/ledger")

    def states(self) -> DataFrame:
        """(stage, state, attempts, tables) as they are: the newest state of each stage that has begun, and its tables if that is COMPLETED."""
        rows = self.ledger().filter("stage <> ''").groupBy("stage").agg(F.max(F.struct("step", "state")).alias("s"), F.max_by(F.col("tables"), F.col("step")).alias("tables"), F.max("attempt").alias("attempts"))
        return rows.select("stage", "s.state", "attempts", F.when(F.col("s.state") == "COMPLETED", F.col("tables")).alias("tables"))

    def _committed(self, entries: list, stage: str):
        """The stage's newest entry, if it is that of a committed attempt."""
        own = [r for r in entries if r["stage"] == stage]
        return own[-1] if own and own[-1]["state"] == "COMPLETED" else None

    def tables(self, stage: str) -> dict[str, DataFrame]:
        """The committed tables of a stage, by name."""
        entry = self._committed(self._entries(), stage)
        if entry is None:
            raise LookupError(f"{stage} of run {self.run_id} is not committed")
        return {name: self.spark.read.parquet(f"{entry['folder']}/{name}") for name in entry["tables"]}

    def _attempt(self, name: str, make, before: dict[str, DataFrame], attempt: int) -> None:
        folder = f"{self.folder}/{name}/{attempt}-{uuid4().hex[:8]}"
        self._note(name, attempt, "RUNNING", folder)
        counts = {}
        for table, rows in make(before).items():
            rows.write.parquet(f"{folder}/{table}")
            counts[table] = self.spark.read.parquet(f"{folder}/{table}").count()
        self._note(name, attempt, "COMPLETED", folder, counts)

    def run(self, stage_from: str | None = None, until: str | None = None) -> str:
        """Run what is not committed, or all from ``stage_from`` on, up to ``until``; the state of the run: COMPLETED, PARTIAL or FAILED.

        Stages before ``stage_from`` must be committed. Folders of attempts that came to nothing are removed when their stage runs again.
        """
        names = [name for name, _ in self.stages]
        for name in (stage_from, until):
            if name is not None and name not in names:
                raise ValueError(f"no stage {name!r}: {', '.join(names)}")
        entries, again, before = self._entries(), False, {}
        for name, make in self.stages:
            again = again or name == stage_from or self._committed(entries, name) is None
            if again and stage_from is not None and names.index(name) < names.index(stage_from):
                raise LookupError(f"{name} comes before {stage_from} and is not committed")
            if again:
                own = [r for r in entries if r["stage"] == name]
                for r in own:
                    if r["state"] == "RUNNING" and not any(x["folder"] == r["folder"] and x["state"] == "COMPLETED" for x in own):
                        removed(self.spark, r["folder"])
                first = max((r["attempt"] for r in own), default=0) + 1
                for k, wait in enumerate((*self.waits, None)):
                    try:
                        self._attempt(name, make, before, first + k)
                        break
                    except Exception as error:
                        self._note(name, first + k, "FAILED" if wait is None else "WAITING", message=f"{type(error).__name__}: {error}"[:500])
                        if wait is None:
                            self._note("", 0, "FAILED")
                            raise
                        self.sleep(wait)
            before |= {f"{name}.{table}": rows for table, rows in self.tables(name).items()}
            if name == until:
                break
        done = all(self._committed(entries, name) is not None for entries in [self._entries()] for name in names)
        self._note("", 0, "COMPLETED" if done else "PARTIAL")
        return "COMPLETED" if done else "PARTIAL"


def record_stages(raw: DataFrame, known: DataFrame | None = None, fuzzy: bool = True, as_of: str | None = None) -> list[Stage]:
    """The stages of a record run: normalise, resolve (with what it writes), events, quality. ``raw``: fields as ``normalised`` takes them, with run_id and grain."""
    def resolved(before):
        rows = before["normalise.records"]
        entities = rows.limit(0).withColumn("entity_id", F.col("record_id")) if known is None else known
        placed = resolve.placed(rows, batch.resolve_batch(rows, entities, fuzzy))
        return {"records": placed, "entities": resolve.new_entities(placed), "edges": resolve.candidate_edges(placed)}

    def events(before):
        rows = before["resolve.records"].filter("entity_id is not null")
        permit = F.lit(None).cast("string")
        found = rows.select("entity_id", "run_id", F.col("outcome").alias("resolution_status"), "grain", (F.col("extra")["event_type"] if "extra" in rows.columns else permit).alias("event_type"), F.col("issued_date").cast("date").alias("event_date"), F.coalesce("legal_name", "trade_name").alias("display_name"), permit.alias("permit_number"))
        return {"events": history.new_business_events(found)}

    def scored(before):
        rows = before["resolve.records"]
        made = rows.filter(F.col("outcome").isin("CANDIDATE", "NEW"))
        sources = rows.filter("entity_id is not null").groupBy("entity_id").agg(F.sort_array(F.collect_set("source_class")).alias("source_classes"))  # four at most
        own = made.select("entity_id", F.coalesce("legal_name", "trade_name", "source_key").alias("canonical_name"), "legal_name", "corp_number", "bn", "address_line1", "city", "province", "postal_code", "phone", "phone_valid", "email", "email_valid", "domain", "employee_bucket", "employee_exact", "naics", "naics_sector", "status")
        nothing = {"entity_type": F.lit(None).cast("string"), "has_coordinates": F.lit(False), "directors": F.lit(0), "has_primary_contact": F.lit(False), "last_verified_at": F.lit(None).cast("timestamp"), "dnc": F.lit(False)}
        return {"scores": quality.scores(own.withColumns(nothing).join(sources, "entity_id"), F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp())}

    return [("normalise", lambda before: {"records": normalised(raw)}), ("resolve", resolved), ("events", events), ("quality", scored)]
