"""Folding closed batches of append tables, so that partitions do not grow with batches and replays stay exact.

A batch fills partitions of its own: their last column, ``_segment``, is ``n-n`` for batch n.  Segments of batches that no replay can
bring back are folded into one, ``first-last``, when there are as many of a size as the fan: a day then has at most a few segments of
each size, and a row is rewritten as often as its batches' number has digits.  Every row keeps its ``_batch_id``.

A fold is whole or not there: the folded rows are written beside the table, the ledger names what they replace, and only then the table is pointed to
them.  A run that dies leaves the ledger, and the next one goes on from it.  Between adding the folded partitions and dropping the old ones a reader
may see both for a moment, as plain tables cannot switch two partitions at once.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.tables import (
    SEGMENT,
    add_partitions,
    append_rows_to,
    create_table,
    drop_partitions,
    partition_columns,
    partition_values,
    table_location,
)

LEDGER = T.StructType(
    [T.StructField(c, T.ArrayType(T.StringType()) if c == "replaced" else T.StringType()) for c in ("place", "folder", "replaced", "table_name", "run")]
)


def span(segment: str) -> tuple[int, int]:
    """First and last batch of a segment."""
    first, last = segment.split("-")
    return int(first), int(last)


def folds(segments: Sequence[str], fan: int) -> list[tuple[str, list[str]]]:
    """(new segment, what it replaces) for the segments of one day; a size is the digits of a segment's span in base ``fan``."""

    def size(segment: tuple[int, int]) -> int:
        return int(math.log(segment[1] - segment[0] + 1, fan) + 1e-9)

    parts = {span(s): [s] for s in segments}
    for level in range(64):
        if not any(size(p) >= level for p in parts):
            break
        if sum(size(p) == level for p in parts) >= fan:
            own = sorted(p for p in parts if size(p) <= level)
            merged = [s for p in own for s in parts.pop(p)]
            whole = min(p[0] for p in own), max(p[1] for p in own)
            # A later, longer segment may span the same batches.
            parts[whole] = parts.pop(whole, []) + merged
    return [(f"{p[0]}-{p[1]}", old) for p, old in sorted(parts.items()) if len(old) > 1]


class Compactor:
    """Folds the append tables of one dataset; ``ledger`` is a table of its own."""

    def __init__(self, spark: SparkSession, ledger: str, fan: int = 8):
        self.spark, self.ledger, self.fan = spark, ledger, fan

    def recover(self) -> None:
        """Finish the folds that were written and not yet taken in."""
        if not self.spark.catalog.tableExists(self.ledger):
            return
        self.spark.catalog.refreshTable(self.ledger)
        runs = defaultdict(list)
        for row in self.spark.table(self.ledger).collect():  # open folds alone: those of one run
            runs[row["table_name"], row["run"]].append(row)
        for (name, run), rows in sorted(runs.items()):
            add_partitions(self.spark, name, [(json.loads(r["place"]), r["folder"]) for r in rows])
            drop_partitions(self.spark, name, [json.loads(old) for r in rows for old in r["replaced"]])
            self.spark.catalog.refreshTable(name)
            drop_partitions(self.spark, self.ledger, [{"table_name": name, "run": run}])

    def compact(self, name: str, open_from: int, cluster_by: Sequence[str] = ()) -> int:
        """Fold segments of batches before ``open_from``, the first that a replay may bring back; gives the number of partitions that went."""
        spark = self.spark
        self.recover()
        spark.catalog.refreshTable(name)
        plan = self._plan(name, open_from)
        if not plan:
            return 0
        parts = partition_columns(spark, name)
        keys = parts[:-1]
        kinds = {f.name: f.dataType for f in spark.table(name).schema.fields}
        lines = [(*(spec[k] for k in keys), old, new) for spec, new, olds in plan for old in olds]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*keys, SEGMENT, "_folded")])
        moves = spark.createDataFrame(lines, schema).select(*(F.col(c).cast(kinds[c]).alias(c) for c in parts), "_folded")
        stored = spark.table(name).filter(F.col(SEGMENT).isin(sorted({line[-2] for line in lines})))
        same = [stored[c].eqNullSafe(moves[c]) for c in parts]
        rows = stored.join(moves, same).select(*(stored[c] for c in stored.columns if c != SEGMENT), F.col("_folded").alias(SEGMENT))
        folder = f"{table_location(spark, name)}/_versions/{uuid.uuid4().hex[:12]}"
        places = append_rows_to(rows, folder, name, parts, cluster_by)
        replaced = {self._text({**spec, SEGMENT: new}): [self._text({**spec, SEGMENT: old}) for old in olds] for spec, new, olds in plan}
        create_table(spark, self.ledger, LEDGER, ["table_name", "run"], "Folds that are written and not yet taken in")
        noted = [(self._text(spec), path, replaced[self._text(spec)], name, folder.rpartition("/")[2]) for path, spec in places.items()]
        spark.createDataFrame(noted, LEDGER).coalesce(1).write.mode("append").insertInto(self.ledger)
        self.recover()
        return len(lines)

    def _plan(self, name: str, open_from: int) -> list[tuple[dict, str, list[str]]]:
        """(other partition values, new segment, old segments); from the catalog alone."""
        days = defaultdict(list)
        for row in partition_values(self.spark, name).collect():
            spec = dict(row["spec"])
            segment = spec.pop(SEGMENT)
            if span(segment)[1] < open_from:
                days[json.dumps(spec, sort_keys=True)].append(segment)
        return [(json.loads(day), new, old) for day, segments in sorted(days.items()) for new, old in folds(segments, self.fan)]

    @staticmethod
    def _text(spec: dict) -> str:
        return json.dumps(spec, sort_keys=True)
