"""Current-state and audit tables that micro-batches write to.

A micro-batch must leave the same result when it is run again (foreachBatch is at
least once), and must not rewrite what it did not change. So every batch writes
its own folder `batch=<id>`, replacing it on a re-run, and reading combines the
folders. Closed batches are merged by levels: `level=<k>/run=<g>` holds the `fan` ** k batches from number g * fan ** k on, so a row is
rewritten once per level, a logarithmic number of times, and reading opens a few folders per level.

A folder whose batches a higher one holds is not read any more. It is deleted by the merge after the one that replaced it,
so a reader that has begun finishes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartstream.operators.upsert import UpsertSpec, finalize, fold, merge
from cartstream.sources.folders import delete_folder, finished_folders

FAN = 16
PREFIX = "_prefix"


class _Levels:
    """Folders of batches and of merged batches; what merging means is up to the subclass."""

    def __init__(self, spark: SparkSession, batches: str, merged: str, fan: int):
        self.spark, self.batches, self.merged, self.fan = spark, batches, merged, fan

    def path(self, run: tuple[int, int]) -> str:
        level, number = run
        return f"{self.merged}/level={level}/run={number}" if level else f"{self.batches}/batch={number}"

    def span(self, run: tuple[int, int]) -> tuple[int, int]:
        """First batch of a run, and the one after its last."""
        level, number = run
        return number * self.fan**level, (number + 1) * self.fan**level

    def runs(self) -> list[tuple[int, int]]:
        """All finished folders as (level, number)."""
        found = [(0, i) for i in finished_folders(self.spark, self.batches, "batch")]
        level = 1
        while higher := finished_folders(self.spark, f"{self.merged}/level={level}", "run"):
            found += [(level, g) for g in higher]
            level += 1
        return found

    def live(self, before: int | None = None) -> list[tuple[int, int]]:
        """The runs to read, oldest first: those no higher run holds, of batches before `before`."""
        out: list[tuple[int, int]] = []
        for run in sorted(self.runs(), reverse=True):
            first, _ = self.span(run)
            if not any(a <= first < b for a, b in map(self.span, out)):
                out.append(run)
        return sorted((r for r in out if before is None or self.span(r)[0] < before), key=self.span)

    def holds(self, batch_id: int) -> bool:
        """Is the batch in a merged run already?"""
        return any(level and self.span((level, g))[0] <= batch_id < self.span((level, g))[1] for level, g in self.live())

    def settle(self, before: int, combine, keep: bool = True) -> None:
        """Merge what makes a whole higher run of batches before `before`, the largest runs first.

        combine(paths, path) writes the runs of `paths` as one.
        """
        replaced = set(self.runs()) - set(self.live())
        top = 1
        while self.fan ** (top + 1) <= before:
            top += 1
        made = False
        for level in range(top, 0, -1):
            groups: dict[int, list[tuple[int, int]]] = {}
            for run in self.live():
                first, end = self.span(run)
                if run[0] < level and end <= before // self.fan**level * self.fan**level:
                    groups.setdefault(first // self.fan**level, []).append(run)
            for number, inside in groups.items():
                if len(inside) > 1:
                    combine([self.path(r) for r in inside], self.path((level, number)))
                    made = True
        if made or not keep:
            gone = replaced if keep else set(self.runs()) - set(self.live())
            for run in gone:
                delete_folder(self.spark, self.path(run))


class KeyedState:
    """Keyed current state of one table; `compact_every` batches are merged into one fold, and as many of these again."""

    def __init__(self, spark: SparkSession, root: str, spec: UpsertSpec, compact_every: int = FAN):
        self.spark, self.spec, root = spark, spec, root.rstrip("/")
        self.levels = _Levels(spark, f"{root}/delta", f"{root}/base", compact_every)

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Store a batch's fold; a second run of the same batch replaces the first, or finds it merged already."""
        if not self.levels.holds(batch_id):
            fold(changes, self.spec).write.mode("overwrite").parquet(self.levels.path((0, batch_id)))
        self.levels.settle(batch_id - 1, self._combine)

    def _combine(self, paths: list[str], path: str) -> None:
        merge([_one_scan(self.spark, paths)], self.spec).write.mode("overwrite").parquet(path)

    def folded(self) -> DataFrame | None:
        paths = [self.levels.path(r) for r in self.levels.live()]
        if not paths:
            return None
        # All folds have one schema: one scan, however many batches there are.
        rows = _one_scan(self.spark, paths)
        return rows if len(paths) == 1 else merge([rows], self.spec)

    def read(self) -> DataFrame | None:
        """Current rows, or None when no batch was stored yet."""
        folded = self.folded()
        return None if folded is None else finalize(folded, self.spec)

    def among(self, keys: DataFrame, before: int | None = None) -> DataFrame | None:
        """Current rows of the keys asked for, as the batches before `before` (not older than the newest two) left them.

        The stored folds are cut down to these keys ahead of the merge, so only their rows are shuffled.
        """
        paths = [self.levels.path(r) for r in self.levels.live(before)]
        if not paths:
            return None
        rows = _one_scan(self.spark, paths).join(keys.select(*self.spec.key), list(self.spec.key), "left_semi")
        return finalize(merge([rows], self.spec), self.spec)

    def compact(self, keep: int = 2) -> None:
        """Merge all that makes a whole run, the newest batches too; with keep=1 what was merged is deleted at once."""
        newest = max((self.levels.span(r)[1] for r in self.levels.live()), default=0)
        self.levels.settle(newest, self._combine, keep=keep > 1)


def _one_scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One frame over folders of the same schema, which is read from the first of them only."""
    return spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)


class BatchLog:
    """Append-only table written once per micro-batch, merged by levels of `compact_every`.

    The newest two batches stay by themselves: the last may be run again and then asks for the one before. With `hashed`, a column of
    hexadecimal digests, merged runs are partitioned by its first `digits` digits, so `among` opens only the parts a batch asks for. With
    `newest_only` older batches are deleted in place of being merged.
    """

    def __init__(
        self, spark: SparkSession, root: str, bloom: list[str] | None = None, compact_every: int = FAN, hashed: str | None = None,
        digits: int = 3, newest_only: bool = False,
    ):
        self.spark, self.root, self.bloom, self.hashed, self.digits = spark, root.rstrip("/"), bloom or [], hashed, digits
        self.newest_only = newest_only
        self.levels = _Levels(spark, self.root, f"{self.root}/runs", compact_every)

    def _writer(self, rows: DataFrame):
        writer = rows.write.mode("overwrite")
        for c in self.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        return writer

    def write(self, rows: DataFrame, batch_id: int) -> None:
        if not self.levels.holds(batch_id):
            self._writer(rows).parquet(self.levels.path((0, batch_id)))
        if self.newest_only:
            for run in self.levels.runs():
                if run[1] < batch_id - 1:
                    delete_folder(self.spark, self.levels.path(run))
        else:
            self.compact(batch_id - 1)

    def _prefix(self):
        return F.substring(self.hashed, 1, self.digits)

    def _combine(self, paths: list[str], path: str) -> None:
        small, large = self._split(paths)
        parts = [_one_scan(self.spark, small)] if small else []
        if large:
            parts.append(self._merged(large))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1].select(*parts[0].columns))
        if self.hashed:
            # A file per prefix, more where a prefix is large.
            self._writer(rows.withColumn(PREFIX, self._prefix()).hint("rebalance", PREFIX)).partitionBy(PREFIX).parquet(path)
        else:
            self._writer(rows.hint("rebalance")).parquet(path)

    def _split(self, paths: list[str]) -> tuple[list[str], list[str]]:
        if not self.hashed:
            return paths, []
        runs = f"{self.root}/runs/"
        return [p for p in paths if not p.startswith(runs)], [p for p in paths if p.startswith(runs)]

    def _merged(self, paths: list[str]) -> DataFrame:
        """Runs partitioned by prefix, the prefix as text whatever it looks like."""
        fields = [f for f in self.spark.read.parquet(paths[0]).schema if f.name != PREFIX]
        schema = StructType([*fields, StructField(PREFIX, StringType())])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/runs").parquet(*paths)
        return rows.select(*schema.names)

    def read(self, before: int | None = None) -> DataFrame | None:
        """All rows, or those of the batches before `before`, which is not older than the newest two."""
        small, large = self._split([self.levels.path(r) for r in self.levels.live(before)])
        parts = ([_one_scan(self.spark, small)] if small else []) + ([self._merged(large).drop(PREFIX)] if large else [])
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if parts else None

    def among(self, wanted: DataFrame, before: int | None = None) -> DataFrame | None:
        """Digests of `wanted` (one column, the hashed one) that the log holds in batches before `before`.

        The parts of merged runs are pruned by the digests asked for when the query runs.
        """
        small, large = self._split([self.levels.path(r) for r in self.levels.live(before)])
        asked, parts = wanted.select(self.hashed), []
        if small:
            parts.append(_one_scan(self.spark, small).select(self.hashed).join(asked, self.hashed, "left_semi"))
        if large:
            asked = asked.withColumn(PREFIX, self._prefix()).filter(F.length(PREFIX) == self.digits)
            parts.append(
                self._merged(large).select(self.hashed, PREFIX).join(F.broadcast(asked) if self._few(asked) else asked, [PREFIX, self.hashed], "left_semi")
                .select(self.hashed)
            )
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if parts else None

    def _few(self, asked: DataFrame) -> bool:
        """Is a batch's list of digests small enough to be sent to all executors? Counted; otherwise the join is shuffled."""
        return asked.count() <= 1_000_000

    def last(self, before: int) -> DataFrame | None:
        """Rows of the newest batch before `before`, which is one of the newest two."""
        ids = [g for level, g in self.levels.runs() if not level and g < before]
        return self.spark.read.parquet(self.levels.path((0, max(ids)))) if ids else None

    def compact(self, before: int) -> None:
        """Merge the batches before `before` that make whole runs, with partitions as large as the session advises."""
        self.levels.settle(before, self._combine)
