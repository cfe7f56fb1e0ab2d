"""Durable tables (the sinks) on plain Parquet.

A table is a folder. Its rows are in ``data-<n>``, split by the partition column ``_p`` and found by partition discovery;
``runs/<n>.json``, written last, marks a finished run: schema, layout, data folder and the last batch of each stream. A second
process continues from the last marker. ``_p`` is a hash bucket of the key columns (rows with a NULL key are spread by
their other columns, as they match nothing) or, with ``month_of``, the month of a date, with the months of all keys in a
table of their own, ``months``. With ``open_until`` only rows where that column is NULL are in buckets; the others
(closed versions) are in one partition for each run that closed them and stay as they are.

A frame from ``merge_upsert`` or ``scd2_apply`` carries its update rows; writing it to the table it came from overwrites the
partitions that these touch (dynamic partition overwrite). Appends add files; a partition with more than ``SMALL_FILES`` of
them is written anew. Other frames go to a new data folder. A merge that dies while Spark moves its files is
repeated with its batch: rows come out the same by their keys; only new rows with a NULL key may come twice.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, early_cleanup, held, scratch_dir, stored

PART = "_p"
SMALL_FILES, SMALL_BYTES = 16, 32 << 20
CODEC = "zstd"  # of the tables and the staged batches
TABLE_ATTR = "_tierforge_table"  # (store, name) of a frame read from a store
MERGE_ATTR = "_tierforge_merge"  # (target, updates, keys, match or None) of a merge's result


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int | None = None):
        self.spark, self.root = spark, (root or scratch_dir(spark, "tables")).rstrip("/")
        self.buckets = buckets or int(spark.conf.get("tierforge.buckets", None) or spark.conf.get("spark.sql.shuffle.partitions"))
        self.rows_written: dict[str, int] = {}  # rows that each table's last write, append or merge put in

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def state(self, name: str) -> dict | None:
        """The marker of the last run, ``None`` for a table that was never written."""
        fs, runs = self._path(name, "runs")
        numbers = [int(s.getPath().getName()[:-5]) for s in fs.listStatus(runs) if s.getPath().getName().endswith(".json")] if fs.exists(runs) else []
        if not numbers:
            return None
        source = fs.open(self._path(name, "runs", f"{max(numbers)}.json")[1])
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def _commit(self, name: str, old: dict | None, folder: str, layout: dict, schema: T.StructType, batch: str | None) -> None:
        streams = dict(old["streams"]) if old else {}
        if batch is not None:
            streams.update([self._stream(batch)])
        columns = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        run = {"run": old["run"] + 1 if old else 1, "folder": folder, "layout": layout, "streams": streams, "schema": json.loads(columns.json())}
        fs, draft = self._path(name, "runs", f"{run['run']}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(run).encode()))
        out.close()
        if not fs.rename(draft, self._path(name, "runs", f"{run['run']}.json")[1]):
            raise RuntimeError(f"{name}: run {run['run']} was finished by another writer")
        if old:
            fs.delete(self._path(name, "runs", f"{old['run']}.json")[1], False)
        if old and old["folder"] != folder:
            fs.delete(self._path(name, old["folder"])[1], True)

    @staticmethod
    def _stream(batch: str) -> tuple[str, int]:
        stream, _, number = batch.rpartition("#")
        return stream, int(number)

    def has(self, name: str, batch: str | None) -> bool:
        """Whether the table holds ``batch``, named ``<stream>#<number>`` with growing numbers."""
        old = self.state(name)
        return bool(old and batch is not None and old["streams"].get(self._stream(batch)[0], -1) >= self._stream(batch)[1])

    def exists(self, name: str) -> bool:
        return self.state(name) is not None

    def _rows(self, name: str, state: dict, only: set[str] | None = None) -> DataFrame:
        """The rows with their partition, of the partitions ``only``."""
        schema = T.StructType.fromJson(state["schema"]).add(PART, T.StringType())
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{state['folder']}")
        return rows if only is None else rows.filter(F.col(PART).isin(sorted(only)))

    def read(self, name: str, still_open: bool = False) -> DataFrame | None:
        """The table (of a history, if asked, the partitions of its open versions); ``None`` when it was never written."""
        state = self.state(name)
        if state is None:
            return None
        rows = self._rows(name, state)
        df = (rows.filter(F.col(PART).startswith("open-")) if still_open and state["layout"]["open_until"] else rows).drop(PART)
        setattr(df, TABLE_ATTR, (self, name))
        return df

    def view(self, name: str) -> str:
        """View sink: register the table as a temp view."""
        view = re.sub(r"\W", "_", f"{self.root.rsplit('/', 1)[-1]}_{name}")
        self.read(name).createOrReplaceTempView(view)
        return view

    def _part(self, df: DataFrame, layout: dict, run: int) -> Column:
        if layout["month_of"]:
            return F.coalesce(F.date_format(layout["month_of"], "yyyy-MM"), F.lit("none"))
        if not layout["keys"]:
            return F.lit("0")
        keyed = reduce(Column.__and__, [F.col(k).isNotNull() for k in layout["keys"]])
        rest = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType) and f.name != PART]
        bucket = F.pmod(F.when(keyed, F.xxhash64(*layout["keys"])).otherwise(F.xxhash64(*rest)), F.lit(layout["buckets"])).cast("string")
        if not layout["open_until"]:
            return bucket
        return F.when(F.col(layout["open_until"]).isNull(), F.concat(F.lit("open-"), bucket)).otherwise(f"closed-{run}")

    def _save(self, df: DataFrame, folder: str, layout: dict, run: int, mode: str = "overwrite", kept: DataFrame | None = None) -> int:
        """Write rows by partition, replacing those that they are in (or beside them with ``mode`` append); the number of rows.
        ``kept``, rows with their partition, are in one task a partition already and go with them."""
        seen, out = Observation(), df.withColumn(PART, self._part(df, layout, run))
        if layout["keys"] or layout["month_of"]:
            out = out.hint("rebalance", F.col(PART))  # one task a partition, large ones split by size
        if kept is not None:
            out = out.unionByName(kept)
        out = out.observe(seen, F.count(F.lit(1)).alias("rows")).sortWithinPartitions(PART, *([layout["month_of"]] if layout["month_of"] else layout["keys"]))
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(folder, compression=CODEC)
        return seen.get["rows"]

    def write(self, name: str, df: DataFrame, keys: list[str] | None = None, month_of: str | None = None, open_until: str | None = None,
              batch: str | None = None) -> DataFrame:
        """Write ``df`` as the table's new state. ``keys``, ``month_of`` and ``open_until`` set the layout of a first write (later ones
        keep it). The result of a merge into this table overwrites the touched partitions only; its staged batch is deleted
        then, so use the returned frame from here on. A ``batch`` that the table already holds is skipped."""
        if self.has(name, batch):
            self.rows_written[name] = 0
            return self.read(name)
        old = self.state(name)
        layout = old["layout"] if old else {"keys": keys or [], "month_of": month_of, "open_until": open_until, "buckets": self.buckets}
        merge, run = getattr(df, MERGE_ATTR, None), old["run"] + 1 if old else 1
        mine = merge and getattr(merge[0], TABLE_ATTR, None)
        if old and mine and mine[0].root == self.root and mine[1] == name and df.columns == [f["name"] for f in old["schema"]["fields"]]:
            folder = old["folder"]
            self.rows_written[name] = self._merge(name, old, *merge[1:])
        else:
            folder = f"data-{run}"
            self.rows_written[name] = self._save(df, f"{self.root}/{name}/{folder}", layout, run)
            if layout["month_of"]:
                held = self._rows(name, {"schema": json.loads(df.schema.json()), "folder": folder}).select(*layout["keys"], F.col(PART).alias("month"))
                self.write(f"{name}/months", held.dropna(subset=layout["keys"]), keys=layout["keys"])
        self._commit(name, old, folder, layout, df.schema, batch)
        if old and folder == old["folder"] and "stored_at" in vars(merge[1]):
            discard(merge[1])
        return self.read(name)

    def _merge(self, name: str, old: dict, updates: DataFrame, keys: list[str], match: list[str] | None) -> int:
        """Overwrite the partitions that the update rows touch. ``match`` finds the rows to replace; the same ``keys`` mean the same bucket.

        Stored rows and the keys that replace some meet by partition, so that the rows that stay are written from where they
        meet; only the batch is shuffled for its write."""
        layout, run, on = old["layout"], old["run"] + 1, match or keys
        batch = updates.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromJson(old["schema"]).fields])
        parts = lambda df, how: {r[0] for r in df.select(self._part(df, how, run)).distinct().collect()}
        filled = parts(batch, layout)
        touched, moved = set(filled), None
        gone = batch.select(*on, self._part(batch, layout, run).alias(PART))  # keys, where rows of them may be
        if layout["open_until"]:  # closed versions are added, and replace open ones
            gone = batch.select(*on, F.concat(F.lit("open-"), self._part(batch, {**layout, "open_until": None}, run)).alias(PART))
            touched = {"open-" + p for p in parts(batch, {**layout, "open_until": None})}
        if layout["month_of"]:
            moved = self._moved(f"{name}/months", batch.withColumn("month", self._part(batch, layout, run)), keys)
            gone = (moved if on == keys else moved.join(batch.select(*{*keys, *on}), keys)).select(*on, F.col("month").alias(PART))
            touched |= {r[0] for r in moved.select("month").distinct().collect()}
        # no anti join: the optimizer would move it below the shuffles by partition
        rows, gone = (df.hint("rebalance", F.col(PART)) for df in (self._rows(name, old, touched), gone.withColumn("_gone", F.lit(True))))
        kept = rows.join(gone, [PART, *on], "left").filter(F.col("_gone").isNull()).select(*batch.columns, PART)
        left = touched - filled  # partitions that may have lost their last row
        with early_cleanup(self.spark), held(self.spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            left -= {r[0] for r in kept.filter(F.col(PART).isin(sorted(left))).select(PART).distinct().collect()} if left else set()
            self._save(batch, f"{self.root}/{name}/{old['folder']}", layout, run, kept=kept)
        if moved is not None:
            discard(moved)
        for p in left:
            fs, path = self._path(name, old["folder"], f"{PART}={p}")
            fs.delete(path, True)
        return batch.count()

    def _moved(self, name: str, batch: DataFrame, keys: list[str]) -> DataFrame:
        """The keys of ``batch`` that are held so far and their months, looked up in their buckets; the lookup table then holds the new ones."""
        state = self.state(name)
        now = stored(batch.select(*keys, "month").dropna(subset=keys), "months", CODEC)
        buckets = {r[0] for r in now.select(self._part(now, state["layout"], 0)).distinct().collect()}
        was = stored(self._rows(name, state, buckets).drop(PART).join(now.select(*keys), keys, "left_semi"), "months", CODEC)
        changed = stored(now.join(was, [*keys, "month"], "left_anti"), "months", CODEC)
        if not changed.isEmpty():
            self._merge(name, state, changed, keys, None)
        for df in (now, changed):
            discard(df)
        return was

    def append(self, name: str, df: DataFrame, keys: list[str] | None = None, batch: str | None = None) -> DataFrame:
        """Append sink: new files beside the current ones (the first write creates the table); partitions of many small files are joined."""
        old = self.state(name)
        if old is None:
            return self.write(name, df, keys=keys, batch=batch)
        self.rows_written[name] = 0
        if not self.has(name, batch):
            schema, folder = T.StructType.fromJson(old["schema"]), f"{self.root}/{name}/{old['folder']}"
            self.rows_written[name] = self._save(df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), folder, old["layout"], old["run"] + 1, "append")
            fs, files = self._path(name, old["folder"], f"{PART}=*", "*.parquet")
            small = Counter(s.getPath().getParent().getName()[len(PART) + 1:] for s in fs.globStatus(files) if s.getLen() < SMALL_BYTES)
            many = {p for p, n in small.items() if n > SMALL_FILES}
            if many:
                self._save(self._rows(name, old, many).drop(PART), folder, old["layout"], old["run"] + 1)
            self._commit(name, old, old["folder"], old["layout"], schema, batch)
        return self.read(name)
