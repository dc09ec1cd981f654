"""Parquet tables under one root, one folder per zone."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from churnflow.functions import fail_when, timestamp_literal
from churnflow.operators.merge import survivors
from churnflow.operators.quality import require_unique_key
from churnflow.schemas import Table
from churnflow.sources.scratch import remove, staged


def conform(df: DataFrame, table: Table, **defaults) -> DataFrame:
    """The table's columns in order and type. Unlisted ones come from ``defaults``; others are dropped.

    A row without a value in a required column fails the write, in the same pass.
    """
    given = set(df.columns)
    picked = []
    for f in table.schema.fields:
        if f.name in given:
            value = F.col(f.name)
        elif f.name in defaults:
            default = defaults[f.name]
            value = timestamp_literal(default) if isinstance(default, datetime) else F.lit(default)
        elif f.nullable:
            value = F.lit(None)
        else:
            raise ValueError(f"{table.name}.{f.name} is required and has no default")
        value = value.cast(f.dataType)
        if not f.nullable:
            value = fail_when(value.isNull(), F.lit(f"{table.name}.{f.name} is required"), value, f.dataType)
        picked.append(value.alias(f.name))
    return df.select(*picked)


def stored_schema(table: Table) -> StructType:
    """The table's columns plus the directory columns that exist only on disk."""
    return StructType(table.schema.fields + [StructField(c, kind) for c, (_, kind) in table.derived.items()])


class Lake:
    """Reads and writes the tables of ``schemas``.

    Types, including those of directory columns, are always the declared ones. A table takes one
    writer at a time. Every write that replaces rows is all or nothing: what is about to be put in place is
    first written aside in full, below the same root, and checked; a note beside it says so until the swap is over.
    A reader that finds the note is refused rather than shown part of a table, and the next
    writer, or ``recover``, finishes the swap from the rows set aside.

    With ``buckets``, tables that declare a ``bucket`` column are laid out by its hash whenever they are replaced as a
    whole, so that what is grouped or joined by it needs no shuffle. How a table is laid out is noted beside it; sessions
    read it by that note, whatever their own setting.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.zone}/{table.name}"

    def read(self, table: Table) -> DataFrame:
        """The stored rows with their directory columns. An absent table is an error."""
        if self._note(table) is not None:
            raise RuntimeError(f"{table.name} is being replaced, or that was cut short: wait, or call recover")
        if buckets := self.buckets_of(table):
            return self._bucketed(table, buckets)
        return self.spark.read.schema(stored_schema(table)).parquet(self.path(table))

    def buckets_of(self, table: Table) -> int | None:
        """How many buckets the stored table has, none if it is not laid out so."""
        return (self._json(self._layout_path(table)) or {}).get("buckets") if table.bucket else None

    def _bucketed(self, table: Table, buckets: int) -> DataFrame:
        """The stored files through the session's catalog, which is where Spark takes bucketing from."""
        name, (column, _) = self._name(table, buckets), table.bucket
        if not self.spark.catalog.tableExists(name):
            fields = stored_schema(table).fields
            if column not in [f.name for f in fields]:
                fields = [*table.schema.fields, StructField(column, LongType()), *fields[len(table.schema.fields):]]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            parts = f"PARTITIONED BY ({', '.join(table.partition_by)}) " if table.partition_by else ""
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet {parts}CLUSTERED BY ({column}) SORTED BY ({column}) INTO {buckets} BUCKETS "
                f"LOCATION '{self.path(table)}'")
            if parts:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def _name(self, table: Table, buckets: int) -> str:
        """In the session's catalog; another layout, perhaps by another session, is another table there."""
        return f"lake_{hashlib.md5(self.path(table).encode()).hexdigest()[:16]}_{buckets}"

    def read_or_empty(self, table: Table) -> DataFrame:
        """``read``, or no rows if nothing was written yet: only for tables that the jobs themselves create.

        Spark knows of the latter that there are none, so what a first write is joined to costs nothing.
        """
        try:
            return self.read(table)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], stored_schema(table)).limit(0)

    def append(self, df: DataFrame, table: Table, **defaults) -> None:
        """Add rows. Adding no rows changes nothing.

        A key that is already in the table, or comes twice, fails the write. Keys are looked for in the partitions
        that the new rows fall into, by one shuffle of keys.
        """
        rows = conform(df, table, **defaults)
        if not table.key:
            self._write(rows, table, "append")
            return
        with staged(rows, table.name) as new:
            self.recover(table)
            stored = self.read_or_empty(table)
            parts = [c for c in table.partition_by if c in table.columns]
            touched = new.select(*parts).distinct().collect() if parts else []  # a row per partition
            for c in parts:
                stored = stored.filter(F.col(c).isin([r[c] for r in touched]))
            require_unique_key(new.select(*table.key).unionByName(stored.select(*table.key)), table.key)
            self._write(new, table, "append")

    def replace(self, df: DataFrame, table: Table, *, skip_empty: bool = False, **defaults) -> None:
        """Replace the whole table; with ``skip_empty``, no input rows leave the old ones in place."""
        self._swap(conform(df, table, **defaults), table, whole=True, skip_empty=skip_empty)

    def replace_partitions(self, df: DataFrame, table: Table, *, rebalance: bool = True, **defaults) -> None:
        """Replace only the partitions that occur in ``df``; all others stay as they are. A repeated key fails the write.

        ``rebalance=False`` saves a shuffle for rows known to belong to a single partition.
        """
        if not table.partition_by:
            raise ValueError(f"{table.name} has no partitions")
        self._swap(conform(df, table, **defaults), table, rebalance=rebalance, check_key=bool(table.key))

    def upsert(self, source: DataFrame, table: Table, touched: Column, *, keys_unique: bool = False) -> None:
        """Add the rows of ``source``, each in place of the stored row with its key, if there is one.

        ``touched`` selects the partitions the source falls into; no others are read or rewritten.
        ``source`` is read several times and must already be outside the table. A repeated key is
        an error; ``keys_unique`` skips looking for one.
        """
        if not keys_unique:
            require_unique_key(source, table.key)
        self.recover(table)
        stored = self.read_or_empty(table).filter(touched)
        self.publish(survivors(stored, source, table.key), source, table)

    def publish(self, kept: DataFrame, source: DataFrame, table: Table, *, touched: Column | None = None, unless_same: Sequence[str] = ()) -> None:
        """Replace the partitions of ``source`` and ``kept`` by the rows of both, all or nothing.

        ``kept`` comes from the files about to be replaced. In an upsert these are the stored rows without
        a match; matched ones are not copied at all. Partitions that ``touched`` selects and that have no rows any more go.
        With ``unless_same``, a partition in which no row differs in these columns stays as it is, and is not written.
        """
        rows = conform(source, table).unionByName(conform(kept, table))
        if unless_same:
            rows = self._changed(rows, table, unless_same)
            if rows is None:
                return
        self._swap(rows, table, touched=touched)

    def _changed(self, rows: DataFrame, table: Table, columns: Sequence[str]) -> DataFrame | None:
        """The rows of partitions whose content differs from what is stored, by digests that know no order."""
        part, = table.partition_by
        sql = table.derived[part][0] if part in table.derived else part
        value = F.xxhash64(*columns)

        def digests(df: DataFrame) -> DataFrame:
            return df.groupBy(F.expr(sql).alias(part)).agg(
                F.count("*").alias("n"), F.sum(value.cast("decimal(20,0)")).alias("total"), F.bit_xor(F.xxhash64(F.lit(1), *columns)).alias("mixed"))

        new = digests(rows)
        values = [r[part] for r in new.select(part).distinct().collect()] if part not in table.derived else None
        stored = self.read_or_empty(table)
        if values is not None:
            stored = stored.filter(F.col(part).isin(values))
        changed = [r[part] for r in new.exceptAll(digests(stored.select(*table.columns))).collect()]  # a row per partition
        if not changed:
            return None
        known = [v for v in changed if v is not None]
        place = F.expr(sql)
        return rows.filter(place.isin(known) | place.isNull() if len(known) < len(changed) else place.isin(known))

    def _swap(
        self, rows: DataFrame, table: Table, *, whole: bool = False, skip_empty: bool = False, rebalance: bool = True,
        check_key: bool = False, touched: Column | None = None,
    ) -> None:
        """Set ``rows`` aside, check them, note it, and finish by ``recover``."""
        aside = f"{self.root}/_aside/{table.name}-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(aside)
            new = self.spark.read.schema(table.schema).parquet(aside)
            if check_key:
                require_unique_key(new, table.key)
            if skip_empty and new.isEmpty():
                remove(self.spark, aside)
                return
            gone = self._emptied(new, table, touched) if touched is not None else []
        except BaseException:
            remove(self.spark, aside)
            raise
        self.recover(table)
        self._set_note(table, {"aside": aside.removeprefix(self.root), "whole": whole, "rebalance": rebalance, "gone": gone})
        self.recover(table)

    def _emptied(self, new: DataFrame, table: Table, touched: Column) -> list[str]:
        """Folders of the touched partitions without a new row."""
        part, = table.partition_by
        before = self.read_or_empty(table).filter(touched).select(part).distinct()
        after = new.select(F.expr(table.derived[part][0] if part in table.derived else part).alias(part)).distinct()
        gone = [r[part] for r in before.exceptAll(after).collect()]  # a row per partition
        return [f"{part}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for v in gone]

    def recover(self, table: Table) -> None:
        """Finish a replacement that was cut short, if there is one. Doing it again changes nothing.

        Without the rows set aside it stops, and nothing is touched.
        """
        note = self._note(table)
        if note is None:
            return
        aside = self.root + note["aside"]
        files, path = self._file(aside)
        if not files.exists(path):
            raise RuntimeError(f"the rows set aside for {table.name} are gone: {aside}")
        self._write(
            self.spark.read.schema(table.schema).parquet(aside), table, "overwrite", "static" if note["whole"] else "dynamic", note["rebalance"])
        for folder in note["gone"]:
            remove(self.spark, f"{self.path(table)}/{folder}")
        self._set_note(table, None)
        remove(self.spark, aside)

    def _note(self, table: Table) -> dict | None:
        """What is known of an unfinished replacement."""
        return self._json(self._note_path(table))

    def _set_note(self, table: Table, note: dict | None) -> None:
        self._set_json(self._note_path(table), note)

    def _json(self, path: str) -> dict | None:
        files, place = self._file(path)
        if not files.exists(place):
            return None
        with_text = self.spark._jvm.org.apache.commons.io.IOUtils
        stream = files.open(place)
        try:
            return json.loads(with_text.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _set_json(self, path: str, value: dict | None) -> None:
        files, place = self._file(path)
        if value is None:
            files.delete(place, False)
            return
        # Renamed into place, so a note is there in full or not at all.
        draft = place.suffix(".draft")
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(value), "utf-8"))
        stream.close()
        files.delete(place, False)
        files.rename(draft, place)

    def _note_path(self, table: Table) -> str:
        return f"{self.root}/_aside/{table.zone}.{table.name}.note"

    def _layout_path(self, table: Table) -> str:
        return f"{self.root}/_layout/{table.zone}.{table.name}.json"

    def _file(self, path: str):
        made = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return made.getFileSystem(self.spark._jsc.hadoopConfiguration()), made

    def _write(self, rows: DataFrame, table: Table, mode: str, overwrite: str = "static", rebalance: bool = True) -> None:
        rows = rows.select("*", *(F.expr(sql).alias(c) for c, (sql, _) in table.derived.items()))
        if table.bucket:
            if mode == "overwrite" and overwrite == "static":
                self._replace_layout(rows, table)
                return
            if self.buckets_of(table):
                raise ValueError(f"{table.name} is bucketed and can only be replaced as a whole")
        if table.partition_by and rebalance:
            # Few files per partition, while a large one is still split over many tasks.
            rows = rows.hint("rebalance", *table.partition_by)
        writer = rows.write.mode(mode).option("partitionOverwriteMode", overwrite)
        writer.partitionBy(*table.partition_by).parquet(self.path(table))

    def _replace_layout(self, rows: DataFrame, table: Table) -> None:
        """The whole table, in buckets or not, as this lake is set; the note of the layout follows the files, and recovery repeats both."""
        column, sql = table.bucket
        if not self.buckets:
            self._set_json(self._layout_path(table), None)
            rows = rows.hint("rebalance", *table.partition_by) if table.partition_by else rows
            rows.write.mode("overwrite").partitionBy(*table.partition_by).parquet(self.path(table))
            return
        kept = rows if column in rows.columns else rows.withColumn(column, F.expr(sql))
        kept = kept.select(*(c for c in kept.columns if c not in table.partition_by), *table.partition_by)
        name = self._name(table, self.buckets)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        # One file a bucket (and partition): the rows of a bucket are in one task already.
        writer = kept.repartition(self.buckets, column).write.mode("overwrite").format("parquet").option("path", self.path(table))
        writer = writer.partitionBy(*table.partition_by) if table.partition_by else writer
        remove(self.spark, self.path(table))
        writer.bucketBy(self.buckets, column).sortBy(column).saveAsTable(name)
        self._set_json(self._layout_path(table), {"buckets": self.buckets})
