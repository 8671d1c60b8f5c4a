"""A keyed table of sorted runs with a manifest: the last row of a key counts.

Rows are dealt to buckets by a hash of the key. Each ``append`` writes a run of files, sorted by key within each bucket, and then a
new manifest that names it; ``compact`` merges all runs into one and switches to a manifest of that run alone. A manifest is one small
file with a number, put in place by a rename that fails if the number is taken, in which case the next one is tried from what
the winner wrote: so writers may run at once, readers see whole states only, and a crash between writing and switching loses
nothing but the run that was being written. Files that no manifest needs go with ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ranksieve.functions.names import quoted
from ranksieve.operators.ranking import last_wins

from .shared import exists, file_system, path_of


@dataclass
class Store:
    spark: SparkSession
    path: str
    key: list[str]
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*map(quoted, self.key)), F.lit(self.buckets)).cast("int")

    def _names(self, folder: str) -> list[str]:
        at = f"{self.path}/{folder}"
        return sorted(x.getPath().getName() for x in file_system(self.spark, at).listStatus(path_of(self.spark, at))) if exists(self.spark, at) else []

    def manifest(self) -> tuple[int, list[str], str | None]:
        """Its number, the runs in order, and their schema; 0 and none before anything was written."""
        numbers = [int(x.split(".")[0]) for x in self._names("manifest") if x.endswith(".json")]
        if not numbers:
            return 0, [], None
        said = json.loads(self.spark.read.text(f"{self.path}/manifest/{max(numbers):012d}.json", wholetext=True).first()[0])
        if said["key"] != self.key or said["buckets"] != self.buckets:
            raise ValueError(f"the store has key {said['key']} and {said['buckets']} buckets")
        return max(numbers), said["runs"], said["schema"]

    def _switch(self, change, schema: str) -> None:
        """Puts the next manifest in place, of ``change`` (runs); anew if another writer was first."""
        fs = file_system(self.spark, self.path)
        while True:
            number, runs, _ = self.manifest()
            text = json.dumps({"key": self.key, "buckets": self.buckets, "runs": change(runs), "schema": schema})
            new, at = f"{self.path}/manifest/new-{uuid.uuid4().hex}", f"{self.path}/manifest/{number + 1:012d}.json"
            out = fs.create(path_of(self.spark, new), False)
            out.write(bytearray(text.encode()))
            out.close()
            if not exists(self.spark, at) and fs.rename(path_of(self.spark, new), path_of(self.spark, at)):
                return
            fs.delete(path_of(self.spark, new), False)

    def _run(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        sorted_rows = rows.withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket").sortWithinPartitions("bucket", *map(quoted, self.key))
        sorted_rows.write.partitionBy("bucket").parquet(f"{self.path}/runs/{name}")
        return name

    def append(self, rows: DataFrame) -> None:
        """Adds rows; of rows of one key here, any one counts. A run that fails leaves the table as it was."""
        name = self._run(rows.dropDuplicates(self.key))
        self._switch(lambda runs: [*runs, name], rows.schema.json())

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The last row of each key, of some buckets or of all; nothing before anything was written."""
        _, runs, schema = self.manifest()
        if schema is None:
            return None
        return self._merged(runs, schema, buckets)

    def _merged(self, runs: list[str], schema: str, buckets: list[int] | None = None) -> DataFrame:
        kind = StructType.fromJson(json.loads(schema))

        def one(name: str) -> DataFrame:
            out = self.spark.read.schema(StructType([*kind.fields, StructField("bucket", IntegerType())])).parquet(f"{self.path}/runs/{name}")
            return out if buckets is None else out.where(F.col("bucket").isin(buckets))

        if len(runs) == 1:  # a run has a key once
            return one(runs[0]).drop("bucket")
        every = None
        for number, name in enumerate(runs):
            part = one(name).withColumn("run", F.lit(number))
            every = part if every is None else every.union(part)
        whole = every.withColumn("whole", F.struct(*map(quoted, self.key)))
        return last_wins(whole, "whole", "run").drop("bucket", "run", "whole")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; reads the buckets these fall into, one run of each after ``compact``."""
        wanted = keys.select(*map(quoted, self.key)).distinct()
        numbers = [r[0] for r in wanted.select(self._bucket().alias("b")).distinct().collect()]  # at most ``buckets``
        found = self.read(numbers)
        if found is None:
            raise ValueError("the store is empty")
        return found.join(wanted, self.key, "left_semi")

    def compact(self) -> None:
        """Merges the runs into one; runs that others add meanwhile stay behind it."""
        _, runs, schema = self.manifest()
        if len(runs) > 1:
            name = self._run(self._merged(runs, schema))
            self._switch(lambda now: [name, *now[len(runs) :]] if now[: len(runs)] == runs else now, schema)

    def vacuum(self) -> int:
        """Deletes runs that the manifest does not name, and older manifests; for when no one reads or writes. How many runs went."""
        number, runs, _ = self.manifest()
        fs, gone = file_system(self.spark, self.path), [x for x in self._names("runs") if x not in runs]
        for name in gone:
            fs.delete(path_of(self.spark, f"{self.path}/runs/{name}"), True)
        for name in self._names("manifest"):
            if name != f"{number:012d}.json":
                fs.delete(path_of(self.spark, f"{self.path}/manifest/{name}"), False)
        return len(gone)
