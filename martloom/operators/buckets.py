"""Tables stored in parts by a hash of their key, of which only those that change are written again.

<path>/version=<id>/bucket=<n>   the rows of some parts
<path>/_manifest                 which folder holds each part, and up to which commit the table is complete;
                                 replaced in one step

A reader that has planned from the old manifest goes on reading the old folders. Folders that no manifest names any more
are deleted two replacements later.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from martloom.operators.files import delete_folder, folders_in, read_text, replace_text

BUCKET = "bucket"


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType | None = None):
        self.spark, self.path, self.key, self._schema = spark, path, key, schema

    def _manifest(self) -> dict:
        text = read_text(self.spark, f"{self.path}/_manifest")
        return json.loads(text) if text else {"covers": -1, "buckets": None, "folders": {}, "old": []}

    def covers(self) -> int:
        """The last commit in the table, -1 if it has never been written."""
        return self._manifest()["covers"]

    def bucket_of(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, buckets: int) -> list[int]:
        """The parts in which the keys of some rows lie; `buckets` counts for a table not yet written."""
        n = self._manifest()["buckets"] or buckets
        return sorted(row[0] for row in rows.select(self.bucket_of(n)).distinct().collect())  # at most n

    def read(self, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of the table, or of some of its parts."""
        manifest = self._manifest()
        wanted = None if only is None else set(only)
        held = [f for n, f in manifest["folders"].items() if wanted is None or int(n) in wanted]
        schema = self._schema or (StructType.fromJson(manifest["schema"]) if "schema" in manifest else None)
        if schema is None:
            raise FileNotFoundError(f"nothing has been written to {self.path}")
        if not held:
            return self.spark.createDataFrame([], schema)
        # a part lies in the folder of the version that wrote it
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in held])

    def replace(self, rows: DataFrame, touched: Iterable[int], covers: int, buckets: int) -> None:
        """Put rows in place of all rows of the parts `touched`; other parts stay as they are."""
        manifest, version = self._manifest(), f"version={uuid.uuid4().hex}"
        n, touched = manifest["buckets"] or buckets, list(touched)
        folders = {k: f for k, f in manifest["folders"].items() if int(k) not in set(touched)}
        if touched:
            placed = rows.withColumn(BUCKET, self.bucket_of(n)).hint("rebalance", BUCKET)
            placed.write.partitionBy(BUCKET).parquet(f"{self.path}/{version}")
            for name in folders_in(self.spark, f"{self.path}/{version}"):
                if name.startswith(f"{BUCKET}="):
                    folders[name.split("=")[1]] = f"{version}/{name}"
        dropped = sorted(set(manifest["folders"].values()) - set(folders.values()))
        schema = StructType([StructField(f.name, f.dataType) for f in rows.schema])
        new = {"covers": covers, "buckets": n, "folders": folders, "old": dropped, "schema": json.loads(schema.json())}
        replace_text(self.spark, f"{self.path}/_manifest", json.dumps(new))
        for folder in manifest["old"]:
            delete_folder(self.spark, f"{self.path}/{folder}")

    def replace_keys(self, rows: DataFrame, keys: DataFrame, covers: int, buckets: int) -> int:
        """Put rows in place of those with the given keys (a column of the key's name); how many parts were written."""
        touched = self.buckets_of(keys, buckets)
        kept = self.read(touched).join(keys.select(self.key).distinct(), self.key, "left_anti") if self.covers() >= 0 else None
        self.replace(rows if kept is None else kept.select(*rows.columns).unionByName(rows), touched, covers, buckets)
        return len(touched)
