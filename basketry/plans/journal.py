"""Finished levels of a run, kept in a shared folder, so that a run that failed goes on from the last one.

The folder holds the encoded pairs, each finished level and the occurrences of the
last one, and a note per finished level.  A note is a text file that Spark's
committer makes visible as a whole, after all that it names.  The notes carry a key
of the run (its parameters and input files): a folder of another run is an error.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from basketry.plans.physical import Tuning, bucketed, bucketed_again


class Journal:
    def __init__(self, spark: SparkSession, folder: str, key: dict, tuning: Tuning) -> None:
        self.spark, self.folder, self.tuning = spark, folder.rstrip("/"), tuning
        self.key = json.loads(json.dumps(key))
        notes = []
        if self._exists("notes"):
            found = spark.read.option("recursiveFileLookup", "true").schema("value string").text(f"{self.folder}/notes")
            notes = [json.loads(r["value"]) for r in found.collect()]  # a note per level
        self.state = max(notes, key=lambda n: n["level"], default=None)
        if self.state is not None and self.state["key"] != self.key:
            raise ValueError(f"{folder} holds the levels of another run: {self.state['key']}")
        self._tables: list[str] = []

    def _path(self, name: str):
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(sc._jsc.hadoopConfiguration()), path

    def _exists(self, name: str) -> bool:
        fs, path = self._path(name)
        return fs.exists(path)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write a frame; what an interrupted run left under the name is replaced."""
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.read(name, df)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read if like is None else self.spark.read.schema(like.schema)
        return reader.parquet(f"{self.folder}/{name}")

    def keep_buckets(self, name: str, df: DataFrame, parts: int, key: str) -> DataFrame:
        return self._own(bucketed(df, parts, key, self.tuning, f"{self.folder}/{name}"))

    def read_buckets(self, name: str, schema: str, parts: int, key: str) -> DataFrame:
        return self._own(bucketed_again(self.spark, f"{self.folder}/{name}", schema, parts, key, self.tuning))

    def _own(self, df: DataFrame) -> DataFrame:
        self._tables.append(df._basketry_table[0])
        return df

    def note(self, level: int, **facts) -> None:
        """The levels up to ``level`` are finished."""
        self.state = {"level": level, "key": self.key, **facts}
        self.spark.createDataFrame([(json.dumps(self.state),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.folder}/notes/level={level}")

    def drop(self, name: str) -> None:
        fs, path = self._path(name)
        fs.delete(path, True)

    def let_go(self) -> None:
        """Drop the session's table names; the files stay for the next run."""
        for t in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")  # external: the files stay
        self._tables = []

    def finish(self) -> None:
        """The run's result is written: its folder goes."""
        self.let_go()
        fs, path = self._path("")
        fs.delete(path, True)
