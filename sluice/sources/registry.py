"""Schema registry: one JSON document per schema, loaded as a small table."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_TYPE = (
    "schema_id string, version string, "
    "fields array<struct<name:string,type:string,required:boolean>>"
)
BUNDLED = Path(__file__).resolve().parent.parent / "schemas"


@dataclass(frozen=True)
class Registry:
    """Registered schemas, one row each, with the number of rows and their size as text."""

    table: DataFrame
    rows: int
    size: int = 0

    def fields(self) -> DataFrame:
        """One row per declared field, with its position."""
        return self.table.select(
            "schema_id", "version", F.posexplode("fields").alias("pos", "f")
        ).select("schema_id", "version", "pos", "f.name", "f.type", "f.required")


def load_registry(spark: SparkSession, path: str | None = None) -> Registry:
    """Load every ``*.json`` under ``path``; of equal schema ids the last file wins.

    Without a path the schemas bundled with the package are used.
    """
    if path is None:
        docs = [json.loads(f.read_text()) for f in sorted(BUNDLED.glob("*.json"))]
        by_id = {d["schema_id"]: d for d in docs}
        table = spark.createDataFrame(
            [(d["schema_id"], d["version"],
              [(f["name"], f["type"], f["required"]) for f in d["fields"]])
             for d in by_id.values()],
            REGISTRY_TYPE,
        )
        return Registry(table, len(by_id), len(json.dumps(list(by_id.values()))))
    docs = (
        spark.read.schema(REGISTRY_TYPE).option("multiLine", True)
        .option("pathGlobFilter", "*.json").json(path)
        .select("*", F.col("_metadata.file_name").alias("_file"))
        .where("schema_id IS NOT NULL")
    )
    table = docs.groupBy("schema_id").agg(
        F.max_by("version", "_file").alias("version"),
        F.max_by("fields", "_file").alias("fields"),
    )
    found = table.agg(F.count("*").alias("n"), F.sum(F.length(F.to_json(F.struct("*")))).alias("size")).first()
    return Registry(table, found["n"], found["size"] or 0)
