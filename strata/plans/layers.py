"""Layer IO (K1-K4): paths, idempotent overwrite sinks, and layer copy between formats.

Row counts of writes come from ``DataFrame.observe`` (collected by the write itself), not from a second scan.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import read_layer
from strata.spec import ENTITY, GOLD_TABLES


@dataclass(frozen=True)
class LayerPaths:
    """``<root>/<layer>/<entity>[/<gold table>]``"""

    root: str
    entity: str = ENTITY

    def _join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._join("bronze", self.entity)

    @property
    def silver(self) -> str:
        return self._join("silver", self.entity)

    def gold(self, table: str) -> str:
        return self._join("gold", self.entity, table)

    def registry(self, gold_tables=GOLD_TABLES) -> list[tuple[str, str, str]]:
        """(table name, layer, location) for every layer table; bronze/silver names carry the layer prefix."""
        entries = [(f"bronze_{self.entity}", "bronze", self.bronze), (f"silver_{self.entity}", "silver", self.silver)]
        entries += [(t, "gold", self.gold(t)) for t in gold_tables]
        return entries


#: columns that hold when a run took place, not what it found
RUN_COLUMNS = ("ingested_at_utc", "silver_transformed_at_utc", "gold_created_at_utc")


def fingerprint(columns: list[str], without=RUN_COLUMNS) -> dict:
    """L3, K4: aggregates that two tables with the same rows share, in any order and any number of files: the rows
    counted, and two sums of 64-bit hashes of them, exact, so that repeated rows count too. They add up over tasks,
    so a write can observe them. Runs at different times differ in the ``without`` columns only."""
    row = F.xxhash64(*[F.col(c) for c in columns if c not in without])
    total = lambda value: F.sum(value.cast("decimal(38,0)")).cast("string")
    return {"rows": F.count(F.lit(1)), "first": total(row), "second": total(F.xxhash64(F.lit("second"), row))}


def fingerprint_of(df: DataFrame) -> dict:
    """:func:`fingerprint` of a table that is read, as plain values."""
    return plain_fingerprint(df.agg(*[v.alias(k) for k, v in fingerprint(df.columns).items()]).first().asDict())


def plain_fingerprint(metrics: dict) -> dict:
    return {"rows": int(metrics["rows"]), "first": metrics["first"] or "0", "second": metrics["second"] or "0"}


def write_observed(df: DataFrame, path: str, metrics: dict, fmt: str = "parquet",
                   mode: str = "overwrite") -> dict:
    """Write ``df`` and collect named aggregate ``metrics`` in the same pass (``DataFrame.observe``).

    The metrics ride on the write's single scan; they are updated once per successful task, so task retries
    after a lost executor do not double count.
    """
    obs = Observation(f"write_{uuid.uuid4().hex[:12]}")
    observed = df.observe(obs, *[expr.alias(name) for name, expr in metrics.items()])
    writer = observed.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    return dict(obs.get)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                fingerprints: dict | None = None, table: str = "") -> int:
    """Full overwrite of a layer (idempotent); returns the written row count. With ``fingerprints`` the write also
    observes that of the table and notes it under ``table``."""
    metrics = fingerprint(df.columns) if fingerprints is not None else {"rows": F.count(F.lit(1))}
    seen = write_observed(df, path, metrics, fmt, mode)
    if fingerprints is not None:
        fingerprints[table] = plain_fingerprint(seen)
    return int(seen["rows"])


def copy_layers(spark: SparkSession, src: LayerPaths, dst: LayerPaths, src_fmt: str = "parquet",
                dst_fmt: str = "parquet", gold_tables=GOLD_TABLES) -> list[dict]:
    """K4: copy bronze, silver and every gold table to another root / format; one read and one write each. Each entry
    has the fingerprint of the rows that were written."""
    out, seen = [], {}
    src_entries = {name: loc for name, _, loc in src.registry(gold_tables)}
    for name, layer, location in dst.registry(gold_tables):
        rows = write_layer(read_layer(spark, src_entries[name], src_fmt), location, dst_fmt, "overwrite", seen, name)
        out.append({"table": name, "layer": layer, "location": location, "rows": rows, "fingerprint": seen[name]})
    return out
