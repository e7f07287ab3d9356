"""Writers of the published tables.

Row order only exists at the sink.  ``repartitionByRange`` + ``sortWithinPartitions`` gives globally ordered
files without pulling the table through one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import master as M


class GateError(RuntimeError):
    """A gate found violations; nothing was written."""


def require_empty(violations: DataFrame, what: str, samples: int = 20) -> None:
    """Fail closed: raise with a few samples when a gate is not empty."""
    found = violations.limit(samples).collect()
    if found:
        raise GateError(f"{what}: {[row.asDict() for row in found]}")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors see: below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_master(master: DataFrame, path: str) -> None:
    """Master in key order with fixed columns; arrays stay arrays in Parquet."""
    ordered(M.clean_rows(master), "match_key").write.mode("overwrite").parquet(path)


def write_master_csv(master: DataFrame, path: str) -> None:
    ordered(M.flat_master(master), "match_key").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_list(master: DataFrame, path: str) -> None:
    M.list_projection(master).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_screening(master: DataFrame, path: str) -> None:
    """Screening table as gzip CSV; stops when an active row has no name or key."""
    rows = M.screening_projection(master)
    require_empty(rows.filter("violation IS NOT NULL"), "screening rows without name or key")
    rows.drop("violation").write.mode("overwrite").option("header", True).option("escape", '"').option("compression", "gzip").csv(path)


def fold_cells(rows: DataFrame, keys: list[str], order: list[str], cells: list[str], separator: str) -> DataFrame:
    """Long rows to one row per key with text cells: the non-empty values of each cell, in ``order``, joined by ``separator``.

    Rows are sorted by key and order (a sort that spills) and read as a stream, so a task holds the open cells of one key and one
    Arrow batch, never an aggregate buffer of all its keys.  NULL keys are a key of their own; NULL values count as empty.
    """
    mark = F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]))
    flat = rows.select(*keys, *[c for c in order if c not in keys + cells], *[F.coalesce(c, F.lit("")).alias(c) for c in cells], mark.alias("_mark"))
    schema = T.StructType([flat.schema[k] for k in keys] + [T.StructField(c, T.StringType()) for c in cells])

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_mark, open_key, parts = None, None, {}

        def closed() -> list:
            return [*open_key, *[separator.join(parts[c]) for c in cells]]

        for batch in batches:
            done = []
            starts = (batch["_mark"] != batch["_mark"].shift()).to_numpy().nonzero()[0].tolist()
            for lo, hi in zip(starts, [*starts[1:], len(batch)]):
                if batch["_mark"].iat[lo] != open_mark:
                    if open_key is not None:
                        done.append(closed())
                    open_mark, open_key, parts = batch["_mark"].iat[lo], [batch[k].iat[lo] for k in keys], {c: [] for c in cells}
                for c in cells:
                    parts[c].extend(v for v in batch[c].iloc[lo:hi] if v)
            if done:
                yield pd.DataFrame(done, columns=keys + cells)
        if open_key is not None:
            yield pd.DataFrame([closed()], columns=keys + cells)

    flat = flat.repartition("_mark").sortWithinPartitions("_mark", *order)
    return flat.mapInPandas(stream, schema)


def write_cells(rows: DataFrame, keys: list[str], order: list[str], cells: list[str], separator: str, path: str) -> None:
    """``fold_cells`` as gzip CSV, one line per key."""
    fold_cells(rows, keys, order, cells, separator).write.mode("overwrite").option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
