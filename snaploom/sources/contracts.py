"""Header and row contracts of CSV files: nothing is inferred, and a file that breaks its contract isn't read."""

from __future__ import annotations

import csv
import json
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    required: tuple[str, ...]
    ordered: tuple[str, ...] | None = None
    ignored: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)
    unique: bool = True
    extra_allowed: bool = True

    @classmethod
    def load(cls, path: str | Path) -> Contract:
        """From a JSON document with ``required_columns`` and, if wanted, the other keys."""
        told = json.loads(Path(path).read_text(encoding="utf-8"))
        required = tuple(told.get("required_columns") or ())
        if not required:
            raise ContractError(f"{path} requires no columns")
        ordered = told.get("ordered_columns")
        return cls(required, tuple(ordered) if ordered is not None else None, tuple(told.get("ignored_columns", ())), dict(told.get("column_aliases", {})), bool(told.get("unique_columns", True)), bool(told.get("allow_additional_columns", True)))

    def names(self, header: Sequence[str]) -> list[str | None]:
        """The column name of each field of a header, None for ignored ones; raises where the header breaks the contract."""
        if not header:
            raise ContractError("there is no header")
        self._unique(header, "in the header")
        named = [None if h in self.ignored else self.aliases.get(h, h) for h in header]
        kept = [n for n in named if n is not None]
        self._unique(kept, "after aliases")
        if self.ordered is not None and tuple(kept) != self.ordered:
            raise ContractError(f"the header isn't the {len(self.ordered)} columns in their order")
        if lacking := sorted(set(self.required) - set(kept)):
            raise ContractError(f"missing columns: {', '.join(lacking)}")
        if not self.extra_allowed and (extra := sorted(set(kept) - set(self.ordered or self.required))):
            raise ContractError(f"unexpected columns: {', '.join(extra)}")
        return named

    def _unique(self, names: Iterable[str], where: str) -> None:
        if self.unique and (twice := sorted(n for n, k in Counter(names).items() if k > 1)):
            raise ContractError(f"repeated columns {where}: {', '.join(twice)}")


def header_of(path: str | Path) -> list[str]:
    with open(path, encoding="utf-8-sig", newline="") as f:
        return next(csv.reader(f), [])


def validated_csv(spark: SparkSession, path: str | Path, contract: Contract) -> DataFrame:
    """All columns as text, blanks as empty text, with ``source_index``: the record's number, the header being 1.

    The header is checked before any row is read. A record with too few or too
    many fields fails the job that reads it; ``strict_load`` separates such
    records instead. A file with line breaks inside quotes is read in one task,
    so the numbers are those of the file.
    """
    named = contract.names(header_of(path))
    fields = [f"c{i}" for i in range(len(named))]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, "broken"]])
    rows = spark.read.csv(str(path), schema=schema, header=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="broken", enforceSchema=True, encoding="UTF-8")
    # numbered in a step of its own: each mention of the counter would count by itself
    rows = rows.withColumn("number", F.monotonically_increasing_id() + 2)
    number = F.col("number")
    checked = F.when(F.col("broken").isNotNull(), F.raise_error(F.concat(F.lit("malformed record "), number.cast("string"))).cast("bigint")).otherwise(number)
    return rows.select(checked.alias("source_index"), *[F.coalesce(F.col(f), F.lit("")).alias(n) for f, n in zip(fields, named) if n is not None])
