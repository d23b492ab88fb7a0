"""Configurable projection of a raw source table into a staging relation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import CharType, StringType, VarcharType


@dataclass(frozen=True)
class SourceSpec:
    """How one raw table is staged. Column names are given in lower case.

    ``renames`` maps source to target names, ``transforms`` gives a SQL
    expression for a source column, ``exclude`` drops columns, and a non-empty
    ``include`` keeps only the listed ones. Exclusion wins over inclusion.
    """

    renames: Mapping[str, str] = field(default_factory=dict)
    transforms: Mapping[str, str] = field(default_factory=dict)
    exclude: Sequence[str] = ()
    include: Sequence[str] = ()
    add_metadata: bool = True

    def keeps(self, column: str) -> bool:
        return column not in self.exclude and (not self.include or column in self.include)


def _is_text(data_type) -> bool:
    return isinstance(data_type, (StringType, VarcharType, CharType))


def stage(raw: DataFrame, spec: SourceSpec, source: str, table: str) -> DataFrame:
    """One projection: lower-cased names, trimmed text, transforms, lineage columns.

    A lineage column is added only if the source itself has none of that name,
    even when the source's own column was excluded.
    """
    present = {f.name.lower() for f in raw.schema.fields}
    columns: list[Column] = []
    for f in raw.schema.fields:
        name = f.name.lower()
        if not spec.keeps(name):
            continue
        if name in spec.transforms:
            value = F.expr(spec.transforms[name])
        elif _is_text(f.dataType):
            value = F.trim(raw[f"`{f.name}`"])
        else:
            value = raw[f"`{f.name}`"]
        columns.append(value.alias(spec.renames.get(name, name)))
    if spec.add_metadata:
        lineage = {
            "source_system": F.lit(source.upper()),
            "source_table": F.lit(table),
            "loaded_at": F.current_timestamp(),
        }
        columns += [value.alias(name) for name, value in lineage.items() if name not in present]
    return raw.select(*columns)
