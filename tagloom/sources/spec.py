"""Where a tag's business data lives, and how to read it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SEARCH_INDEX = "es"
# Spellings of ``inType`` that mean the search-index connector.
SEARCH_INDEX_NAMES = ("es", "elasticsearch")


@dataclass(frozen=True)
class SourceSpec:
    """A data source named by a tag definition.

    ``kind`` picks the Spark format; the search-index connector is the default. For the
    search index, ``nodes`` is the host list and ``index/doc_type`` the resource. For any
    file format, ``nodes/index/doc_type`` (the parts present) is the path.
    """

    kind: str | None = None
    nodes: str | None = None
    index: str | None = None
    doc_type: str | None = None
    fields: str | None = None

    @classmethod
    def from_map(cls, rule: Mapping[str, str | None]) -> SourceSpec:
        """Build from a parsed rule; unknown keys are ignored, missing ones are None."""
        # Key names used in stored tag definitions.
        return cls(
            kind=rule.get("inType"),
            nodes=rule.get("esNodes"),
            index=rule.get("esIndex"),
            doc_type=rule.get("esType"),
            fields=rule.get("selectFields"),
        )

    @property
    def format(self) -> str:
        kind = (self.kind or SEARCH_INDEX).strip().lower()
        return SEARCH_INDEX if kind in SEARCH_INDEX_NAMES else kind

    @property
    def columns(self) -> list[str]:
        return [name.strip() for name in (self.fields or "").split(",") if name.strip()]

    @property
    def resource(self) -> str:
        return "/".join(part for part in (self.index, self.doc_type) if part)

    @property
    def path(self) -> str | None:
        """Path for file formats; None for the search index."""
        if self.format == SEARCH_INDEX:
            return None
        return "/".join(part for part in ((self.nodes or "").rstrip("/"), self.resource) if part)

    def options(self) -> dict[str, str]:
        """Reader options of the search-index connector; none for file formats."""
        if self.format != SEARCH_INDEX:
            return {}
        return search_index_options(self.nodes, self.resource, self.fields)


def search_index_options(
    nodes: str | None, resource: str, fields: str | None = None
) -> dict[str, str]:
    # Option names of the connector. Dates are left as stored.
    options = {
        "es.nodes": nodes,
        "es.resource": resource,
        "es.read.field.include": fields,
        "es.mapping.date.rich": "false",
    }
    return {name: value for name, value in options.items() if value}


def read_source(
    spark: SparkSession, spec: SourceSpec, schema: StructType | str | None = None
) -> DataFrame:
    """Business data of a tag, pruned to the fields its definition names."""
    reader = spark.read.format(spec.format).options(**spec.options())
    if schema is not None:
        reader = reader.schema(schema)
    frame = reader.load(spec.path) if spec.path else reader.load()
    return frame.select(*spec.columns) if spec.columns else frame
