"""Layer catalog: layer → table → (file, schema), typed loads, asset discovery.

Bronze is read with an explicit all-string schema for CSV (inference would turn
``YYYY-MM`` into timestamps and hide format violations); Parquet keeps its
types.  Loads are lazy: nothing is read until a check runs, and Catalyst then
prunes columns and pushes filters into the scan.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The reference's layer → table → file layout.
REFERENCE_LAYOUT = {
    "bronze": {"suppliers": "suppliers_raw.csv", "parts": "parts_catalog_raw.csv", "work_orders": "work_orders_raw.csv"},
    "silver": {"suppliers": "suppliers_cleansed.csv", "parts": "parts_catalog_cleansed.csv", "work_orders": "work_orders_cleansed.csv"},
    "gold": {"production_metrics": "production_metrics.csv"},
}
# Columns read as text whatever they look like (seed type overrides).
TEXT_OVERRIDES = ["quality_rating", "contract_start_date", "phone", "spec_revision"]
#: Column of a CSV schema that holds the line of a row with too few or too many fields, or with a field of another type
#: in a column that is read.
CORRUPT = "_corrupt_record"


@dataclass
class Catalog:
    root: str
    layout: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: REFERENCE_LAYOUT)
    schemas: Mapping[str, StructType] = field(default_factory=dict)  # "layer.table" → schema
    layer_dirs: bool = True  # files live under <root>/<layer>/ (else directly under root)
    header: bool = True  # CSV files begin with a line of names

    def path(self, layer: str, table: str) -> str:
        layer_l, table_l = layer.lower(), table.lower()
        if layer_l not in self.layout:
            raise ValueError(f"Unknown layer '{layer_l}'. Choose from: {list(self.layout)}")
        if table_l not in self.layout[layer_l]:
            raise ValueError(f"Unknown table '{table_l}' for layer '{layer_l}'. Choose from: {list(self.layout[layer_l])}")
        sub = f"{layer_l}/" if self.layer_dirs else ""
        return f"{self.root.rstrip('/')}/{sub}{self.layout[layer_l][table_l]}"


def _read(spark: SparkSession, path: str, schema: StructType | None, header: bool = True) -> DataFrame:
    if path.endswith(".csv"):
        r = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if schema is not None and CORRUPT in schema.names:
            r = r.option("columnPruning", False)  # a pruned parser does not count the fields of a row
        return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", False).csv(path)
    return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)


def load_table(spark: SparkSession, catalog: Catalog, layer: str, table: str) -> DataFrame:
    """Case-insensitive lookup; ValueError on unknown layer/table."""
    path = catalog.path(layer, table)
    return _read(spark, path, catalog.schemas.get(f"{layer.lower()}.{table.lower()}"), catalog.header)


def load_layer(spark: SparkSession, catalog: Catalog, layer: str) -> dict[str, DataFrame]:
    """All tables of a layer (lazy)."""
    if layer.lower() not in catalog.layout:
        raise ValueError(f"Unknown layer '{layer}'")
    return {t: load_table(spark, catalog, layer, t) for t in catalog.layout[layer.lower()]}


def csv_schema(types: Mapping[str, str], text: Sequence[str] = tuple(TEXT_OVERRIDES), corrupt: bool = True) -> StructType:
    """Schema of a CSV file from column types in file order; columns of *text* are read as text whatever their declared
    type.  With *corrupt*, a row that does not fit is kept, padded with nulls, and its line is in the column `CORRUPT`."""
    fields = [StructField(c, StringType() if c in text else StructType.fromDDL(f"c {t}")[0].dataType, True) for c, t in types.items()]
    return StructType(fields + [StructField(CORRUPT, StringType(), True)] * corrupt)


def all_string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def typed_load(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Apply column type overrides (``try_cast``: bad values become null, never an error)."""
    return df.select(*[
        (F.col(c).cast("string").try_cast(types[c]) if types[c] != "string" else F.col(c).cast("string")).alias(c)
        if c in types else F.col(c)
        for c in df.columns
    ])


def seed_types(columns: list[str]) -> dict[str, str]:
    """Text overrides (``TEXT_OVERRIDES``) for the columns a table actually has,
    ready for ``typed_load``: these columns stay text whatever they look like."""
    return {c: "string" for c in TEXT_OVERRIDES if c in columns}


def discover_assets(spark: SparkSession, folder: str, pattern: str = r"(.*)\.(csv|parquet)$") -> DataFrame:
    """One asset per file whose name matches ``pattern`` (asset = first group).

    Uses the binaryFile source with only path and length selected, so file
    contents are never read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
             .select("path", "length"))
    name = F.regexp_extract(F.element_at(F.split("path", "/"), -1), pattern, 1)
    return files.select(name.alias("asset_name"), "path", F.col("length").alias("bytes")).filter(F.col("asset_name") != "")


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Register DataFrames as temp views (once per session); returns view names."""
    names = []
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
