"""Where a logical table comes from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlet.session import fit_joins
from martlet.sources import adapters
from martlet.sources.io import read_csv_table
from martlet.sources.schemas import SCHEMAS, schema_of


def logical_name(file_name: str, prefix: str = "", suffix: str = "_dataset") -> str:
    """``<prefix>orders_dataset.csv`` -> ``orders``: drops the extension, the prefix and the suffix."""
    stem = file_name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    stem = stem.removeprefix(prefix).removesuffix(suffix)
    return {"product_category_name_translation": "category_translation"}.get(stem, stem)


class Sources:
    """Lazy tables by logical name, with a memo so that a plan built twice is built once.

    ``stored`` holds tables that stand in for a computed model, for instance a mart that was
    written before: operators ask ``src.model(fct_orders)`` and get the stored table if there is
    one, else the lazy plan.
    """

    def __init__(self, spark: SparkSession, reader: Callable[[str], DataFrame], label: str = "", unnumbered: dict[str, str] | None = None):
        fit_joins(spark)
        self.spark = spark
        self.label = label
        self._reader = reader
        self._unnumbered = unnumbered or {}
        self._tables: dict[str, DataFrame] = {}
        self._models: dict[str, DataFrame] = {}
        self.stored: dict[str, DataFrame] = {}
        # what was computed from these tables and is no frame, such as a trained model
        self.memo: dict[str, object] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._reader(name)
        return self._tables[name]

    def unnumbered(self, name: str) -> DataFrame:
        """The table, without its row number if that would first have to be worked out; for those that don't need it."""
        return self.table(self._unnumbered.get(name, name))

    def model(self, fn: Callable[[Sources], DataFrame]) -> DataFrame:
        name = fn.__name__
        if name in self.stored:
            return self.stored[name]
        if name not in self._models:
            self._models[name] = fn(self)
        return self._models[name]


def file_sources(
    spark: SparkSession, paths: dict[str, str], fmt: str = "csv"
) -> Sources:
    """Sources in files: logical name -> path of a CSV file or folder, or of a parquet table."""

    def read(name: str) -> DataFrame:
        if fmt == "csv":
            return read_csv_table(spark, paths[name], schema_of(name))
        return spark.read.schema(schema_of(name)).format(fmt).load(paths[name])

    return Sources(spark, read)


def derived_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The logical sources derived from the star-schema test tables in ``sf_dir``."""
    raw = adapters.RawTables(spark, sf_dir)
    made = {**adapters.ADAPTERS, "order_lines": adapters.order_lines}
    return Sources(spark, lambda name: raw.adapted(made[name]), sf_dir, {"order_items": "order_lines"})


def read_source(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return derived_sources(spark, sf_dir).table(name)


def source_names() -> list[str]:
    return sorted(SCHEMAS)
