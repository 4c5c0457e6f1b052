"""Helpers shared by the catalogue modules."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from casebook.config import FIXTURE_SETTINGS
from casebook.sources import fixtures as fx
from casebook.sources.tables import Tables

CFG = FIXTURE_SETTINGS
STAGED = "spark.casebook.staged"  # session setting: folder of document tables stored as an ingest would leave them
_CACHE: dict[tuple[int, str], tuple[SparkSession, "Fixture"]] = {}


class Fixture:
    """Derived fixture DataFrames of one scale-factor folder.

    Instances are shared per (session, folder) so the logical plans are built
    once; they are plans, not cached data, so every query still reads the
    tables.
    """

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (id(spark), sf_dir)
        hit = _CACHE.get(key)
        if hit is not None and hit[0] is spark:
            return hit[1]
        obj = super().__new__(cls)
        obj._init(spark, sf_dir)
        _CACHE[key] = (spark, obj)
        return obj

    def _init(self, spark: SparkSession, sf_dir: str) -> None:
        self.t = Tables(spark, sf_dir)
        self.spark = spark

    def _staged(self, name: str) -> DataFrame | None:
        """A document table written beforehand (see ``stage_documents``), where the session names their folder."""
        root = self.spark.conf.get(STAGED, None)
        return self.spark.read.parquet(f"{root}/{name}") if root else None

    @functools.cached_property
    def _tickets_raw(self) -> DataFrame:
        return self._staged("tickets") or fx.ticket_documents(self.t.orders, self.t.customer, CFG)

    def tickets_raw(self) -> DataFrame:
        return self._tickets_raw

    @functools.cached_property
    def _messages_raw(self) -> DataFrame:
        return self._staged("messages") or fx.message_documents(self.t.conversations, CFG)

    def messages_raw(self) -> DataFrame:
        return self._messages_raw

    def customers_raw(self) -> DataFrame:
        return fx.customer_documents(self.t.customer)

    @functools.cached_property
    def _classes(self) -> DataFrame:
        return fx.classifications(self.t.orders)

    def classes(self) -> DataFrame:
        return self._classes

    def clusters(self) -> DataFrame:
        return fx.clusters(self.t.orders)

    def directory(self) -> DataFrame:
        return fx.directory(self.t.customer)

    def staging(self) -> DataFrame:
        return fx.staging(self.t.orders)


def stage_documents(spark: SparkSession, sf_dir: str, root: str, files: int) -> None:
    """Write the ticket and message documents as stored tables of ``files`` files."""
    f = Fixture(spark, sf_dir)
    for name, docs in (("tickets", f.tickets_raw()), ("messages", f.messages_raw())):
        docs.repartition(files, "id").write.mode("overwrite").parquet(f"{root}/{name}")
