"""The contact side of a match, worked out once and kept for later matches.

Every way in which names meet joins registrant keys with contact keys. A
``ContactIndex`` writes the contact keys as tables bucketed and sorted by the
columns they are joined on, when a match first needs them; later matches read
them without moving a contact row by an exchange, except those rows that a
registrant's key has already been found for.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame

from ..store import settled, shared_folder

T = TypeVar("T")


class Fresh:
    """Contact tables of one match: nothing is kept."""

    def table(self, name: str, by: list[str], make: Callable[[], DataFrame], settle: bool = False) -> DataFrame:
        return settled(make()) if settle else make()

    def order(self, name: str, make: Callable[[], T]) -> T:
        return make()


class ContactIndex(Fresh):
    """Contacts (``Name``, ``contact_pos`` and others) to be matched again and again.

    Give it to ``fuzzy_match`` or ``enrich_audience`` instead of the contacts.
    Cutoffs of 90 and more use kept tables for all reasons to meet; lower ones
    keep what they share with these. The contacts are read once, when the
    index is made, so it stands for them as they were then. ``buckets`` should
    be such that a bucket fits a task's memory; a key that is hot among the
    contacts stays in one bucket, unlike in a match without index.
    """

    def __init__(self, contacts: DataFrame, buckets: int | None = None):
        self.spark = contacts.sparkSession
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.prefix = f"rosterlink_{uuid.uuid4().hex}"
        self._tables: dict[str, str] = {}
        self._orders: dict[str, object] = {}
        self.contacts = self.table("contacts", ["Name"], lambda: contacts)

    def table(self, name: str, by: list[str], make: Callable[[], DataFrame], settle: bool = False) -> DataFrame:
        if name not in self._tables:
            table = f"{self.prefix}_{re.sub('[^0-9a-z]', '_', name)}"
            # Dealt as the buckets are, so that each bucket is one file.
            rows = make().repartition(self.buckets, *by)
            path = f"{shared_folder(self.spark).rstrip('/')}/{table}"
            rows.write.format("parquet").option("path", path).bucketBy(self.buckets, *by).sortBy(*by).saveAsTable(table)
            self._tables[name] = table
        return self.spark.table(self._tables[name])

    def order(self, name: str, make: Callable[[], T]) -> T:
        if name not in self._orders:
            self._orders[name] = make()
        return self._orders[name]

    def drop(self) -> None:
        """Forget the tables; their files stay in the shared folder."""
        for table in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()


def contacts_of(contacts: DataFrame | ContactIndex) -> tuple[DataFrame, Fresh]:
    """The contacts as a frame, and who keeps their tables."""
    return (contacts.contacts, contacts) if isinstance(contacts, ContactIndex) else (contacts, Fresh())
