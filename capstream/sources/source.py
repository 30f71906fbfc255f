"""The captured tables: where each change stream lives and how it is labelled."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CdcSource:
    """One captured table: where its change stream lives and how it is labelled.

    ``name`` is the column prefix of the projected event (``<name>_clerk``).
    ``kind`` is ``kafka`` (a broker topic) or ``files`` (a replay folder of
    Kafka-shaped parquet rows). ``max_offsets_per_trigger`` (topic) and
    ``max_files_per_trigger`` (folder) bound a micro-batch: without them the
    first batch of a backlog is the whole backlog. ``min_partitions`` splits a
    topic's offsets over more tasks than it has partitions.
    """

    name: str
    topic: str
    connector: str
    server: str
    db: str
    schema_name: str | None
    table: str = "customer"
    kind: str = "kafka"
    bootstrap_servers: str | None = None
    path: str | None = None
    fail_on_data_loss: bool = True
    starting_offsets: str | None = None
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    ts_unit: str = "micros"
    options: dict = field(default_factory=dict)

    def with_(self, **kw) -> "CdcSource":
        d = {k: getattr(self, k) for k in self.__dataclass_fields__}
        d.update(kw)
        return CdcSource(**d)


# --- fixed values: the two captured databases --------------------------------
POSTGRES = CdcSource(name="postgres", topic="postgrestopic.public.customer", connector="postgresql",
                     server="postgrestopic", db="postgres", schema_name="public")
MYSQL = CdcSource(name="mysql", topic="mysqltopic.mariadb.customer", connector="mysql",
                  server="mysqltopic", db="mariadb", schema_name=None)
