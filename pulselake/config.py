"""Locations and switches of one lake."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from collections.abc import Mapping


@dataclass(frozen=True)
class LakeConfig:
    """Where the layers live and how they are written.

    ``table_format`` is a partitioned file format, ``"parquet"`` or ``"orc"``;
    what makes the files tables is kept in small records beside them.
    """

    root: str
    table_format: str = "parquet"
    kafka_servers: str | None = None
    starting_offsets: str = "earliest"
    trigger: str = "30 seconds"
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    jdbc_url: str | None = None
    jdbc_properties: Mapping[str, str] = field(default_factory=dict)
    jdbc_connections: int = 8

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> "LakeConfig":
        # PULSELAKE_JDBC_USER, _PASSWORD, _DRIVER, _STRINGTYPE: any property of the driver.
        prefix = "PULSELAKE_JDBC_"
        properties = {
            name.removeprefix(prefix).lower(): value
            for name, value in env.items()
            if name.startswith(prefix) and name != f"{prefix}URL"
        }
        return cls(
            root=env["PULSELAKE_ROOT"],
            table_format=env.get("PULSELAKE_FORMAT", "parquet"),
            kafka_servers=env.get("PULSELAKE_KAFKA"),
            starting_offsets=env.get("PULSELAKE_OFFSETS", "earliest"),
            jdbc_url=env.get("PULSELAKE_JDBC_URL"),
            jdbc_properties=properties,
        )

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.layer(layer)}/{name}"
