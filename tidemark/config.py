"""Job settings from environment variables, a mapping or a YAML file.

No address, user or password has a default.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

PREFIX = "TIDEMARK_"


def _need(values: Mapping[str, Any], name: str) -> Any:
    value = values.get(name)
    if value in (None, ""):
        raise KeyError(f"setting {name!r} is missing")
    return value


@dataclass(frozen=True)
class BusSettings:
    """Message bus connection."""

    servers: str
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    protocol: str = "SASL_PLAINTEXT"
    mechanism: str = "PLAIN"
    offsets_per_trigger: int = 500

    @classmethod
    def of(cls, values: Mapping[str, Any]) -> BusSettings:
        servers = _need(values, "servers")
        return cls(
            servers=servers if isinstance(servers, str) else ",".join(servers),
            username=values.get("username"),
            password=values.get("password"),
            protocol=values.get("protocol", cls.protocol),
            mechanism=values.get("mechanism", cls.mechanism),
            offsets_per_trigger=int(
                values.get("offsets_per_trigger", cls.offsets_per_trigger)
            ),
        )


@dataclass(frozen=True)
class DatabaseSettings:
    """JDBC connection."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    @classmethod
    def of(cls, values: Mapping[str, Any]) -> DatabaseSettings:
        return cls(
            url=_need(values, "url"),
            driver=_need(values, "driver"),
            user=values.get("user"),
            password=values.get("password"),
        )


@dataclass(frozen=True)
class JobSettings:
    """Everything a job needs besides its tables."""

    bus: BusSettings | None = None
    database: DatabaseSettings | None = None
    topics: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, values: Mapping[str, Any]) -> JobSettings:
        return cls(
            bus=BusSettings.of(values["bus"]) if values.get("bus") else None,
            database=DatabaseSettings.of(values["database"])
            if values.get("database")
            else None,
            topics=dict(values.get("topics") or {}),
        )

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobSettings:
        """``TIDEMARK_BUS_SERVERS``, ``TIDEMARK_DATABASE_URL``, ``TIDEMARK_TOPICS_RAW`` …"""
        env = os.environ if env is None else env
        groups: dict[str, dict[str, str]] = {"bus": {}, "database": {}, "topics": {}}
        for name, value in env.items():
            if not name.startswith(PREFIX):
                continue
            group, _, key = name[len(PREFIX) :].lower().partition("_")
            if group in groups and key:
                groups[group][key] = value
        return cls.of(groups)

    @classmethod
    def from_yaml(cls, path: str) -> JobSettings:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML settings needs the yaml package") from error
        with open(path, encoding="utf-8") as handle:
            return cls.of(yaml.safe_load(handle) or {})
