"""Declared services and their lookup."""

from __future__ import annotations

from collections.abc import Iterable

from costgauge.operators.timeseries import MetricSpec
from costgauge.services import compute, network, storage
from costgauge.services.declare import ResourceTable, Service

DECLARED: tuple[Service, ...] = (
    compute.GKE,
    compute.COMPUTE_ENGINE,
    compute.CLOUD_RUN,
    network.CLOUD_NAT,
    compute.CLOUD_BUILD,
    compute.CLOUD_SCHEDULER,
    storage.CLOUD_STORAGE,
    storage.PUBSUB,
    network.CLOUD_CDN,
    network.CLOUD_DNS,
    network.CLOUD_ROUTER,
    compute.DATAFLOW,
    storage.BIGQUERY,
    storage.BIGTABLE,
    compute.CLOUD_FUNCTIONS,
    storage.ARTIFACT_REGISTRY,
    storage.CLOUD_KMS,
    network.CLOUD_ARMOR,
    network.CLOUD_LOAD_BALANCER,
    storage.CLOUD_SQL,
)
_REGISTRY: dict[str, Service] = {}


def _key(name: str) -> str:
    """Names compare without case, blanks, underscores and slashes."""
    return "".join(c for c in name.upper() if c.isalnum())


def register(service: Service) -> None:
    _REGISTRY[_key(service.name)] = service


def get_service(name: str) -> Service | None:
    return _REGISTRY.get(_key(name))


def list_services(tag: str | None = None) -> list[str]:
    """Names of all services, or of those with a tag (``registered`` or ``catalog``)."""
    return [s.name for s in _REGISTRY.values() if tag is None or tag in s.tags]


def active_services(names: Iterable[str]) -> list[Service]:
    """The asked-for services; all of them if none is asked for."""
    asked = [_key(n) for n in names]
    return [s for k, s in _REGISTRY.items() if not asked or k in asked]


def all_specs() -> list[tuple[str, MetricSpec]]:
    """Every declared metric with its service."""
    return [(s.name, spec) for s in DECLARED for spec in s.specs]


for _service in DECLARED:
    register(_service)

__all__ = [
    "DECLARED",
    "ResourceTable",
    "Service",
    "active_services",
    "all_specs",
    "get_service",
    "list_services",
    "register",
]
