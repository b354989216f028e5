"""Run parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone


@dataclass(frozen=True)
class RunParams:
    """What one ingestion run needs to know; ``run_ts`` is fixed so that a rerun gives the same rows."""

    account_id: str
    client_id: str
    additional_client_id: str = ""
    job_name: str = "bronze-gcp-ingestion"
    window_days: int = 7
    active_services: tuple[str, ...] = ()
    catalog: str = "glue_catalog"
    database: str = "bronze"
    warehouse: str = ""
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def client_ids(self) -> tuple[str, ...]:
        """Every tenant the rows are stored under."""
        return tuple(c for c in (self.client_id, self.additional_client_id) if c)


def parse_params(args: Mapping[str, str], run_ts: datetime | None = None) -> RunParams:
    """Read job arguments; project, client and bucket are required."""
    services = tuple(s.strip().upper() for s in args.get("ACTIVE_SERVICES", "").split(",") if s.strip())
    return RunParams(
        account_id=args["PROJECT_ID"],
        client_id=args["CLIENT_ID"],
        additional_client_id=args.get("ADDITIONAL_CLIENT_ID", ""),
        job_name=args.get("JOB_NAME", "bronze-gcp-ingestion"),
        window_days=int(args.get("WINDOW_DAYS", "7")),
        active_services=services,
        catalog=args.get("ICEBERG_CATALOG", "glue_catalog"),
        database=args.get("ICEBERG_DATABASE", "bronze"),
        warehouse=args["S3_BUCKET"],
        run_ts=run_ts or datetime.now(timezone.utc),
    )
