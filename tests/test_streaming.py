"""Arriving files end in the same table as a batch run."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from costgauge import schemas
from costgauge.params import RunParams
from costgauge.plans import ingestion
from costgauge.services import get_service
from costgauge.streaming import ingest

PARAMS = RunParams("proj", "client", run_ts=datetime(2024, 1, 31, tzinfo=timezone.utc))


def test_arrivals_are_upserted(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    service = get_service("CloudSQL")
    table = service.tables[0]
    schema = schemas.parsed("name string, state string, settings struct<tier: string>")

    def run():
        records = ingest.new_records(spark, str(source), schema, files_per_batch=1)
        query = ingest.upsert_arrivals(
            records,
            lambda batch: ingestion.snapshot(batch, table, service, PARAMS),
            target,
            table.key,
            ["state"],
            table.partition_by,
            str(tmp_path / "progress"),
        )
        assert query.awaitTermination(120)

    (source / "1.json").write_text(json.dumps({"name": "a", "state": "1", "settings": {"tier": "x"}}) + "\n")
    run()
    (source / "2.json").write_text("\n".join(json.dumps({"name": n, "state": "2"}) for n in "ab"))
    run()
    run()
    rows = spark.read.parquet(target).collect()
    assert sorted((r.resource_id, r.state, r.tier) for r in rows) == [("a", "2", None), ("b", "2", None)]
