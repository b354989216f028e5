"""Storage, database, messaging and key services."""

from __future__ import annotations

from costgauge.operators.timeseries import MetricSpec
from costgauge.services.declare import ResourceTable, Service, fields

# Fixed values in all declarations: names of tables, columns and metrics, types, source paths, units, intervals.
CLOUD_STORAGE = Service(
    "Cloud Storage",
    "storage.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_cloud_storage",
            fields(
                ("project_id", "string", None),
                ("bucket_name", "string", "name"),
                ("location", "string", "location"),
                ("location_type", "string", None),
                ("storage_class", "string", "storage_class"),
                ("time_created", "string", "time_created"),
                ("updated", "string", "updated"),
                ("metageneration", "string", "metageneration"),
                ("storage_size_bytes", "double", None),
                ("object_count", "int", None),
                ("lifecycle_rules_count", "int", None),
                ("labels", "map<string,string>", "labels"),
                ("default_event_based_hold", "boolean", "default_event_based_hold"),
                ("default_object_retention_days", "int", None),
                ("retention_policy_enabled", "boolean", None),
                ("retention_period_days", "int", "retention_policy.retention_period"),
                ("requester_pays", "boolean", "billing.requester_pays"),
                ("versioning_enabled", "boolean", "versioning.enabled"),
                ("logging_enabled", "boolean", "logging.log_object_prefix"),
                ("website_config", "string", None),
                ("cors_config", "string", None),
                ("lifecycle_config", "string", None),
                ("encryption_type", "string", None),
                ("kms_key_name", "string", "encryption.default_kms_key_name"),
            ),
            id_fields=("project_id", "bucket_name"),
        ),
    ),
    (
        MetricSpec("storage.googleapis.com/api/request_count", "Count", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/object_count", "Count", "Gauge", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/total_bytes", "Bytes", "Gauge", "PT5M"),
        MetricSpec("storage.googleapis.com/network/sent_bytes_count", "Bytes", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/network/received_bytes_count", "Bytes", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/availability", "Ratio", "Mean", "PT5M"),
        MetricSpec("storage.googleapis.com/api/error_count", "Count", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/api/latency", "Milliseconds", "Mean", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/object_size_distribution", "Count", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/class_a_request_count", "Count", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/class_b_request_count", "Count", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/download_bytes", "Bytes", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/upload_bytes", "Bytes", "Sum", "PT5M"),
        MetricSpec("storage.googleapis.com/storage/delete_count", "Count", "Sum", "PT5M"),
    ),
    tags=("catalog",),
)

PUBSUB = Service(
    "Pub/Sub",
    "pubsub.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_pubsub_topics",
            fields(
                ("project_id", "string", None),
                ("topic_name", "string", "name"),
                ("kms_key_name", "string", "kms_key_name"),
                ("message_retention_duration", "string", "message_retention_duration"),
                ("message_storage_policy", "string", "message_storage_policy"),
                ("labels", "map<string,string>", "labels"),
                ("schema_settings", "string", "schema_settings"),
                ("message_ordering_enabled", "boolean", "enable_message_ordering"),
                ("snapshot_count", "int", None),
                ("subscription_count", "int", None),
                ("create_time", "string", "create_time"),
                ("modify_time", "string", "modify_time"),
            ),
            id_fields=("project_id", "topic_name"),
        ),
        ResourceTable(
            "bronze_gcp_pubsub_subscriptions",
            fields(
                ("project_id", "string", None),
                ("subscription_name", "string", "name"),
                ("topic_name", "string", "topic"),
                ("push_endpoint", "string", "push_config.push_endpoint"),
                ("ack_deadline_seconds", "int", "ack_deadline_seconds"),
                ("message_retention_duration", "string", "message_retention_duration"),
                ("retain_acked_messages", "boolean", "retain_acked_messages"),
                ("enable_message_ordering", "boolean", "enable_message_ordering"),
                ("filter", "string", "filter"),
                ("dead_letter_policy", "string", "dead_letter_policy"),
                ("retry_policy", "string", "retry_policy"),
                ("detached", "boolean", "detached"),
                ("enable_exactly_once_delivery", "boolean", "enable_exactly_once_delivery"),
                ("labels", "map<string,string>", "labels"),
                ("create_time", "string", "create_time"),
                ("modify_time", "string", "modify_time"),
            ),
            id_fields=("project_id", "subscription_name"),
        ),
    ),
    (
        *(
            MetricSpec("pubsub.googleapis.com/topic/message_count", "Count", "Sum", "PT5M"),
            MetricSpec("pubsub.googleapis.com/topic/byte_count", "Bytes", "Sum", "PT5M"),
            MetricSpec("pubsub.googleapis.com/topic/snapshot_count", "Count", "Gauge", "PT5M"),
        ),
        *(
            MetricSpec("pubsub.googleapis.com/subscription/num_undelivered_messages", "Count", "Gauge", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/num_outstanding_messages", "Count", "Gauge", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/oldest_unacked_message_age", "Seconds", "Gauge", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/ack_message_count", "Count", "Sum", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/nack_message_count", "Count", "Sum", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/push_request_count", "Count", "Sum", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/push_request_latencies", "Milliseconds", "Mean", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/dead_letter_message_count", "Count", "Sum", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/backlog_bytes", "Bytes", "Gauge", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/flow_control_limit_bytes", "Bytes", "Gauge", "PT5M"),
            MetricSpec("pubsub.googleapis.com/subscription/flow_control_limit_messages", "Count", "Gauge", "PT5M"),
        ),
    ),
    tags=("catalog",),
)

BIGQUERY = Service(
    "BIGQUERY",
    "bigquery.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_bigquery_datasets",
            fields(
                ("project_id", "string", None),
                ("dataset_id", "string", "dataset_id"),
                ("friendly_name", "string", "friendly_name"),
                ("description", "string", "description"),
                ("location", "string", "location"),
                ("default_table_expiration_ms", "double", "default_table_expiration_ms"),
                ("default_partition_expiration_ms", "double", "default_partition_expiration_ms"),
                ("labels", "map<string,string>", "labels"),
                ("created", "string", "created"),
                ("modified", "string", "modified"),
            ),
            id_fields=("project_id", "dataset_id"),
        ),
        ResourceTable(
            "bronze_gcp_bigquery_tables",
            fields(
                ("project_id", "string", None),
                ("dataset_id", "string", None),
                ("table_id", "string", "table_id"),
                ("table_type", "string", "table_type"),
                ("friendly_name", "string", "friendly_name"),
                ("description", "string", "description"),
                ("num_bytes", "double", "num_bytes"),
                ("num_rows", "double", "num_rows"),
                ("created", "string", "created"),
                ("modified", "string", "modified"),
                ("expires", "string", "expires"),
                ("partitioning_type", "string", "partitioning_type"),
                ("partition_field", "string", "partition_field"),
                ("clustering_fields", "string", "clustering_fields"),
                ("labels", "map<string,string>", "labels"),
            ),
            id_fields=("project_id", "dataset_id", "table_id"),
            parent_field="dataset_id",
        ),
    ),
    (
        MetricSpec("bigquery.googleapis.com/storage/stored_bytes", "Bytes", "Average", "PT1H"),
        MetricSpec("bigquery.googleapis.com/storage/table_count", "Count", "Average", "PT1H"),
        MetricSpec("bigquery.googleapis.com/query/count", "Count", "Average", "PT1H"),
        MetricSpec("bigquery.googleapis.com/slots/allocated_for_project", "Count", "Average", "PT1H"),
        MetricSpec("bigquery.googleapis.com/query/scanned_bytes_billed", "Bytes", "Average", "PT1H"),
    ),
)

BIGTABLE = Service(
    "BIGTABLE",
    "bigtable.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_bigtable_instances",
            fields(
                ("project_id", "string", None),
                ("instance_id", "string", "instance_id"),
                ("display_name", "string", "display_name"),
                ("instance_type", "string", "type_"),
                ("state", "string", "state"),
                ("labels", "map<string,string>", "labels"),
            ),
            id_fields=("project_id", "instance_id"),
        ),
        ResourceTable(
            "bronze_gcp_bigtable_clusters",
            fields(
                ("project_id", "string", None),
                ("instance_id", "string", None),
                ("cluster_id", "string", "cluster_id"),
                ("location", "string", "location_id"),
                ("state", "string", "state"),
                ("serve_nodes", "double", "serve_nodes"),
                ("storage_type", "string", "default_storage_type"),
                ("autoscaling_enabled", "string", None),
                ("autoscaling_min_nodes", "double", None),
                ("autoscaling_max_nodes", "double", None),
                ("autoscaling_cpu_target", "double", None),
            ),
            id_fields=("project_id", "instance_id", "cluster_id"),
            parent_field="instance_id",
            flatten=False,
        ),
        ResourceTable(
            "bronze_gcp_bigtable_tables",
            fields(
                ("project_id", "string", None),
                ("instance_id", "string", None),
                ("table_id", "string", "table_id"),
                ("replication_state", "string", "replication_state"),
                ("column_families", "string", "column_families"),
            ),
            id_fields=("project_id", "instance_id", "table_id"),
            parent_field="instance_id",
            flatten=False,
        ),
    ),
    (
        MetricSpec("bigtable.googleapis.com/server/request_count", "Count", "Average", "PT5M"),
        MetricSpec("bigtable.googleapis.com/cluster/cpu_load", "Ratio", "Average", "PT5M"),
        MetricSpec("bigtable.googleapis.com/server/latencies", "ms", "Average", "PT5M"),
        MetricSpec("bigtable.googleapis.com/disk/bytes_used", "Bytes", "Average", "PT5M"),
        MetricSpec("bigtable.googleapis.com/cluster/node_count", "Count", "Average", "PT5M"),
    ),
)

CLOUD_SQL = Service(
    "CloudSQL",
    "cloudsql.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_sql_instances",
            fields(
                ("resource_id", "string", "name"),
                ("resource_name", "string", "name"),
                ("database_version", "string", "database_version"),
                ("region", "string", "region"),
                ("gce_zone", "string", "gce_zone"),
                ("state", "string", "state"),
                ("tier", "string", "settings.tier"),
                ("availability_type", "string", "settings.availability_type"),
                ("disk_type", "string", "settings.data_disk_type"),
                ("data_disk_size_gb", "int", "settings.data_disk_size_gb"),
                ("settings_pricing_plan", "string", "settings.pricing_plan"),
                ("server_ca_cert", "string", "server_ca_cert.cert_serial_number"),
                ("ip_addresses", "string", None),
            ),
        ),
    ),
    (
        MetricSpec("cloudsql.googleapis.com/database/cpu/utilization", "Percent", "Average", "PT5M"),
        MetricSpec("cloudsql.googleapis.com/database/memory/utilization", "Percent", "Average", "PT5M"),
        MetricSpec("cloudsql.googleapis.com/database/disk/utilization", "Percent", "Average", "PT5M"),
        MetricSpec("cloudsql.googleapis.com/database/disk/read_ops_count", "Count", "Average", "PT5M"),
        MetricSpec("cloudsql.googleapis.com/database/disk/write_ops_count", "Count", "Average", "PT5M"),
    ),
)

ARTIFACT_REGISTRY = Service(
    "ARTIFACT_REGISTRY",
    "artifactregistry.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_artifact_registry_repositories",
            fields(
                ("project_id", "string", None),
                ("location", "string", None),
                ("repository_name", "string", "name"),
                ("description", "string", "description"),
                ("format", "string", "format_"),
                ("mode", "string", "mode"),
                ("kms_key_name", "string", "kms_key_name"),
                ("size_bytes", "double", "size_bytes"),
                ("cleanup_policy_dry_run", "string", "cleanup_policies"),
                ("labels", "map<string,string>", "labels"),
                ("create_time", "string", "create_time"),
                ("update_time", "string", "update_time"),
            ),
            id_fields=("project_id", "location", "repository_name"),
        ),
    ),
    (
        MetricSpec("artifactregistry.googleapis.com/repository/request_count", "Count", "Average", "PT5M"),
        MetricSpec("artifactregistry.googleapis.com/repository/api/request_count", "Count", "Average", "PT5M"),
        MetricSpec("artifactregistry.googleapis.com/repository/size", "Bytes", "Average", "PT5M"),
        MetricSpec("artifactregistry.googleapis.com/quota/project_region_upstream_host_reads/usage", "Count", "Average", "PT5M"),
        MetricSpec("artifactregistry.googleapis.com/quota/project_region_upstream_host_reads/limit", "Count", "Average", "PT5M"),
        MetricSpec("artifactregistry.googleapis.com/repository/request_latencies", "us", "Average", "PT5M"),
        MetricSpec("artifactregistry.googleapis.com/repository/api/request_latencies", "us", "Average", "PT5M"),
    ),
)

CLOUD_KMS = Service(
    "CloudKMS",
    "cloudkms.googleapis.com",
    (
        ResourceTable("bronze_gcp_kms_key_rings", fields(
            ("resource_id", "string", "name"),
            ("resource_name", "string", "name"),
            ("create_time", "string", "create_time"),
        )),
        ResourceTable(
            "bronze_gcp_kms_crypto_keys",
            fields(
                ("resource_id", "string", "name"),
                ("resource_name", "string", "name"),
                ("key_ring_id", "string", None),
                ("purpose", "string", "purpose"),
                ("create_time", "string", "create_time"),
                ("next_rotation_time", "string", "next_rotation_time"),
                ("rotation_period", "string", "rotation_period"),
                ("labels", "string", "labels"),
            ),
            parent_field="resource_name",
        ),
    ),
    (
        MetricSpec("serviceruntime.googleapis.com/api/request_count", "Count", "Average", "PT5M"),
    ),
)
