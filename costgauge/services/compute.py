"""Compute services."""

from __future__ import annotations

from costgauge.operators.timeseries import MetricSpec
from costgauge.services.declare import ResourceTable, Service, fields

# Fixed values in all declarations: names of tables, columns and metrics, types, source paths, units, intervals.
GKE = Service(
    "GKE",
    "kubernetes.io",
    (
        ResourceTable(
            "bronze_gcp_gke_clusters",
            fields(
                ("project_id", "string", None),
                ("location", "string", "location"),
                ("cluster_name", "string", "name"),
                ("description", "string", "description"),
                ("current_master_version", "string", "current_master_version"),
                ("current_node_version", "string", "current_node_version"),
                ("current_node_count", "double", "current_node_count"),
                ("status", "string", "status"),
                ("autopilot_enabled", "string", "autopilot.enabled"),
                ("network", "string", "network"),
                ("subnetwork", "string", "subnetwork"),
                ("cluster_ipv4_cidr", "string", "cluster_ipv4_cidr"),
                ("services_ipv4_cidr", "string", "services_ipv4_cidr"),
                ("logging_service", "string", "logging_service"),
                ("monitoring_service", "string", "monitoring_service"),
                ("release_channel", "string", "release_channel.channel"),
                ("labels", "map<string,string>", "resource_labels"),
                ("create_time", "string", "create_time"),
                ("expire_time", "string", "expire_time"),
                ("endpoint", "string", "endpoint"),
            ),
            id_fields=("project_id", "location", "cluster_name"),
        ),
        ResourceTable(
            "bronze_gcp_gke_node_pools",
            fields(
                ("project_id", "string", None),
                ("location", "string", None),
                ("cluster_name", "string", None),
                ("node_pool_name", "string", "name"),
                ("status", "string", "status"),
                ("version", "string", "version"),
                ("machine_type", "string", "config.machine_type"),
                ("disk_size_gb", "double", "config.disk_size_gb"),
                ("disk_type", "string", "config.disk_type"),
                ("image_type", "string", "config.image_type"),
                ("preemptible", "string", "config.preemptible"),
                ("spot", "string", "config.spot"),
                ("initial_node_count", "double", "initial_node_count"),
                ("autoscaling_enabled", "string", "autoscaling.enabled"),
                ("min_node_count", "double", "autoscaling.min_node_count"),
                ("max_node_count", "double", "autoscaling.max_node_count"),
                ("total_min_node_count", "double", "autoscaling.total_min_node_count"),
                ("total_max_node_count", "double", "autoscaling.total_max_node_count"),
                ("locations", "string", "locations"),
                ("labels", "map<string,string>", "config.labels"),
            ),
            id_fields=("project_id", "location", "cluster_name", "node_pool_name"),
            parent_field="cluster_name",
            flatten=False,
        ),
    ),
    (
        MetricSpec("kubernetes.io/node/cpu/allocatable_utilization", "Ratio", "Average", "PT5M"),
        MetricSpec("kubernetes.io/node/memory/allocatable_utilization", "Ratio", "Average", "PT5M"),
        MetricSpec("kubernetes.io/container/cpu/request_utilization", "Ratio", "Average", "PT5M"),
        MetricSpec("kubernetes.io/container/memory/request_utilization", "Ratio", "Average", "PT5M"),
        MetricSpec("kubernetes.io/pod/volume/total_bytes", "Bytes", "Average", "PT5M"),
    ),
    tags=("registered",),
)

COMPUTE_ENGINE = Service(
    "ComputeEngine",
    "compute.googleapis.com/Instance",
    (
        ResourceTable(
            "bronze_gcp_compute_instances",
            fields(
                ("resource_id", "string", "id"),
                ("resource_name", "string", "name"),
                ("zone", "string", "zone"),
                ("region", "string", None),
                ("machine_type", "string", "machine_type"),
                ("machine_family", "string", None),
                ("cpu_platform", "string", "cpu_platform"),
                ("status", "string", "status"),
                ("preemptible", "boolean", "scheduling.preemptible"),
                ("spot", "boolean", "scheduling.provisioning_model"),
                ("disk_count", "int", None),
                ("network_interface_count", "int", None),
                ("labels", "string", "labels"),
            ),
            with_service=True,
        ),
        ResourceTable(
            "bronze_gcp_disks",
            fields(
                ("resource_id", "string", "id"),
                ("name", "string", "name"),
                ("disk_size_gb", "int", "size_gb"),
                ("disk_type", "string", "type"),
                ("status", "string", "status"),
                ("zone", "string", "zone"),
                ("region", "string", None),
                ("attached_to", "string", "users"),
                ("provisioned_iops", "int", "provisioned_iops"),
                ("provisioned_throughput", "int", "provisioned_throughput"),
                ("labels", "string", "labels"),
            ),
        ),
    ),
    (
        MetricSpec("compute.googleapis.com/instance/cpu/utilization", "Percent", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/cpu/utilization", "Percent", "Percentile", "PT5M", 95),
        MetricSpec("compute.googleapis.com/instance/network/received_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/network/received_bytes_count", "Bytes", "Percentile", "PT5M", 95),
        MetricSpec("compute.googleapis.com/instance/network/sent_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/network/sent_bytes_count", "Bytes", "Percentile", "PT5M", 95),
        MetricSpec("compute.googleapis.com/instance/disk/read_ops_count", "Count", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/disk/read_ops_count", "Count", "Percentile", "PT5M", 95),
        MetricSpec("compute.googleapis.com/instance/disk/write_ops_count", "Count", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/disk/write_ops_count", "Count", "Percentile", "PT5M", 95),
        MetricSpec("compute.googleapis.com/instance/disk/read_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/disk/write_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/memory/balloon/ram_used", "Bytes", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/memory/balloon/ram_used", "Bytes", "Percentile", "PT5M", 95),
        MetricSpec("compute.googleapis.com/instance/disk/throttled_read_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("compute.googleapis.com/instance/disk/throttled_write_bytes_count", "Bytes", "Average", "PT5M"),
    ),
    tags=("registered",),
)

CLOUD_RUN = Service(
    "CloudRun",
    "run.googleapis.com/Service",
    (
        ResourceTable(
            "bronze_gcp_cloudrun_services",
            fields(
                ("resource_id", "string", "name"),
                ("resource_name", "string", "name"),
                ("region", "string", None),
                ("description", "string", "description"),
                ("ingress", "string", "ingress"),
                ("launch_stage", "string", "launch_stage"),
                ("vcpu_limit", "string", "template.containers.resources.limits.cpu"),
                ("memory_limit", "string", "template.containers.resources.limits.memory"),
                ("cpu_allocation", "string", None),
                ("concurrency_max", "int", "template.max_instance_request_concurrency"),
                ("min_instances", "int", "template.scaling.min_instance_count"),
                ("max_instances", "int", "template.scaling.max_instance_count"),
                ("timeout_seconds", "int", "template.timeout"),
                ("service_account", "string", "template.service_account"),
                ("labels", "string", "labels"),
            ),
            with_service=True,
        ),
        ResourceTable(
            "bronze_gcp_cloudrun_revisions",
            fields(
                ("resource_id", "string", "name"),
                ("revision_name", "string", "name"),
                ("service_name", "string", "service"),
                ("region", "string", None),
                ("vcpu_limit", "string", None),
                ("memory_limit", "string", None),
                ("concurrency_max", "int", "max_instance_request_concurrency"),
                ("min_instances", "int", "scaling.min_instance_count"),
                ("max_instances", "int", "scaling.max_instance_count"),
                ("timeout_seconds", "int", "timeout"),
                ("execution_environment", "string", "execution_environment"),
                ("labels", "string", "labels"),
            ),
            fetched=False,
        ),
    ),
    (
        MetricSpec("run.googleapis.com/request_count", "Count", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/container/instance_count", "Count", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/container/instance_count", "Count", "Percentile", "PT5M", 95),
        MetricSpec("run.googleapis.com/container/cpu/utilizations", "Percent", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/container/cpu/utilizations", "Percent", "Percentile", "PT5M", 95),
        MetricSpec("run.googleapis.com/container/memory/utilizations", "Percent", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/container/memory/utilizations", "Percent", "Percentile", "PT5M", 95),
        MetricSpec("run.googleapis.com/container/network/received_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/container/network/sent_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/request_concurrency", "Count", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/request_concurrency", "Count", "Percentile", "PT5M", 95),
        MetricSpec("run.googleapis.com/request_latencies", "Milliseconds", "Average", "PT5M"),
        MetricSpec("run.googleapis.com/request_latencies", "Milliseconds", "Percentile", "PT5M", 95),
    ),
    tags=("registered",),
)

CLOUD_FUNCTIONS = Service(
    "CLOUD_FUNCTIONS",
    "cloudfunctions.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_cloud_functions",
            fields(
                ("project_id", "string", None),
                ("location", "string", None),
                ("function_name", "string", "name"),
                ("description", "string", "description"),
                ("state", "string", "state"),
                ("environment", "string", "environment"),
                ("runtime", "string", "build_config.runtime"),
                ("entry_point", "string", "build_config.entry_point"),
                ("available_memory", "string", "service_config.available_memory"),
                ("available_cpu", "string", "service_config.available_cpu"),
                ("timeout_seconds", "double", "service_config.timeout_seconds"),
                ("min_instance_count", "double", "service_config.min_instance_count"),
                ("max_instance_count", "double", "service_config.max_instance_count"),
                ("max_instance_request_concurrency", "double", "service_config.max_instance_request_concurrency"),
                ("ingress_settings", "string", "service_config.ingress_settings"),
                ("vpc_connector", "string", "service_config.vpc_connector"),
                ("service_account_email", "string", "service_config.service_account_email"),
                ("uri", "string", "service_config.uri"),
                ("build_id", "string", "build_config.build"),
                ("docker_repository", "string", "build_config.docker_repository"),
                ("labels", "map<string,string>", "labels"),
                ("create_time", "string", "create_time"),
                ("update_time", "string", "update_time"),
            ),
            id_fields=("project_id", "location", "function_name"),
        ),
    ),
    (
        MetricSpec("cloudfunctions.googleapis.com/function/execution_count", "Count", "Average", "PT5M"),
        MetricSpec("cloudfunctions.googleapis.com/function/active_instances", "Count", "Average", "PT5M"),
        MetricSpec("cloudfunctions.googleapis.com/function/user_memory_bytes", "Bytes", "Average", "PT5M"),
        MetricSpec("cloudfunctions.googleapis.com/function/execution_times", "ns", "Average", "PT5M"),
        MetricSpec("cloudfunctions.googleapis.com/function/instance_count", "Count", "Average", "PT5M"),
        MetricSpec("cloudfunctions.googleapis.com/function/network_egress", "Bytes", "Average", "PT5M"),
        MetricSpec("cloudfunctions.googleapis.com/function/missed_execution_count", "Count", "Average", "PT5M"),
    ),
)

CLOUD_BUILD = Service(
    "CloudBuild",
    "cloudbuild.googleapis.com/Build",
    (
        ResourceTable(
            "bronze_gcp_cloudbuild_triggers",
            fields(
                ("resource_id", "string", "id"),
                ("resource_name", "string", "name"),
                ("description", "string", "description"),
                ("trigger_type", "string", None),
                ("disabled", "boolean", "disabled"),
                ("filename", "string", "filename"),
                ("repo_type", "string", "trigger_template.repo_type"),
                ("repo_name", "string", "trigger_template.repo_name"),
                ("branch_name", "string", "trigger_template.branch_name"),
                ("tag_name", "string", "trigger_template.tag_name"),
                ("substitutions", "string", "substitutions"),
                ("included_files", "string", "included_files"),
                ("ignored_files", "string", "ignored_files"),
            ),
            with_service=True,
        ),
        ResourceTable(
            "bronze_gcp_cloudbuild_builds",
            fields(
                ("resource_id", "string", "id"),
                ("build_id", "string", "id"),
                ("project_id", "string", "project_id"),
                ("status", "string", "status"),
                ("create_time", "string", "create_time"),
                ("start_time", "string", "start_time"),
                ("finish_time", "string", "finish_time"),
                ("timeout", "string", "timeout"),
                ("images", "string", "images"),
                ("queue_ttl", "string", "queue_ttl"),
                ("logs_bucket", "string", "logs_bucket"),
                ("source_type", "string", "source.storage_source"),
                ("steps_count", "int", "steps"),
                ("substitutions", "string", "substitutions"),
                ("tags", "string", "tags"),
                ("service_account", "string", "service_account"),
                ("machine_type", "string", "options.machine_type"),
            ),
            with_service=True,
        ),
    ),
    (
        MetricSpec("cloudbuild.googleapis.com/build/count", "Count", "Average", "PT5M"),
        MetricSpec("cloudbuild.googleapis.com/build/count", "Count", "Percentile", "PT5M", 95),
        MetricSpec("cloudbuild.googleapis.com/build/trigger_count", "Count", "Average", "PT5M"),
        MetricSpec("cloudbuild.googleapis.com/build/duration", "Seconds", "Average", "PT5M"),
        MetricSpec("cloudbuild.googleapis.com/build/duration", "Seconds", "Percentile", "PT5M", 95),
        MetricSpec("cloudbuild.googleapis.com/build/duration", "Seconds", "Maximum", "PT5M"),
        MetricSpec("cloudbuild.googleapis.com/build/concurrent_builds", "Count", "Average", "PT5M"),
        MetricSpec("cloudbuild.googleapis.com/build/concurrent_builds", "Count", "Percentile", "PT5M", 95),
        MetricSpec("cloudbuild.googleapis.com/build/queue_time", "Seconds", "Average", "PT5M"),
        MetricSpec("cloudbuild.googleapis.com/build/status", "Count", "Average", "PT5M"),
    ),
    tags=("registered",),
)

DATAFLOW = Service(
    "Dataflow",
    "dataflow.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_dataflow_jobs",
            fields(
                ("project_id", "string", None),
                ("region", "string", None),
                ("job_id", "string", "id"),
                ("job_name", "string", "name"),
                ("job_type", "string", "type"),
                ("current_state", "string", "currentState"),
                ("current_state_time", "string", "currentStateTime"),
                ("runner_config", "string", None),
                ("sdk_version", "string", None),
                ("environment_worker_zone", "string", None),
                ("environment_machine_type", "string", None),
                ("environment_max_workers", "double", None),
                ("environment_num_workers", "double", None),
                ("environment_disk_size_gb", "double", None),
                ("environment_network", "string", None),
                ("environment_subnetwork", "string", None),
                ("environment_service_account", "string", None),
                ("environment_temp_location", "string", None),
                ("environment_experiments", "string", None),
                ("create_time", "string", "createTime"),
                ("start_time", "string", "startTime"),
                ("labels", "map<string,string>", "labels"),
            ),
            id_fields=("project_id", "region", "job_id"),
            with_service=True,
            fetched=False,
        ),
    ),
    (
        MetricSpec("dataflow.googleapis.com/job/element_count", "Count", "Average", "PT1H"),
        MetricSpec("dataflow.googleapis.com/job/system_lag", "Seconds", "Average", "PT1H"),
        MetricSpec("dataflow.googleapis.com/job/system_lag", "Seconds", "Percentile", "PT1H", 95),
        MetricSpec("dataflow.googleapis.com/job/data_watermark_lag", "Seconds", "Average", "PT1H"),
        MetricSpec("dataflow.googleapis.com/job/current_num_vcpus", "Count", "Average", "PT1H"),
        MetricSpec("dataflow.googleapis.com/job/current_num_vcpus", "Count", "Percentile", "PT1H", 95),
        MetricSpec("dataflow.googleapis.com/job/cpu_utilization", "Ratio", "Average", "PT1H"),
        MetricSpec("dataflow.googleapis.com/job/cpu_utilization", "Ratio", "Percentile", "PT1H", 95),
        MetricSpec("dataflow.googleapis.com/job/estimated_bytes", "Bytes", "Percentile", "PT1H", 95),
        MetricSpec("dataflow.googleapis.com/job/memory_usage", "Bytes", "Percentile", "PT1H", 95),
    ),
)

CLOUD_SCHEDULER = Service(
    "Cloud Scheduler",
    "scheduler.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_cloud_scheduler",
            fields(
                ("project_id", "string", None),
                ("job_name", "string", "name"),
                ("description", "string", "description"),
                ("schedule", "string", "schedule"),
                ("time_zone", "string", "time_zone"),
                ("state", "string", "state"),
                ("attempt_deadline", "string", "attempt_deadline"),
                ("retry_count", "int", "retry_config.retry_count"),
                ("min_backoff_duration", "string", "retry_config.min_backoff_duration"),
                ("max_backoff_duration", "string", "retry_config.max_backoff_duration"),
                ("max_doublings", "int", "retry_config.max_doublings"),
                ("http_target_url", "string", "http_target.uri"),
                ("http_target_http_method", "string", "http_target.http_method"),
                ("http_target_body", "string", "http_target.body"),
                ("pubsub_target_topic_name", "string", "pubsub_target.topic_name"),
                ("pubsub_target_data", "string", "pubsub_target.data"),
                ("app_engine_target_service", "string", "app_engine_target.service"),
                ("app_engine_target_version", "string", "app_engine_target.version"),
                ("app_engine_target_host", "string", "app_engine_target.host"),
                ("app_engine_target_relative_uri", "string", "app_engine_target.relative_uri"),
                ("oidc_token_service_account_email", "string", "oidc_token.service_account_email"),
                ("oidc_token_audience", "string", "oidc_token.audience"),
                ("oauth_token_service_account_email", "string", "oauth_token.service_account_email"),
                ("oauth_token_scope", "string", "oauth_token.scope"),
                ("labels", "map<string,string>", "labels"),
                ("create_time", "string", "create_time"),
                ("update_time", "string", "update_time"),
                ("last_attempt_time", "string", "last_attempt_time"),
            ),
            id_fields=("project_id", "job_name"),
        ),
    ),
    (
        MetricSpec("scheduler.googleapis.com/job/attempt_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/attempt_success_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/attempt_failure_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/latency", "Milliseconds", "Mean", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/error_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/timeout_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/permission_denied_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/http_2xx_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/http_4xx_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/http_5xx_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/pubsub_success_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/pubsub_failure_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/appengine_success_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/appengine_failure_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/retry_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/retry_success_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/retry_failure_count", "Count", "Sum", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/active_count", "Count", "Gauge", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/paused_count", "Count", "Gauge", "PT5M"),
        MetricSpec("scheduler.googleapis.com/job/disabled_count", "Count", "Gauge", "PT5M"),
    ),
    tags=("catalog",),
)
