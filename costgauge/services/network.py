"""Network services."""

from __future__ import annotations

from costgauge.operators.timeseries import MetricSpec
from costgauge.services.declare import ResourceTable, Service, fields

# Fixed values in all declarations: names of tables, columns and metrics, types, source paths, units, intervals.
CLOUD_NAT = Service(
    "CloudNAT",
    "compute.googleapis.com/Router",
    (
        ResourceTable(
            "bronze_gcp_cloudnat_gateways",
            fields(
                ("resource_id", "string", "id"),
                ("resource_name", "string", "name"),
                ("region", "string", "region"),
                ("nat_ip_allocate_option", "string", "nat_ip_allocate_option"),
                ("source_subnetwork_ip_ranges_to_nat", "string", "source_subnetwork_ip_ranges_to_nat"),
                ("nat_ips", "string", "nat_ips"),
                ("min_ports_per_vm", "int", "min_ports_per_vm"),
                ("max_ports_per_vm", "int", "max_ports_per_vm"),
                ("enable_dynamic_port_allocation", "boolean", "enable_dynamic_port_allocation"),
                ("enable_endpoint_independent_mapping", "boolean", "enable_endpoint_independent_mapping"),
                ("log_config_enable", "boolean", "log_config.enable"),
                ("log_config_filter", "string", "log_config.filter"),
                ("subnetworks", "string", "subnetworks"),
            ),
            with_service=True,
        ),
    ),
    (
        MetricSpec("router.googleapis.com/nat/sent_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("router.googleapis.com/nat/sent_bytes_count", "Bytes", "Percentile", "PT5M", 95),
        MetricSpec("router.googleapis.com/nat/received_bytes_count", "Bytes", "Average", "PT5M"),
        MetricSpec("router.googleapis.com/nat/received_bytes_count", "Bytes", "Percentile", "PT5M", 95),
        MetricSpec("router.googleapis.com/nat/open_connections", "Count", "Average", "PT5M"),
        MetricSpec("router.googleapis.com/nat/open_connections", "Count", "Percentile", "PT5M", 95),
        MetricSpec("router.googleapis.com/nat/allocated_ports", "Count", "Average", "PT5M"),
        MetricSpec("router.googleapis.com/nat/allocated_ports", "Count", "Percentile", "PT5M", 95),
        MetricSpec("router.googleapis.com/nat/closed_connections_count", "Count", "Average", "PT5M"),
        MetricSpec("router.googleapis.com/nat/port_usage", "Percent", "Average", "PT5M"),
        MetricSpec("router.googleapis.com/nat/port_usage", "Percent", "Percentile", "PT5M", 95),
        MetricSpec("router.googleapis.com/nat/nat_allocation_failed", "Count", "Average", "PT5M"),
    ),
    tags=("registered",),
)

CLOUD_ROUTER = Service(
    "CloudRouter",
    "router.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_cloudrouter_routers",
            fields(
                ("project_id", "string", None),
                ("region", "string", "region"),
                ("router_name", "string", "name"),
                ("description", "string", "description"),
                ("network", "string", "network"),
                ("bgp_asn", "double", "bgp.asn"),
                ("bgp_advertise_mode", "string", "bgp.advertise_mode"),
                ("bgp_advertised_groups", "string", "bgp.advertised_groups"),
                ("bgp_advertised_ip_ranges", "string", "bgp.advertised_ip_ranges"),
                ("encrypted_interconnect_router", "string", "encrypted_interconnect_router"),
                ("creation_timestamp", "string", "creation_timestamp"),
                ("self_link", "string", "self_link"),
                ("kind", "string", "kind"),
            ),
            id_fields=("project_id", "region", "router_name"),
            with_service=True,
        ),
        ResourceTable(
            "bronze_gcp_cloudrouter_bgp_peers",
            fields(
                ("project_id", "string", None),
                ("region", "string", None),
                ("router_name", "string", None),
                ("peer_name", "string", "name"),
                ("peer_asn", "double", "peer_asn"),
                ("interface_name", "string", "interface_name"),
                ("ip_address", "string", "ip_address"),
                ("peer_ip_address", "string", "peer_ip_address"),
                ("advertised_route_priority", "double", "advertised_route_priority"),
                ("advertise_mode", "string", "advertise_mode"),
                ("management_type", "string", "management_type"),
                ("enable", "string", "enable"),
                ("enable_ipv6", "string", "enable_ipv6"),
                ("bfd_session_initialization_mode", "string", "bfd.session_initialization_mode"),
                ("bfd_min_transmit_interval", "double", "bfd.min_transmit_interval"),
                ("bfd_min_receive_interval", "double", "bfd.min_receive_interval"),
                ("bfd_multiplier", "double", "bfd.multiplier"),
            ),
            id_fields=("project_id", "region", "router_name", "peer_name"),
            with_service=True,
            fetched=False,
        ),
    ),
    (
        MetricSpec("router.googleapis.com/bgp/session_up", "Bool", "Average", "PT1H"),
        MetricSpec("router.googleapis.com/bgp/received_routes_count", "Count", "Average", "PT1H"),
        MetricSpec("router.googleapis.com/bgp/received_routes_count", "Count", "Percentile", "PT1H", 95),
        MetricSpec("router.googleapis.com/bgp/sent_routes_count", "Count", "Average", "PT1H"),
        MetricSpec("router.googleapis.com/nat/allocated_ports", "Count", "Average", "PT1H"),
        MetricSpec("router.googleapis.com/nat/port_usage", "Count", "Percentile", "PT1H", 95),
        MetricSpec("router.googleapis.com/nat/port_usage", "Count", "Average", "PT1H"),
        MetricSpec("router.googleapis.com/nat/nat_ip_count", "Count", "Average", "PT1H"),
        MetricSpec("router.googleapis.com/nat/nat_ip_count", "Count", "Percentile", "PT1H", 95),
        MetricSpec("router.googleapis.com/nat/dropped_sent_packets_count", "Count", "Average", "PT1H"),
    ),
)

CLOUD_CDN = Service(
    "Cloud CDN",
    "loadbalancing.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_cloud_cdn",
            fields(
                ("project_id", "string", None),
                ("url_map_name", "string", "name"),
                ("description", "string", "description"),
                ("default_service", "string", "default_service"),
                ("cdn_enabled", "boolean", None),
                ("cache_mode", "string", None),
                ("client_ttl", "int", None),
                ("max_ttl", "int", None),
                ("default_ttl", "int", None),
                ("negative_caching", "boolean", None),
                ("serve_while_stale", "boolean", None),
                ("bypass_cache_on_request_headers", "string", None),
                ("compressed", "boolean", None),
                ("region", "string", "region"),
                ("labels", "map<string,string>", "resource_labels"),
                ("create_time", "string", "creation_timestamp"),
                ("update_time", "string", None),
            ),
            id_fields=("project_id", "url_map_name"),
        ),
    ),
    (
        MetricSpec("loadbalancing.googleapis.com/https/request_count", "Count", "Sum", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/backend_request_count", "Count", "Sum", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/response_count", "Count", "Sum", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/cache_hit_count", "Count", "Sum", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/cache_miss_count", "Count", "Sum", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/cache_fill_bytes", "Bytes", "Sum", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/total_latencies", "Milliseconds", "Mean", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/backend_latencies", "Milliseconds", "Mean", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/sent_bytes_count", "Bytes", "Sum", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/received_bytes_count", "Bytes", "Sum", "PT5M"),
    ),
    tags=("catalog",),
)

CLOUD_DNS = Service(
    "Cloud DNS",
    "dns.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_cloud_dns",
            fields(
                ("project_id", "string", None),
                ("zone_name", "string", "name"),
                ("description", "string", "description"),
                ("dns_name", "string", "dns_name"),
                ("visibility", "string", "visibility"),
                ("creation_time", "string", "creation_time"),
                ("labels", "map<string,string>", "labels"),
                ("name_server_set", "string", "name_server_set"),
                ("peering_config", "string", None),
                ("forwarding_config", "string", None),
                ("service_directory_config", "string", None),
                ("record_set_count", "int", None),
            ),
            id_fields=("project_id", "zone_name"),
        ),
    ),
    (
        MetricSpec("dns.googleapis.com/query_count", "Count", "Sum", "PT5M"),
        MetricSpec("dns.googleapis.com/response_count", "Count", "Sum", "PT5M"),
        MetricSpec("dns.googleapis.com/success_count", "Count", "Sum", "PT5M"),
        MetricSpec("dns.googleapis.com/rcode_count", "Count", "Sum", "PT5M"),
        MetricSpec("dns.googleapis.com/latency", "Milliseconds", "Mean", "PT5M"),
        MetricSpec("dns.googleapis.com/nxdomain_count", "Count", "Sum", "PT5M"),
        MetricSpec("dns.googleapis.com/servfail_count", "Count", "Sum", "PT5M"),
        MetricSpec("dns.googleapis.com/formerr_count", "Count", "Sum", "PT5M"),
        MetricSpec("dns.googleapis.com/record_set_count", "Count", "Gauge", "PT5M"),
        MetricSpec("dns.googleapis.com/zone_count", "Count", "Gauge", "PT5M"),
    ),
    tags=("catalog",),
)

CLOUD_ARMOR = Service(
    "CloudArmor",
    "networksecurity.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_security_policies",
            fields(
                ("resource_id", "string", "id"),
                ("resource_name", "string", "name"),
                ("description", "string", "description"),
                ("type", "string", "type_"),
                ("fingerprint", "string", "fingerprint"),
            ),
        ),
    ),
    (
        MetricSpec("networksecurity.googleapis.com/external_waf/request_count", "Count", "Average", "PT5M"),
    ),
)

CLOUD_LOAD_BALANCER = Service(
    "CloudLoadBalancer",
    "loadbalancing.googleapis.com",
    (
        ResourceTable(
            "bronze_gcp_loadbalancer_forwarding_rules",
            fields(
                ("resource_id", "string", "id"),
                ("resource_name", "string", "name"),
                ("region", "string", "region"),
                ("network", "string", "network"),
                ("load_balancing_scheme", "string", "load_balancing_scheme"),
                ("ip_address", "string", "I_p_address"),
                ("ip_protocol", "string", "I_p_protocol"),
                ("port_range", "string", "port_range"),
                ("backend_service", "string", "backend_service"),
                ("description", "string", "description"),
            ),
        ),
        ResourceTable(
            "bronze_gcp_loadbalancer_backend_services",
            fields(
                ("resource_id", "string", "id"),
                ("resource_name", "string", "name"),
                ("protocol", "string", "protocol"),
                ("port", "int", "port"),
                ("health_checks", "string", "health_checks"),
                ("session_affinity", "string", "session_affinity"),
                ("load_balancing_scheme", "string", "load_balancing_scheme"),
                ("description", "string", "description"),
            ),
        ),
    ),
    (
        MetricSpec("loadbalancing.googleapis.com/https/request_count", "Count", "Average", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/backend_latencies", "Milliseconds", "Average", "PT5M"),
        MetricSpec("loadbalancing.googleapis.com/https/response_bytes_count", "Bytes", "Average", "PT5M"),
    ),
)
