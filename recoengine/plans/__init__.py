"""End-to-end jobs (loader, statistics, offline, parameter search,
streaming) and the registry of driver queries."""
