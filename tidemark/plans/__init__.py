"""User-facing jobs (recovery, KPI reports, lineage) and the query registry."""
