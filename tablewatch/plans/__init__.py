"""End-to-end jobs: anomaly detection (detect), SQL and catalog access
(catalog)."""
