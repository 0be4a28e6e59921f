"""Agent telemetry analytics as Spark jobs: evaluation runs, span trees, monitoring, calibration."""
