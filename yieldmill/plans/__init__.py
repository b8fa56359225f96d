"""Warehouse plans: staging, dimensions, facts, telemetry and marts."""
