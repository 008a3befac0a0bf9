"""Reading and writing: tables, messages, derived telemetry."""
