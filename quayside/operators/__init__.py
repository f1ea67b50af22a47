"""DataFrame -> DataFrame operators: selection, tables, audit, sinks, telemetry."""
