"""Sources (readers) and sinks (raw table, audit log)."""
